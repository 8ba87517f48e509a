import pytest
from check_oracles import difference, duck

from labelmill.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert difference(spark, duck(sf), QUERIES[name], ORACLES[name], sf) is None
