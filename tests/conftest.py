import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from bench import session

    return session("8")


@pytest.fixture
def samples(spark):
    """FIXTURES.md 2.1."""
    rows = [
        (1, "Sheet1", "  我想了解一下万能险　", "寿险意图"),
        (2, "Sheet1", "今天天气怎么样", "拒识"),
        (3, "Sheet1", "", "拒识"),
        (4, "Sheet1", "nan", "寿险意图"),
        (5, "Sheet1", "帮我写一首诗", None),
        (6, "Sheet1", "请帮我办理理赔手续", "寿险相关"),
        (7, "Sheet1", "今天天气怎么样", "寿险意图"),
        (8, "Sheet1", "请帮我办理理赔手续", "寿险意图"),
        (9, "Sheet1", "请帮我办理理赔手续", "其他"),
        (10, "Sheet2", "帮我写一首诗", " 拒识 "),
        (11, "Sheet2", "None", "拒识"),
        (12, "Sheet2", "NONE", "拒识"),
        (13, "new", "保单怎么退保", "寿险意图"),
        (14, "new", "我想了解一下万能险", "寿险意图"),
    ]
    from labelmill.sources.members import Member, load_samples

    schema = "seq long, sheet string, input string, output string"
    df = spark.createDataFrame(rows, schema)
    notes = spark.createDataFrame([("x", "y")], "input string, remark string")
    # Each member starts where the one before it ends, so the numbers above come out again.
    members = {
        name: Member(df.where(df.sheet == name).withColumn("pos", df.seq - first), order_col="pos")
        for name, first in (("Sheet1", 0), ("Sheet2", 10), ("new", 13))
    } | {"notes": Member(notes, order_col="pos")}
    return load_samples(spark, members)
