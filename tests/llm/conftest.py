import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark, tmp_path):
    """Documents from (doc_id, text), with columns whose names operators use themselves."""

    def run(rows):
        schema = "doc_id long, text string"
        docs = spark.createDataFrame(rows, schema)
        for name in ("id", "row", "_row", "spans", "key", "n", "part", "node", "label"):
            docs = docs.withColumn(name, F.lit("own"))
        return docs

    return run


@pytest.fixture
def hard():
    """Nulls, empty and very long texts, repeated rows and ids, a null id."""
    long = " ".join(f"word{i % 977} é" for i in range(20_000))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "one two three four five six"),
        (5, "one two three four five six"),
        (5, "another text under the same id"),
        (None, "no id here at all"),
        (7, long),
        (8, long),
        (9, "日本語 text with 	odd  blanks\r\n\r\nand lines"),
    ]


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
