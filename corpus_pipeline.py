"""A training-corpus pipeline over the documents table.

Toxic documents go, one document of each group of near duplicates stays, passages that stand in
several places are taken out, personal data is sanitised, and what is left is packed into token
sequences. Every stage works on all rows that the one before it kept.
"""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm import jaccard, packing, pii, repeats, toxicity
from labelmill.sources.staging import Staging

# Near duplicates: five words, a similarity of 0.8.
WORDS, NUM, DEN = 5, 80, 100
# Bytes of a repeated passage: under that of fifty short words.
PASSAGE_BYTES = 240
END_ID = 50256
# Bytes of rows that go to a Python worker at a time. A batch is held by the executor and by the
# worker, and workers stay from stage to stage, so this bounds what all stages add up to.
BATCH_BYTES = "4m"


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def mild(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the limit, by the label table's grades."""
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, toxicity.severity(F.col("quality"), F.col("toxic")))
    return toxicity.keep_mild(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each component of near duplicates."""
    _small_batches(spark)
    return jaccard.one_of_each(docs, words=WORDS, num=NUM, den=DEN)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand elsewhere too."""
    _small_batches(spark)
    return repeats.without_repeats(docs, length=PASSAGE_BYTES, length_col="n_chars")


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data named by its kind and what reveals it generalised."""
    _small_batches(spark)
    return pii.sanitised(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    _small_batches(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=END_ID)


STAGES = [
    ("toxicity", mild),
    ("n-gram Jaccard join", distinct),
    ("suffix-array dedup", unrepeated),
    ("PII", private),
    ("packing", packed),
]

# A fitted model, byte positions and a tokenizer decide, none of which SQL has.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again for the next."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = staging.table(stage(spark, docs, sf_dir), f"stage-{at}")
        if at:
            staging.drop(f"stage-{at - 1}")
    return docs
