"""The library's operators as named queries over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions.numbers import l2_normalize
from labelmill.functions.text import strip_text
from labelmill.operators import analyze, clean, similarity, split
from labelmill.operators.embed import HashedTokenEncoder, embed, embed_cached
from labelmill.operators.formats import get_format
from labelmill.operators.rank import add_ids
from labelmill.operators.records import prefixed, to_json_lines, to_records
from labelmill.plans import jobs
from labelmill.sources.members import (
    Member,
    load_folder,
    load_samples,
    load_separated,
    member_counts,
    separate,
)
from labelmill.sources.sinks import export
from labelmill.sources.staging import Staging, shared_folder

LABELS = ("keep", "drop")
PROMPT = "Answer keep or drop."
PREFIX = "Judge this text:\n"
DIM = 64

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__.removesuffix("_query")] = run
    return run


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/labelmill/{uuid.uuid4().hex}"


def _cores(spark: SparkSession) -> int:
    """Tasks for costly work on the given tables, which are one file with one row group each."""
    return spark.sparkContext.defaultParallelism


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as samples: 20 members, one of them ``new``; labels from the review table."""
    labels = _table(spark, sf, "labels")
    label = (
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 1, "keep")
        .when(F.col("quality").isNotNull(), "drop")
    )
    return (
        _table(spark, sf, "documents")
        .join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("seq"),
            F.when(F.col("source") == "src19", "new").otherwise(F.col("source")).alias("sheet"),
            strip_text(F.col("text")).alias("input"),
            label.alias("output"),
        )
    )


def regular_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean(separate(samples(spark, sf))[0], LABELS)


def all_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Regular and new rows, each cleaned among themselves."""
    tagged = samples(spark, sf).withColumn("is_new", F.col("sheet") == "new")
    return clean.clean(tagged, LABELS, within=["is_new"])


def staged_clean(spark: SparkSession, sf: str) -> DataFrame:
    """``all_clean``, written down for operators that read their input several times."""
    return Staging(spark).table(all_clean(spark, sf), "cleaned")


def sets(spark: SparkSession, sf: str) -> DataFrame:
    """Split regular rows with the new ones injected."""
    regular, new = separate(staged_clean(spark, sf).drop("is_new"))
    return split.inject_new(split.split_dataset(regular), new)


# Sources


def _members(spark: SparkSession, sf: str) -> dict[str, Member | str]:
    docs = _table(spark, sf, "documents").withColumnRenamed("lang", "role")
    return {
        "conversations": f"{sf}/conversations.parquet",
        "benchmark": f"{sf}/benchmark.parquet",  # has no role: skipped
        "new": Member(docs, order_col="doc_id"),
    }


@query
def load_samples_query(spark, sf):
    rows = load_samples(spark, _members(spark, sf), "text", "role")
    return rows.select(
        "seq", "sheet", F.md5("input").alias("input_md5"), F.col("output").alias("role")
    )


@query
def load_separated_counts(spark, sf):
    regular, new = load_separated(
        spark, _members(spark, sf), "new", input_col="text", output_col="role"
    )
    both = regular.withColumn("part", F.lit("regular")).unionByName(
        new.withColumn("part", F.lit("new"))
    )
    return both.groupBy("part").agg(
        F.count("*").alias("rows"), F.sum(F.length("input")).alias("chars")
    )


def _per_member(rows: DataFrame) -> DataFrame:
    """Rows, characters, a sum over hashes, and the first and last number of each member."""
    text = F.concat_ws("|", F.coalesce("input", F.lit("-")), F.coalesce("output", F.lit("-")))
    return rows.groupBy("sheet").agg(
        F.count("*").alias("rows"),
        F.sum(F.length("input")).alias("chars"),
        F.sum(_hash(text)).alias("hashes"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.count_distinct("seq").alias("numbers"),
    )


def _hash(text) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


@query
def load_folder_counts(spark, sf):
    """All documents written as a folder of members, one for each source, and read as one table."""
    path = _scratch(spark)
    docs = _table(spark, sf, "documents").select(
        F.col("source").alias("sheet"), F.col("text").alias("input"), F.col("lang").alias("output")
    )
    docs.write.partitionBy("sheet").parquet(path)
    return _per_member(load_folder(spark, path))


@query
def load_csv_members(spark, sf):
    """All conversations as CSV and all documents as JSON lines, read as two members."""
    path = _scratch(spark)
    turns = _table(spark, sf, "conversations").repartitionByRange("conv_id", "turn")
    options = {"header": "true", "multiLine": "true", "escape": "\"", "quoteAll": "true"}
    turns.select("text", "role").write.options(**options).csv(f"{path}/conversations")
    docs = _table(spark, sf, "documents").repartitionByRange("doc_id")
    docs.select("text", F.col("lang").alias("role")).write.json(f"{path}/documents")
    members = {
        "conversations": Member(f"{path}/conversations", "csv", options),
        "documents": Member(f"{path}/documents", "json"),
    }
    return _per_member(load_samples(spark, members, "text", "role"))


@query
def member_counts_query(spark, sf):
    counts = member_counts(samples(spark, sf))
    return counts.withColumn("sheet", F.coalesce("sheet", F.lit("all")))


# Cleaning


@query
def normalize_text(spark, sf):
    padded = F.concat(F.lit("　 \t\x1f"), F.col("text"), F.lit(" \r\n "))
    stripped = strip_text(padded)
    return _table(spark, sf, "documents").select(
        "doc_id", F.length(stripped).cast("long").alias("chars"), F.md5(stripped).alias("text_md5")
    )


@query
def null_tokens(spark, sf):
    spelled = samples(spark, sf).withColumn("output", F.coalesce("output", F.lit("nan")))
    blanked = clean.blank_tokens(spelled)
    return blanked.select(
        "seq",
        F.coalesce("output", F.lit("-")).alias("output"),
        F.col("input").isNull().alias("input_missing"),
    )


@query
def drop_null_rows(spark, sf):
    return clean.drop_null_rows(clean.blank_tokens(samples(spark, sf))).select(
        "seq", "sheet", "output"
    )


@query
def legal_labels(spark, sf):
    rows = clean.drop_null_rows(clean.blank_tokens(samples(spark, sf)))
    return clean.keep_legal(rows, LABELS).select("seq", "sheet", "output")


@query
def illegal_label_values(spark, sf):
    return clean.illegal_labels(samples(spark, sf), LABELS)


@query
def dedup_keep_last(spark, sf):
    return regular_clean(spark, sf).select("seq", "output", F.md5("input").alias("input_md5"))


@query
def dedup_whole_documents(spark, sf):
    docs = _table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"), F.col("text").alias("input")
    )
    return clean.keep_last(docs).select("seq", F.md5("input").alias("input_md5"))


@query
def validation_metrics(spark, sf):
    parts = F.when(F.col("sheet") == "new", "new").otherwise("regular")
    return clean.validation_metrics(samples(spark, sf).withColumn("part", parts), LABELS, ["part"])


# Split


@query
def label_counts(spark, sf):
    return split.label_counts(regular_clean(spark, sf))


@query
def stratified_split(spark, sf):
    rows = staged_clean(spark, sf).where("not is_new")
    return split.stratified_split(rows).select("seq", "output", "split")


@query
def random_split(spark, sf):
    rows = staged_clean(spark, sf).where("not is_new")
    return split.random_split(rows).select("seq", "output", "split")


@query
def split_fallback(spark, sf):
    """Each document its own label: no stratified split exists."""
    docs = _table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("output")
    )
    return split.split_dataset(docs)


@query
def split_by_source(spark, sf):
    """Twenty labels."""
    docs = _table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"), F.col("source").alias("output")
    )
    return split.split_dataset(docs, split.SplitRatios(0.7, 0.2, 0.1), seed=7)


@query
def split_null_labels(spark, sf):
    """Uncleaned samples: most have no label."""
    rows = Staging(spark).table(samples(spark, sf).select("seq", "output"), "samples")
    tagged = split.stratified_split(rows)
    return tagged.select("seq", F.coalesce("output", F.lit("-")).alias("output"), "split")


@query
def inject_new(spark, sf):
    return sets(spark, sf).select("split", "injected", "seq", "output")


@query
def split_summary(spark, sf):
    summary = split.split_summary(sets(spark, sf))
    return summary.withColumn("output", F.coalesce("output", F.lit("all")))


@query
def record_ids(spark, sf):
    return add_ids(sets(spark, sf), ["split"], ["injected"], width=64).select("split", "id", "seq")


@query
def ids_null_group(spark, sf):
    """Ids within labels, of which most are missing."""
    rows = add_ids(samples(spark, sf).select("seq", "output"), ["output"], width=64)
    return rows.select(F.coalesce("output", F.lit("-")).alias("output"), "id", "seq")


@query
def record_ids_sparse(spark, sf):
    """Numbers far apart, as byte offsets are."""
    docs = _table(spark, sf, "documents")
    rows = docs.select("source", (F.col("doc_id") * 200_000).alias("seq"))
    return add_ids(rows, ["source"], width=64)


# Records


def _turns(json: str, key: str, text_key: str) -> list:
    who = ("system", "user", "assistant")
    return [
        F.get_json_object(json, f"$.{key}[{i}].{field}").alias(f"{name}_{out}")
        for i, name in enumerate(who)
        for field, out in (("role", "role"), (text_key, "text"))
    ]


def _lines(spark, sf, fmt, prefix=""):
    rows = all_clean(spark, sf)
    if get_format(fmt).with_id:
        rows = add_ids(staged_clean(spark, sf), [], ["is_new"])
    return to_json_lines(to_records(rows, fmt, PROMPT, prefix))


@query
def prefix_input(spark, sf):
    return regular_clean(spark, sf).select(
        "seq", F.md5(prefixed(F.col("input"), PREFIX)).alias("input_md5")
    )


@query
def record_openai(spark, sf):
    return _lines(spark, sf, "openai").select("seq", *_turns("json", "messages", "content"))


@query
def record_internal(spark, sf):
    lines = _lines(spark, sf, "internal", PREFIX)
    return lines.select(
        "seq",
        F.get_json_object("json", "$.id").cast("long").alias("id"),
        *_turns("json", "conversations", "context"),
    )


@query
def record_ark(spark, sf):
    fields = ("instruction", "input", "output")
    return _lines(spark, sf, "ark").select(
        "seq", *(F.get_json_object("json", f"$.{f}").alias(f) for f in fields)
    )


def _read_back(spark: SparkSession, path: str, schema: str, texts: list[str]) -> DataFrame:
    """Records, ids (where the format has them), characters and hashes per written split."""
    ids = (
        F.min("r.id").alias("first_id"),
        F.max("r.id").alias("last_id"),
        F.count_distinct("r.id").alias("ids"),
    )
    with_id = schema.startswith("id ")
    record = F.concat_ws("|", *([F.col("r.id").cast("string")] if with_id else []), *map(F.expr, texts))
    return (
        spark.read.text(path)
        .withColumn("r", F.from_json("value", schema))
        .groupBy("split")
        .agg(
            F.count("r").alias("records"),
            *(ids if with_id else ()),
            F.sum(F.length(F.expr(texts[1]))).alias("chars"),
            F.sum(_hash(record)).alias("hashes"),
        )
    )


INTERNAL = "id long, conversations array<struct<role string, context string>>"
CONTEXTS = [f"r.conversations[{i}].context" for i in range(3)]


@query
def export_counts(spark, sf):
    path = _scratch(spark)
    export(sets(spark, sf), path, "internal", PROMPT)
    return _read_back(spark, path, INTERNAL, CONTEXTS)


@query
def export_array_counts(spark, sf):
    """Each part file of a JSON array read by itself: records, and a sum over their hashes."""
    path = _scratch(spark)
    export(sets(spark, sf), path, "ark", PROMPT)
    record = "array<struct<instruction string, input string, output string>>"
    whole = spark.read.text(path, wholetext=True).withColumn("r", F.from_json("value", record))
    text = F.concat_ws("|", "r.instruction", "r.input", "r.output")
    return (
        whole.select("split", F.explode("r").alias("r"))
        .groupBy("split")
        .agg(
            F.count("*").alias("records"),
            F.sum(_hash(text)).alias("hashes"),
        )
    )


# Reports


@query
def label_stats(spark, sf):
    return analyze.label_stats(analyze.histogram(all_clean(spark, sf)))


@query
def length_stats(spark, sf):
    return analyze.length_stats(analyze.histogram(all_clean(spark, sf)))


@query
def split_label_report(spark, sf):
    return analyze.label_stats(analyze.split_histogram(sets(spark, sf)))


@query
def split_report(spark, sf):
    return analyze.length_stats(analyze.split_histogram(sets(spark, sf)))


@query
def label_bars(spark, sf):
    """One line per source for the whole documents table."""
    docs = _table(spark, sf, "documents").select(
        F.col("text").alias("input"), F.concat_ws("/", "lang", "source").alias("output")
    )
    return analyze.label_lines(analyze.label_stats(analyze.histogram(docs)))


@query
def label_lines_many(spark, sf):
    """A label for each document and for each source: more than one task should rank."""
    docs = _table(spark, sf, "documents")
    hist = analyze.histogram(
        docs.select(
            F.explode(
                F.array(
                    F.struct(F.lit("documents").alias("dataset"), F.col("doc_id").cast("string").alias("output")),
                    F.struct(F.lit("sources").alias("dataset"), F.col("source").alias("output")),
                )
            ).alias("of"),
            F.col("text").alias("input"),
        ).select("of.*", "input")
    )
    return analyze.label_lines(analyze.label_stats(hist), most=0)


@query
def length_stats_empty_set(spark, sf):
    """Lengths by label as data sets, one of which has no rows."""
    hist = analyze.histogram(all_clean(spark, sf).withColumn("dataset", F.col("output")))
    return analyze.length_stats(hist, (*LABELS, "none"))


@query
def report_text(spark, sf):
    return analyze.report_lines(analyze.split_histogram(sets(spark, sf)))


# Similarity


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors = _table(spark, sf, "embeddings")
    return vectors.where("label = 1"), vectors.where("label = 0")


def _rounded(matches: DataFrame) -> DataFrame:
    return matches.withColumn("similarity", similarity.reported())


def _neighbours(spark, sf, k, threshold=None):
    queries, refs = _sides(spark, sf)
    return similarity.topk_cosine(queries, refs, k, threshold, "vec_id", "vec_id")


def _reviewed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = _table(spark, sf, "documents").join(_table(spark, sf, "labels"), "doc_id")
    return docs.where("toxic = 1"), docs.where("quality = 1 and toxic = 0")


def _halves(spark: SparkSession, sf: str, k: int) -> DataFrame:
    """All vectors: those of five labels against those of the others."""
    vectors = _table(spark, sf, "embeddings")
    low, high = vectors.where("label < 5"), vectors.where("label >= 5")
    return similarity.topk_cosine(low, high, k, None, "vec_id", "vec_id")


@query
def topk_cosine(spark, sf):
    return _rounded(_halves(spark, sf, 1))


@query
def topk3_cosine(spark, sf):
    return _rounded(_halves(spark, sf, 3))


@query
def nearest_few_references(spark, sf):
    """All vectors, of which only the references, those of one label, are few enough to be sent."""
    vectors = _table(spark, sf, "embeddings")
    queries, refs = vectors.where("label > 0"), vectors.where("label = 0")
    return _rounded(
        similarity.topk_cosine(
            queries, refs, 2, None, "vec_id", "vec_id", broadcast_bytes=128 << 10
        )
    )


@query
def all_nearest_vectors(spark, sf):
    """Both sides too big to broadcast: blocks meet pairwise."""
    vectors = _table(spark, sf, "embeddings")
    low, high = vectors.where("label < 5"), vectors.where("label >= 5")
    return _rounded(
        similarity.topk_cosine(
            low, high, 2, None, "vec_id", "vec_id", broadcast_bytes=0, block_bytes=128 << 10
        )
    )


@query
def near_documents(spark, sf):
    """Hashed vectors of all documents against all: regions that are too far apart do not meet."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    vectors = Staging(spark).table(embed(docs, HashedTokenEncoder(DIM), "text"), "vectors")
    return _rounded(
        similarity.topk_cosine(
            vectors, vectors, 3, 0.99, "doc_id", "doc_id", broadcast_bytes=0, block_bytes=512 << 10
        )
    )


@query
def conflict_pairs(spark, sf):
    """Neighbours at or above the threshold with the texts filed under the same ids."""
    flagged = similarity.flag(_neighbours(spark, sf, 3), 0.35)
    flagged = Staging(spark).table(flagged, "flagged")
    docs = _table(spark, sf, "documents")
    found = similarity.attach_texts(flagged, docs, docs, "doc_id", "doc_id", "text")
    return _rounded(found).orderBy(F.desc("similarity"), "q_id", "rank")


@query
def conflict_summary(spark, sf):
    queries, _ = _sides(spark, sf)
    flagged = similarity.flag(_neighbours(spark, sf, 3), 0.35)
    return similarity.conflict_summary(flagged, queries.count(), 0.35, 3, "q_id")


@query
def score_range(spark, sf):
    scores = similarity.score_range(_halves(spark, sf, 3))
    return scores.select(*(similarity.reported(c).alias(c) for c in scores.columns))


@query
def conflict_lexical(spark, sf):
    queries, refs = _reviewed(spark, sf)
    return _rounded(
        similarity.topk_lexical(queries, refs, 1, 0.9, "doc_id", "doc_id", "text", _cores(spark))
    )


@query
def topk3_lexical(spark, sf):
    queries, refs = _reviewed(spark, sf)
    return _rounded(
        similarity.topk_lexical(queries, refs, 3, None, "doc_id", "doc_id", "text", _cores(spark))
    )


@query
def lexical_all_documents(spark, sf):
    """The whole table against itself, by token counts."""
    docs = _table(spark, sf, "documents")
    return _rounded(
        similarity.topk_lexical(docs, docs, 3, 0.9, "doc_id", "doc_id", "text", _cores(spark))
    )


@query
def l2_normalize_query(spark, sf):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") * 2))
    return _table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(l2_normalize(scaled)).alias("pos", "value")
    ).select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


def _weights(vectors: DataFrame, *ids: str) -> DataFrame:
    return (
        vectors.select(*ids, F.posexplode("embedding").alias("bucket", "weight"))
        .where("weight <> 0")
        .select(*ids, F.col("bucket").cast("long"), F.col("weight").cast("double"))
    )


@query
def embed_hashed(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return _weights(embed(docs, HashedTokenEncoder(DIM), "text", tasks=_cores(spark)), "doc_id")


@query
def embedding_cache_merge(spark, sf):
    """Reviewed documents fill the cache, then all documents: only the others are encoded."""
    docs = _table(spark, sf, "documents")
    encoder, path = HashedTokenEncoder(DIM), _scratch(spark)

    def run(rows: DataFrame) -> DataFrame:
        texts = rows.groupBy(F.col("text").alias("input")).agg(F.min("doc_id").alias("doc_id"))
        return embed_cached(texts, encoder, path, encoder.encoder_id)

    run(docs.join(_table(spark, sf, "labels").select("doc_id"), "doc_id"))
    return _weights(run(docs), "doc_id")


# Jobs


@query
def job_full(spark, sf):
    run = jobs.full_job(samples(spark, sf), _scratch(spark), labels=LABELS, prompt=PROMPT)
    return _read_back(spark, run.records_path, INTERNAL, CONTEXTS)


@query
def job_split(spark, sf):
    run = jobs.split_job(
        samples(spark, sf), _scratch(spark), labels=LABELS, prompt=PROMPT, fmt="openai"
    )
    schema = "messages array<struct<role string, content string>>"
    return _read_back(
        spark, run.records_path, schema, [f"r.messages[{i}].content" for i in range(3)]
    )


@query
def job_convert(spark, sf):
    path, _ = jobs.convert_job(
        samples(spark, sf), _scratch(spark), labels=LABELS, prompt=PROMPT, prefix=PREFIX
    )
    return _read_back(spark, path, INTERNAL, CONTEXTS)


@query
def job_clean(spark, sf):
    path, _ = jobs.clean_job(samples(spark, sf), _scratch(spark), LABELS)
    return spark.read.parquet(path).select("output", F.md5("input").alias("input_md5"))


@query
def job_conflict(spark, sf):
    encoder = HashedTokenEncoder(DIM)
    run = jobs.conflict_job(
        samples(spark, sf),
        encoder,
        encoder.encoder_id,
        _scratch(spark),
        reference_label="keep",
        query_label="toxic",
        k=3,
        threshold=0.9,
    )
    return run.flagged.select(
        "seq", "rank", "similarity", F.md5("similar_text").alias("similar_md5")
    )
