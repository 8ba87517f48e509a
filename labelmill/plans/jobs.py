"""The jobs users call: whole runs from samples to written results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.defaults import (
    ENCODER_BATCH,
    FORMAT,
    LEGAL_LABELS,
    NEW_SHEET,
    QUERY_LABEL,
    REFERENCE_LABEL,
    SEED,
    SYSTEM_PROMPT,
    THRESHOLD,
    TOPK,
    SplitRatios,
)
from labelmill.functions.text import text_key
from labelmill.operators import clean as cleaning
from labelmill.operators.analyze import WHOLE, split_histogram
from labelmill.operators.embed import EncoderFactory, embed_cached
from labelmill.operators.formats import RecordFormat, get_format
from labelmill.operators.similarity import (
    check_parameters,
    conflict_summary,
    flag,
    reported,
    score_range,
    topk_cosine,
)
from labelmill.operators.skew import ROWS_PER_SALT, salted_join
from labelmill.operators.split import inject_new, split_with_sizes
from labelmill.sources.members import in_member
from labelmill.sources.sinks import export, run_path, run_stamp, write_report, write_table
from labelmill.sources.staging import Staging

FULL_SET = "data"
SETS = ("train", "val", "test")


class EmptyResult(ValueError):
    """Cleaning left no rows; ``metrics`` tells why."""

    def __init__(self, metrics: Row) -> None:
        super().__init__(cleaning.validation_summary(metrics))
        self.metrics = metrics


@dataclass(frozen=True)
class SplitRun:
    """What a split run wrote, and its counters (``metrics`` by regular / new)."""

    records_path: str
    report_path: str | None
    sizes: dict[str, int]
    metrics: dict[str, Row]


def full_and_splits(sets: DataFrame) -> DataFrame:
    """Injected splits plus the full set ``data``, where an injected row appears only once."""
    copy = F.col("injected") & (F.col("split") != "train")
    names = F.when(copy, F.array("split")).otherwise(F.array("split", F.lit(FULL_SET)))
    return sets.withColumn("split", F.explode(names))


def _cleaned(
    staging: Staging, samples: DataFrame, labels: Sequence[str], is_new
) -> tuple[DataFrame, dict[str, Row]]:
    """Cleaned rows with their text lengths, written once, and the counters; regular and new rows
    are kept apart. The counters take a pass of their own: metrics observed on the way would count
    rows twice when a lost executor's tasks run again."""
    tagged = samples.withColumn("is_new", is_new)
    cleaned = cleaning.clean(tagged, labels, within=["is_new"])
    rows = staging.table(
        cleaned.withColumn("length", F.length("input").cast("long")), "cleaned"
    )
    counted = cleaning.validation_metrics(tagged, labels, by=["is_new"], cleaned=rows).collect()
    metrics = {"new" if m.is_new else "regular": m for m in counted}
    return rows, _valid(metrics, samples, labels)


def _valid(
    metrics: dict[str, Row], samples: DataFrame, labels: Sequence[str]
) -> dict[str, Row]:
    """The counters, unless no regular row is left."""
    if "regular" not in metrics or not metrics["regular"].is_valid:
        raise EmptyResult(
            metrics.get("regular")
            or cleaning.validation_metrics(samples.where(F.lit(False)), labels).first()
        )
    return metrics


def split_job(
    samples: DataFrame,
    output: str,
    labels: Sequence[str] = LEGAL_LABELS,
    new_sheet: str | None = NEW_SHEET,
    ratios: SplitRatios = SplitRatios(),
    seed: int = SEED,
    fmt: str | RecordFormat = FORMAT,
    prompt: str = SYSTEM_PROMPT,
    prefix: str = "",
    stamp: str | None = None,
    full_set: bool = False,
    report: bool = False,
) -> SplitRun:
    """Clean, split, inject the new rows into train and val, write the records.

    ``full_set`` adds the set ``data`` (all rows), ``report`` the text report.
    """
    fmt, stamp = get_format(fmt), stamp or run_stamp()
    with Staging(samples.sparkSession) as staging:
        rows, metrics = _cleaned(staging, samples, labels, in_member(new_sheet))
        regular = rows.where(~F.col("is_new")).drop("is_new")
        new = rows.where("is_new").drop("is_new")
        # Tagging only compares keys, so the tags are not worth writing down.
        tagged, cut = split_with_sizes(regular, ratios, seed, staging=staging)
        sets = inject_new(tagged, new)

        n_new = metrics["new"].final_count if "new" in metrics else 0
        sizes = {name: cut[name] + n_new * (name != "test") for name in SETS}
        if full_set:
            sizes[FULL_SET] = sum(m.final_count for m in metrics.values())
        records_path = run_path(output, "records", stamp, fmt.suffix)
        wanted = full_and_splits(sets) if full_set else sets
        export(wanted, records_path, fmt, prompt, prefix, sizes)

        report_path = None
        if report:
            report_path = run_path(output, "analysis_report", stamp, ".txt")
            hist = staging.table(split_histogram(sets), "histogram")
            write_report(hist, report_path, (WHOLE, *SETS), staging)
        return SplitRun(records_path, report_path, sizes, metrics)


def full_job(samples: DataFrame, output: str, report: bool = True, **options) -> SplitRun:
    """``split_job`` with the full set and the report."""
    return split_job(samples, output, full_set=True, report=report, **options)


def clean_job(
    samples: DataFrame,
    output: str,
    labels: Sequence[str] = LEGAL_LABELS,
    format: str = "parquet",
    stamp: str | None = None,
) -> tuple[str, Row]:
    """Write the cleaned (input, output) table of all members; (path, counters)."""
    tagged = samples.withColumn("is_new", F.lit(False))
    # Counted by text digests, so that the rows are written only once, as the result.
    counted = cleaning.validation_metrics(tagged, labels, by=["is_new"]).collect()
    metrics = _valid({"regular": m for m in counted}, samples, labels)
    path = run_path(output, "cleaned", stamp or run_stamp())
    cleaned = cleaning.clean(tagged, labels, within=["is_new"])
    write_table(cleaned.select("input", "output"), path, format)
    return path, metrics["regular"]


def convert_job(
    samples: DataFrame,
    output: str,
    labels: Sequence[str] = LEGAL_LABELS,
    fmt: str | RecordFormat = FORMAT,
    prompt: str = SYSTEM_PROMPT,
    prefix: str = "",
    skip_validation: bool = False,
    stamp: str | None = None,
) -> tuple[str, int]:
    """Write the records of all members, cleaned unless told otherwise; (path, rows)."""
    fmt = get_format(fmt)
    with Staging(samples.sparkSession) as staging:
        if skip_validation:
            # Ids are given in several reads; without them the source is read as it is.
            rows = staging.table(samples, "samples") if fmt.with_id else samples
        else:
            rows, _ = _cleaned(staging, samples, labels, F.lit(False))
            rows = rows.drop("is_new")
        path = run_path(output, "records", stamp or run_stamp(), fmt.suffix)
        sizes = export(
            rows.withColumn("split", F.lit(FULL_SET)),
            path,
            fmt,
            prompt,
            prefix,
            {FULL_SET: rows.count()},
        )
        return path, sizes[FULL_SET]


@dataclass(frozen=True)
class ConflictRun:
    """Flagged rows ``(seq, input, similarity, similar_text, rank)`` and one-row summaries.

    They read staged tables: call ``staging.clear()`` when done with them.
    """

    flagged: DataFrame
    summary: DataFrame
    range: DataFrame
    path: str | None
    staging: Staging


def conflict_job(
    samples: DataFrame,
    encoder: EncoderFactory,
    encoder_id: str,
    cache: str,
    output: str | None = None,
    reference_label: str = REFERENCE_LABEL,
    query_label: str = QUERY_LABEL,
    k: int = TOPK,
    threshold: float = THRESHOLD,
    batch_size: int = ENCODER_BATCH,
    refresh_cache: bool = False,
    format: str = "parquet",
    rows_per_salt: int = ROWS_PER_SALT,
) -> ConflictRun:
    """Flag query rows whose text is close to a reference text under a different label.

    Rows are not cleaned, but missing texts take no part. Both sides come from one scan. Each distinct
    text, on whichever side it is, is encoded once, unless the cache has it, and compared once; copies
    then count as often as they occur: a reference text with n rows fills up to n of a query's k
    places, and a query text yields its matches for each of its rows. Equally similar texts rank by
    their first row.
    """
    if encoder is None:
        raise RuntimeError("the conflict job needs an encoder")
    check_parameters(k, threshold)
    staging = Staging(samples.sparkSession)
    try:
        # One scan for both sides, in which a row may be on either.
        rows = cleaning.drop_null_rows(cleaning.blank_tokens(samples))
        asks, answers = F.col("output") == query_label, F.col("output") == reference_label
        labelled = staging.table(
            rows.where(asks | answers).select(
                "seq", "input", asks.alias("asks"), answers.alias("answers")
            ),
            "labelled",
        )
        # Each text once, whichever sides it is on: the first row and the number of rows of each.
        texts = staging.table(
            labelled.groupBy("input").agg(
                F.min(F.when(F.col("asks"), F.col("seq"))).alias("q_id"),
                F.count_if("asks").alias("q_rows"),
                F.min(F.when(F.col("answers"), F.col("seq"))).alias("r_id"),
                F.count_if("answers").alias("r_rows"),
            ),
            "texts",
        )
        n_queries, n_rows, n_refs = texts.agg(
            F.count("q_id"), F.coalesce(F.sum("q_rows"), F.lit(0)), F.count("r_id")
        ).first()
        if not n_queries:
            raise ValueError(f"no row is labelled {query_label!r}")
        if not n_refs:
            raise ValueError(f"no row is labelled {reference_label!r}")
        encoded = embed_cached(
            texts, encoder, cache, encoder_id, batch_size=batch_size, refresh=refresh_cache
        )
        vectors = staging.table(
            encoded.select("q_id", "r_id", "r_rows", "text_key", "embedding"), "vectors"
        )
        queries = vectors.where("q_id is not null").select("q_id", "embedding")
        refs = vectors.where("r_id is not null").select("r_id", "embedding")
        matches = staging.table(topk_cosine(queries, refs, k, staging=staging.part()), "matches")

        # A copy of a reference text ranks right behind the text's first row.
        most = k * n_queries
        copies = vectors.where("r_id is not null").select(
            "r_id", F.least(F.col("r_rows"), F.lit(k)).cast("int").alias("copies")
        )
        per_ref = matches.groupBy("r_id").agg(F.count("*").alias("n"))
        order = W.partitionBy("q_id").orderBy(F.desc("similarity"), "r_id", "copy")
        neighbours = staging.table(
            salted_join(matches, copies, "r_id", "q_id", per_ref, most, rows_per_salt)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
            .withColumn("rank", F.row_number().over(order).cast("long"))
            .where(F.col("rank") <= k)
            .select("q_id", "r_id", "rank", "similarity"),
            "neighbours",
        )

        # Texts are looked up for what is flagged, and then put back for each row of a query text.
        hits = flag(neighbours, threshold)
        hits_per_ref = hits.groupBy("r_id").agg(F.count("*").alias("n"))
        ref_texts = texts.where("r_id is not null").select("r_id", F.col("input").alias("similar_text"))
        found = salted_join(hits, ref_texts, "r_id", "q_id", hits_per_ref, most, rows_per_salt)
        own_texts = texts.where("q_id is not null").select("q_id", "input", "q_rows")
        by_text = found.join(own_texts, "q_id").select(
            text_key(F.col("input")).alias("key"), "similarity", "similar_text", "rank"
        )
        query_rows = labelled.where("asks").select("seq", "input", text_key(F.col("input")).alias("key"))
        per_text = own_texts.select(
            text_key(F.col("input")).alias("key"), F.col("q_rows").alias("n")
        )
        flagged = staging.table(
            salted_join(query_rows, by_text, "key", "seq", per_text, n_rows, rows_per_salt).select(
                "seq", "input", reported().alias("similarity"), "similar_text", "rank"
            ),
            "flagged",
        ).orderBy(F.desc("similarity"), "seq", "rank")
        if output:
            write_table(flagged.select("input", "similarity", "similar_text"), output, format)
        return ConflictRun(
            flagged,
            conflict_summary(flagged, n_rows, threshold, k),
            score_range(neighbours),
            output,
            staging,
        )
    except BaseException:
        staging.clear()
        raise
