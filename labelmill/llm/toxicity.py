"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

``P(grade >= j) = sigmoid(w.x - theta_j)`` with one weight vector for all grades and ordered
thresholds. Features say which hashed words and word beginnings a text has. The model is fitted on a
bounded sample of labelled rows; it scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import LOWER, Words, flat, slices, span_hashes
from labelmill.sources.staging import Staging

# Labelled rows of each grade that a fit may use, in order of a hash of their id.
SAMPLE_PER_GRADE = 5000
BITS = 18
# Lengths in bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
# Features that a fit keeps, and the documents of the sample that must have one.
FEATURES = 2000
LEAST_DOCS = 4
STEPS = 300
PENALTY = 1e-3
# Texts of this expected severity or more are rejected.
REJECT = 0.4
GRADES = 3

RESULT = "doc_id long, expected_severity double, grade int, p_toxic double, p_severe double"

LETTERS = np.zeros(256, bool)
LETTERS[128:] = LETTERS[48:58] = LETTERS[65:91] = LETTERS[97:123] = True


def severity(quality: Column, toxic: Column) -> Column:
    """Grades of the label table: 0 not toxic, 1 toxic, 2 toxic and of poor quality."""
    return F.when(toxic == 1, F.when(quality == 0, 2).otherwise(1)).when(toxic == 0, 0)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature number of each word and word beginning, repetitions included."""
    words = Words(data, offsets, LETTERS)
    lower = LOWER[data]
    row = words.row_of()
    rows, ids = [row], [span_hashes(lower, words.starts, words.ends)]
    for size in BEGINNINGS:
        longer = words.ends - words.starts > size
        starts = words.starts[longer]
        rows.append(row[longer])
        ids.append(span_hashes(lower, starts, starts + size) + np.uint64(size))
    mask = np.uint64((1 << BITS) - 1)
    return np.concatenate(rows), (np.concatenate(ids) & mask).astype(np.int64)


@dataclass
class OrdinalModel:
    """Weights of the kept features, and a threshold for each grade from 1 on."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, 50.0))

    def reach(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text and grade j >= 1 the probability of grade j or more."""
        rows, ids = features(data, offsets)
        count = len(offsets) - 1
        used = self.weights[ids] != 0
        pairs = np.unique(rows[used] << BITS | ids[used])
        score = np.bincount(
            pairs >> BITS, self.weights[pairs & ((1 << BITS) - 1)], minlength=count
        )
        return _sigmoid(score[:, None] - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_rows(
    grades: np.ndarray, rows: np.ndarray, ids: np.ndarray, weight: np.ndarray
) -> OrdinalModel:
    """Maximum likelihood with a small ridge penalty, by Adam over the whole sample.

    ``rows, ids`` list each kept feature of each row once; ``weight`` weighs rows. Grades that no row
    has get a threshold out of reach; without rows of two grades every text gets the one grade.
    """
    model = OrdinalModel()
    present = np.unique(grades)
    if len(present) < 2:
        model.thresholds = np.where(np.arange(1, GRADES) <= present.max(initial=0), -50.0, 50.0)
        return model
    n = len(grades)
    kept, cols = np.unique(ids, return_inverse=True)
    # Column j - 1: whether a row reaches grade j.
    reached = grades[:, None] >= np.arange(1, GRADES)
    weight = weight / weight.sum()
    rate = (weight[:, None] * reached).sum(0).clip(1e-6, 1 - 1e-6)
    # theta_1, then the logarithms of the steps to the next ones, so that they stay ordered.
    base = -np.log(rate / (1 - rate))
    params = np.concatenate(
        [np.zeros(len(kept)), base[:1], np.log(np.diff(base).clip(1e-3))]
    )
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, steps = params[: len(kept)], np.exp(params[len(kept) + 1 :])
        theta = params[len(kept)] + np.concatenate([[0.0], np.cumsum(steps)])
        score = np.bincount(rows, w[cols], minlength=n)
        at_least = _sigmoid(score[:, None] - theta)
        edge = np.hstack([np.ones((n, 1)), at_least, np.zeros((n, 1))])
        slope = np.hstack([np.zeros((n, 1)), at_least * (1 - at_least), np.zeros((n, 1))])
        own = np.arange(n)
        likely = (edge[own, grades] - edge[own, grades + 1]).clip(1e-12)
        up, down = slope[own, grades] / likely, slope[own, grades + 1] / likely
        by_row = weight * (up - down)
        by_theta = np.zeros(GRADES - 1)
        for j in range(1, GRADES):
            by_theta[j - 1] = (weight * (down * (grades + 1 == j) - up * (grades == j))).sum()
        tail = np.cumsum(by_theta[::-1])[::-1]
        gradient = -np.concatenate(
            [np.bincount(cols, by_row[rows], minlength=len(kept)), tail[:1], tail[1:] * steps]
        )
        gradient[: len(kept)] += PENALTY * w
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
        params -= 0.05 * (1 - 0.9 * step / STEPS) * move
    weights = params[: len(kept)].astype(np.float32)
    model.weights[kept] = np.where(np.abs(weights) < 1e-3, 0, weights)
    model.thresholds = params[len(kept)] + np.concatenate(
        [[0.0], np.cumsum(np.exp(params[len(kept) + 1 :]))]
    )
    model.thresholds[np.arange(1, GRADES) > present.max()] = 50.0
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_grade: int = SAMPLE_PER_GRADE,
) -> OrdinalModel:
    """Fit on at most ``per_grade`` labelled rows of each grade, weighed to the grades' true shares.

    ``grade`` is an expression on ``labels``: 0, 1 or 2, or null for rows to leave out. Where an id
    has several labels the highest grade holds. Ids without a document are ignored.
    """
    graded = (
        labels.select(F.col(id_col).cast("long").alias("id"), grade.cast("int").alias("g"))
        .where("id is not null and g between 0 and 2")
        .groupBy("id")
        .agg(F.max("g").alias("g"))
    )
    shares = {r.g: r["count"] for r in graded.groupBy("g").count().collect()}
    chosen = reduce(
        DataFrame.unionByName,
        (
            graded.where(F.col("g") == g).orderBy(F.xxhash64("id"), "id").limit(per_grade)
            for g in range(GRADES)
        ),
    )

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, ids = features(*flat(part.column("text")))
                pairs = np.unique(rows << BITS | ids)
                bounds = np.searchsorted(pairs >> BITS, np.arange(part.num_rows + 1))
                values = pa.array((pairs & ((1 << BITS) - 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
                yield pa.record_batch(
                    {"id": part.column("id"), "g": part.column("g"), "ids": lists}
                )

    with Staging(docs.sparkSession) as staging:
        # At most three times ``per_grade`` pairs of numbers: small enough to broadcast.
        sample = staging.table(
            docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id")
            .select("id", "g", "text")
            .mapInArrow(sparse, "id long, g int, ids array<int>"),
            "sample",
        )
        # Only what the kept features of the sample are comes to the driver. A fixed order makes the
        # sums, and so the model, the same each time.
        kept = _features_kept(sample)
        own = F.array_intersect("ids", F.array(*map(F.lit, kept))) if kept else F.array()
        told = sample.select("id", "g", own.cast("array<int>").alias("ids")).toArrow().sort_by("id")
    grades = told["g"].to_numpy().astype(np.int64)
    lists = told["ids"].combine_chunks()
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(grades)), sizes)
    taken = np.bincount(grades, minlength=GRADES)
    true = np.array([shares.get(g, 0) for g in range(GRADES)])
    return fit_rows(grades, rows, ids, true[grades] / np.maximum(taken[grades], 1))


def _features_kept(sample: DataFrame) -> list[int]:
    """The features of LEAST_DOCS documents or more that toxic texts have most unlike others."""
    n_toxic, n_mild = sample.agg(F.count_if(F.col("g") > 0), F.count_if(F.col("g") == 0)).first()
    docs, bad = F.col("docs"), F.col("bad")
    odds = ((bad + 0.5) / (n_toxic + 1)) / ((docs - bad + 0.5) / (n_mild + 1))
    told = (
        sample.select("g", F.explode("ids").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("docs"), F.count_if(F.col("g") > 0).alias("bad"))
        .where(docs >= LEAST_DOCS)
        .withColumn("surprise", F.abs(F.log(odds)) * F.sqrt("docs"))
        .where("surprise > 0")
        .orderBy(F.desc("surprise"), "feature")
        .limit(FEATURES)
    )
    return [r.feature for r in told.select("feature").collect()]


def score(
    docs: DataFrame, model: OrdinalModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, expected_severity, grade, p_toxic, p_severe`` for every row.

    ``grade`` is the highest grade reached with a probability of at least one half, and
    ``expected_severity`` the mean grade. A null text counts as empty: no features.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                reach = sent.value.reach(*flat(part.column("text")))
                yield pa.record_batch(
                    {
                        "doc_id": part.column("id"),
                        "expected_severity": reach.sum(1),
                        "grade": pa.array((reach >= 0.5).sum(1), pa.int32()),
                        "p_toxic": reach[:, 0],
                        "p_severe": reach[:, 1],
                    }
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RESULT)


def limit_for(model: OrdinalModel, limit: float = REJECT) -> float:
    """The expected severity to reject from: ``limit`` beyond what a text without features has."""
    unknown = float(_sigmoid(-model.thresholds).sum())
    return limit + unknown * (1 - limit / (GRADES - 1))


def keep_mild(
    docs: DataFrame, model: OrdinalModel, *, text_col: str = "text", limit: float = REJECT
) -> DataFrame:
    """The rows of ``docs``, all columns, whose expected severity is below ``limit``.

    The limit holds for a model that expects nothing of a text without features. Where it expects
    more, as after few labels, the limit rises in proportion, up to the highest severity, so that
    rows go by what they say and not by the labels' shares.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    limit = limit_for(model, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                reach = sent.value.reach(*flat(part.column(text_col)))
                yield part.filter(pa.array(reach.sum(1) < limit))

    return docs.mapInArrow(run, docs.schema)
