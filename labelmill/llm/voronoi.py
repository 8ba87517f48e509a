"""Exact top-k by inner product, as a Voronoi kNN join.

Rows and queries are assigned to the nearest of a bounded number of pivots. A summary of each cell
(its size, its radius, the k + 1 smallest distances to the pivot) gives every query a score that its
k-th best match is sure to reach; from these follows, for each group of queries and each cell, the
distance from the pivot below which no row of the cell can matter. Only rows beyond it are sent to
that group, where they stream past the group's queries.

With pivot p of row x: ``q.p - |q| d(x, p) <= q.x <= q.p + |q| d(x, p)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelmill.operators.rank import add_places
from labelmill.sources.staging import Staging

# Pivots at most, and rows of the sample that they come from. The sample decides speed, not results.
PIVOTS = 128
SAMPLE_ROWS = 4096
SAMPLE_BYTES = 32 << 20
# Queries that a task holds at a time; rows that stream past them in one slice.
GROUP_QUERIES = 4096
SLICE_ROWS = 65536
# Rows that make a slice of their own worth while.
LEAST_ROWS = 1024
# A table of distance bounds up to this size is broadcast.
BOUNDS_BYTES = 32 << 20
LARGEST = 2**63 - 1

RESULT = "query_id long, rank int, vec_id long, score long"


def _dtype(largest: float) -> str:
    """The smallest type that holds all components; float64 holds any scaled double exactly."""
    return "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8"


def _scaled(column: pa.Array, scale: int, dims: int) -> np.ndarray:
    """Rows of ``floor(scale * x)`` as doubles, shorter vectors followed by zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = np.floor(scale * values)
    return out


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products, saturated at the bounds of a long."""
    top = max(1, queries.shape[1]) * np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0)
    if top < 2**53:
        return (queries @ rows.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in queries]
    other = [[int(x) for x in row] for row in rows]
    out = np.zeros((len(exact), len(other)), np.int64)
    for i, a in enumerate(exact):
        for j, b in enumerate(other):
            total = sum(x * y for x, y in zip(a, b, strict=True))
            out[i, j] = max(-LARGEST - 1, min(LARGEST, total))
    return out


def best(values: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``values`` the k highest, ties to the smaller id; ``ids`` has the same shape."""
    if values.shape[1] > 4 * k:
        # Everything that reaches the k-th value stays, however many ties that are.
        bar = np.partition(values, values.shape[1] - k, axis=1)[:, -k][:, None]
        keep = values >= bar
        width = max(k, int(keep.sum(axis=1).max(initial=0)))
        if width < values.shape[1]:
            order = np.argsort(~keep, axis=1, kind="stable")[:, :width]
            values = np.take_along_axis(values, order, 1)
            ids = np.take_along_axis(ids, order, 1)
    by_id = np.argsort(ids, axis=1, kind="stable")
    values, ids = np.take_along_axis(values, by_id, 1), np.take_along_axis(ids, by_id, 1)
    # ~value orders like -value, without overflow at the smallest long.
    order = np.argsort(~values, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(values, order, 1), np.take_along_axis(ids, order, 1)


def choose_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Centres of a few rounds of k-means over the distinct rows of the sample."""
    sample = np.unique(sample, axis=0)
    count = max(1, min(most, len(sample) // 8))
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)].astype(np.float64)
    for _ in range(5):
        nearest, _ = nearest_pivot(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        sizes = np.bincount(nearest, minlength=count)[:, None]
        centres = np.where(sizes > 0, sums / np.maximum(sizes, 1), centres)
    return centres


def nearest_pivot(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    squares = (rows**2).sum(1)[:, None] - 2 * rows @ pivots.T + (pivots**2).sum(1)
    cell = squares.argmin(1)
    return cell, np.sqrt(((rows - pivots[cell]) ** 2).sum(1))


def _chain(pivots: np.ndarray) -> list[int]:
    """The pivots in an order in which neighbours stand together."""
    left = set(range(1, len(pivots)))
    order = [0]
    while left:
        rest = np.fromiter(left, int)
        order.append(int(rest[((pivots[rest] - pivots[order[-1]]) ** 2).sum(1).argmin()]))
        left.remove(order[-1])
    return order


def _query_groups(pivots: np.ndarray, sizes: dict[int, int]) -> tuple[dict[int, tuple[int, int]], int]:
    """Cell -> (first group, groups): neighbouring cells share one, a full cell has several."""
    groups, group, held = {}, 0, 0
    for cell in _chain(pivots):
        size = sizes.get(cell, 0)
        if held and held + size > GROUP_QUERIES:
            group, held = group + 1, 0
        parts = max(1, ceil(size / GROUP_QUERIES))
        groups[cell] = (group, parts)
        group, held = group + parts - 1, held + size if parts == 1 else GROUP_QUERIES
    return groups, group + 1


def top_k(
    data: DataFrame,
    *,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    scale: int = 1024,
    staging: Staging | None = None,
) -> DataFrame:
    """The k rows of highest ``sum(floor(scale * q) * floor(scale * x))`` for each query row.

    ``is_query`` is a condition on ``data``. Returns query_id, rank (from 1), vec_id and score, ties
    to the smaller vec_id; a query has fewer rows only if there are fewer candidates.

    * Rows with a null id, a null vector, or a null or non-finite component take no part.
    * Shorter vectors count as followed by zeros; empty ones score 0 with every row.
    * Rows that share an id count each by itself: as a query, a row is left out of its own results
      only, and each query row has results of its own. Ties among them go by the vectors' order.
    * Scores beyond a long's range are saturated. No queries or no candidates: no rows.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    spark = data.sparkSession
    vectors = data.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    ).where(
        "id is not null and v is not null and forall(v, x -> x is not null and not isnan(x)"
        f" and abs(x) * {scale}D < double('infinity'))"
    )
    n, ids, dims, high, low, n_queries = vectors.agg(
        F.count("*"),
        F.count_distinct("id"),
        F.max(F.size("v")),
        F.max(F.array_max("v")),
        F.min(F.array_min("v")),
        F.count_if("q"),
    ).first()
    if not n_queries or n < 2:
        return spark.createDataFrame([], RESULT)
    staging = staging or Staging(spark)
    names = None
    if ids < n:
        # Numbers of their own for all rows, in the order of the ids.
        numbered = add_places(vectors, [F.col("id"), F.col("v")], staging, "rows")
        names = numbered.select(F.col("place").alias("row"), "id")
        vectors = numbered.select(F.col("place").alias("id"), "v", "q")
    dtype = _dtype(scale * max(abs(high or 0.0), abs(low or 0.0)) + 1)

    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(1, dims))))
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(rows).select("v").toArrow()["v"]
    pivots = choose_pivots(_scaled(sample.combine_chunks(), scale, dims), PIVOTS)
    # Rounding moves a bound by less than this share of the numbers that enter it.
    slack = 1e-9

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                part = batch.slice(start, 8192)
                points = _scaled(part.column("v"), scale, dims)
                cell, distance = nearest_pivot(points, pivots)
                yield pa.record_batch(
                    {
                        "id": part.column("id"),
                        "q": part.column("q"),
                        "point": pa.array([p.tobytes() for p in points.astype(dtype)], pa.binary()),
                        "cell": pa.array(cell, pa.int32()),
                        "distance": pa.array(distance * (1 + slack)),
                    }
                )

    cells = staging.table(
        vectors.mapInArrow(assign, "id long, q boolean, point binary, cell int, distance double"),
        "cells",
    )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, np.ndarray] = {}
        counts: dict[int, list] = {}
        for batch in batches:
            for cell, part in batch.groupby("cell"):
                distances = part["distance"].to_numpy()
                kept[cell] = np.sort(np.append(kept.get(cell, []), distances))[: k + 1]
                now = counts.setdefault(cell, [0, 0.0])
                now[0] += int(part["q"].sum())
                now[1] = max(now[1], float(distances.max()))
        yield pd.DataFrame(
            [(c, *counts[c], kept[c].tolist()) for c in kept],
            columns=["cell", "queries", "radius", "least"],
        )

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        least = np.sort(np.concatenate(part["least"].to_numpy()))[: k + 1].tolist()
        row = (part["cell"].iloc[0], part["queries"].sum(), part["radius"].max(), least)
        return pd.DataFrame([row], columns=part.columns)

    schema = "cell int, queries long, radius double, least array<double>"
    # One row for each of at most PIVOTS cells.
    summary = (
        cells.select("cell", "q", "distance")
        .mapInPandas(partial, schema)
        .groupBy("cell")
        .applyInPandas(merge, schema)
        .collect()
    )
    radius = np.zeros(len(pivots))
    least_cells, least = [], []
    for s in summary:
        radius[s.cell] = s.radius
        least_cells += [s.cell] * len(s.least)
        least += s.least
    least_cells, least = np.array(least_cells), np.array(least)
    groups, n_groups = _query_groups(pivots, {s.cell: s.queries for s in summary})
    # Slices that a group has at least, so that there is work for all partitions.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least_slices = ceil(partitions / n_groups)
    # More than any group has.
    most_slices = ceil(n / SLICE_ROWS) + least_slices
    first = np.array([groups[c][0] for c in range(len(pivots))])
    parts = np.array([groups[c][1] for c in range(len(pivots))])

    def group_of(cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return first[cell] + (ids // 100) % parts[cell]

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowest: dict[int, np.ndarray] = {}
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            ids = batch.column("id").to_numpy()
            points = np.stack(
                [np.frombuffer(p, dtype) for p in batch.column("point").to_pylist()]
            ).astype(np.float64)
            norms = np.sqrt((points**2).sum(1))[:, None]
            products = points @ pivots.T
            size = norms * np.sqrt((pivots**2).sum(1)).max(initial=0)
            floor = products[:, least_cells] - norms * least
            # k + 1 rows reach this; the query itself may be one of them.
            if floor.shape[1] > k:
                sure = np.partition(floor, floor.shape[1] - k - 1, axis=1)[:, -k - 1][:, None]
            else:
                sure = np.full((len(ids), 1), -np.inf)
            sure = sure - slack * (size + norms * radius.max(initial=0)) - 1e-6
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(norms > 0, (sure - products) / norms, -np.inf)
            for group, at in pd.Series(np.arange(len(ids))).groupby(group_of(cell, ids)):
                mine = need[at.to_numpy()].min(0)
                lowest[group] = np.minimum(lowest.get(group, np.inf), mine)
        for group, need in lowest.items():
            kept = np.flatnonzero(need <= radius)
            yield pa.record_batch(
                {
                    "grp": pa.array(np.full(len(kept), group), pa.int32()),
                    "cell": pa.array(kept, pa.int32()),
                    "need": pa.array(need[kept]),
                }
            )

    needed = (
        cells.where("q")
        .select("id", "point", "cell")
        .mapInArrow(bounds, "grp int, cell int, need double")
        .groupBy("grp", "cell")
        .agg(F.min("need").alias("need"))
    )
    needed = staging.table(needed, "needed")
    if n_groups * len(pivots) * 16 <= BOUNDS_BYTES:
        needed = F.broadcast(needed)
    wanted = cells.join(needed, "cell").where("distance >= need").select("grp", "id", "point")
    # A group is cut by the rows that are sent to it; queries go to its slices and to no others.
    cut = staging.table(
        wanted.groupBy("grp")
        .agg(F.count("*").alias("rows"))
        .select(
            "grp",
            F.greatest(
                F.ceil(F.col("rows") / SLICE_ROWS),
                F.least(F.lit(least_slices), F.ceil(F.col("rows") / LEAST_ROWS)),
            )
            .cast("int")
            .alias("slices"),
        ),
        "slices",
    )
    if n_groups * 16 <= BOUNDS_BYTES:
        cut = F.broadcast(cut)
    slice_no = F.pmod(F.xxhash64("id"), "slices").cast("int").alias("slice")
    sent = wanted.join(cut, "grp").select("grp", slice_no, F.lit(1).alias("role"), "id", "point")

    def with_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = group_of(batch.column("cell").to_numpy(), batch.column("id").to_numpy())
            yield pa.record_batch(
                {
                    "grp": pa.array(group, pa.int32()),
                    "id": batch.column("id"),
                    "point": batch.column("point"),
                }
            )

    asking = (
        cells.where("q")
        .select("id", "cell", "point")
        .mapInArrow(with_group, "grp int, id long, point binary")
        .join(cut, "grp")
        .select(
            "grp",
            F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"),
            F.lit(0).alias("role"),
            "id",
            "point",
        )
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, state = None, [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if state is not None:
                query_ids, _, values, ids = state
                full = ids >= -LARGEST  # places that no row has taken hold the smallest long
                yield pa.record_batch(
                    {
                        "query_id": pa.array(np.repeat(query_ids, full.sum(1))),
                        "vec_id": pa.array(ids[full]),
                        "score": pa.array(values[full]),
                    }
                )

        for batch in batches:
            keys = batch.column("grp").to_numpy().astype(np.int64) * most_slices
            keys += batch.column("slice").to_numpy()
            keys = keys * 2 + batch.column("role").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if keys[lo] // 2 != key:
                    yield from flush()
                    key, held, state = keys[lo] // 2, [], None
                ids = batch.column("id").to_numpy()[lo:hi]
                points = np.stack(
                    [np.frombuffer(p, dtype) for p in batch.column("point")[lo:hi].to_pylist()]
                ).astype(np.float64)
                if keys[lo] % 2 == 0:
                    held.append((ids, points))
                    continue
                if state is None:
                    if not held:
                        continue
                    state = (
                        np.concatenate([h[0] for h in held]),
                        np.concatenate([h[1] for h in held]),
                        np.zeros((sum(len(h[0]) for h in held), 0), np.int64),
                        np.zeros((sum(len(h[0]) for h in held), 0), np.int64),
                    )
                step = max(k, (4 << 20) // max(1, len(state[0])))
                for at in range(0, len(ids), step):
                    some = ids[at : at + step]
                    found = scores(state[1], points[at : at + step])
                    shown = np.broadcast_to(some, found.shape).copy()
                    own = shown == state[0][:, None]
                    found[own], shown[own] = -LARGEST - 1, -LARGEST - 1
                    state = (
                        *state[:2],
                        *best(np.hstack([state[2], found]), np.hstack([state[3], shown]), k),
                    )
        yield from flush()

    found = (
        asking.unionByName(sent)
        .repartition("grp", "slice")
        .sortWithinPartitions("grp", "slice", "role")
        .mapInArrow(solve, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
    if names is None:
        return ranked
    asked = names.select(F.col("row").alias("query_id"), F.col("id").alias("asked"))
    given = names.select(F.col("row").alias("vec_id"), F.col("id").alias("given"))
    return ranked.join(asked, "query_id").join(given, "vec_id").select(
        F.col("asked").alias("query_id"), "rank", F.col("given").alias("vec_id"), "score"
    )
