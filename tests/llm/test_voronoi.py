import numpy as np
import pytest
from pyspark.sql import functions as F

from labelmill.llm import voronoi

VECTORS = "vec_id long, embedding array<float>, id string, cell int, q int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "own", 7, 7) for i, v in rows], VECTORS)


def by_hand(rows, k=10):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    rows = [(i, v) for i, v in rows if i is not None and usable(v)]
    whole = [[int(np.floor(1024 * float(np.float32(x)))) for x in v] for _, v in rows]
    out = {}
    for at, (q, _) in enumerate(rows):
        if q % 100 == 0:
            scored = [
                (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[at], v, strict=False)))), i)
                for j, ((i, _), v) in enumerate(zip(rows, whole, strict=True))
                if j != at
            ]
            if scored:
                best = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
                out[q] = sorted(out.get(q, []) + best)
    return out


def found(df, **options):
    out = {}
    for r in voronoi.top_k(df, is_query=F.col("vec_id") % 100 == 0, **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_clusters_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 6))
    rows = []
    for i in range(900):
        v = centres[i % 9] + 0.05 * rng.normal(size=6) if i % 3 else centres[0]
        rows.append((i, [float(x) for x in v]))
    assert found(frame(spark, rows)) == by_hand(rows)


def test_unusable_rows(spark):
    rows = [
        (0, [1.0, 2.0]),
        (100, [0.0, 0.0]),
        (200, None),
        (300, [float("nan"), 1.0]),
        (400, [None, 1.0]),
        (1, [float("inf"), 1.0]),
        (2, [1.0, -1.0]),
        (3, [1.0]),
        (4, []),
        (None, [1.0, 1.0]),
    ]
    assert found(frame(spark, rows)) == by_hand(rows)


def test_large_numbers_are_exact_and_saturate(spark):
    rows = [(0, [3.0e6, 1.0]), (1, [3.0e6, 1.0]), (2, [2.9e6, 5.0]), (100, [1.0, 0.5])]
    assert found(frame(spark, rows)) == by_hand(rows)
    huge = frame(spark, [(0, [1e30]), (1, [1e30]), (2, [-1e30])])
    assert found(huge)[0] == [(1, 1, 2**63 - 1), (2, 2, -(2**63))]


def test_repeated_ids_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [2.0, 0.0]), (5, [1.0, 1.0]), (100, [1.0, 2.0])]
    rows += [(100, [0.5, 2.0]), (3, [1.0, 2.0])]
    # Each row counts, whatever its id; both rows of id 0 have results.
    one = 1024 * 1024
    assert found(frame(spark, rows), k=2)[0] == [(1, 5, 2 * one)] * 2 + [(2, 0, one)] * 2
    assert found(frame(spark, rows)) == by_hand(rows)
    assert found(frame(spark, [])) == {}
    assert found(frame(spark, [(0, [1.0])])) == {}
    with pytest.raises(ValueError):
        found(frame(spark, rows), k=0)


def test_small_groups_and_slices(spark, monkeypatch):
    monkeypatch.setattr(voronoi, "GROUP_QUERIES", 3)
    monkeypatch.setattr(voronoi, "SLICE_ROWS", 50)
    monkeypatch.setattr(voronoi, "BOUNDS_BYTES", 0)
    rng = np.random.default_rng(4)
    rows = [(100 * i if i < 20 else i, [float(x) for x in rng.normal(size=4)]) for i in range(400)]
    assert found(frame(spark, rows), k=3) == by_hand(rows, 3)
