import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelmill.functions.text import text_key
from labelmill.operators.embed import HashedTokenEncoder, embed, embed_cached, read_cache
from labelmill.operators.skew import salted_join
from labelmill.plans import jobs
from labelmill.sources import vectors
from labelmill.sources.vectors import VectorCache

LABELS = ("a", "b")


def make(spark, rows):
    return spark.createDataFrame(rows, "seq long, sheet string, input string, output string")


def many(spark):
    rows = [(i, "old", f"text {i}", LABELS[i % 3 == 0]) for i in range(100)]
    rows += [(100 + i, "old", "text 5", "a") for i in range(3)] + [(110, "old", None, "a")]
    rows += [(200 + i, "new", f"text {i + 95}", "b") for i in range(10)] + [(220, "new", "x", "c")]
    return make(spark, rows)


def records(path, split):
    from pathlib import Path

    parts = sorted(Path(path, f"split={split}").glob("part-*"))
    return [json.loads(x) for p in parts for x in p.read_text(encoding="utf-8").splitlines()]


def test_full_job(spark, tmp_path):
    run = jobs.full_job(many(spark), str(tmp_path), labels=LABELS, stamp="s")
    assert run.records_path == f"{tmp_path}/records_s.jsonl"
    assert run.sizes == {"train": 90, "val": 20, "test": 10, "data": 110}
    assert (run.metrics["regular"].duplicate_count, run.metrics["new"].invalid_label_count) == (3, 1)
    got = {s: records(run.records_path, s) for s in run.sizes}
    assert {s: len(r) for s, r in got.items()} == run.sizes
    for rs in got.values():
        assert sorted(r["id"] for r in rs) == list(range(1, len(rs) + 1))
    text = {s: [r["conversations"][1]["context"] for r in rs] for s, rs in got.items()}
    new = {f"text {i}" for i in range(95, 105)}
    assert new <= set(text["train"]) and new <= set(text["val"])
    by_id = sorted(got["data"], key=lambda r: r["id"])
    assert {r["conversations"][1]["context"] for r in by_id[-10:]} == new
    report = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "analysis_report_s.txt").glob("part-*"))
    assert [x for x in report.splitlines() if "总条数" in x] == [f"  总条数：{n}" for n in (110, 90, 20, 10)]


def test_split_and_convert_and_clean_jobs(spark, tmp_path):
    run = jobs.split_job(many(spark), str(tmp_path), labels=LABELS, new_sheet=None, fmt="openai", stamp="s")
    assert sum(run.sizes.values()) == 105 and set(run.sizes) == {"train", "val", "test"}
    assert run.report_path is None
    path, n = jobs.convert_job(many(spark), str(tmp_path), LABELS, stamp="c")
    assert n == len(records(path, "data")) == 105
    path, n = jobs.convert_job(many(spark), str(tmp_path), skip_validation=True, stamp="raw")
    got = [r["conversations"][1]["context"] for r in records(path, "data")]
    assert n == len(got) == 115 and "nan" in got
    path, metrics = jobs.clean_job(many(spark), str(tmp_path), LABELS, stamp="t")
    assert spark.read.parquet(path).columns == ["input", "output"]
    assert metrics.final_count == spark.read.parquet(path).count() == 105


def test_nothing_left_is_an_error(spark, tmp_path):
    for job in (jobs.full_job, jobs.clean_job, jobs.convert_job):
        with pytest.raises(jobs.EmptyResult, match="no row is left"):
            job(many(spark), str(tmp_path))
        with pytest.raises(jobs.EmptyResult):
            job(many(spark).where("false"), str(tmp_path))


def conflicts(rows, k, threshold):
    """Brute force over the rows themselves."""
    encode = HashedTokenEncoder(8).encode
    first, out = {}, []
    refs = [(s, t) for s, _, t, label in rows if label == "life" and t not in (None, "nan")]
    for s, t in refs:
        first.setdefault(t, s)

    def unit(t):
        v = encode([t])[0]
        return np.float64(np.float32(v / np.linalg.norm(v)))

    for s, _, t, label in rows:
        if label != "new" or t in (None, "nan"):
            continue
        a = unit(t)
        scored = sorted(
            (-round(float(a @ unit(r) / np.linalg.norm(a) / np.linalg.norm(unit(r))), 12), first[r], r)
            for _, r in refs
        )
        out += [(s, i + 1, round(-x, 4), r) for i, (x, _, r) in enumerate(scored[:k]) if -x >= threshold]
    return sorted(out)


@pytest.mark.parametrize("rows_per_salt", [4, 1_000_000])
def test_conflict_job(spark, tmp_path, rows_per_salt):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words, size=4)) for _ in range(40)]
    rows = [(i, "m", str(rng.choice(texts)), str(rng.choice(["life", "new", "other"]))) for i in range(150)]
    rows += [(200 + i, "m", texts[0], "new") for i in range(60)]  # hot query text
    rows += [(300 + i, "m", texts[1], "life") for i in range(60)]  # hot reference text
    rows += [(400, "m", None, "new"), (401, "m", "nan", "life")]
    encoder = HashedTokenEncoder(8)
    run = jobs.conflict_job(
        make(spark, rows).repartition(3), encoder, encoder.encoder_id, f"{tmp_path}/cache", f"{tmp_path}/out",
        "life", "new", k=3, threshold=0.8, rows_per_salt=rows_per_salt,
    )
    want = conflicts(rows, 3, 0.8)
    got = run.flagged.collect()
    assert sorted((r.seq, r["rank"], r.similarity, r.similar_text) for r in got) == want
    assert [r.similarity for r in got] == sorted((r.similarity for r in got), reverse=True)
    s = run.summary.first()
    checked = sum(label == "new" and t not in (None, "nan") for _, _, t, label in rows)
    by_seq = {r[0]: r[2] for r in rows}
    assert (s.total_checked, s.high_risk_rows) == (checked, len(want))
    assert s.high_risk_count == len({by_seq[w[0]] for w in want})
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(want)
    run.staging.clear()


def test_conflict_job_errors(spark, tmp_path):
    encoder = HashedTokenEncoder(8)
    rows = make(spark, [(1, "m", "x", "life"), (2, "m", "y", "new")])

    def run(df, enc=encoder, **options):
        return jobs.conflict_job(df, enc, "e", f"{tmp_path}/cache", None, "life", "new", **options)

    for bad in ("life", "new"):
        with pytest.raises(ValueError):
            run(rows.where(rows.output != bad))
    with pytest.raises(ValueError):
        run(rows, threshold=0)
    with pytest.raises(RuntimeError):
        run(rows, enc=None)
    assert run(rows, threshold=1.0).flagged.count() == 0


def test_cache_encodes_only_what_is_missing(spark, tmp_path):
    class Logged(HashedTokenEncoder):
        """Writes down the texts it encodes."""

        def __init__(self, folder):
            super().__init__(8)
            self.folder = str(folder)

        def encode(self, texts):
            import uuid
            from pathlib import Path

            assert len(texts) <= 5
            Path(self.folder, uuid.uuid4().hex).write_text("\n".join(texts))
            return super().encode(texts)

    log = tmp_path / "log"
    log.mkdir()
    seen = []

    def run(n, **options):
        before = set(log.iterdir())
        texts = spark.createDataFrame([(f"text {i}",) for i in range(n)], "input string")
        got = embed_cached(texts, Logged(log), f"{tmp_path}/cache", "e", batch_size=5, **options)
        assert got.count() == n
        seen.append(sum(len(p.read_text().split("\n")) for p in set(log.iterdir()) - before))

    assert read_cache(spark, f"{tmp_path}/cache", "e") is None
    run(20)
    run(20)
    run(33)
    run(33, refresh=True)
    assert seen == [20, 0, 13, 33]


def cached(spark, path):
    return {r.text_key: list(r.embedding) for r in read_cache(spark, path, "e").collect()}


def texts_of(spark, numbers):
    return spark.createDataFrame([(f"text {i}",) for i in numbers], "input string")


@pytest.mark.parametrize("refresh", [False, True])
def test_a_write_that_fails_leaves_the_old_vectors(spark, tmp_path, monkeypatch, refresh):
    class Failing(HashedTokenEncoder):
        def encode(self, texts):
            if "text 7" in texts:
                raise RuntimeError("the encoder is gone")
            return super().encode(texts)

    path = f"{tmp_path}/cache"
    embed_cached(texts_of(spark, range(5)), HashedTokenEncoder(8), path, "e").count()
    before = cached(spark, path)
    assert len(before) == 5
    with pytest.raises(Exception, match="the encoder is gone"):
        embed_cached(texts_of(spark, range(20)), Failing(8), path, "e", batch_size=1, refresh=refresh)
    assert cached(spark, path) == before
    # Stopped after the vectors are written, before they are named.
    with monkeypatch.context() as patch:
        patch.setattr(VectorCache, "_put", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            embed_cached(texts_of(spark, range(20)), HashedTokenEncoder(8), path, "e", refresh=refresh)
    assert cached(spark, path) == before
    VectorCache(spark, path, "e").vacuum()
    assert cached(spark, path) == before
    assert embed_cached(texts_of(spark, range(3, 20)), HashedTokenEncoder(8), path, "e").count() == 17
    assert len(cached(spark, path)) == 20


def test_runs_at_the_same_time_and_many_versions(spark, tmp_path):
    path = f"{tmp_path}/cache"
    cache = VectorCache(spark, path, "e")

    def version(numbers, buckets):
        rows = texts_of(spark, numbers).withColumn("text_key", text_key(F.col("input")))
        return cache.write(embed(rows.repartition(buckets, "text_key"), HashedTokenEncoder(8)), buckets)

    one, two = version(range(10), 8), version(range(5, 15), 16)
    first = cache.add(one, None, 8)
    # The second run saw no cache either: texts that the first one has are not there twice.
    second = cache.add(two, None, 16)
    assert (first.number, second.number, second.buckets) == (0, 1, 8)
    assert read_cache(spark, path, "e").count() == 15
    for i in range(15, 30):
        embed_cached(texts_of(spark, [i]), HashedTokenEncoder(8), path, "e").count()
    assert len(cache.commit().versions) <= vectors.MOST_VERSIONS
    assert read_cache(spark, path, "e").count() == len(cached(spark, path)) == 30
    assert cache.write(read_cache(spark, path, "e").where("false"), 8) is None


def test_the_cache_is_read_without_a_shuffle(spark, tmp_path):
    path = f"{tmp_path}/cache"
    for numbers in (range(50), range(40, 90)):
        found = embed_cached(texts_of(spark, numbers), HashedTokenEncoder(8), path, "e")
    assert found.count() == 50
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Each version is scanned by bucket; above such a scan there is no exchange up to the join.
    scans = [i for i, line in enumerate(plan.split("\n")) if "FileScan parquet" in line]
    lines = plan.split("\n")
    assert len(scans) == 2
    for i in scans:
        assert "Bucketed: true" in lines[i]
        depth = lines[i].index("FileScan")
        for line in reversed(lines[:i]):
            at = len(line) - len(line.lstrip(" :+-"))
            if at < depth:
                depth = at
                assert "Exchange" not in line
                if "Join" in line:
                    break


def test_embed_is_unit_length(spark):
    df = spark.createDataFrame([(1, "a b  a"), (2, "")], "id long, input string")
    got = {r.id: r.embedding for r in embed(df, HashedTokenEncoder(16)).collect()}
    assert sorted(x for x in got[1] if x) == pytest.approx([1 / 5**0.5, 2 / 5**0.5])
    assert not any(got[2])


def test_salted_join_is_a_join(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(900)]
    df = spark.createDataFrame(rows, "id long, key string")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4)], "key string, v int")
    counts = df.groupBy("key").count().withColumnRenamed("count", "n")
    got = salted_join(df, lookup, "key", "id", counts, 900, rows_per_salt=20)
    want = [(i, v) for i, key in rows for k, v in [("hot", 1), ("hot", 2), ("k1", 3)] if k == key]
    assert Counter((r.id, r.v) for r in got.collect()) == Counter(want)


def test_staging_is_cleared_also_after_an_error(spark, samples, tmp_path, monkeypatch):
    from labelmill.sources import staging

    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path / "shared"))
    jobs.clean_job(samples, str(tmp_path / "out"), ["寿险意图", "拒识"])
    with pytest.raises(jobs.EmptyResult):
        jobs.clean_job(samples, str(tmp_path / "none"), ["no such label"])
    assert not [p for p in (tmp_path / "shared").rglob("*") if p.is_file()]
