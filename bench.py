"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "load_samples",
    "validation_metrics",
    "dedup_whole_documents",
    "stratified_split",
    "split_report",
    "label_bars",
    "record_internal",
    "export_counts",
    "topk_cosine",
    "topk3_cosine",
    "all_nearest_vectors",
    "conflict_pairs",
    "conflict_lexical",
    "embed_hashed",
    "embedding_cache_merge",
    "job_full",
    "job_conflict",
)


def session(cpus: str = os.environ.get("BENCH_CPUS", "8")) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("labelmill")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # One process: its temporary folder is shared by all there is.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="labelmill-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from labelmill.catalogue import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # One round on the smallest tables, so that the JVM's compilation and the start of the Python
    # workers are not timed.
    smallest = Path(sf_dir).parent / "sf0.001"
    if smallest.is_dir():
        for name in HEADLINE:
            run(name, str(smallest))
    seconds = {name: run(name, sf_dir) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
