import pytest
from pyspark.sql import functions as F

from labelmill.sources import members as members_module
from labelmill.functions.text import READER_NULL_TOKENS, WHITESPACE, strip_text
from labelmill.sources.members import (
    Member,
    load_folder,
    load_samples,
    load_separated,
    member_counts,
    separate,
)


def texts(df):
    return [r.input for r in df.orderBy("seq").collect()]


def write(spark, rows, path, files, format="parquet"):
    df = spark.createDataFrame([(i, f"{path[-1]}{i:05d}", "a") for i in range(rows)], "n int, input string, output string")
    df.repartitionByRange(files, "n").sortWithinPartitions("n").write.format(format).option("header", True).save(path)


@pytest.mark.parametrize("format", ["parquet", "csv", "json"])
@pytest.mark.parametrize("broadcast_files", [100_000, 0])
def test_order_over_members_files_and_blocks(spark, tmp_path, monkeypatch, format, broadcast_files):
    monkeypatch.setattr(members_module, "BROADCAST_FILES", broadcast_files)
    write(spark, 3000, f"{tmp_path}/b", 3, format)
    write(spark, 500, f"{tmp_path}/a", 2, format)
    options = {"header": "true"} if format == "csv" else {}
    members = {name: Member(f"{tmp_path}/{name}", format, options) for name in "ba"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # several blocks per file
    try:
        df = load_samples(spark, members)
        assert texts(df) == [f"b{i:05d}" for i in range(3000)] + [f"a{i:05d}" for i in range(500)]
        assert df.select("seq").distinct().count() == 3500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert df.columns == ["seq", "sheet", "input", "output"]
    counts = {r.sheet: r.rows for r in member_counts(df).collect()}
    assert counts == {"b": 3000, "a": 500, None: 3500}


def test_parquet_positions_are_contiguous(spark, tmp_path):
    write(spark, 100, f"{tmp_path}/m", 4)
    df = load_samples(spark, {"m": "m"}, base=str(tmp_path))
    assert [r.seq for r in df.orderBy("seq").collect()] == list(range(100))


def test_folder_of_members(spark, tmp_path):
    for name in ("two", "one"):
        write(spark, 10, f"{tmp_path}/sheet={name}", 1)
    df = load_folder(spark, str(tmp_path))
    assert [r.sheet for r in df.orderBy("seq").collect()] == ["one"] * 10 + ["two"] * 10
    with pytest.raises(FileNotFoundError):
        load_folder(spark, f"{tmp_path}/none")


def test_missing_path_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_samples(spark, {"m": f"{tmp_path}/none"})
    write(spark, 3, f"{tmp_path}/m", 1)
    with pytest.raises(ValueError):
        load_samples(spark, {"m": f"{tmp_path}/m"}, output_col="label")
    with pytest.raises(ValueError):
        load_samples(spark, {"m": spark.read.parquet(f"{tmp_path}/m")})


def test_separate(spark, samples):
    regular, new = separate(samples)
    assert (regular.count(), new.count()) == (12, 2)
    for disabled in ("", None, "absent"):
        regular, new = separate(samples, disabled)
        assert (regular.count(), new.count()) == (14, 0)


def test_new_member_alone_is_an_error(spark, tmp_path):
    write(spark, 3, f"{tmp_path}/m", 1)
    with pytest.raises(ValueError):
        load_separated(spark, {"new": f"{tmp_path}/m"})
    regular, new = load_separated(spark, {"new": f"{tmp_path}/m", "old": f"{tmp_path}/m"})
    assert (regular.count(), new.count()) == (3, 3)


def test_reader_null_tokens(spark):
    df = spark.createDataFrame([(0, "NA", "x"), (1, " N/A ", "y"), (2, "na", "z")], "p int, input string, output string")
    got = load_samples(spark, {"m": Member(df, order_col="p")}, null_tokens=READER_NULL_TOKENS)
    assert texts(got) == [None, None, "na"]


def test_strip_is_python_strip(spark):
    odd = ["", "　 x　", "\x1c\x1f a b \x85\xa0", "​x​", "﻿x", " ", "x", "éé "]
    odd += [c + "m" + c for c in WHITESPACE] + [chr(c) + "m" for c in range(1, 0x3100, 7)]
    df = spark.createDataFrame([(s,) for s in odd], "s string")
    got = df.select("s", strip_text(F.col("s")).alias("t")).collect()
    assert [r.t for r in got] == [r.s.strip() for r in got]


def test_numbers_become_text(spark):
    df = spark.createDataFrame([(0, 1.0, True)], "p int, input double, output boolean")
    assert load_samples(spark, {"m": Member(df, order_col="p")}).first()[2:] == ("1.0", "true")
