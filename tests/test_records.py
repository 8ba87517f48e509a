import json

import pytest

from labelmill.operators.formats import FORMATS, RecordFormat, chat, flat, get_format
from labelmill.operators.rank import add_ids
from labelmill.operators.records import to_json_lines, to_records
from labelmill.sources import sinks

TEXT, LABEL = "我想了解一下万能险", "寿险意图"
PROMPT = "你是一个意图分类模型，只能输出：寿险意图 或 拒识"


def record(spark, fmt, text=TEXT, label=LABEL, **options):
    df = spark.createDataFrame([(1, text, label)], "id long, input string, output string")
    return json.loads(to_json_lines(to_records(df, fmt, **options)).first().json)


def test_presets(spark):
    said = [("system", PROMPT), ("user", TEXT), ("assistant", LABEL)]
    assert record(spark, "openai") == {"messages": [{"role": r, "content": t} for r, t in said]}
    said[1] = ("human", TEXT)
    assert record(spark, "internal") == {
        "id": 1,
        "conversations": [{"role": r, "context": t} for r, t in said],
    }
    flat = {"instruction": PROMPT, "input": TEXT, "output": LABEL}
    assert record(spark, "ark") == flat
    ark = get_format("ark")
    assert (ark.container, ark.suffix) == ("json_array", ".json")


def test_prefix_prompt_and_missing_texts(spark):
    got = record(spark, "ark", prefix="判断：\n", prompt="p", label=None)
    assert got == {"instruction": "p", "input": "判断：\n" + TEXT, "output": "nan"}


def test_awkward_characters(spark):
    text = 'a"b\\c\t\n\x01 😀 é '
    assert record(spark, "ark", text=text)["input"] == text


def test_registry(spark, monkeypatch):
    assert list(FORMATS) == ["openai", "internal", "ark"]
    mine = RecordFormat(chat("turns", "value", ("s", "u", "a")))
    monkeypatch.setitem(FORMATS, "mine", mine)
    assert get_format("mine") is mine is get_format(mine)
    said = [("s", PROMPT), ("u", TEXT), ("a", LABEL)]
    assert record(spark, "mine") == {"turns": [{"role": r, "value": t} for r, t in said]}
    with pytest.raises(ValueError, match="openai, internal, ark, mine"):
        get_format("other")


def test_constants_win_and_keep_their_place(spark):
    constants = {"user": "fixed", "tags": ["a", "b"], "meta": {"n": 1, "none": None}}
    got = record(spark, RecordFormat(flat(("s", "user", "assistant"), constants)))
    assert list(got) == ["s", "user", "assistant", "tags", "meta"]
    assert got["user"] == "fixed" and got["meta"] == {"n": 1, "none": None}


def split_table(spark, **sizes):
    rows = [(i, s, f"text {s} {i}", LABEL, False) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(
        rows, "seq long, split string, input string, output string, injected boolean"
    ).repartition(5)


def folder(path, split):
    parts = sorted((path / f"split={split}").glob("part-*"))
    return "".join(p.read_text(encoding="utf-8") for p in parts), len(parts)


def test_json_lines_round_trip(spark, tmp_path):
    path = tmp_path / "out"
    sizes = sinks.export(split_table(spark, train=30, val=4), str(path), "internal")
    assert sizes == {"train": 30, "val": 4}
    for split, n in sizes.items():
        content = folder(path, split)[0]
        assert TEXT[:0] + LABEL in content  # not escaped
        got = sorted((json.loads(line) for line in content.splitlines()), key=lambda r: r["id"])
        assert [r["id"] for r in got] == list(range(1, n + 1))
        assert [r["conversations"][1]["context"] for r in got] == [
            f"text {split} {i}" for i in range(n)
        ]


@pytest.mark.parametrize("tasks", [1, 5])
def test_each_json_array_file_parses(spark, tmp_path, tasks):
    sizes = {"train": 25, "val": 10, "test": 0}
    df = split_table(spark, train=25, val=10).repartition(tasks)
    sinks.export(df, str(tmp_path / "a"), "ark", sizes=sizes)
    found = {}
    for split in sizes:
        parts = sorted((tmp_path / "a" / f"split={split}").glob("part-*"))
        arrays = [json.loads(p.read_text(encoding="utf-8")) for p in parts]
        assert 1 <= len(arrays) <= tasks
        found[split] = sorted(r["input"] for a in arrays for r in a)
    assert found["train"] == sorted(f"text train {i}" for i in range(25))
    assert len(found["val"]) == 10 and found["test"] == []


def test_json_arrays_over_small_batches(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        sinks.export(split_table(spark, train=20, val=7).coalesce(1), str(tmp_path / "b"), "ark")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for split, n in (("train", 20), ("val", 7)):
        (part,) = (tmp_path / "b" / f"split={split}").glob("part-*")
        assert len(json.loads(part.read_text(encoding="utf-8"))) == n


def test_ordered_json_lines(spark, tmp_path):
    sinks.export(split_table(spark, train=40, val=9), str(tmp_path / "o"), "openai", ordered=True)
    for split, n in (("train", 40), ("val", 9)):
        lines = folder(tmp_path / "o", split)[0].splitlines()
        assert [json.loads(line)["messages"][1]["content"] for line in lines] == [
            f"text {split} {i}" for i in range(n)
        ]


def test_export_without_ids_does_not_shuffle(spark):
    df = split_table(spark, train=5)
    fmt = get_format("openai")
    lines = to_json_lines(to_records(df, fmt))
    assert lines._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # repartition(5)


def test_id_buckets_do_not_change_ids(spark):
    df = split_table(spark, train=100, val=3)

    def ids(width):
        return sorted((r.split, r.seq, r.id) for r in add_ids(df, width=width).collect())

    assert ids(1) == ids(7) == ids(1 << 20)


def test_ids_of_sparse_numbers_and_null_groups(spark):
    df = spark.range(2000).selectExpr(
        "id * 200000 as seq", "if(id % 10 = 0, null, concat('s', id % 2)) as split"
    )
    got = add_ids(df, width=100).collect()
    assert len(got) == 2000
    for name in (None, "s0", "s1"):
        mine = sorted((r.seq, r.id) for r in got if r.split == name)
        assert [i for _, i in mine] == list(range(1, len(mine) + 1))


def test_places_over_a_range_shuffle(spark):
    from pyspark.sql import functions as F

    from labelmill.operators.rank import add_places
    from labelmill.sources.staging import Staging

    df = spark.range(500).selectExpr("id", "id % 7 as v")
    with Staging(spark) as staging:
        rows = add_places(df, (F.desc("v"), F.col("id")), staging, "t").collect()
    ordered = sorted(rows, key=lambda r: (-r.v, r.id))
    assert [r.place for r in ordered] == list(range(1, 501))


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_tables_keep_their_columns_when_empty(spark, tmp_path, format):
    schema = "input string, similarity double, similar_text string"
    rows = [('a "b", c\n x', 0.9, "y")]
    for name, data in (("full", rows), ("empty", [])):
        path = f"{tmp_path}/{name}"
        sinks.write_table(spark.createDataFrame(data, schema), path, format)
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        back = reader.schema(schema).format(format).load(path)
        assert back.columns == ["input", "similarity", "similar_text"]
        assert [tuple(r) for r in back.collect()] == data
    if format == "csv":
        header = "".join(p.read_text() for p in (tmp_path / "empty").glob("part-*")).strip()
        assert header == '"input","similarity","similar_text"'


def test_run_paths():
    from datetime import datetime

    stamp = sinks.run_stamp(datetime(2026, 4, 2, 18, 32, 28))
    assert stamp == "2026-04-02_18-32-28"
    assert sinks.run_path("/o", "train", stamp, ".jsonl") == "/o/train_2026-04-02_18-32-28.jsonl"
