"""JSON arrays in parallel: every way to cut a file gives the rows that a parser gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cuefold.sources import files, json_arrays, sinks

SCHEMA = "a string, b array<int>, c struct<d:string,e:double>"


def rows_of(n, seed=0):
    rng = random.Random(seed)
    odd = ['"', "\\", "{", "}", "[", "]", ",", "\n", "é", "۔", "x", " ", "\\\"", "}{"]
    text = lambda: "".join(rng.choice(odd) for _ in range(rng.randrange(12)))
    return [{"a": text() if rng.random() > 0.1 else None, "b": [rng.randrange(9) for _ in range(rng.randrange(4))], "c": {"d": text(), "e": rng.random()}} for _ in range(n)]


def split_by(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)


@pytest.fixture
def small_ranges(spark):
    split_by(spark, 97)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def plain(row):
    return (row.a, None if row.b is None else list(row.b), (row.c.d, row.c.e))


@pytest.mark.parametrize("indent", [None, 1])
def test_ranges_give_what_a_parser_gives(spark, tmp_path, small_ranges, indent):
    want = {}
    for k in range(3):
        rows = rows_of(40 * k + 1, k)
        (tmp_path / f"f{k}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=bool(k)), encoding="utf-8")
        want |= {(f"f{k}.json", i): (r["a"], r["b"], (r["c"]["d"], r["c"]["e"])) for i, r in enumerate(rows)}
    got = json_arrays.read(spark, str(tmp_path / "*.json"), SCHEMA)
    assert json_arrays._pieces(spark, str(tmp_path / "f2.json")).select("start").distinct().count() > 20
    assert {(r.file.rsplit("/", 1)[1], r.pos): plain(r) for r in got.collect()} == want


def test_arrays_of_nothing_and_broken_ones(spark, tmp_path):
    for name, text in {"empty": "[]", "blank": "[ \n ]\n", "one": '﻿[{"a": "}"}]'}.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    read = lambda name: json_arrays.read(spark, str(tmp_path / f"{name}.json"), SCHEMA).collect()
    assert read("empty") == read("blank") == [] and [(r.pos, r.a, r.b) for r in read("one")] == [(0, "}", None)]
    for name, text in {"cut": '[{"a": "x"}, {"a": "y"', "string": '[{"a": "x', "many": '[{"a": "x"}'}.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
        with pytest.raises(ValueError, match="whole"):
            read(name)


def test_an_element_longer_than_ranges(spark, tmp_path, small_ranges):
    rows = [{"a": "}" * 900, "b": [1], "c": {"d": "x", "e": 1.0}}, {"a": "z", "b": [], "c": {"d": "{" * 400 + '"' * 9, "e": 2.0}}]
    (tmp_path / "long.json").write_text(json.dumps(rows), encoding="utf-8")
    got = sorted(json_arrays.read(spark, str(tmp_path / "long.json"), SCHEMA).collect(), key=lambda r: r.pos)
    assert [plain(r) for r in got] == [(r["a"], r["b"], (r["c"]["d"], r["c"]["e"])) for r in rows]


def test_written_in_parallel_byte_by_byte(spark, tmp_path):
    rows = [{"pos": p, "a": r["a"], "n": r["c"]["e"]} for p, r in enumerate(rows_of(300))]
    df = spark.createDataFrame([(r["pos"], r["a"], r["n"]) for r in rows], "pos long, a string, n double").repartition(7)
    path = tmp_path / "out" / "all.json"
    sinks.json_array(df, str(path))
    text = path.read_text(encoding="utf-8")
    assert json.loads(text) == [{"a": r["a"], "n": r["n"]} for r in rows]
    pretty = [r.json.replace("\n", "\n  ") for r in df.orderBy("pos").select(F.to_json(F.struct("a", "n"), {"pretty": "true", "ignoreNullFields": "false"}).alias("json")).collect()]
    assert text == "[\n  " + ",\n  ".join(pretty) + "\n]"
    sinks.json_array(df.where("pos < 0"), str(path))
    assert path.read_text() == "[\n]" and [p.name for p in path.parent.iterdir() if not p.name.startswith(".")] == ["all.json"]
    for bad, said in ((df.withColumn("pos", F.lit(1).cast("long")), "repeats"), (df.withColumn("pos", F.lit(None).cast("long")), "null")):
        with pytest.raises(ValueError, match=said):
            sinks.json_array(bad, str(path))


def test_manifests_of_both_forms(spark, tmp_path):
    df = spark.createDataFrame([(0, "a/EP1_x/EP1_x_000.wav", "t", 1.0, "ur")], "pos long, audio_path string, transcript string, duration double, language string")
    sinks.manifest(df, str(tmp_path / "one" / "manifest.json"))
    sinks.manifest(df, str(tmp_path / "two" / "manifest.jsonl"))
    assert sorted(r.folder for r in files.manifests(spark, str(tmp_path)).collect()) == ["one", "two"]
    lines = tmp_path / "reviewed.jsonl"
    lines.write_text("\n".join(json.dumps({"transcript": f"t{k}", "chunk_index": k}) for k in range(5)), encoding="utf-8")
    assert [(r.pos, r.chunk_index) for r in files.reviewed(spark, str(lines)).orderBy("pos").collect()] == [(k, k) for k in range(5)]
