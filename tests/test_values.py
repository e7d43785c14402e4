"""Values of any shape."""

import json

import pytest
from pyspark.sql import functions as F

from scholium.functions import values as V
from scholium.sources import files


def plain(x):
    if isinstance(x, list):
        return [y for v in x for y in plain(v)]
    return [] if x is None else [x if isinstance(x, str) else json.dumps(x, separators=(",", ":"))]


@pytest.mark.parametrize("value", [[], [[]], 7, "a", "s[[[", [1, [2, [3, ["a", None, [[["deep"]]]]]], {"k": [1, [2]]}], ["q\"[\\", True, 1.5, "", {"a": None}], None, [[[[[[["x"], "y"]]]]], "z"], "日本語 ]"])
def test_leaves(spark, value):
    df = spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "j string")
    assert df.select(V.leaf_texts(V.variant(F.col("j"))).alias("x")).first().x == plain(value)


def test_deep_and_wide(spark):
    j = "[" * 90 + '"x"' + "]" * 90
    df = spark.createDataFrame([(j,), (json.dumps([[i] for i in range(5000)]),), ("{bad",), (None,)], "j string")
    got = [r.x for r in df.select(V.leaf_texts(V.variant(F.col("j"))).alias("x")).collect()]
    assert got == [["x"], [str(i) for i in range(5000)], None, None]


@pytest.mark.parametrize("j, want", [('{"text": "A"}', ["A"]), ('"B"', ["B"]), ('[{"text": "A"}, "B", {"name": "no"}, null, ["C"], {"text": ""}]', ["A", "B", "C"]), ("[]", []), (None, None)])
def test_named(spark, j, want):
    assert spark.createDataFrame([(j,)], "j string").select(V.named(V.variant(F.col("j"))).alias("x")).first().x == want


def test_files_of_lists_and_objects(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n": 1}, {"n": 2}]')
    (tmp_path / "b.json").write_text('{"x": {"n": 3},\n "y": {"n": 4}}')
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("17")
    rows = files.json_records(spark, str(tmp_path), "n int").collect()
    assert sorted((r.key or "", r.place, r.record.n) for r in rows) == [("", 0, 1), ("", 1, 2), ("x", 0, 3), ("y", 1, 4)]


def test_entries_keep_other_columns(spark):
    df = spark.createDataFrame([(1, '{"a": 1}', "k"), (2, "[5, [6]]", "k"), (3, None, "k"), (4, '"x"', "k")], "id int, j string, key string").withColumn("v", V.variant(F.col("j")))
    got = files.entries(df.drop("j"), "v").select("id", "key", "place", F.to_json("record").alias("r")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, "a", 0, "1"), (2, None, 0, "5"), (2, None, 1, "[6]")]))
