"""Ties of first rows, character references, last names of several words."""

import html

from pyspark.sql import functions as F

from scholium.functions.text import sanitize, unescape
from scholium.operators.dedup import keep_first
from scholium.operators.quality import roster_absent


def test_one_row_of_each_key_on_ties(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 7, "c"), (None, 1, "d"), (None, 1, "d"), (2, None, "e")], "k int, o int, v string")
    got = sorted(((r.k, r.o, r.v) for r in keep_first(rows, ["k"], ["o"]).collect()), key=str)
    assert [(k, o) for k, o, _ in got] == [(1, 5), (2, None), (None, 1)]
    assert keep_first(rows.limit(0), ["k"], ["o"]).count() == 0


def test_references_as_in_html(spark):
    texts = ["Caf&eacute; &#233;", "a &amp;lt; b &lt;i&gt;", "&#x1F600;&#128;&#0;&#xD800;&#99999999999;", "&nosuch; & plain &", "", "&hellip;&#39;&#x27;x&#8212", "&#1;z&#x0041;&Aacute;&", "no reference"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(unescape(F.col("t"))).collect()]
    assert got == [html.unescape(t) for t in texts]


def test_sanitize_keeps_null(spark):
    rows = spark.createDataFrame([(None,), ("<i>Caf&eacute;</i>&nbsp; x",)], "t string").select(sanitize(F.col("t")).alias("t")).collect()
    assert rows[0].t is None and rows[1].t == "Café x"


def test_last_names_of_two_words(spark):
    roster = spark.createDataFrame([("A van der Berg", "der Berg", 30), ("B Lee Quill", "Quill", 30), ("C Absent", "Absent", 30)], "name string, last string, works int")
    present = spark.createDataFrame([("Anna van  der Bergh",), ("Mc Quillan",)], "name string")
    assert [r.last for r in roster_absent(roster, present, 20).collect()] == ["Absent"]
