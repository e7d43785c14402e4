"""Scalar functions on fixed cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from scholium.functions import arrays as A
from scholium.functions import text as T
from scholium.operators import filters


def values(spark, f, cells, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r.v for r in df.select("i", f(F.col("c")).alias("v")).orderBy("i").collect()]


CASES = [
    (T.sanitize, ["A &lt;i&gt;new&lt;/i&gt;  test", None, "x <jats:p>y</jats:p>"], ["A new test", None, "x y"]),
    (T.normalize_title, ["Attention Is All You Need", "Foo .", "Étude on _x!", None], ["attention is all you need", "foo ", "étude on _x", ""]),
    (T.fingerprint, ["Attention Is All You Need", "Foo .", "Étude on _x!", None], ["431e0c981c0c16d7152e369c4da83b25", "d83d7e46b5a299f6dfd0b80b406c9d4e", "cf6cf65189f8d0fd556e0b1aba8b97dd", hashlib.md5(b"").hexdigest()]),
    (T.normalize_doi, [" HTTPS://DOI.org/10.1/AB ", "https://doi.org/doi:10.1/x", "doi.org/10.1/y", "", None], ["10.1/ab", "10.1/x", "10.1/y", None, None]),
    (T.name_key, ["José A. Núñez-Pérez", "Madonna", "李 明"], ["nunez-perez jose", "madonna", " "]),
    (T.plain_key, ["José A. Núñez-Pérez"], ["nunezperez jose"]),
    (T.initial_key, ["José A. Núñez-Pérez"], ["nunezperez j"]),
    (T.clean_name, ["Dr. Ann B. Lee, Ph.D.", "Prof. X (emeritus)"], ["Ann B. Lee", "X"]),
    (T.is_person_name, ["Ann Lee", "Ann", "Meet our faculty", "A 1 b"], [True, False, False, False]),
    (T.first_last, ["Lee, Ann", "Ann Lee"], ["Ann Lee", "Ann Lee"]),
    (T.last_first, ["Ann B. Lee", "Lee"], ["Lee, Ann B.", "Lee"]),
    (T.strip_number_suffix, ["Wei Wang 0001", "Wei Wang"], ["Wei Wang", "Wei Wang"]),
    (T.first_year, ["Spring 2019", "none"], [2019, None]),
    (T.tokens, ["abcdefgh", "abc", None], [2, 0, 0]),
    (T.source_label, ["dblp", "other"], ["DBLP", "other"]),
    (T.surname, ["Ann O'Neil-Lee", ""], ["lee", ""]),
    (lambda c: T.bar(F.length(c), 3), ["abcdefg"], ["██"]),
    (lambda c: filters.has_term(c), ["Cold storage", "Tea"], [True, False]),
    (lambda c: filters.has_term(c, whole_words=True), ["Cold storage", "a RAG system"], [False, True]),
]


@pytest.mark.parametrize("f,cells,want", CASES)
def test_cases(spark, f, cells, want):
    assert values(spark, f, cells) == want


def test_title_similarity(spark):
    df = spark.createDataFrame([("A B C", "a b c d"), ("", "x"), (None, "x")], "a string, b string")
    assert [r.v for r in df.select(T.title_similarity(F.col("a"), F.col("b")).alias("v")).collect()] == [0.75, 0.0, 0.0]


def test_inverted_text(spark):
    df = spark.sql("select map('we', array(0), 'deep', array(1, 3), 'go', array(2)) as m")
    assert df.select(T.inverted_text(F.col("m")).alias("v")).first().v == "we deep go deep"


def test_parse_response(spark):
    good = '```json\n{"ai_relevance": "primary", "domains": ["a"]}\n```'
    out = values(spark, T.parse_response, [good, "{bad", '{"confidence": 0.9}'])
    assert (out[0].ai_relevance, out[0].domains, out[0].confidence, out[0].parse_error) == ("primary", ["a"], 0.5, False)
    assert (out[1].ai_relevance, out[1].annotation, out[1].parse_error) == ("peripheral", "{bad", True)
    assert (out[2].ai_relevance, out[2].confidence, out[2].parse_error) == ("peripheral", 0.9, False)


def test_best_url(spark):
    df = spark.createDataFrame([("pdf", "u", "d"), ("", "https://openalex.org/W1", "10.1/x"), (None, "https://r.org/1", "d"), (None, None, None)], "p string, u string, d string")
    both = df.select(T.best_url(F.col("p"), F.col("u"), F.col("d")).alias("a"), T.export_url(F.col("p"), F.col("u"), F.col("d")).alias("b")).collect()
    assert [r.a for r in both] == ["pdf", "https://doi.org/10.1/x", "https://r.org/1", None]
    assert [r.b for r in both] == ["https://doi.org/d", "https://doi.org/10.1/x", "https://doi.org/d", ""]


def test_bibtex_key(spark):
    df = spark.createDataFrame([("Ann Smith", 2020, "On the Deep End")], "a string, y int, t string")
    assert df.select(T.bibtex_key(F.col("a"), F.col("y"), F.col("t")).alias("k")).first().k == "Smith2020deep"


def test_arrays(spark):
    row = spark.range(1).select(A.ordered_union(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("a"), F.lit("c"))).alias("u"), A.same_set(F.array(F.lit("x")), F.array(F.lit("x"), F.lit("x"))).alias("s"), A.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))).alias("c")).first()
    assert row.u == ["b", "a", "c"] and row.s and abs(row.c - 0.5**0.5) < 1e-12


def test_search_language(spark):
    assert filters.parse_search('author:Chris -venue:"big press" year:2024..2026 free') == [(False, "author", "Chris"), (True, "venue", "big press"), (False, "year", "2024..2026"), (False, "text", "free")]
    df = spark.createDataFrame([(1, "Deep nets", ["Christopher T. Robertson"], "J", 2024, ["Law"], ["AI"], ["x y"], "s"), (2, "Other", ["Ann Lee"], "Big Press", 2020, [], [], [], None)], "id int, title string, author_names array<string>, venue string, year int, schools array<string>, domains array<string>, subfields array<string>, summary string")
    hits = lambda q: [r.id for r in filters.search(df, q).orderBy("id").collect()]
    assert hits("author:Chris") == [1] and hits('author:"C. Robertson"') == [1] and hits("-author:Lee") == [1]
    assert hits("year:2020..2021") == [2] and hits('venue:"big press"') == [2] and hits('subfield:"x y" deep') == [1] and hits("school:law -domain:ai") == []


def test_references_as_html_reads_them(spark):
    import html
    import random
    from html.entities import html5

    r = random.Random(1)
    names = list(html5)
    cells = ["AT&amp T &copy 2020", "&notit; &notin; &ampamp; &amp;lt; &#65 &#x41; &#xZ &# & &; &unknown; &AMPx &#0; &#x80; &#129; &#xD800; &#1114112; &#99999999999;", *("&" + n for n in names)]
    cells += ["".join(r.choice(["x", " ", "&", "&" + r.choice(names), "&" + r.choice(names).rstrip(";"), ";", f"&#{r.randrange(300)}", "-", "é"]) for _ in range(12)) for _ in range(1000)]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
    got = {x.i: x.o for x in df.select("i", T.unescape(F.col("c")).alias("o")).collect()}
    assert [got[i] for i in range(len(cells))] == [html.unescape(c) for c in cells]


def test_inverted_index(spark):
    texts = ["b a b c b", "one", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.inverted_index(F.split("t", " ")).alias("x")).select("i", "x", T.inverted_text(F.col("x")).alias("t")).orderBy("i").collect()
    assert [r["x"] for r in rows] == [{"a": [1], "b": [0, 2, 4], "c": [3]}, {"one": [0]}, {"": [0]}, None]
    assert [r["t"] for r in rows] == texts
    assert spark.range(1).select(F.size(T.inverted_index(F.array().cast("array<string>")))).first()[0] == 0


def test_a_name_is_folded_once(spark):
    names = spark.createDataFrame([("José A. Núñez-Pérez",), ("Madonna",), ("Ann  Lee",), (None,)], "n string").select(T.name_key(F.col("n")).alias("k"))
    assert [r["k"] for r in names.collect()] == ["nunez-perez jose", "madonna", "lee ann", None]
    assert names._jdf.queryExecution().analyzed().toString().count("translate(") == 1


def test_references_are_searched_once(spark):
    """Searching a text anew for each of its references takes time that grows with the square of their number."""
    plan = spark.range(1).select(T.unescape(F.col("id").cast("string")).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1
    many = spark.range(1).select(F.repeat(F.lit("a &eacute;&#233;&#xE9;&eacute&notit;&nope; &"), 500).alias("t"))
    assert many.select(T.unescape(F.col("t")).alias("t")).first().t == "a éééé¬it;&nope; &" * 500
