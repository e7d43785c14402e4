"""Operators on small cases, and a plain model of merging."""

import random

import pytest
from pyspark.sql import functions as F

from scholium.operators import analytics, dedup, export, filters, maintain, match, quality

KEYS = "arrival int, doi string, fp string, source string, citation_count int, title string, concepts array<string>"


def founder_model(rows):
    by_doi, by_fp, out = {}, {}, {}
    for a, doi, fp in sorted(rows):
        hit = by_doi.get(doi) if doi else None
        hit = by_fp.get(fp) if hit is None else hit
        if hit is None:
            hit = a
            if doi:
                by_doi[doi] = a
            by_fp[fp] = a
        out[a] = hit
    return out


@pytest.mark.parametrize("seed", range(4))
def test_founders_follow_arrival(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.choice(["", None, *(f"d{k}" for k in range(12))]), f"t{r.randrange(14)}") for i in range(60)]
    df = spark.createDataFrame(rows, "arrival int, doi string, fp string")
    assert {x.arrival: x.founder for x in dedup.founders(df).collect()} == founder_model(rows)


def test_merge(spark):
    rows = [(1, "d1", "T1", "a", 0, "T1", ["x"]), (2, "d2", "T1", "b", 7, "T1", ["y", "x"]), (3, "d2", "T2", "c", 1, "T2", None)]
    out = {r.arrival: r for r in dedup.merge(spark.createDataFrame(rows, KEYS)).collect()}
    assert set(out) == {1, 3}
    assert (out[1].all_sources, out[1].citation_count, out[1].doi, out[1].concepts) == (["a", "b"], 7, "d1", ["x", "y"])
    assert out[3].all_sources is None
    chain = [(1, None, "T1", "a", 0, "T1", []), (2, "d1", "T1", "b", 0, "T1", []), (3, "d1", "T3", "c", 0, "T3", [])]
    out = {r.arrival: r.doi for r in dedup.merge(spark.createDataFrame(chain, KEYS)).collect()}
    assert out == {1: "d1", 3: "d1"}
    assert dedup.merge(spark.createDataFrame([], KEYS)).count() == 0


def test_anti_dedup_keeps_batch_duplicates(spark):
    batch = spark.createDataFrame([(1, "d9", "t9"), (2, "d9", "t9"), (3, "d1", "tx"), (4, None, "t2"), (5, None, "t7")], "id int, doi string, fp string")
    master, rejected = (spark.createDataFrame(x, "doi string, fp string") for x in ([("d1", "t1"), (None, "t2")], [("d1", "t0"), (None, "t7")]))
    assert {r.id: r.caught for r in dedup.anti_dedup(batch, [master, rejected]).collect()} == {1: None, 2: None, 3: 0, 4: 0, 5: 1}


AUTHORS = "array<struct<name:string,affiliation:string,is_bu:boolean,openalex_id:string>>"
ROSTER = "name string, school string, secondary_school string, openalex_id string, alternate_openalex_ids array<string>, ord int"


@pytest.fixture(scope="module")
def roster(spark):
    return spark.createDataFrame(
        [("Ann Lee", "Engineering", None, "A1", ["A9"], 1), ("Bob Ray", "School of Law", None, "A2", None, 2), ("Cy Fox", "Engineering", None, "A3", [], 3), ("Cy Fox", "Arts", None, "A4", [], 4), ("Di Orr", "Arts", "School of Law", "A5", [], 5)], ROSTER
    )


def test_verification(spark, roster):
    papers = spark.createDataFrame([(1, [("X", "", True, None)]), (2, [("X", "", False, "A9"), ("Y", "", None, None)]), (3, [("Bob Ray", "", False, None)]), (4, [("Cy Fox", "", False, None)]), (5, []), (6, None)], f"paper_id int, authors {AUTHORS}")
    out = {r.paper_id: [a.is_bu for a in r.authors] for r in match.verify_authors(papers, roster).collect()}
    assert out == {1: [True], 2: [True, False], 3: [True]}


def test_schools(spark, roster):
    rules = [("university of x school of law", "School of Law", "LAW"), ("school of law", "School of Law", "LAW"), ("surgery", "Medicine", "NON-LAW")]
    cases = [
        (1, [("Q", "", False, "A1"), ("R", "", False, "A2")]), (2, [("Q", "University of Y, School of Law", False, None)]), (3, [("Q", "University of Y, School of Law", True, None)]), (4, [("Bob Ray", "", True, None)]),
        (5, [("Cy Fox", "", True, None)]), (6, [("Q", "", False, "A5")]), (7, [("Bob Ray", "", True, None)] + [("Z", "", False, None)] * 30), (8, []),
    ]
    papers = spark.createDataFrame(cases, f"paper_id int, authors {AUTHORS}")
    out = {r.paper_id: (r.bu_schools, r.bu_category) for r in match.assign_schools(papers, roster, rules, ["target university"], "Unit (unspecified)").collect()}
    assert out[1] == (["Engineering", "School of Law"], "BOTH")
    assert out[2] == ([], "UNCLASSIFIED") and out[3] == (["School of Law"], "LAW") and out[4] == (["School of Law"], "LAW")
    assert out[5] == (["Unit (unspecified)"], "NON-LAW") and out[6] == (["Arts", "School of Law"], "BOTH")
    assert out[7] == (["Unit (unspecified)"], "NON-LAW") and out[8] == ([], "UNCLASSIFIED")


def test_resolution_prefers_the_target(spark):
    rows = spark.createDataFrame([("f", "X", 9, False, 1), ("f", "Y", 3, True, 2), ("g", "Z", 1, None, 3)], "fac string, id string, works int, at boolean, ord int")
    out = {r.fac: (r.id, r.rare) for r in match.resolve_best(rows, "fac", F.col("at"), F.col("works"), "ord").collect()}
    assert out == {"f": ("Y", False), "g": ("Z", True)}


def test_best_titles(spark):
    kind = "id int, title string, year int, surnames array<string>"
    ours = spark.createDataFrame([(1, "a b c d e f g h i j", 2020, ["lee"]), (2, "k l m", 2020, []), (3, "", 2020, [])], kind)
    cand = spark.createDataFrame([(10, "a b c d e f g h i j", 2020, ["lee"], 1), (11, "a b c d e f g h i j", 2022, ["lee"], 0), (12, "A B C D E F G H I", 2021, [], 0), (13, "k l m", None, ["x"], 0)], kind + ", rank int")
    out = {r.id: (r.candidate, r.score) for r in match.best_titles(ours, cand).collect()}
    assert out == {1: (12, 0.9), 2: (13, 1.0)}


def test_backfill(spark):
    a = "array<struct<name:string,openalex_id:string>>"
    df = spark.createDataFrame([(1, [("X", None), ("Y", "o")], [("P", "p"), ("Q", "q")]), (2, [("X", None)], [("x", "1"), ("Z", "2"), ("X ", "3")])], f"id int, authors {a}, fresh_authors {a}")
    out = {r.id: [x.openalex_id for x in r.authors] for r in match.backfill_ids(df).collect()}
    assert out == {1: ["p", "o"], 2: ["3"]}


def test_relevance(spark):
    df = spark.createDataFrame([(1, "primary", ["Law AI"], None), (2, "peripheral", ["Law"], 2021), (3, None, [], 2021), (4, "methodological", ["law"], 2019)], "id int, ai_relevance string, domains array<string>, year int")
    assert [r.id for r in filters.relevance_filter(df, "methodological", "LAW", 2020).collect()] == [1]
    assert sorted(r.id for r in filters.relevance_filter(df, "unknown").collect()) == [1, 2, 3, 4]


def test_figures(spark):
    df = spark.createDataFrame([(1, ["A", "B", "C"]), (2, ["A", "U"])], "id int, s array<string>")
    assert sorted((r.a, r.b, r.n) for r in analytics.pairs(df, "s", ["U"]).collect()) == [("A", "B", 1), ("A", "C", 1), ("B", "C", 1)]
    votes = spark.createDataFrame([("p", "Law", 1), ("p", "Med", 2), ("q", "Law", 1), ("q", None, 2), ("q", None, 3)], "k string, v string, o int")
    assert {r.k: r.v for r in analytics.majority(votes, "k", "v", "o").collect()} == {"p": "Law"}
    runs = spark.createDataFrame([("s", 1, 100, True), ("s", 2, 100, True), ("s", 3, 100, True), ("s", 4, 5, True), ("s", 5, 0, False), ("s", 6, 0, False), ("s", 7, 0, False)], "source string, run_no int, n int, ok boolean")
    out = {r.run_no: r for r in analytics.source_health(runs, ok=F.col("ok")).collect()}
    assert out[4].degraded and out[4].avg_before == 100 and not out[3].degraded and out[7].failures == 3 and out[7].critical and not out[6].critical
    years = spark.createDataFrame([("g", 2018, 150), ("g", 2019, 200), ("g", 2020, 5), ("g", 2021, 180), ("g", 2022, 190)], "g string, year int, n int")
    assert [r.year for r in analytics.dips(years, "g").collect()] == [2020]
    costs = spark.createDataFrame([("g", 1, 4.0), ("g", 2, 4.0), ("g", 3, 4.0)], "g string, o int, c double")
    assert sorted(r.o for r in analytics.under_cap(costs, "g", "o", F.col("c"), 5.0).collect()) == [1, 2]
    before, after = (spark.createDataFrame(x, "k string, n int") for x in ([("a", 10), ("b", 10), ("c", 0)], [("a", 15), ("b", 16), ("c", 10)]))
    assert {r.k: (r.trend, r.growth_pct) for r in analytics.trends(before, after, "k").collect()} == {"b": ("growth", 60), "c": ("new", None)}
    week = spark.sql("select date'2026-03-30' as d, 7 as n")
    assert analytics.week_histogram(week, "d", "n").first().week == "2026-03-W5"


def test_upkeep(spark):
    master = spark.createDataFrame([("d1", 95), ("d2", 5)], "doi string, citation_count int")
    out = {r.doi: r for r in maintain.refresh_citations(master, spark.createDataFrame([("d1", 120)], "doi string, citation_count int")).collect()}
    assert out["d1"].milestone == 100 and out["d1"].citation_count == 120 and not out["d2"].changed
    old = spark.createDataFrame([("a", f"a{i}") for i in range(20)] + [("b", f"b{i}") for i in range(10)], "school string, name string")
    scraped = spark.createDataFrame([("a", f"A{i}") for i in range(9)], "school string, name string")
    assert maintain.merge_roster(scraped, old).groupBy("school").count().orderBy("school").collect()[0]["count"] == 20
    assert [r.school for r in maintain.protected_schools(scraped, old).collect()] == ["a"]
    assert sorted(r["index"] for r in maintain.numbered(spark.range(50).withColumnRenamed("id", "o"), "o").collect()) == list(range(50))


def test_quality(spark):
    papers = spark.createDataFrame([(["x"], ["x", "y"], ["s"]), (["a", "b"], ["b", "a", "a"], []), ([], [], ["s"])], "f array<string>, l array<string>, s array<string>")
    out = quality.consistency(papers, "f", "l", "s")
    assert sorted((r.level, r.check_name, r.message) for r in out.collect()) == [("FAIL", "names_differ", "1"), ("FAIL", "no_author", "1"), ("WARN", "no_school", "1")]
    assert quality.exit_code(out) == 2
    a, b, c = spark.range(100), spark.range(95), spark.range(94)
    assert quality.gate(a, b).count() == 0 and quality.gate(a, c).first().level == "FAIL"


def test_exports(spark, tmp_path):
    kind = "index int, title string, authors array<struct<name:string>>, year int, venue string, doi string, url string, pdf_url string, annotation string, ai_relevance string, domains array<string>, publication_type string, bu_schools array<string>, bu_category string, citation_count int"
    rows = [(i, "The Deep End", [("Ann Smith",)], 2020, "J", "10.1/x", "", None, "a {b}", "primary", ["D"], t, ["S", "School of Law"], "BOTH", i) for i, t in enumerate(["article", "conference paper", "PhD thesis"])]
    df = spark.createDataFrame(rows, kind)
    out = export.bibtex(df).orderBy("index").collect()
    assert [r.key for r in out] == ["Smith2020deep", "Smith2020deepb", "Smith2020deepc"]
    assert out[0].entry.startswith("@article{Smith2020deep,\n  title = {The Deep End},\n  author = {Smith, Ann},\n  year = {2020},\n  journal = {J},\n  doi = {10.1/x},\n  note = {a \\{b\\}}")
    assert "booktitle" in out[1].entry and out[2].entry.startswith("@phdthesis")
    lines = export.bibliography(df).collect()
    assert len(lines) == 6 and {r.section for r in lines} == {"LAW", "NON-LAW"}
    target = f"{tmp_path}/master"
    export.save_master(df, target)
    export.save_master(df.limit(1), target)
    assert export.read_master(spark, target).count() == 1
    assert export.fill_counts("We list 11,903 papers of 5 schools.", {"papers": 12000, "schools": 7}) == "We list 12,000 papers of 7 schools."


def test_keys_that_very_many_share(spark):
    n = 60000
    titles = spark.range(1, n + 1).select(F.col("id").alias("at"))
    keys = export.bibtex_keys(titles, F.lit("A B"), F.lit(2020), F.lit("Deep things"), "at")
    got = {r["at"]: r["key"].removeprefix("B2020deep") for r in keys.collect()}
    codes = [c for c in range(98, n + 2144) if not 0xD800 <= c < 0xE000]
    assert got[1] == "" and all(got[i + 2] == chr(c) for i, c in enumerate(codes) if i + 2 <= n)
    assert len(set(got.values())) == n


N = 100000


@pytest.fixture
def many(spark):
    """Rows of which two samples give two sets of ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.range(0, N, 1, 8).select((F.col("id") * 7919 % N).alias("at"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def places(numbered, order, name):
    rows = numbered.collect()  # with all columns, or both readings of the ranges would be one
    return [r[name] for r in sorted(rows, key=lambda r: r[order])]


def test_append_numbers_all(many):
    fresh = many.select("at", F.lit("s").alias("source"), *[F.col("text").alias(c) for c in ("pdf_url", "url", "doi")])
    master = fresh.limit(1).select((F.col("at") - N).alias("at"), F.lit(0).alias("index"), F.lit("").alias("best_url"), F.array("source").alias("all_sources"))
    assert places(maintain.append(master, fresh, "at"), "at", "index") == list(range(N + 1))


def test_audit_lines_are_numbered_all(many):
    lines = many.select(F.struct((F.col("at") % 7).alias("m"), F.lpad(F.col("at").cast("string"), 6, "0").alias("name")).alias("order"), "text")
    assert places(maintain.numbered(lines, "order", "place"), "order", "place") == list(range(N))


def test_blocks_are_numbered_all(many):
    """Sort keys with nulls, which come first."""
    blocks = many.select(F.struct(F.when(F.col("at") >= 10, F.lit("x")).alias("school"), "at").alias("_order"), "text")
    got = {r["_order"]["at"]: r["place"] for r in maintain.numbered(blocks, "_order", "place").collect()}
    assert got == {i: i for i in range(N)}


def test_sweep_arrivals_are_numbered_all(many):
    works = many.select(F.format_string("W%06d", "at").alias("source_id"), "text")
    assert places(maintain.numbered(works, "source_id", "arrival"), "source_id", "arrival") == list(range(N))
