"""Directory pages, rosters, harvests by identifier, reports and state files."""

import json

import pytest
from pyspark.sql import functions as F

from scholium import schemas
from scholium.functions.arrays import flat_texts
from scholium.operators import analytics, export, match, quality, report
from scholium.sources import roster

CARDS = """<body><h3>Ann Heading</h3><div class="x profile-item"><h3><a href="/p">Prof. Ann Lee</a></h3><p class="profile-title">Chair</p></div>
<div class="profile-item"><p>no name</p></div><li class="profile-item"><span class="profile-name">Bo Smith, Ph.D.</span></li><li class="profile-item"><h4>ann lee</h4></li></body>"""
PAGES = {
    "sph": '<div class="sph-profile-basic-card"><div class="sph-profile-basic-content">Ann Lee,MPH,Health</div></div><h3>Not Taken</h3>',
    "cards": CARDS,
    "filter": '<ul><li class="bu-filtering-result-item"><a>Cy Young</a><a>Second Link</a></li></ul>',
    "person": '<div class="person-card"><h2>Di Moe</h2><span class="title">Lecturer</span><script>var a = 1</script></div>',
    "second": '<div class="faculty-card"><h2>Faculty & Staff</h2></div><div class="profile-card"><a class="name">Ed Poe</a></div>',
    "listing": '<div class="profile-listing"><a href="/profile/1">Flo Roe</a><a href="/about">About Us</a><a href="/x/profile">Gus Tay</a></div>',
    "headings": "<h2>Our Team</h2><h3>Hal Upp, PhD</h3><h4>Ian Vox</h4><h5>Research Areas</h5><h3>One</h3>",
    "links": '<h2><a href="/people/j">Jo Wye</a></h2><h2><a href="/news">Not This</a></h2><p><br></p></div>',
    "none": "<p>Nobody Here</p>", "empty": "", "null": None,
}
FOUND = {
    "sph": [("Ann Lee", "MPH")], "cards": [("Ann Lee", "Chair"), ("Bo Smith", "")], "filter": [("Cy Young", "")], "person": [("Di Moe", "Lecturer")], "second": [("Ed Poe", "")],
    "listing": [("Flo Roe", ""), ("Gus Tay", "")], "headings": [("Hal Upp", ""), ("Ian Vox", "")], "links": [("Jo Wye", "")], "none": [], "empty": [], "null": [],
}


def test_each_strategy(spark):
    pages = spark.createDataFrame([(k, v) for k, v in PAGES.items()], "k string, html string")
    got = {r.k: [(p["name"], p["title"]) for p in r.people] for r in roster.people(roster.scan(pages)).collect()}
    want = {k: v for k, v in FOUND.items()}
    assert got == want
    assert roster.people(roster.scan(pages.limit(0))).count() == 0


def test_deep_and_broken_pages():
    deep = "<div>" * 5000 + "<h3>Ann Lee</h3>" + "</p></div>" * 6000
    assert [t for _, t, _ in roster.names_of_page(deep)] == ["Ann Lee"]


def test_roster_pages_and_names(spark):
    h = lambda *names: "".join(f"<h3>{n}</h3>" for n in names)
    rows = [
        ("A", 0, "u", 1, h("Ann Lee", "Bo Poe")), ("A", 0, "u", 2, h("ann lee")), ("A", 0, "u", 3, ""), ("A", 0, "u", 4, h("Cy Roe")), ("A", 0, "u", 5, ""), ("A", 0, "u", 6, h("Too Late")),
        ("A", 1, "v", 1, h("Bo Poe")), ("B", 2, "w", 1, h("BO POE", "Di Tay")), ("B", 2, "w", 3, h("After Gap")),
    ]
    people, counts = roster.roster(spark.createDataFrame(rows, "school string, ord int, source_url string, page int, html string"))
    assert sorted(tuple(r) for r in people.collect()) == [("Ann Lee", "", "A", "u"), ("Bo Poe", "", "A", "u"), ("Cy Roe", "", "A", "u"), ("Di Tay", "", "B", "w")]
    assert {r.school: r.n for r in counts.collect()} == {"A": 3, "B": 2}


def test_page_addresses(spark):
    rows = spark.createDataFrame([("http://x/d", 1, "num"), ("http://x/d", 2, "num"), ("http://x/d/", 2, "paged"), ("http://x/d/", 3, "page")], "u string, p int, s string")
    got = [r[0] for r in rows.select(roster.page_url(F.col("u"), F.col("p"), F.col("s"))).collect()]
    assert got == ["http://x/d", "http://x/d/?num=2", "http://x/d?paged=2", "http://x/d/page/3/"]


def test_by_author_takes_a_paper_once(spark):
    schema = "author_id string, title string, abstract string, doi string, fp string, arrival long, year int"
    papers = spark.createDataFrame([
        ("a", "deep nets", None, "d1", "f1", 1, 2014), ("b", "deep nets", None, "d1", "f1", 2, 2014), ("b", "deep sea", "", "", "f2", 3, 2021), ("a", "deep sea", "", None, "f2", 4, 2021),
        ("a", "shallow", "", "d3", "f3", 5, 2021), ("c", "deep", "", "d4", "f4", 6, 2021), ("b", "deep known", "", "d9", "f5", 7, 2021), ("a", None, "deep", "d6", "f6", 8, None),
    ], schema)
    people = spark.createDataFrame([("a", "Ann", "X"), ("b", "Bo", None), ("", "No Id", "Y"), (None, "None", "Y")], "openalex_id string, name string, school string")
    got = roster.by_author(papers, people, spark.createDataFrame([("d9", "f9")], "doi string, fp string"), ["deep"])
    assert sorted((r.arrival, r._harvested_via, r._faculty_school) for r in got.collect()) == [(1, "Ann", "X"), (3, "Bo", ""), (8, "Ann", "X")]
    schools, decades = roster.author_breakdown(got)
    assert {r.school: r.n for r in schools.collect()} == {"X": 2, "": 1}
    assert {r.decade: r.n for r in decades.collect()} == {2010: 1, 2020: 1}


def test_split_profiles(spark):
    people = spark.createDataFrame([("Chris Lee", "P1"), ("Solo", "P9"), (None, "P8")], "name string, openalex_id string")
    schema = "id string, display_name string, alternatives array<string>, works_count int, last_institutions array<string>"
    rows = [
        ("P1", "Chris Lee", None, 50, []), ("P2", "Christopher Lee", None, 10, ["Near"]), ("P3", "C. Lee", None, 9, []), ("P4", "Dana Lee", ["C Lee", "Chris Q. Lee"], 11, None),
        ("P5", "Chris Lee", None, 99, ["Far"]), ("P6", "Chris Loe", None, 99, []), ("P7", None, [None], 99, []),
    ]
    got = match.split_profiles(people, spark.createDataFrame(rows, schema), ["near"])
    assert sorted((r.name, r.id, r.works) for r in got.collect()) == [("Chris Lee", "P2", 10), ("Chris Lee", "P4", 11)]
    assert match.split_profiles(people, spark.createDataFrame([], schema), ["near"]).count() == 0


def test_search_text():
    assert roster.search_text("U", ["M"], ["w x"]) == '("U"[Affiliation]) AND ("M"[MeSH Terms] OR "w x"[Title/Abstract])'


def test_flat_texts(spark):
    rows = spark.createDataFrame([([[["a", None], None], None, [["b"], []]],), ([],), (None,)], "v array<array<array<string>>>")
    assert [r[0] for r in rows.select(flat_texts(F.col("v"), 2)).collect()] == [["a", "b"], [], None]


@pytest.fixture
def master(spark):
    fields = f"index int, title string, authors array<{schemas.AUTHOR}>, year int, venue string, doi string, abstract string, url string, source string, all_sources array<string>, citation_count int, publication_type string, ai_relevance string, domains array<string>, subfields array<string>, bu_schools array<string>, bu_category string"
    person = lambda n, ours, at="": (n, at, ours, None, None, None)
    rows = [
        (0, "One", [person("Ann", True, "Dept of Law"), person("Bo", False)], 2020, "J", "d", "a", "u", "x", ["x", "y"], 7, "article", "primary", ["Health"], ["Vision"], ["Arts", "Law"], "BOTH"),
        (1, "Two", [person("Ann", True, "ECE")], 2023, "J", "", None, "", "x", None, 9, None, None, ["Health", "Law"], [], ["Arts"], None),
        (2, None, [], None, None, None, "", None, None, [], None, "article", "primary", None, None, None, "LAW"),
    ]
    return spark.createDataFrame(rows, fields)


def test_statistics(master):
    got = {(r.section, r.value): (r.n, r.pct) for r in report.statistics(master).collect()}
    assert [got["category", c] for c in ("LAW", "NON-LAW", "BOTH", "UNCLASSIFIED")] == [(1, 33.3), (0, 0.0), (1, 33.3), (1, 33.3)]
    assert got["school", "Arts"] == (2, None) and got["type", "unknown"] == (1, None) and got["relevance", "unclassified"] == (1, 33.3)
    assert got["domain", "Health"] == (2, None) and got["year", "2023"] == (1, None) and got["cited", "Two"] == (9, None) and got["author", "Ann"] == (2, None) and ("author", "Bo") not in got
    text = report.statistics_text(report.statistics(master), "T", 1)
    assert text.startswith("# T\n\n## category\n") and text.index("2023") < text.index("2020  ") and "█" in text
    empty = report.statistics(master.limit(0))  # no share of no papers
    assert sorted((r.value, r.n) for r in empty.collect()) == sorted((c, 0) for c in report.CATEGORIES)


def test_reports(spark, master):
    rows = lambda data, schema: spark.createDataFrame(data, schema)
    titles, people = "title string", rows([("Ann", 6), ("Bo", 9)], "name string, n long")
    monthly = report.monthly(
        "M", {"added": 1200}, rows([("x", 3, "ok", 1.0, None), ("y|z", 5, "FAILED", 2.0, "boom")], "source string, count int, status string, duration_s double, error string"), rows([("Arts", 2)], "school string, n long"),
        rows([], "name string, school string, ours int, theirs int, ratio double"), rows([("T", 100)], "title string, milestone int"), rows([("P",)], titles), rows([(404, "B")], "status int, title string"), rows([("k", 1, 2, "growth")], "key string, n_before long, n_after long, trend string"), people, ["bad"],
    )
    for part in ("- added: 1,200", "| y\\|z | 5 | FAILED | 2.0 |", "- Arts: 2", "- 100+: T", "- P", "- [404] B", "- k 1 to 2 growth", "- Bo: 9\n- Ann: 6", "- FAILED: y|z boom", "- bad"):
        assert part in monthly
    assert "Coverage gaps" not in monthly
    sample = rows([("t", "a", "primary", 0.5, "s", ["Arts"])], "title string, abstract string, relevance string, confidence double, summary string, schools array<string>")
    quarterly = report.quarterly("Q", master, rows([("Ann", None, 1)], "name string, school string, n long"), sample, rows([("2024-01-W1", 3, "█")], "week string, added long, bar string"), people, rows([("A", "B", 4)], "a string, b string, n long"), {"zero_weeks": 2, "health": {}}, 2023)
    for part in ("- total: 3", "- Ann (): 1", "- [primary 0.50] t: s", "- 2024-01-W1 █ 3", "- 9: Two", "- 2023: 1", "- Health: 2", "- A + B: 4", "- zero weeks: 2"):
        assert part in quarterly
    missing = rows([("Cy", "Math", None)], "name string, department string, notes string")
    gap = report.gap_report("G", master, rows([("Ann",), ("Cy",)], "name string"), missing)
    for part in ("- papers: 3", "- without abstract: 2", "- in several sources: 1", "- x: 2", "- unknown: 1", "- Engineering: 1", "- Law: 1", "- found: 1", "- Cy (Math) ", "- 2021, 2022"):
        assert part in gap
    ours, gone = rows([("Ann", f"t{i}") for i in range(7)], "name string, title string"), rows([("Bo", "s", "lost")], "name string, source string, title string")
    lines = report.audit_lines(rows([("Ann",), ("Bo",), ("Cy",)], "name string"), ours, gone)
    assert sorted((r.name, r.n_ours, r.n_missing, r.titles) for r in lines.collect()) == [("Ann", 7, 0, [f"t{i}" for i in range(5)]), ("Bo", 0, 1, None)]
    text = report.audit("A", lines)
    ordered = report.audit_rows(rows([("Ann",), ("Bo",), ("Cy",)], "name string"), ours, gone).orderBy("order")
    assert [r.text for r in ordered.collect()] == [x for x in text.split("\n") if x and x != "# A"]
    assert text.index("Bo: 0 papers, 1 missing") < text.index("Ann: 7 papers") and "- missing from s: lost" in text


def test_counts(spark):
    papers = spark.createDataFrame([(["Arts", "Unspecified", ""], ["openalex", "own"]), (["Arts"], None), (None, [])], "bu_schools array<string>, all_sources array<string>")
    people = spark.createDataFrame([("i",), ("",), (None,)], "openalex_id string")
    got = {(r.what, r.label): r.n for r in analytics.publication_counts(papers, people).collect()}
    assert got == {("papers", ""): 3, ("schools", ""): 1, ("roster", ""): 3, ("with_id", ""): 1, ("mentions", "OpenAlex"): 1, ("mentions", "own"): 1}
    new = {r.school: r.n for r in analytics.new_by_value(papers.select(F.when(F.size("bu_schools") != 1, F.col("bu_schools")).alias("s")), "s").collect()}
    assert new == {"Arts": 1, "Unspecified": 1, "": 1, "Unknown": 2}
    raw = spark.createDataFrame([("a",), ("a",), (None,)], "source string")
    assert sorted(((r.source, r.raw, r.new, r.dupes) for r in analytics.source_counts(raw, raw.filter("source = 'a'").limit(1)).collect()), key=str) == [("a", 2, 1, 1), (None, 1, 0, 1)]


def test_state_files_and_sizes(spark, tmp_path):
    state = str(tmp_path / "state")
    assert export.load_state(spark, state, {"n": 1}) == {"n": 1}
    export.save_state(spark, state, {"cost": 2.5, "health": {"a": [1]}})
    assert export.load_state(spark, state, {"n": 1, "cost": 0}) == {"n": 1, "cost": 2.5, "health": {"a": [1]}}
    index = str(tmp_path / "index")
    export.save_index(spark.createDataFrame([("b", 1), ("a", 2), ("a", 3)], "doi string, n int"), index, ["doi"])
    assert sorted(r.doi for r in spark.read.parquet(index).collect()) == ["a", "b"]
    records = spark.createDataFrame([(i, json.dumps({"t": f"x, {i}];"})) for i in range(3)], "index int, json string")
    script = str(tmp_path / "script")
    export.write_lines(export.script_lines(records).orderBy("index").select("line"), script)
    assert export.parses_back(spark, script, 3) and not export.parses_back(spark, script, 4)
    size, digest = export.path_sizes(spark, script)
    assert size > 0 and len(digest) == 16 and export.path_sizes(spark, script) == (size, digest)


def test_gate_of_files(spark, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad"
    spark.range(2).write.parquet(good)
    bad.mkdir()
    (bad / "x.parquet").write_bytes(b"not parquet")
    got = {(r.check_name, r.message.split(":")[0]) for r in quality.files_there(spark, [str(tmp_path / "no")], [good, str(bad)]).collect()}
    assert got == {("missing", str(tmp_path / "no")), ("unreadable", str(bad))}
