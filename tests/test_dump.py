"""A gzipped dump: cut at record boundaries, bounded memory, parsed by all tasks."""

import gzip
import random
import tracemalloc

import pytest

from scholium.sources import dump, parsers

HEAD = '<?xml version="1.0"?>\n<!DOCTYPE dblp SYSTEM "dblp.dtd">\n<dblp>\n'


@pytest.mark.parametrize("seed", range(5))
def test_cut_wherever_lines_end(seed):
    r = random.Random(seed)
    records = [f'<{t} key="{i}"><title>{"x" * r.randrange(5)} &lt;article&gt;</title></{t}>' for i, t in enumerate(r.choices(dump.TAGS, k=200))]
    text = HEAD.replace("\n", "") + "".join(r.choice(["", "<www>no</www>", "  "]) + x for x in records) + "</dblp>"
    joined = text  # lines end before a space or after an element
    spots = [i for i, c in enumerate(joined) if c == " " or joined[i - 1 : i] == ">" and i]
    lines, last = [], 0
    for i in sorted(r.sample(spots, min(len(spots), 150))):
        lines.append(joined[last:i])
        last = i
    lines.append(joined[last:])
    got = list(dump.cut(lines))
    assert [t.replace("\n", "") for t, _ in got] == records and all(w for _, w in got)


def test_damaged_records():
    lines = ["<article key='1'><title>a</title></article><article key='2'>", *["<x/>" * 10] * 30, "<article key='3'>ok</article>", "<phdthesis>open"]
    got = list(dump.cut(lines, most=1000))
    assert [(t[:16], w) for t, w in got] == [("<article key='1'", True), ("<article key='2'", False), ("<article key='3'", True), ("<phdthesis>open\n", False)]


def entries(n):
    for i in range(n):
        yield f'<article key="a/{i}">'
        yield f"<author>Ann {i % 100}</author><title>Paper {i}.</title><year>{2000 + i % 20}</year></article>"


def test_a_million_records_in_bounded_memory():
    tracemalloc.start()
    n = sum(1 for _ in dump.cut(entries(1_000_000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1_000_000 and peak < 1_000_000


def test_a_million_records_through_spark(spark, tmp_path):
    with gzip.open(tmp_path / "dump.xml.gz", "wt", compresslevel=1) as f:
        f.write(HEAD)
        f.writelines(x + "\n" for x in entries(1_000_000))
        f.write("</dblp>\n")
    rows = dump.dump_records(spark, str(tmp_path / "dump.xml.gz"), parts=8)
    assert rows.rdd.getNumPartitions() == 8
    assert rows.groupBy("whole").count().collect()[0][:] == (True, 1_000_000)


def test_entries(spark, tmp_path):
    with gzip.open(tmp_path / "a.xml.gz", "wt") as f:
        f.write(HEAD + '<article mdate="x" key="j/1"><author orcid="0">J&uuml;rgen O&apos;Neil 0002</author>\n<author>Bo &#233; Li</author><title>On H<sub>2</sub>O &amp; <i>more</i> n &lt; 5.</title><year>2020</year><journal>J</journal><ee>http://a</ee><ee type="oa">https://doi.org/10.1/X</ee></article>')
        f.write("<inproceedings key='c/2'><author>Cy</author><title>T</title><year>soon</year><booktitle>B</booktitle></inproceedings><proceedings key='p'><title>None</title></proceedings></dblp>")
    with gzip.open(tmp_path / "b.xml.gz", "wt") as f:
        f.write("<article key='cut'><author>A</author>")
    got = {r.source_id: r for r in dump.index_entries(dump.dump_records(spark, str(tmp_path))).collect()}
    assert set(got) == {"j/1", "c/2"}
    one, two = got["j/1"], got["c/2"]
    assert (one.title, [a.name for a in one.authors], one.year, one.doi, one.venue, one.url, one.publication_type) == ("On H2O & more n < 5", ["Jürgen O'Neil", "Bo é Li"], 2020, "10.1/x", "J", "http://a", "article")
    assert (two.year, two.venue, two.doi) == (None, "B", None)


def test_authors_of_the_roster(spark, tmp_path):
    with gzip.open(tmp_path / "a.xml.gz", "wt") as f:
        for k, names in enumerate([["Ann B. Lee"], ["Ann Lee"], ["Wei Wang"], ["Wei Wang", "José Díaz 0001"], ["No Body"], ["John Byers"]]):
            f.write(f"<article key='{k}'>" + "".join(f"<author>{n}</author>" for n in names) + f"<title>T{k}</title><year>{2015 + k}</year></article>\n")
    roster = spark.createDataFrame([("Ann B. Lee",), ("wei wang",), ("Jose Diaz",), ("John W. Byers",), ("",)], "name string")
    master = spark.createDataFrame([], "doi string, title_fingerprint string")
    records = dump.index_entries(dump.dump_records(spark, str(tmp_path)))
    got = {r.source_id: [a.name for a in r.authors if a.is_bu] for r in parsers.index_dump(records, roster, master, ["wang", "lee"], affiliation="Ours").collect()}
    assert got == {"0": ["Ann B. Lee"], "3": ["Wei Wang", "José Díaz"], "5": ["John Byers"]}
    assert {r.source_id for r in parsers.index_dump(records, roster, master, ["wang", "lee"], since=2019).collect()} == {"5"}


def test_records_are_dealt_out_by_number(spark, tmp_path):
    """Without a key to deal by, the reading task sorts all its records."""
    with gzip.open(tmp_path / "b.xml.gz", "wt") as f:
        f.write("<article>1</article>\n<article>1</article>\n")
    rows = dump.dump_records(spark, str(tmp_path / "b.xml.gz"))
    assert rows.columns == ["file", "text", "whole"] and rows.count() == 2
    assert "RoundRobin" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(5))
def test_many_lines_at_a_time(seed):
    """Lines that come joined give what they give one by one, damaged records too."""
    r = random.Random(seed)
    for _ in range(400):
        lines = ["".join(r.choices(["<article", "<article>", "<article k='1'>", "</article>", "<phdthesis>", "</phdthesis>", "x", " ", "<articles>"], k=r.randrange(5))) for _ in range(20)]
        most = r.choice([0, 3, 10, 25, 60, 1000])
        spots = sorted(r.sample(range(1, 20), 4))
        joined = ["\n".join(lines[a:b]) for a, b in zip([0, *spots], [*spots, 20])]
        assert list(dump.cut(joined, most=most)) == list(dump.cut(lines, most=most))


def test_records_are_parsed_once_and_after_they_were_dealt_out(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<article><author>A</author><title>T</title></article>\n")
    plan = dump.index_entries(dump.dump_records(spark, str(tmp_path)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1
    assert plan.index("from_xml(") < plan.index("RepartitionByExpression") < plan.index("MapInArrow")
