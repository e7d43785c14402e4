"""The bibliography as one text over many files, against a plain version."""

import os
import random
from collections import defaultdict

from scholium.operators import document

KIND = "index int, title string, authors array<struct<name:string>>, year int, venue string, doi string, url string, pdf_url string, annotation string, ai_relevance string, subfields array<string>, domains array<string>, publication_type string, bu_schools array<string>, bu_category string, citation_count int"


def plain(papers, title, day):
    def block(p):
        names = [a[0] for a in p["authors"]]
        who = ", ".join(names[:5]) + f", et al. ({len(names)} authors)" if len(names) > 5 else ", ".join(names)
        out = [f"#### {p['title'] or 'Untitled'}\n", f"**{who}** ({'n.d.' if p['year'] is None else p['year']})"]
        out += [f"*{p['venue']}*"] if p["venue"] else []
        out += ["\nSchool(s): " + ", ".join(p["bu_schools"])] if p["bu_schools"] else []
        figures = [f"AI Relevance: **{p['ai_relevance']}**"] if p["ai_relevance"] and p["ai_relevance"] != "unknown" else []
        figures += ["Subfields: " + ", ".join(p["subfields"])] if p["subfields"] else []
        figures += [f"Citations: {p['citation_count']}"] if p["citation_count"] is not None else []
        figures += [f"Type: **{p['publication_type']}**"] if p["publication_type"] in ("grant", "preprint") else []
        out += ["\n" + " | ".join(figures)] if figures else []
        links = [f"[{n}]({before}{p[k]})" for n, before, k in (("DOI", "https://doi.org/", "doi"), ("Source", "", "url"), ("PDF", "", "pdf_url")) if p[k]]
        out += ["\n" + " · ".join(links)] if links else []
        out += [f"\n> {p['annotation']}"] if p["annotation"] else []
        return [*out, ""]

    order = lambda p: (-(p["year"] or 0), -(p["citation_count"] or 0), p["index"])

    def by(some, f):
        groups = defaultdict(list)
        for p in some:
            groups[f(p)].append(p)
        return sorted(groups.items())

    domain = lambda p: p["domains"][0] if p["domains"] else "Uncategorized"
    school = lambda p: next((s for s in p["bu_schools"] or [] if "Law" not in s), (p["bu_schools"] or ["Unknown"])[0])
    law = [p for p in papers if p["bu_category"] in ("LAW", "BOTH")]
    rest = [p for p in papers if p["bu_category"] in ("NON-LAW", "BOTH")]
    none = [p for p in papers if p["bu_category"] not in ("LAW", "NON-LAW", "BOTH")]
    out = [f"# {title}", f"\n*Generated: {day}*", f"\n*Total papers: {len(papers)}*", f"*LAW faculty: {len(law)} · NON-LAW faculty: {len(rest)} · Unclassified: {len(none)}*\n", "## Table of Contents\n"]
    out += [f"- [Part I: School of Law Faculty](#part-i-school-of-law-faculty) ({len(law)} papers)", f"- [Part II: Non-Law Faculty](#part-ii-non-law-faculty) ({len(rest)} papers)"]
    out += [f"- [Part III: Unclassified](#part-iii-unclassified) ({len(none)} papers)"] if none else []
    out += ["\n---\n", "# Part I: School of Law Faculty\n"]
    for d, some in by(law, domain):
        out += [f"## {d} ({len(some)} papers)\n", *(x for p in sorted(some, key=order) for x in block(p))]
    out += ["\n---\n", "# Part II: Non-Law Faculty\n"]
    for s, those in by(rest, school):
        out.append(f"## {s} ({len(those)} papers)\n")
        for d, some in by(those, domain):
            out += [f"### {d} ({len(some)} papers)\n", *(x for p in sorted(some, key=order) for x in block(p))]
    if none:
        out += ["\n---\n", "# Part III: Unclassified\n", document.UNCLASSIFIED_NOTE + "\n", *(x for p in sorted(none, key=order) for x in block(p))]
    return "\n".join(out).split("\n")


def rows(n, r):
    some = lambda *x: r.choice([None, "", *x])
    return [
        (i, some("Deep", "Nets ünd"), [(f"A{k}",) for k in range(r.randint(0, 7))], r.choice([None, 0, 2019, 2020, 2021]), some("J"), some("10.1/x"), some("http://x"), some("http://p"), some("why\nso"), some("primary", "unknown"), r.choice([None, [], ["S", "T"]]),
         r.choice([None, [], ["Vision"], ["Text", "Law"]]), some("grant", "article"), r.choice([None, [], ["School of Law"], ["School of Law", "Arts"], ["Medicine"]]), r.choice([None, "LAW", "NON-LAW", "BOTH", "UNCLASSIFIED", "NON-LAW"]), r.choice([None, 0, 3, 5]))
        for i in range(n)
    ]


def lines(path):
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    return [open(f"{path}/{f}", encoding="utf-8").read() for f in files]


def test_text_over_many_files(spark, tmp_path):
    data = rows(900, random.Random(1))
    df = spark.createDataFrame(data, KIND)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "47")
    try:
        document.write_document(document.blocks(df, "Ours", "May 1, 2024"), f"{tmp_path}/out")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = lines(f"{tmp_path}/out")
    names = [f.split()[0] for f in KIND.replace("array<struct<name:string>>", "x").split(", ")]
    want = plain([dict(zip(names, x)) for x in data], "Ours", "May 1, 2024")
    assert "".join(files).split("\n")[:-1] == want
    assert len(files) > 30
    arts = next(k for k, f in enumerate(files) if "\n## Arts (" in "\n" + f)
    after = next(k for k, f in enumerate(files) if "\n## Medicine (" in "\n" + f)
    assert after - arts >= 3 and sum(x.startswith("## Arts (") for f in files for x in f.split("\n")) == 1  # one heading for a section over several files


def test_nothing(spark, tmp_path):
    document.write_document(document.blocks(spark.createDataFrame([], KIND), "Ours", "today"), f"{tmp_path}/out")
    assert "".join(lines(f"{tmp_path}/out")).split("\n")[:-1] == plain([], "Ours", "today")
