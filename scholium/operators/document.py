"""The annotated bibliography as one ordered text over many files.

Headings are rows of their own, made from the sums that they tell, and sort before what they head. So a section has one
heading wherever its papers lie, and the text is one sort over all rows, cut into files by ranges: no task sees a whole
section, and none needs to know how the one before it ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import author_line, blank

#: Headings of the parts, by category, in order.
PARTS = (("LAW", "Part I: School of Law Faculty"), ("NON-LAW", "Part II: Non-Law Faculty"), ("UNCLASSIFIED", "Part III: Unclassified"))
UNCLASSIFIED_NOTE = "*These papers have authors of ours whose school could not be determined from available affiliation data. Manual review recommended.*"
ORDER = ("part", "school", "domain", "kind", "y", "c", "index")
_KEYS = "part int, school string, domain string, kind int, y long, c long, index long, text string"


def _paragraph(*parts: Column) -> Column:
    """What is there of some lines."""
    return F.concat_ws("\n", *parts)


def entry(schools_label: str = "School(s)", untitled: str | None = "Untitled") -> Column:
    """The block of one paper: heading, authors, venue, schools, figures, links, annotation, each where it is there.

    A heading without a title says `untitled`; where that is None an empty title stays empty, and a null one makes the block null.
    """
    figures = F.concat_ws(
        " | ", F.concat(F.lit("AI Relevance: **"), F.nullif(blank(F.col("ai_relevance")), F.lit("unknown")), F.lit("**")), F.when(F.size("subfields") > 0, F.concat(F.lit("Subfields: "), F.array_join("subfields", ", "))),
        F.concat(F.lit("Citations: "), F.col("citation_count").cast("string")), F.when(F.col("publication_type").isin("grant", "preprint"), F.concat(F.lit("Type: **"), "publication_type", F.lit("**"))),
    )
    link = lambda name, address: F.concat(F.lit(f"[{name}]("), address, F.lit(")"))
    links = F.concat_ws(" · ", link("DOI", F.concat(F.lit("https://doi.org/"), blank(F.col("doi")))), link("Source", blank(F.col("url"))), link("PDF", blank(F.col("pdf_url"))))
    authors = F.coalesce(author_line(F.transform("authors", lambda a: F.coalesce(a["name"], F.lit("Unknown")))), F.lit(""))
    title = F.col("title") if untitled is None else F.coalesce(blank(F.col("title")), F.lit(untitled))
    block = _paragraph(
        F.concat(F.lit("#### "), title, F.lit("\n")), F.concat(F.lit("**"), authors, F.lit("** ("), F.coalesce(F.col("year").cast("string"), F.lit("n.d.")), F.lit(")")), F.concat(F.lit("*"), blank(F.col("venue")), F.lit("*")),
        F.when(F.size("bu_schools") > 0, F.concat(F.lit(f"\n{schools_label}: "), F.array_join("bu_schools", ", "))), F.concat(F.lit("\n"), blank(figures)), F.concat(F.lit("\n"), blank(links)), F.concat(F.lit("\n> "), blank(F.col("annotation"))), F.lit(""),
    )
    return F.when(title.isNotNull(), block)


def blocks(papers: DataFrame, title: str, generated: str, schools_label: str = "School(s)", untitled: str | None = "Untitled") -> DataFrame:
    """(part, school, domain, kind, y, c, index, text): headings and papers; sorted by ORDER, nulls first, they are the text.

    Papers of both categories stand in two parts. Within a part papers are by first other school (not where the part is
    of one school), first domain, falling year and citations, and index. A part without papers keeps its heading, but for the
    unclassified one, which is not there then.
    """
    none = F.lit(None).cast("string")
    category = F.coalesce("bu_category", F.lit("UNCLASSIFIED"))
    of = F.when(category == "BOTH", F.array(F.lit(0), F.lit(1))).when(category == "LAW", F.array(F.lit(0))).when(category == "NON-LAW", F.array(F.lit(1))).otherwise(F.array(F.lit(2)))
    other = F.get(F.filter("bu_schools", lambda s: ~F.contains(s, F.lit("Law"))), 0)
    school = F.when(F.col("part") == 1, F.coalesce(other, F.get("bu_schools", 0), F.lit("Unknown"))).otherwise("")
    domain = F.when(F.col("part") < 2, F.coalesce(F.get("domains", 0), F.lit("Uncategorized"))).otherwise("")
    placed = papers.withColumn("part", F.explode(of)).withColumns({"_school": school, "_domain": domain})
    falling = lambda c: -F.coalesce(F.col(c), F.lit(0)).cast("long")
    rows = placed.select("part", F.col("_school").alias("school"), F.col("_domain").alias("domain"), F.lit(3).alias("kind"), falling("year").alias("y"), falling("citation_count").alias("c"), F.col("index").cast("long").alias("index"), entry(schools_label, untitled).alias("text"))

    sums = placed.groupBy("part", F.col("_school").alias("school"), F.col("_domain").alias("domain")).agg(F.count(F.lit(1)).alias("n"))
    head = lambda marks, name: F.concat(F.lit(marks + " "), name, F.lit(" ("), F.col("n").cast("string"), F.lit(" papers)\n"))
    key = lambda frame, s, d, kind, text: frame.select("part", s.alias("school"), d.alias("domain"), F.lit(kind).alias("kind"), *[F.lit(0).cast("long").alias(c) for c in ("y", "c", "index")], text.alias("text"))
    domains = key(sums.filter("part < 2"), F.col("school"), F.col("domain"), 2, F.when(F.col("part") == 1, head("###", F.col("domain"))).otherwise(head("##", F.col("domain"))))
    schools = key(sums.filter("part = 1").groupBy("part", "school").agg(F.sum("n").alias("n")), F.col("school"), none, 1, head("##", F.col("school")))

    counts = papers.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.array_contains(of, k)).alias(f"n{k}") for k in range(3)])  # one row
    number = lambda c: F.col(c).cast("string")
    anchor = lambda name: name.lower().replace(":", "").replace(" ", "-")
    contents = [F.concat(F.lit(f"- [{name}](#{anchor(name)}) ("), number(f"n{k}"), F.lit(" papers)")) for k, (_, name) in enumerate(PARTS)]
    opening = _paragraph(
        F.lit(f"# {title}\n\n*Generated: {generated}*\n"), F.concat(F.lit("*Total papers: "), number("all"), F.lit("*")),
        F.concat(F.lit("*LAW faculty: "), number("n0"), F.lit(" · NON-LAW faculty: "), number("n1"), F.lit(" · Unclassified: "), number("n2"), F.lit("*\n")), F.lit("## Table of Contents\n"), *contents[:2], F.when(F.col("n2") > 0, contents[2]), F.lit("\n---\n"),
    )
    parts = [F.lit(f"# {PARTS[0][1]}\n"), F.lit(f"\n---\n\n# {PARTS[1][1]}\n"), F.when(F.col("n2") > 0, F.lit(f"\n---\n\n# {PARTS[2][1]}\n\n{UNCLASSIFIED_NOTE}\n"))]
    tops = counts.select(F.posexplode(F.array(opening, *parts)).alias("_k", "text")).filter("text is not null").withColumn("part", F.greatest(F.col("_k") - 1, F.lit(0)))
    fronts = key(tops, none, none, 0, F.col("text")).withColumn("y", F.when(F.startswith("text", F.lit(f"# {title}\n")), -1).otherwise(0).cast("long"))
    return fronts.unionByName(schools).unionByName(domains).unionByName(rows)


def write_document(ordered: DataFrame, path: str) -> None:
    """blocks() as text files whose names sort as the text goes on."""
    ordered.orderBy(*ORDER).select("text").write.mode("overwrite").text(path)
