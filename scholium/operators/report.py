"""Statistics and reports: figures as rows, and bounded ones of them as text.

A report collects only rows whose number its sections bound (a top-k, a year, a school, a run's sources).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .analytics import count_values, departments, nullish, per_year, several_sources, top

CATEGORIES = ("LAW", "NON-LAW", "BOTH", "UNCLASSIFIED")
#: The sections of statistics(), and how many rows each keeps (none: all values).
SECTIONS = {"category": None, "school": None, "type": 15, "relevance": None, "domain": 20, "subfield": 20, "year": 15, "cited": 20, "author": 30}


def statistics(papers: DataFrame) -> DataFrame:
    """(section, value, n, pct): the sections' values, the most frequent first, ties by the value; years from the last.

    `n` of the section `cited` are citations; `pct` is of all papers, for categories and relevance. All categories stand there.
    """
    text = lambda c, none: F.coalesce(F.col(c).cast("string"), F.lit(none)).alias("value")
    one = lambda values: papers.select(values).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    seen = one(text("bu_category", "UNCLASSIFIED")).filter(F.col("value").isin(*CATEGORIES))
    categories = papers.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in CATEGORIES])).alias("value")).join(seen, "value", "left").select("value", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    ours = papers.select(F.explode(F.transform(F.filter("authors", lambda a: F.coalesce(a["is_bu"], F.lit(False))), lambda a: a["name"])).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    cited = papers.filter(F.coalesce("citation_count", F.lit(0)) > 0).select(F.coalesce("title", F.lit("?")).alias("value"), F.col("citation_count").cast("bigint").alias("n"))
    years = per_year(papers).select(F.col("year").cast("string").alias("value"), "n")
    counts = {
        "category": categories, "school": count_values(papers, "bu_schools"), "type": one(text("publication_type", "unknown")), "relevance": one(text("ai_relevance", "unclassified")),
        "domain": count_values(papers, "domains"), "subfield": count_values(papers, "subfields"), "year": years, "cited": cited, "author": ours,
    }
    total, out = papers.agg(F.count(F.lit(1)).alias("_all")), None  # one row
    for section, most in SECTIONS.items():
        order = [F.desc("value")] if section == "year" else [F.desc("n"), F.asc("value")]
        kept = counts[section] if most is None else counts[section].orderBy(*order).limit(most)
        share = F.round(F.col("n") * 100.0 / F.nullif(F.col("_all"), F.lit(0)), 1) if section in ("category", "relevance") else F.lit(None).cast("double")
        part = kept.join(F.broadcast(total)).select(F.lit(section).alias("section"), "value", "n", share.alias("pct"))
        out = part if out is None else out.unionByName(part)
    return out


def statistics_text(found: DataFrame, title: str, year_step: int = 3) -> str:
    """statistics() as text."""
    rows = [r.asDict() for r in found.collect()]  # bounded: see SECTIONS; schools and types of relevance are few
    blocks = []
    for section in SECTIONS:
        here = [r for r in rows if r["section"] == section]
        here.sort(key=lambda r: -int(r["value"]) if section == "year" else (-r["n"], r["value"]))
        lines = []
        for r in here:
            tail = f" ({r['pct']:.1f}%)" if r["pct"] is not None else "  " + "█" * (r["n"] // year_step) if section == "year" else ""
            lines.append(f"{r['value'][:70]:<50} {r['n']:>6}{tail}".rstrip())
        blocks.append((section, lines))
    return document(title, blocks)


def document(title: str, sections: Iterable[tuple[str, Sequence[str]]]) -> str:
    """A title and those sections that have lines."""
    return "\n\n".join([f"# {title}", *("\n".join([f"## {heading}", *lines]) for heading, lines in sections if lines)]) + "\n"


def bullets(rows: DataFrame, line: Column, order: Sequence[Column | str], most: int) -> list[str]:
    """The first few rows as list items."""
    return [f"- {r['line']}" for r in rows.orderBy(*order).limit(most).select(line.alias("line")).collect()]


def grid(rows: DataFrame, columns: Sequence[str], order: Sequence[Column | str], most: int) -> list[str]:
    """The first few rows as a table; a table without rows has no lines."""
    found = rows.orderBy(*order).limit(most).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).collect()
    cell = lambda v: v.replace("|", "\\|").replace("\n", " ")
    return ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns), *("| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in found)] if found else []


def monthly(title: str, run: dict[str, float], sources: DataFrame, schools: DataFrame, gaps: DataFrame, milestones: DataFrame, published: DataFrame, broken: DataFrame, trends: DataFrame, candidates: DataFrame, errors: Sequence[str] = ()) -> str:
    """A run's report: its figures, sources (source, count, status, duration_s, error), new papers by school (school, n), coverage
    gaps (name, school, ours, theirs, ratio), milestones (title, milestone), published (title), broken (status, title), trends (key, n_before, n_after, trend), candidates (name, n)."""
    bad = sources.filter(F.col("status").isin("FAILED", "CRITICAL", "DEGRADED", "PARTIAL_TIMEOUT", "PARTIAL_ERROR"))
    head = lambda c, n: F.substring(F.coalesce(F.col(c), F.lit("")), 1, n)
    return document(title, [
        ("Summary", [f"- {k.replace('_', ' ')}: {v:,}" for k, v in run.items()]),
        ("Sources", grid(sources, ["source", "count", "status", "duration_s"], [F.desc("count"), "source"], 1000)),
        ("Coverage gaps", grid(gaps, ["name", "school", "ours", "theirs", "ratio"], ["ratio", "name"], 15)),
        ("New papers by school", bullets(schools, F.concat_ws(": ", "school", F.col("n").cast("string")), [F.desc("n"), "school"], 1000)),
        ("Milestones of citations", bullets(milestones, F.concat(F.col("milestone").cast("string"), F.lit("+: "), head("title", 200)), [F.desc("milestone"), "title"], 1000)),
        ("Preprints now published", bullets(published, head("title", 200), ["title"], 1000)),
        ("Broken addresses", bullets(broken, F.concat(F.lit("["), F.col("status").cast("string"), F.lit("] "), head("title", 60)), ["title"], 20)),
        ("Trends", bullets(trends, F.concat_ws(" ", "key", F.concat(F.col("n_before").cast("string"), F.lit(" to"), F.lit(" "), F.col("n_after").cast("string")), "trend"), [F.desc("n_after"), "key"], 1000)),
        ("People to add", bullets(candidates, F.concat(F.col("name"), F.lit(": "), F.col("n").cast("string")), [F.desc("n"), "name"], 15)),
        ("Alerts", bullets(bad, F.concat(F.col("status"), F.lit(": "), F.col("source"), F.lit(" "), head("error", 100)), ["source"], 1000)),
        ("Validation failures", [f"- {e}" for e in errors]),
    ])


def quarterly(title: str, master: DataFrame, gaps: DataFrame, sample: DataFrame, weeks: DataFrame, candidates: DataFrame, pairs: DataFrame, state: dict, year: int) -> str:
    """A quarter's review: people of few papers (name, school, n), a sample to read (maintain.sample_view), weeks (week, added, bar),
    candidates (name, n), the most cited of the last two years, output by year, domains, pairs of schools (a, b, n), and the state."""
    recent = master.filter(F.coalesce("year", F.lit(0)) >= year - 1).withColumn("_c", F.coalesce("citation_count", F.lit(0)))
    years = per_year(master.filter(F.col("year") >= year - 5))
    shown = F.concat(F.lit("["), F.coalesce("relevance", F.lit("?")), F.lit(" "), F.format_number(F.coalesce("confidence", F.lit(0.0)), 2), F.lit("] "), F.col("title"), F.lit(": "), F.col("summary"))
    return document(title, [
        ("Papers", [f"- total: {master.count():,}"]),
        ("People of few papers", bullets(gaps, F.concat(F.col("name"), F.lit(" ("), F.coalesce("school", F.lit("")), F.lit("): "), F.col("n").cast("string")), ["n", "name"], 1000)),
        ("Sample to read", bullets(sample, shown, ["relevance", "title"], 100)),
        ("Weeks", bullets(weeks, F.concat_ws(" ", "week", "bar", F.col("added").cast("string")), ["week"], 1000)),
        ("People to add", bullets(candidates, F.concat(F.col("name"), F.lit(": "), F.col("n").cast("string")), [F.desc("n"), "name"], 15)),
        ("Most cited of late", bullets(recent, F.concat(F.col("_c").cast("string"), F.lit(": "), F.substring(F.coalesce("title", F.lit("")), 1, 80)), [F.desc("_c"), "title"], 10)),
        ("Output by year", bullets(years, F.concat_ws(": ", F.col("year").cast("string"), F.col("n").cast("string")), ["year"], 100)),
        ("Domains", bullets(top(count_values(master, "domains"), 15), F.concat_ws(": ", "value", F.col("n").cast("string")), [F.desc("n"), "value"], 15)),
        ("Schools together", bullets(pairs, F.concat(F.col("a"), F.lit(" + "), F.col("b"), F.lit(": "), F.col("n").cast("string")), [F.desc("n"), "a", "b"], 10)),
        ("State", [f"- {k.replace('_', ' ')}: {v}" for k, v in state.items() if not isinstance(v, dict)]),
    ])


def gap_report(title: str, master: DataFrame, known: DataFrame, missing: DataFrame) -> str:
    """Coverage of the dataset, of known people (name), those that are missing (name, department, notes), and years without papers."""
    lack = nullish(master, ["abstract", "doi", "url"]).first()
    several = several_sources(master).first()
    by = lambda c, most: bullets(count_values(master.select(F.array(F.coalesce(c, F.lit("unknown"))).alias("v")), "v"), F.concat_ws(": ", "value", F.col("n").cast("string")), [F.desc("n"), "value"], most)
    years = per_year(master)
    rows = {r["year"] for r in years.select("year").collect()}  # years are few
    empty = [str(y) for y in range(min(rows), max(rows) + 1) if y not in rows] if rows else []
    people = master.select(F.explode("authors").alias("a")).filter("a.is_bu").select("a.affiliation")
    n_known, n_missing = known.count(), missing.count()
    return document(title, [
        ("Coverage", [f"- papers: {lack['n']:,}", *(f"- without {c}: {lack[f'no_{c}']:,}" for c in ("abstract", "doi", "url")), f"- in several sources: {several['multi_source']:,}"]),
        ("By source", by("source", 1000)),
        ("By year", bullets(years, F.concat_ws(": ", F.col("year").cast("string"), F.col("n").cast("string")), [F.desc("year")], 10)),
        ("By type", by("publication_type", 10)),
        ("Departments", bullets(departments(people), F.concat_ws(": ", "department", F.col("n").cast("string")), [F.desc("n"), "department"], 100)),
        ("Known people", [f"- checked: {n_known:,}", f"- found: {n_known - n_missing:,}", f"- missing: {n_missing:,}"]),
        ("Missing people", bullets(missing, F.concat(F.col("name"), F.lit(" ("), F.coalesce("department", F.lit("")), F.lit(") "), F.coalesce("notes", F.lit(""))), ["name"], 1000)),
        ("Years without papers", ["- " + ", ".join(empty)] if empty else []),
    ])


def audit_lines(people: DataFrame, ours: DataFrame, missing: DataFrame, shown: int = 5) -> DataFrame:
    """(name, n_ours, n_missing, titles, gaps) of people with any: the first few titles held, and (source, title) of what is missing.

    people (name), ours (name, title), missing (name, source, title). Few titles are kept by an ordered window, not by a list of all.
    """
    a = ours.groupBy("name").agg(F.count(F.lit(1)).alias("n_ours"))
    from .dedup import windowed_first

    first = windowed_first(ours, ["name"], ["title"], shown).groupBy("name").agg(F.array_sort(F.collect_list("title")).alias("titles"))
    b = missing.groupBy("name").agg(F.count(F.lit(1)).alias("n_missing"), F.array_sort(F.collect_list(F.struct("source", F.substring("title", 1, 70).alias("title")))).alias("gaps"))
    met = people.select("name").distinct().join(a, "name", "left").join(first, "name", "left").join(b, "name", "left")
    n = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return met.select("name", n("n_ours"), n("n_missing"), "titles", "gaps").filter("n_ours > 0 or n_missing > 0")


def audit_rows(people: DataFrame, ours: DataFrame, missing: DataFrame, shown: int = 5) -> DataFrame:
    """(order, text): the lines of all people with papers or gaps, however many; sorted by order they are the audit's text.

    Each gap is a row, never an element of a list, so a person of very many gaps is many tasks' work like any other rows.
    """
    from .dedup import windowed_first

    counts = lambda df, n: df.groupBy("name").agg(F.count(F.lit(1)).alias(n))
    n = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    known = people.select("name").distinct().join(counts(ours, "n_ours"), "name", "left").join(counts(missing, "n_missing"), "name", "left").select("name", n("n_ours"), n("n_missing")).filter("n_ours > 0 or n_missing > 0")
    row = lambda df, kind, source, title, text: df.select(F.struct((-F.col("n_missing")).alias("m"), "name", F.lit(kind).alias("kind"), source.alias("source"), title.alias("title")).alias("order"), text.alias("text"))
    none, title = F.lit(""), F.substring("title", 1, 70)
    heads = row(known, 0, none, none, F.concat(F.lit("## "), "name", F.lit(": "), F.col("n_ours").cast("string"), F.lit(" papers, "), F.col("n_missing").cast("string"), F.lit(" missing")))
    held = row(windowed_first(ours, ["name"], ["title"], shown).join(known, "name"), 1, none, F.col("title"), F.concat(F.lit("- "), "title"))
    gaps = row(missing.join(known, "name"), 2, F.col("source"), title, F.concat(F.lit("- missing from "), "source", F.lit(": "), title))
    return heads.unionByName(held).unionByName(gaps)


def audit(title: str, lines: DataFrame, most: int = 1000) -> str:
    """audit_lines() of the people of the most gaps as text, `most` of them; audit_rows() has no bound."""
    sections = []
    for r in lines.orderBy(F.desc("n_missing"), "name").limit(most).collect():
        items = [f"- {t}" for t in r["titles"] or []] + [f"- missing from {g['source']}: {g['title']}" for g in r["gaps"] or []]
        sections.append((f"{r['name']}: {r['n_ours']} papers, {r['n_missing']} missing", items))
    return document(title, sections)
