"""Keeping a master dataset: updates, guarded merges, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import best_url
from ..storage import stored


def refresh_citations(master: DataFrame, fresh: DataFrame, key: str = "doi", count: str = "citation_count", marks: Sequence[int] = (100, 1000), since: int | None = None, open_access: str | None = None) -> DataFrame:
    """master with fresh counts where they differ, `changed`, and `milestone`: the largest mark that a count crossed.

    With `since`, only rows of that year or later are refreshed; with `open_access`, that flag takes a fresh value where there is one.
    """
    flags = [] if open_access is None else [F.max(open_access).alias("_open")]
    new = fresh.groupBy(F.col(key).alias("_k")).agg(F.max(count).alias("_new"), *flags)
    due = F.col(key) == F.col("_k")
    met = master.alias("m").join(new, due if since is None else due & (F.col("year") >= since), "left")
    old, now = F.coalesce(F.col(count), F.lit(0)), F.coalesce("_new", count)
    crossed = F.coalesce(*[F.when((old < m) & (F.col("_new") >= m), F.lit(m)) for m in sorted(marks, reverse=True)])
    out = met.withColumn("changed", F.coalesce(F.col("_new") != old, F.lit(False))).withColumn("milestone", crossed).withColumn(count, now)
    if open_access is not None:
        out = out.withColumn(open_access, F.coalesce("_open", open_access))
    return out.drop("_k", "_new", "_open")


def update_preprints(master: DataFrame, fresh: DataFrame, key: str = "doi") -> DataFrame:
    """master in which preprints take the venue of a journal that a fresh record gives, and become published."""
    new = fresh.filter("source_type = 'journal'").groupBy(F.col(key).alias("_k")).agg(F.max("venue").alias("_venue"))
    met = master.join(new, master[key] == F.col("_k"), "left")
    status = F.coalesce("publication_status", F.lit(""))
    kind = F.coalesce("publication_type", F.lit("")).isin("preprint", "posted-content")
    candidate = (status == "preprint") | (kind & F.nullif(F.col(key), F.lit("")).isNotNull())
    change = candidate & F.col("_venue").isNotNull() & ~F.col("_venue").eqNullSafe(F.col("venue"))
    met = met.withColumn("updated", change)
    return met.withColumn("publication_status", F.when(F.col("updated"), "published").otherwise(F.col("publication_status"))).withColumn("venue", F.when(F.col("updated"), F.col("_venue")).otherwise(F.col("venue"))).drop("_k", "_venue")


def fill_abstracts(master: DataFrame, fresh: DataFrame, key: str = "doi", most: int = 200, seed: str = "0") -> DataFrame:
    """master with abstracts from fresh records for a seeded sample of the rows that lack one."""
    lack = F.nullif(F.col("abstract"), F.lit("")).isNull() & F.col(key).isNotNull()
    drawn = master.filter(lack).orderBy(F.md5(F.concat(F.lit(seed + ":"), F.col(key))), key).limit(most).select(F.col(key).alias("_k")).distinct()
    new = fresh.groupBy(F.col(key).alias("_k")).agg(F.max(F.nullif(F.col("abstract"), F.lit(""))).alias("_new"))
    met = master.join(drawn.join(new, "_k"), master[key] == F.col("_k"), "left")
    return met.withColumn("abstract", F.coalesce(F.nullif("abstract", F.lit("")), "_new", "abstract")).drop("_k", "_new")


def merge_roster(scraped: DataFrame, old: DataFrame, school: str = "school", name: str = "name", least: int = 10, share: float = 0.5) -> DataFrame:
    """The scraped rows, and old ones of schools that were not scraped or lost too many; a name once, scraped first."""
    new_n = scraped.groupBy(F.col(school).alias("_s")).agg(F.count(F.lit(1)).alias("_new"))
    old_n = old.groupBy(F.col(school).alias("_s")).agg(F.count(F.lit(1)).alias("_old"))
    back = old_n.join(new_n, "_s", "left").filter(F.col("_new").isNull() | ((F.col("_old") > least) & (F.col("_new") < share * F.col("_old")))).select("_s")
    kept = old.join(back, old[school] == F.col("_s"), "left_semi").join(scraped.select(F.lower(name).alias("_n")).distinct(), F.lower(old[name]) == F.col("_n"), "left_anti")
    return scraped.unionByName(kept, allowMissingColumns=True)


def protected_schools(scraped: DataFrame, old: DataFrame, school: str = "school", least: int = 10, share: float = 0.5) -> DataFrame:
    new_n = scraped.groupBy(school).agg(F.count(F.lit(1)).alias("n_new"))
    old_n = old.groupBy(school).agg(F.count(F.lit(1)).alias("n_old"))
    return old_n.join(new_n, school, "left").withColumn("n_new", F.coalesce("n_new", F.lit(0))).filter((F.col("n_old") > least) & (F.col("n_new") < share * F.col("n_old")))


def coverage_audit(people: DataFrame, ours: DataFrame, theirs: DataFrame, least: int = 2, ratio: float = 0.7, most: int = 5) -> DataFrame:
    """People with fewer works here than elsewhere: counts, ratio and a few missing titles, from (id, work) rows."""
    a = ours.groupBy("id").agg(F.countDistinct("work").alias("n_ours"), F.collect_set("work").alias("_a"))
    b = theirs.groupBy("id").agg(F.countDistinct("work").alias("n_theirs"), F.collect_set("work").alias("_b"))
    none = F.array().cast("array<string>")
    met = people.join(b, "id").join(a, "id", "left").withColumn("n_ours", F.coalesce("n_ours", F.lit(0)))
    share = F.col("n_ours") / F.col("n_theirs")
    missing = F.slice(F.array_sort(F.array_except("_b", F.coalesce("_a", none))), 1, most)
    return met.filter((F.col("n_theirs") >= least) & (share <= ratio)).withColumn("ratio", F.round(share, 2)).withColumn("missing", missing).drop("_a", "_b")


def missing_by_prefix(theirs: DataFrame, ours: DataFrame, title: str = "title", chars: int = 50) -> DataFrame:
    """Rows of theirs whose cleaned title begins like none of ours; both sides are cleaned before they are cut."""
    from ..functions.text import keep_accents

    head = lambda: F.substring(keep_accents(F.col(title)), 1, chars)
    return theirs.withColumn("_p", head()).join(ours.select(head().alias("_p")).distinct(), "_p", "left_anti").drop("_p")


def append(master: DataFrame, new: DataFrame, order: str = "arrival") -> DataFrame:
    """master and new rows behind it with `index` going on, addresses and sources filled in."""
    first = master.agg(F.coalesce(F.max("index") + 1, F.lit(0)).alias("_first"))  # one row
    ranked = numbered(new, order).join(F.broadcast(first)).withColumn("index", (F.col("index") + F.col("_first")).cast("int")).drop("_first")
    filled = ranked.withColumn("best_url", best_url(F.col("pdf_url"), F.col("url"), F.col("doi"))).withColumn("all_sources", F.coalesce("all_sources", F.array("source")) if "all_sources" in new.columns else F.array("source"))
    return master.unionByName(filled.select(*[c for c in filled.columns if c in master.columns]), allowMissingColumns=True)


def numbered(rows: DataFrame, order: str, name: str = "index") -> DataFrame:
    """rows with whole numbers from 0 in an order: places within sorted partitions, and how many rows stand before each.

    Ranges are drawn from a sample, so they are not the same when they are drawn again: the placed rows are stored, and both
    the sums and the rows read from there. Only a row for each partition goes through one task.
    """
    placed = stored(rows.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)  # a partition's number, and a row's place in it
    sizes = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.withColumn("_p", part).join(F.broadcast(before), "_p").withColumn(name, (at + F.col("_before")).cast("int")).drop("_p", "_id", "_before")


def harvest_totals(reports: DataFrame) -> DataFrame:
    return reports.agg(F.sum("count").alias("harvested"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.startswith("status", F.lit("PARTIAL"))).alias("partial"), F.count_if(F.col("status") == "FAILED").alias("failed"))


def union_all(sources: Sequence[DataFrame]) -> DataFrame:
    """All sources with the columns of any."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def prompt_text(title: Column, year: Column, venue: Column, kind: Column, abstract: Column, topics: Column) -> Column:
    """What a classifier is asked about: a line for each field that is there."""
    from ..functions.text import blank

    line = lambda name, c: F.concat(F.lit(f"{name}: "), c)
    short = F.when(F.length(abstract) > 800, F.concat(F.substring(abstract, 1, 800), F.lit("..."))).otherwise(blank(abstract))
    some = F.slice(F.filter(topics, lambda t: F.coalesce(t, F.lit("")) != ""), 1, 8)
    return F.concat_ws("\n", line("Title", F.coalesce(title, F.lit(""))), line("Year", F.nullif(year, F.lit(0)).cast("string")), line("Venue", blank(venue)), line("Type", blank(kind)), line("Abstract", short), line("Topics", blank(F.array_join(some, ", "))))


def sample_view(papers: DataFrame, title: int = 100, abstract: int = 200) -> DataFrame:
    """The columns that a reviewer of a sample sees: the beginnings of titles and abstracts, the answer, the schools."""
    start = lambda c, n: F.substring(F.coalesce(F.col(c), F.lit("")), 1, n)
    summary, schools = F.coalesce("one_line_summary", F.lit("")), F.coalesce("bu_schools", F.array().cast("array<string>"))
    return papers.select(start("title", title).alias("title"), start("abstract", abstract).alias("abstract"), F.col("ai_relevance").alias("relevance"), "confidence", summary.alias("summary"), schools.alias("schools"))
