"""Counts, shares, trends, samples and other figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import source_label


def count_values(rows: DataFrame, values: str, name: str = "value") -> DataFrame:
    """(value, n) of an array's elements."""
    return rows.select(F.explode(values).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def top(counts: DataFrame, most: int, n: str = "n", by: str = "value") -> DataFrame:
    """The most frequent ones; ties in the order of the value."""
    return counts.orderBy(F.desc(n), by).limit(most)


def per_year(rows: DataFrame, year: str = "year") -> DataFrame:
    """(year, n) of years that are there."""
    return rows.filter(F.coalesce(F.col(year), F.lit(0)) != 0).groupBy(F.col(year).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def per_decade(rows: DataFrame, year: str = "year") -> DataFrame:
    return rows.filter(F.coalesce(F.col(year), F.lit(0)) != 0).groupBy((F.floor(F.col(year) / 10) * 10).cast("int").alias("decade")).agg(F.count(F.lit(1)).alias("n"))


def pairs(rows: DataFrame, values: str, without: Sequence[str] = ()) -> DataFrame:
    """(a, b, n): how many rows have both of two different values, a before b."""
    kept = F.filter(F.array_distinct(values), lambda v: ~v.isin(list(without))) if without else F.array_distinct(values)
    both = rows.select(kept.alias("v")).select("v", F.explode("v").alias("a")).select("a", F.explode("v").alias("b")).filter("a < b")
    return both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def new_names(rows: DataFrame, names: str, known: DataFrame, least: int = 5) -> DataFrame:
    """(name, n) of names in enough rows that a list of known ones lacks."""
    counted = count_values(rows, names, "name").filter(F.col("n") >= least)
    return counted.join(known.select("name").distinct(), "name", "left_anti")


def share(rows: DataFrame, by: str, name: str = "value") -> DataFrame:
    """(value, n, pct)."""
    counted = rows.groupBy(F.col(by).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("_all"))
    return counted.join(F.broadcast(total)).select(name, "n", F.round(F.col("n") * 100.0 / F.col("_all"), 6).alias("pct"))  # total is one row


def dominance(rows: DataFrame, group: str, value: str, least: int = 20, most: float = 0.95) -> DataFrame:
    """(group, n, top, share, flagged): each larger group's most frequent value and its share."""
    each = rows.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    best = each.groupBy(group).agg(F.sum("_n").alias("n"), F.min_by(F.struct(F.col(value).alias("v"), "_n"), F.struct(-F.col("_n"), value)).alias("b"))
    return best.filter(F.col("n") >= least).select(group, "n", F.col("b.v").alias("top"), F.round(F.col("b._n") / F.col("n"), 6).alias("share"), (F.col("b._n") / F.col("n") > most).alias("flagged"))


def majority(rows: DataFrame, key: str, value: str, order: str, without: str | None = None) -> DataFrame:
    """(key, value, votes): the most frequent value, the first met of equals, if it has two votes or there are few rows."""
    seen = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_all"))
    votes = (rows.filter(F.col(value) != without) if without else rows.filter(F.col(value).isNotNull())).groupBy(key, value).agg(F.count(F.lit(1)).alias("votes"), F.min(order).alias("_first"))
    best = votes.groupBy(key).agg(F.min_by(F.struct(value, "votes"), F.struct(-F.col("votes"), "_first")).alias("b"))
    met = best.join(seen, key)
    return met.filter((F.col("b.votes") >= 2) | (F.col("_all") <= 2)).select(key, F.col(f"b.{value}").alias(value), F.col("b.votes").alias("votes"))


def distinct_works(rows: DataFrame, key: str, doi: str = "doi", fp: str = "fp") -> DataFrame:
    return rows.groupBy(key).agg(F.countDistinct(F.coalesce(F.nullif(F.col(doi), F.lit("")), F.col(fp))).alias("n"))


def week_label(day: Column) -> Column:
    """`YYYY-MM-Wn` with weeks of a month from its first day."""
    return F.concat(F.date_format(day, "yyyy-MM"), F.lit("-W"), (F.floor((F.dayofmonth(day) - 1) / 7) + 1).cast("string"))


def week_histogram(rows: DataFrame, day: str, amount: str, width: int = 30) -> DataFrame:
    """(week, added, bar): the longest bar has `width` blocks, a week of none a dot."""
    weeks = rows.groupBy(week_label(F.col(day)).alias("week")).agg(F.sum(amount).alias("added"))
    most = weeks.agg(F.max("added").alias("_most"))
    blocks = F.floor(F.col("added") * width / F.greatest(F.col("_most"), F.lit(1))).cast("int")
    return weeks.join(F.broadcast(most)).select("week", "added", F.when(F.col("added") == 0, "·").otherwise(F.repeat(F.lit("█"), blocks)).alias("bar"))  # most is one row


def gaps(rows: DataFrame, key: str, step: str) -> DataFrame:
    """(key, step): whole numbers between a key's least and largest that have no row."""
    span = rows.groupBy(key).agg(F.min(step).alias("_a"), F.max(step).alias("_b"))
    every = span.select(key, F.explode(F.sequence("_a", "_b")).alias(step))
    return every.join(rows.select(key, step).distinct(), [key, step], "left_anti")


def coverage_gap(people: DataFrame, works: DataFrame, least: int = 3) -> DataFrame:
    """people (id, name) with `n`, of works (author_id, author_name) by id or else by name, who have few."""
    by_id = works.filter("author_id is not null and author_id <> ''").groupBy(F.col("author_id").alias("_i")).agg(F.count(F.lit(1)).alias("_a"))
    by_name = works.groupBy(F.lower("author_name").alias("_m")).agg(F.count(F.lit(1)).alias("_b"))
    met = people.join(by_id, people["id"] == F.col("_i"), "left").join(by_name, F.lower(people["name"]) == F.col("_m"), "left")
    return met.withColumn("n", F.coalesce("_a", "_b", F.lit(0))).filter(F.col("n") < least).drop("_i", "_m", "_a", "_b")


def surname_rarity(names: DataFrame, last: str, most: int = 3) -> DataFrame:
    counts = names.groupBy(F.col(last).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    return names.join(counts, names[last].eqNullSafe(F.col("_l"))).withColumn("rare", F.col("_n") <= most).drop("_l", "_n")


def match_rate(rows: DataFrame, group: str, matched: Column) -> DataFrame:
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(matched).alias("matched"), F.round(F.count_if(matched) / F.count(F.lit(1)), 6).alias("rate"))


def cost_totals(rows: DataFrame, tier: str = "ai_relevance", tokens_in: str = "input_tokens", tokens_out: str = "output_tokens", price_in: float = 3.0, price_out: float = 15.0) -> DataFrame:
    """One row: papers, relevant ones, tokens and cost by prices for a million tokens."""
    a, b = (F.coalesce(F.sum(c), F.lit(0)) for c in (tokens_in, tokens_out))
    relevant = F.count_if(~F.coalesce(F.col(tier), F.lit("unknown")).isin("not_relevant", "unknown"))
    return rows.agg(F.count(F.lit(1)).alias("n"), relevant.alias("n_relevant"), a.alias("tokens_in"), b.alias("tokens_out"), F.round(a / 1e6 * price_in + b / 1e6 * price_out, 6).alias("cost"))


def nullish(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with how many rows lack each column."""
    types = dict(rows.dtypes)
    lack = lambda c: F.col(c).isNull() | ((F.col(c) == "") if types[c] == "string" else F.lit(False))
    return rows.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(lack(c)).alias(f"no_{c}") for c in columns])


def source_health(runs: DataFrame, source: str = "source", run: str = "run_no", count: str = "n", ok: Column | None = None, keep: int = 5) -> DataFrame:
    """runs with the mean of the counts before, whether this one is degraded, how many failed in a row, and critical."""
    w = Window.partitionBy(source).orderBy(run)
    good = F.lit(True) if ok is None else ok
    out = runs.withColumn("avg_before", F.round(F.avg(count).over(w.rowsBetween(-keep, -1)), 6))
    out = out.withColumn("degraded", F.coalesce(good & (F.col(count) < 0.1 * F.col("avg_before")) & (F.col("avg_before") > 10), F.lit(False)))
    streak = F.count_if(good).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = out.withColumn("_run", streak).withColumn("failures", F.count_if(~good).over(Window.partitionBy(source, "_run").orderBy(run).rowsBetween(Window.unboundedPreceding, 0))).drop("_run")
    return out.withColumn("critical", F.col("failures") >= 3)


def dips(counts: DataFrame, group: str, step: str = "year", n: str = "n", few: int = 10, many: int = 100) -> DataFrame:
    """Steps of few rows between neighbours of many, not among a group's first two and not its last."""
    w = Window.partitionBy(group).orderBy(step)
    marked = counts.withColumn("_before", F.lag(n).over(w)).withColumn("_after", F.lead(n).over(w)).withColumn("_at", F.row_number().over(w))
    return marked.filter((F.col(n) < few) & (F.col("_before") > many) & (F.col("_after") > many) & (F.col("_at") > 2)).drop("_before", "_after", "_at")


def under_cap(rows: DataFrame, group: str, order: str, cost: Column, cap: float) -> DataFrame:
    """Rows of each group for which the cost before them is under the cap."""
    before = F.coalesce(F.sum(cost).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return rows.withColumn("_before", before).filter(F.col("_before") < cap).withColumn("cost_before", F.round("_before", 6)).drop("_before")


def trends(before: DataFrame, after: DataFrame, key: str, n: str = "n", growth: float = 1.5, fresh: int = 10) -> DataFrame:
    """(key, n_before, n_after, trend, growth_pct) of what grew much, or is new and frequent."""
    a, b = before.select(key, F.col(n).alias("n_before")), after.select(key, F.col(n).alias("n_after"))
    met = b.join(a, key, "left").withColumn("n_before", F.coalesce("n_before", F.lit(0)))
    grew = (F.col("n_before") > 0) & (F.col("n_after") > growth * F.col("n_before"))
    new = (F.col("n_before") == 0) & (F.col("n_after") >= fresh)
    pct = F.when(grew, F.floor((F.col("n_after") / F.col("n_before") - 1) * 100 + 0.5))
    return met.filter(grew | new).select(key, "n_before", "n_after", F.when(grew, "growth").otherwise("new").alias("trend"), pct.alias("growth_pct"))


def most_cited(rows: DataFrame, most: int, citations: str = "citation_count", order: str = "idx") -> DataFrame:
    return rows.filter(F.coalesce(F.col(citations), F.lit(0)) > 0).orderBy(F.desc(citations), order).limit(most)


def newest_first(rows: DataFrame, year: str = "year", citations: str = "citation_count", order: str = "idx") -> DataFrame:
    return rows.orderBy(F.desc(F.coalesce(F.col(year), F.lit(0))), F.desc(F.coalesce(F.col(citations), F.lit(0))), order)


def stratified_sample(rows: DataFrame, tier: str, key: str, most: int = 5, seed: str = "0") -> DataFrame:
    """A few rows of each tier, drawn by a hash of their key; Spark limits each task's rows of a tier first."""
    w = Window.partitionBy(tier).orderBy(F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string"))), key)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")


def review_sample(rows: DataFrame, tier: str, confidence: str, key: str, tiers: Sequence[str], most: int = 5, lowest: int = 100, seed: str = "0") -> DataFrame:
    """rows with `stratum`: a few of each of some tiers, and a few of those of the lowest confidence, in which an unknown one counts as sure.

    A row can be drawn twice, once by its tier and once for its confidence.
    """
    some = stratified_sample(rows.filter(F.col(tier).isin(list(tiers))), tier, key, most, seed).withColumn("stratum", F.col(tier))
    unsure = rows.orderBy(F.col(confidence).asc_nulls_last(), key).limit(lowest)  # a report's size, not the table's
    return some.unionByName(sample(unsure, key, most, seed).withColumn("stratum", F.lit("lowest")))


def sample(rows: DataFrame, key: str, most: int, seed: str = "0") -> DataFrame:
    return rows.orderBy(F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string"))), key).limit(most)


def cross_counts(rows: DataFrame, values: str, category: str, name: str = "school") -> DataFrame:
    """(school, category, n) of an array's elements with their row's category; rows without elements count nowhere."""
    return rows.select(F.explode(values).alias(name), F.col(category).alias("category")).groupBy(name, "category").agg(F.count(F.lit(1)).alias("n"))


def new_by_value(rows: DataFrame, values: str, missing: str = "Unknown", name: str = "school") -> DataFrame:
    """(school, n): a null array counts as `missing`, an empty one nowhere."""
    return count_values(rows.select(F.coalesce(F.col(values), F.array(F.lit(missing))).alias("_v")), "_v", name)


def publication_counts(papers: DataFrame, roster: DataFrame, schools: str = "bu_schools", sources: str = "all_sources", author_id: str = "openalex_id") -> DataFrame:
    """(what, label, n): papers, named schools, people, people with an identifier, and mentions of each source's label."""
    named = papers.select(F.explode(schools).alias("s")).filter((F.col("s") != "") & ~F.contains(F.lower("s"), F.lit("unspecified")))
    mentions = papers.select(F.explode(sources).alias("s")).groupBy(source_label(F.col("s")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    one = lambda df, what, n: df.agg(n.alias("n")).select(F.lit(what).alias("what"), F.lit("").alias("label"), "n")
    totals = [one(papers, "papers", F.count(F.lit(1))), one(named, "schools", F.countDistinct("s")), one(roster, "roster", F.count(F.lit(1))), one(roster, "with_id", F.count_if(F.nullif(F.col(author_id), F.lit("")).isNotNull()))]
    out = mentions.select(F.lit("mentions").alias("what"), "label", "n")
    for t in totals:
        out = out.unionByName(t)
    return out


# The parts of an affiliation that tell its department; the first that fits counts.
DEPARTMENTS = {
    "CS": ["computer science", "cs"], "Law": ["law"], "Engineering": ["engineering", "ece"], "Medicine": ["medicine", "medical"],
    "SPH": ["public health", "sph"], "Questrom": ["business", "questrom"],
}


def departments(affiliations: DataFrame, affiliation: str = "affiliation", table: dict[str, list[str]] = DEPARTMENTS) -> DataFrame:
    """(department, n) of affiliations that name one."""
    text = F.lower(F.coalesce(F.col(affiliation), F.lit("")))
    first = F.coalesce(*[F.when(F.greatest(*[F.contains(text, F.lit(p)) for p in parts], F.lit(False)), F.lit(d)) for d, parts in table.items()])
    return affiliations.select(first.alias("department")).filter("department is not null").groupBy("department").agg(F.count(F.lit(1)).alias("n"))


def several_sources(papers: DataFrame, sources: str = "all_sources") -> DataFrame:
    """One row with how many papers there are, and how many keep a list of sources."""
    return papers.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size(sources) > 0).alias("multi_source"))


def source_counts(raw: DataFrame, new: DataFrame, by: str = "source") -> DataFrame:
    """(source, raw, new, dupes) of harvested rows and of those that the dedup kept."""
    a = raw.groupBy(by).agg(F.count(F.lit(1)).alias("raw"))
    b = new.groupBy(F.col(by).alias("_b")).agg(F.count(F.lit(1)).alias("_new"))
    kept = F.coalesce("_new", F.lit(0).cast("bigint"))
    return a.join(b, F.col(by).eqNullSafe(F.col("_b")), "left").select(by, "raw", kept.alias("new"), (F.col("raw") - kept).alias("dupes"))
