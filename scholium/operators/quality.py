"""Checks of a dataset: rows of (level, check_name, message)."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import same_set
from .streaks import last_streaks


def _issues(rows: DataFrame, level: Column, check: str, message: Column) -> DataFrame:
    return rows.select(level.alias("level"), F.lit(check).alias("check_name"), message.alias("message")).filter("level is not null")


def anchors(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """expected (key, least) against counts (key, n): FAIL for none, WARN for few."""
    met = expected.join(counts.select("key", "n"), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    level = F.when(F.col("n") == 0, "FAIL").when(F.col("n") < F.col("least"), "WARN")
    return _issues(met, level, "anchor", F.concat(F.col("key").cast("string"), F.lit(": "), F.col("n").cast("string"), F.lit(" of "), F.col("least").cast("string")))


def minimum(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """FAIL for each group under its minimum."""
    met = expected.join(counts.select("key", "n"), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return _issues(met, F.when(F.col("n") < F.col("least"), "FAIL"), "minimum", F.concat(F.col("key").cast("string"), F.lit(": "), F.col("n").cast("string"), F.lit(" under "), F.col("least").cast("string")))


def consistency(papers: DataFrame, flagged: str, listed: str, schools: str) -> DataFrame:
    """Counts of papers without a flagged author, with lists that differ, without a school."""
    none = F.coalesce(F.size(flagged), F.lit(0)) <= 0
    differ = ~same_set(F.col(flagged), F.col(listed))
    homeless = F.coalesce(F.size(schools), F.lit(0)) <= 0
    sums = papers.agg(F.count_if(none).alias("a"), F.count_if(differ).alias("b"), F.count_if(homeless).alias("c"))
    rows = sums.select(F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.lit(name).alias("name"), F.col(c).alias("n")) for level, name, c in (("FAIL", "no_author", "a"), ("FAIL", "names_differ", "b"), ("WARN", "no_school", "c"))])).alias("x"))
    return rows.filter("x.n > 0").select("x.level", F.col("x.name").alias("check_name"), F.col("x.n").cast("string").alias("message"))


def suspicious(papers: DataFrame, names: str, most: int = 300, crowd: int = 30, under: int = 100, authors: str = "authors") -> DataFrame:
    """WARN for people of very many papers, and papers with very many flagged authors among few."""
    people = papers.select(F.explode(names).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    many = _issues(people, F.lit("WARN"), "prolific", F.concat("name", F.lit(": "), F.col("n").cast("string")))
    crowded = papers.filter((F.size(names) > crowd) & (F.size(authors) < under))
    return many.union(_issues(crowded, F.lit("WARN"), "crowded", F.concat(F.size(names).cast("string"), F.lit(" of "), F.size(authors).cast("string"))))


def roster_absent(roster: DataFrame, present: DataFrame, least: int) -> DataFrame:
    """Roster rows (name, last, works) of enough works whose name is not present, nor any present name with their last one.

    A last name of n words is looked for in every n neighbouring words of the present names, as a whole or within them;
    present names are few against papers, and each distinct run of words is tested once.
    """
    named = roster.filter(F.col("works") >= least).join(present.select(F.col("name").alias("_n")).distinct(), F.col("name") == F.col("_n"), "left_anti")
    words = present.select(F.filter(F.split(F.lower("name"), r"\s+"), lambda w: w != "").alias("w")).filter(F.size("w") > 0).distinct()
    sized = words.select("w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("_size"))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("_size") + 1)).alias("i")
    parts = sized.select("w", "_size", starts).select("_size", F.array_join(F.slice("w", F.col("i"), F.col("_size")), " ").alias("_w")).distinct()
    last = F.trim(F.regexp_replace(F.lower("last"), r"\s+", " "))
    wanted = named.filter(F.length("last") > 3).select("last", last.alias("_last")).distinct().withColumn("_words", F.size(F.split("_last", " ")))
    near = wanted.join(parts, (F.col("_words") == F.col("_size")) & F.contains(F.col("_w"), F.col("_last"))).select("last").distinct()
    return named.join(near, "last", "left_anti")


def gate(old: DataFrame, new: DataFrame, most_lost: int = 5) -> DataFrame:
    """FAIL if the dataset lost more rows than it may."""
    counts = old.agg(F.count(F.lit(1)).alias("a")).join(new.agg(F.count(F.lit(1)).alias("b")))  # one row each
    return _issues(counts, F.when(F.col("b") < F.col("a") - most_lost, "FAIL"), "dropped", F.concat(F.col("a").cast("string"), F.lit(" to "), F.col("b").cast("string")))


def run_sanity(runs: DataFrame, warn_new: int = 200, fail_new: int = 500, warn_cost: float = 5.0, fail_cost: float = 10.0) -> DataFrame:
    """Runs that added or cost too much."""
    level = F.when((F.col("added") > fail_new) | (F.col("cost") > fail_cost), "FAIL").when((F.col("added") > warn_new) | (F.col("cost") > warn_cost), "WARN")
    return _issues(runs, level, "run", F.concat(F.col("added").cast("string"), F.lit(" added")))


def run_alerts(runs: DataFrame, sources: DataFrame, zero_weeks: int = 3, failures: int = 3) -> DataFrame:
    """run_sanity()'s issues, FAIL for a run that again added nothing, and FAIL for a source that keeps failing.

    runs (added, cost, zero_weeks before this one), sources (source, consecutive_failures).
    """
    weeks = F.coalesce("zero_weeks", F.lit(0)) + 1
    idle = _issues(runs, F.when((F.col("added") == 0) & (weeks >= zero_weeks), "FAIL"), "idle", F.concat(F.lit("nothing new for "), weeks.cast("string"), F.lit(" weeks")))
    failing = _issues(sources, F.when(F.col("consecutive_failures") >= failures, "FAIL"), "source", F.concat("source", F.lit(" failed "), F.col("consecutive_failures").cast("string"), F.lit(" runs")))
    return run_sanity(runs).unionByName(idle).unionByName(failing)


def log_alerts(log: DataFrame, source_log: DataFrame, zero_weeks: int = 3, failures: int = 3, run: str = "run_no", source: str = "source") -> DataFrame:
    """What the run log tells now: FAIL if its last runs added nothing, as many as zero_weeks in a row, and for each source whose last runs failed.

    log (run_no, added), source_log (source, run_no, status): a run failed if its status is FAILED; a partial one did not.
    """
    idle = last_streaks(log, [], [run], F.coalesce("added", F.lit(0)) == 0).filter(F.col("streak") >= zero_weeks)
    failing = last_streaks(source_log, [source], [run], F.col("status") == "FAILED").filter(F.col("streak") >= failures)
    none = _issues(idle, F.lit("FAIL"), "idle", F.concat(F.lit("nothing new for "), F.col("streak").cast("string"), F.lit(" weeks")))
    return none.unionByName(_issues(failing, F.lit("FAIL"), "source", F.concat(source, F.lit(" failed "), F.col("streak").cast("string"), F.lit(" runs"))))


def files_there(spark: SparkSession, paths: Sequence[str], tables: Sequence[str] = ()) -> DataFrame:
    """FAIL for each path that does not exist, and for each Parquet table that can't be read: what a gate asks besides gate()."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    rows = []
    for path in [*paths, *tables]:
        at = hadoop.Path(path)
        if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            rows.append(("FAIL", "missing", path))
        elif path in tables:
            try:
                spark.read.parquet(path).limit(1).count()
            except (PySparkException, Py4JJavaError) as broken:
                rows.append(("FAIL", "unreadable", f"{path}: {type(broken).__name__}"))
    return spark.createDataFrame(rows, "level string, check_name string, message string")


def links_to_check(papers: DataFrame, url: str = "url") -> DataFrame:
    """Addresses that are no DOI: what a link check would ask for."""
    return papers.filter(F.nullif(F.col(url), F.lit("")).isNotNull() & ~F.contains(F.col(url), F.lit("doi.org/")))


def exit_code(issues: DataFrame, strict: bool = False) -> int:
    """2 for any FAIL, 1 for any WARN if strict, else 0."""
    levels = {r["level"] for r in issues.select("level").distinct().collect()}
    return 2 if "FAIL" in levels else 1 if strict and "WARN" in levels else 0
