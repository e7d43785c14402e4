"""The incremental update as a plan: harvest, deduplicate, filter, verify, assign, append, check."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, filters, maintain, match, quality
from ..sources import remote
from ..storage import stored


@dataclass
class Harvest:
    papers: DataFrame | None
    report: DataFrame


def harvest(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], budget_s: float | None = None) -> Harvest:
    """Papers of all sources, and (source, count, status, error, duration_s): a source that fails leaves the others whole.

    A source that is read part by part (sources/remote.py) keeps what its parts gave, and says PARTIAL_ERROR or
    PARTIAL_TIMEOUT. With a budget, sources that would begin after it are skipped.
    """
    found, rows, began = [], [], time.monotonic()
    for name, load in sources.items():
        at = time.monotonic()
        if budget_s is not None and at - began > budget_s:
            rows.append((name, 0, "skipped", "", 0.0))
            continue
        try:
            df = stored(load(), f"harvest-{name}")
            count, status, error = remote.summary(df) if "_status" in df.columns else (df.count(), "ok", "")
            if status != remote.FAILED:
                found.append(remote.records(df) if "_status" in df.columns else df)
            rows.append((name, count, status, error, time.monotonic() - at))
        except Exception as e:  # noqa: BLE001  one source's failure is reported, not raised
            rows.append((name, 0, "FAILED", str(e)[:500], time.monotonic() - at))
    report = spark.createDataFrame(rows, "source string, count long, status string, error string, duration_s double")
    return Harvest(maintain.union_all(found) if found else None, report)


@dataclass
class Update:
    master: DataFrame
    added: DataFrame
    caught: DataFrame
    issues: DataFrame | None = field(default=None)


def update(master: DataFrame, batch: DataFrame, roster: DataFrame, rejected: DataFrame, outside: DataFrame, rules: Sequence[tuple[str, str, str]], institution: Sequence[str], unspecified: str) -> Update:
    """master with the new papers of a batch: unknown to it and both negative indexes, on the subject, by our authors."""
    keys = master.select("doi", F.col("title_fingerprint").alias("fp"))
    known = stored(dedup.anti_dedup(batch.withColumn("fp", F.col("title_fingerprint")), [keys, rejected, outside]), "update-caught")
    new = filters.keyword_filter(known.filter("caught is null").drop("caught", "fp"))
    verified = match.verify_authors(new.withColumn("paper_id", F.col("title_fingerprint")), roster)
    tagged = match.assign_schools(verified, roster, rules, institution, unspecified).drop("paper_id")
    added = stored(tagged, "update-added")
    after = maintain.append(master, added.withColumn("arrival", F.monotonically_increasing_id()))
    return Update(after, added, dedup.batch_counts(known, ["master", "rejected", "outside"]), quality.gate(master, after))
