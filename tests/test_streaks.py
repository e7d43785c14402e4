"""Streaks against a plain count, over few and many partitions."""

import random

import pytest
from pyspark.sql import functions as F

from scholium.operators import quality, streaks
from scholium.sources import parsers


def plain(rows):
    now, last, out = 0, object(), {}
    for key, at, on in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or ""), r[1])):
        now = 0 if key != last else now
        last = key
        now = now + 1 if on else 0
        out[at] = now
    return out


@pytest.mark.parametrize("partitions", ["1", "3", "37"])
@pytest.mark.parametrize("chance", [0.5, 0.99, 1.0, 0.0])
def test_against_plain(spark, partitions, chance):
    r = random.Random(7)
    rows = [(r.choice([None, "a", "b", "hot", "hot", "hot", "hot"]), at, (None if r.random() < 0.1 and chance < 0.9 else r.random() < chance)) for at in range(1500)]
    r.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        df = spark.createDataFrame(rows, "k string, at int, on boolean")
        assert {x.at: x.streak for x in streaks.streaks(df, ["k"], ["at"], F.col("on")).collect()} == plain(rows)
        alone = [(None, at, on) for _, at, on in rows]
        assert {x.at: x.streak for x in streaks.streaks(df, [], ["at"], F.col("on")).collect()} == plain(alone)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_window_without_a_partition(spark):
    df = spark.createDataFrame([(1, True)], "at int, on boolean")
    assert streaks.streaks(df.filter("false"), [], ["at"], F.col("on")).count() == 0
    plan = streaks.streaks(df, [], ["at"], F.col("on"))._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_pages_of_several_listings(spark):
    rows = [("a", p, n) for p, n in enumerate([1, 0, 0, 1, 0, 0, 0, 5, 5])] + [("b", p, 1) for p in range(4)] + [(None, p, 0) for p in range(6)]
    df = spark.createDataFrame(rows, "listing string, page int, n_recent int")
    got = sorted((x.listing or "", x.page) for x in parsers.stop_at_old_pages(df, listing=["listing"]).collect())
    assert got == [("", p) for p in range(3)] + [("a", p) for p in range(7)] + [("b", p) for p in range(4)]


def test_alerts_from_the_log(spark):
    log = spark.createDataFrame([(1, 0), (2, 4), (3, 0), (4, 0), (5, None)], "run_no int, added int")
    sources = spark.createDataFrame([("a", n, "FAILED") for n in range(3)] + [("b", n, s) for n, s in enumerate(["FAILED", "FAILED", "PARTIAL"])] + [("c", 1, "FAILED")], "source string, run_no int, status string")
    got = sorted(tuple(x) for x in quality.log_alerts(log, sources).collect())
    assert got == [("FAIL", "idle", "nothing new for 3 weeks"), ("FAIL", "source", "a failed 3 runs")]
    assert quality.log_alerts(log.filter("run_no < 5"), sources.filter("source = 'b'")).count() == 0


def test_a_batch_that_begins_with_a_key(spark):
    size = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    rows = spark.range(0, 2 * size, 1, 1).select((F.col("id") >= size).alias("k"), F.col("id").alias("at"))
    got = {r["at"]: r["streak"] for r in streaks.streaks(rows, ["k"], ["at"], F.lit(True)).collect()}
    assert got == {i: i % size + 1 for i in range(2 * size)}
