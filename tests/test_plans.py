"""Streaming ingest and the update plan."""

import json

import pytest
from pyspark.sql import functions as F

from scholium import schemas
from scholium.plans import registry, update
from scholium.sources.parsers import record
from scholium.streaming import ingest


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [("A title", "2026-01-01"), ("a TITLE!", "2026-01-02"), ("Other", "2026-01-09")]
    (source / "a.json").write_text("\n".join(json.dumps({"title": t, "harvested_at": d, "source": "s"}) for t, d in rows))
    stream = ingest.landed(spark, str(source), "title string, harvested_at string, source string")
    q = ingest.write_available(ingest.first_seen(stream), str(tmp_path / "out"), str(tmp_path / "c"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    q = ingest.counts(ingest.landed(spark, str(source), "title string, harvested_at string, source string"), "harvested_at", "source").writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(n) as n from counts").first().n == 3


def papers(spark, rows):
    raw = spark.createDataFrame(rows, f"t string, d string, a array<{schemas.AUTHOR}>")
    return record(raw, "2026-01-01", title=F.col("t"), doi=F.col("d"), authors=F.col("a"), source=F.lit("s"))


def test_update(spark):
    us = [("Ann Lee", "", False, "A1", None, None)]
    them = [("Zed", "", False, "Z", None, None)]
    master = papers(spark, [("Known deep learning", "10.1/a", us)]).withColumn("index", F.lit(0)).withColumn("best_url", F.lit("")).withColumn("all_sources", F.array(F.lit("s"))).withColumn("bu_schools", F.array(F.lit("S")))
    batch = papers(spark, [("Known: deep learning", None, us), ("New deep learning", "10.1/b", us), ("New tea", None, us), ("Their deep learning", None, them), ("Bad deep learning", "10.1/c", us)])
    roster = spark.createDataFrame([("Ann Lee", "Arts", None, "A1", [], 1)], "name string, school string, secondary_school string, openalex_id string, alternate_openalex_ids array<string>, ord int")
    rejected = spark.createDataFrame([("10.1/c", None)], "doi string, fp string")
    none = spark.createDataFrame([], "doi string, fp string")
    out = update.update(master, batch, roster, rejected, none, [("law", "Law", "LAW")], ["target"], "Unit (unspecified)")
    assert [(r.title, r.bu_schools) for r in out.added.collect()] == [("New deep learning", ["Arts"])]
    assert sorted((r["index"], r.title) for r in out.master.collect()) == [(0, "Known deep learning"), (1, "New deep learning")]
    assert {r.target: r.n for r in out.caught.collect()} == {"master": 1, "rejected": 1, "new": 3} and out.issues.count() == 0


def test_harvest_isolates_failures(spark):
    def fail():
        raise RuntimeError("down")

    out = update.harvest(spark, {"a": lambda: spark.range(3), "b": fail, "c": lambda: spark.range(2).withColumn("x", F.lit(1))})
    assert {r.source: (r["count"], r.status) for r in out.report.collect()} == {"a": (3, "ok"), "b": (0, "FAILED"), "c": (2, "ok")}
    assert out.papers.count() == 5
    assert set(r.status for r in update.harvest(spark, {"a": lambda: spark.range(1), "b": lambda: spark.range(1)}, -1).report.collect()) == {"skipped"}


@pytest.mark.parametrize("name", ["q_works", "q_concept_sweep", "q_source_papers"])
def test_landed_lines_are_read_once(spark, name):
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_pairs_of_profiles_are_not_moved(spark):
    plan = registry.queries()["q_split_profiles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # nothing is summed above the last join


def test_authors_are_parsed_once(spark):
    plan = registry.queries()["q_author_shapes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json(") + plan.lower().count("parsejson(") <= 1


def test_people_and_profiles_meet_sorted(spark):
    """Repeated people are sent through the driver if Spark takes them to be as small as they were before."""
    plan = registry.queries()["q_split_profiles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert next(line for line in plan.splitlines() if "Join" in line).strip("+- ").startswith("SortMergeJoin")
