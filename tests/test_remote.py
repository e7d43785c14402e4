"""Sources that are asked part by part."""

import contextlib
import datetime as dt
import io
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholium.plans import update
from scholium.sources import remote

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests
SCHEMA = T.StructType([T.StructField("title", T.StringType()), T.StructField("day", T.DateType())])


def months(since, until):
    return [m for m in range(1, 13) if (since is None or m >= since.month) and (until is None or m <= until.month)]


def good(part, since, until):
    for d in (1, 15):
        yield f"paper {part}.{d}", dt.date(2024, part, d)


def broken(part, since, until):
    yield from good(part, since, until)
    if part == 3:
        raise OSError("connection lost")
    if part == 5:
        raise ValueError("bad page")


def late(part, since, until):
    import time

    for d in range(1, 29):
        yield f"paper {part}.{d}", dt.date(2024, part, d)
        time.sleep(0.2)


def dead(part, since, until):
    raise OSError("no route")


@pytest.fixture(scope="module")
def sources(spark):
    remote.register(spark, "good_source", SCHEMA, months, good, "day")
    remote.register(spark, "broken_source", SCHEMA, months, broken, "day")
    remote.register(spark, "late_source", SCHEMA, lambda a, b: [1, 2], late, "day", budget_s=0.5)
    remote.register(spark, "dead_source", SCHEMA, months, dead, "day")
    remote.register(spark, "empty_source", SCHEMA, lambda a, b: [], good, "day")
    return spark


def test_parts_are_tasks_and_dates_are_pushed(sources):
    rows = sources.read.format("good_source").load()
    assert rows.rdd.getNumPartitions() == 12
    some = remote.since(sources, "good_source", "day", dt.date(2024, 3, 2), dt.date(2024, 5, 1))
    assert some.rdd.getNumPartitions() == 3
    assert sorted(r.title for r in remote.records(some).collect()) == ["paper 3.15", "paper 4.1", "paper 4.15", "paper 5.1"]
    assert sorted((r.part, r.status, r.n) for r in remote.statuses(some).collect()) == [("3", "ok", 1), ("4", "ok", 2), ("5", "ok", 1)]
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        some.explain("formatted")
    assert "2024-03-02" in plan.getvalue().partition("PushedFilters")[2].splitlines()[0]


def test_other_filters_stay_with_spark(sources):
    rows = remote.records(sources.read.format("good_source").load()).filter((F.col("title") == "paper 2.15") & (F.col("day") > F.lit(dt.date(2024, 1, 20))) & (F.month("day") == 2))
    assert [r.title for r in rows.collect()] == ["paper 2.15"]


def test_failing_parts_cost_their_own_rest(sources):
    out = update.harvest(sources, {n: lambda n=n: sources.read.format(f"{n}_source").load() for n in ("good", "broken", "late", "dead", "empty")} | {"plain": lambda: sources.createDataFrame([("x", None)], SCHEMA)})
    report = {r.source: r for r in out.report.collect()}
    assert (report["good"].status, report["good"]["count"]) == ("ok", 24)
    assert (report["broken"].status, report["broken"]["count"]) == ("PARTIAL_ERROR", 24) and "2 of 12 parts, 3: OSError: connection lost" in report["broken"].error
    assert report["late"].status == "PARTIAL_TIMEOUT" and 2 <= report["late"]["count"] < 20
    assert (report["dead"].status, report["dead"]["count"]) == ("FAILED", 0)
    assert (report["empty"].status, report["empty"]["count"]) == ("ok", 0)
    assert out.papers.count() == 24 + 24 + report["late"]["count"] + 1
    assert set(out.papers.columns) == {"title", "day"}
