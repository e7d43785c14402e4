"""A dataset stays readable whatever fails in a commit."""

import os

import pytest
from pyspark.sql import functions as F

from scholium import versions


@pytest.fixture
def path(spark, tmp_path):
    target = f"file://{tmp_path}/master"
    assert versions.read(spark, target) is None
    versions.commit(spark.range(3), target)
    return target


def n(spark, path):
    return versions.read(spark, path).count()


def test_commits_replace(spark, path):
    first = versions.current(spark, path)
    versions.commit(versions.read(spark, path).union(spark.range(4)), path, based_on=first)  # it reads what it replaces
    assert n(spark, path) == 7
    with pytest.raises(versions.CommitError):
        versions.commit(spark.range(1), path, based_on=first)
    for k in range(4):
        versions.commit(spark.range(k), path)
    assert n(spark, path) == 3
    assert len([f for f in os.listdir(path.removeprefix("file://")) if f.startswith("v-")]) == 2


def test_a_failed_write(spark, path):
    bad = spark.range(5).select(F.raise_error(F.lit("disk full")).cast("long").alias("id"))
    with pytest.raises(Exception, match="disk full"):
        versions.commit(bad, path)
    assert n(spark, path) == 3
    versions.commit(spark.range(9), path)
    assert n(spark, path) == 9


@pytest.mark.parametrize("step", ["_write", "_point", "_rename", "_sweep"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_kill_at_each_step(spark, path, monkeypatch, step, when):
    real = getattr(versions, step)

    def killed(*a):
        if when == "after":
            real(*a)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, step, killed)
        with pytest.raises(KeyboardInterrupt):
            versions.commit(spark.range(8), path)
    switched = step == "_sweep" or when == "after" and step in ("_point", "_rename")
    assert n(spark, path) == (8 if switched else 3)
    versions.commit(spark.range(2), path)
    assert n(spark, path) == 2
    left = os.listdir(path.removeprefix("file://"))
    assert not [f for f in left if f.startswith("_next-")] and len([f for f in left if f.startswith("v-")]) == 2


def test_a_rename_that_does_nothing(spark, path, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(versions, "_rename", lambda *a: None)
        with pytest.raises(versions.CommitError):
            versions.commit(spark.range(8), path)
    assert n(spark, path) == 3


def test_a_rename_that_fails(spark, path, monkeypatch):
    real = versions._rename
    with monkeypatch.context() as m:
        m.setattr(versions, "_rename", lambda s, source, target: real(s, source + "-gone", target))
        with pytest.raises(versions.CommitError):
            versions.commit(spark.range(8), path)
    assert n(spark, path) == 3
