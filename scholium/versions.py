"""Datasets that are replaced as a whole: versions in folders of their own, and one small file that says which one counts.

A commit writes a new folder, then replaces the pointer by a rename that the file system does in one step, then sweeps up
what is old. Whatever fails or is killed in between, the pointer names a folder that is whole: the old one until the
rename, the new one after it. Readers look the pointer up; the versions before stay for those that read them already.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"
_VERSION = re.compile(r"v-(\d{10})-[0-9a-f]{8}")


class CommitError(RuntimeError):
    """The new version does not count; the one before still does."""


def _files(spark: SparkSession, path: str):
    """(org.apache.hadoop.fs, the file system of a path, its configuration)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs
    return fs, fs.Path(path).getFileSystem(conf), conf


def current(spark: SparkSession, path: str) -> str | None:
    """The name of the version that counts; None where nothing was committed yet."""
    fs, system, _ = _files(spark, path)
    pointer = fs.Path(path, POINTER)
    if not system.exists(pointer):
        return None
    stream = system.open(pointer)
    try:
        name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    if not _VERSION.fullmatch(name):
        raise CommitError(f"{path}/{POINTER} names no version")
    return name


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset as last committed; None where nothing was."""
    name = current(spark, path)
    return None if name is None else spark.read.parquet(f"{path}/{name}")


def _write(df: DataFrame, folder: str) -> None:
    df.write.parquet(folder)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Replace a file in one step; raises if that did not happen."""
    fs, _, conf = _files(spark, target)
    gateway = spark.sparkContext._gateway
    overwrite = gateway.new_array(getattr(fs, "Options$Rename"), 1)
    overwrite[0] = getattr(fs, "Options$Rename").OVERWRITE
    fs.FileContext.getFileContext(fs.Path(target).toUri(), conf).rename(fs.Path(source), fs.Path(target), overwrite)


def _point(spark: SparkSession, path: str, name: str) -> None:
    fs, system, _ = _files(spark, path)
    beside = f"{path}/_next-{uuid.uuid4().hex}"
    stream = system.create(fs.Path(beside), False)
    stream.write(bytearray((name + "\n").encode()))
    stream.close()
    _rename(spark, beside, f"{path}/{POINTER}")


def _sweep(spark: SparkSession, path: str, name: str, keep: int) -> None:
    """Delete versions older than the `keep` newest up to the current one, and pointers that were never put in place."""
    fs, system, _ = _files(spark, path)
    now = int(_VERSION.fullmatch(name)[1])
    names = [f.getPath().getName() for f in system.listStatus(fs.Path(path))]
    done = sorted((n for n in names if (m := _VERSION.fullmatch(n)) and int(m[1]) <= now and n != name), reverse=True)
    for old in [*done[max(0, keep - 1) :], *(n for n in names if n.startswith("_next-"))]:
        system.delete(fs.Path(path, old), True)


def commit(df: DataFrame, path: str, keep: int = 2, based_on: str | None = None) -> str:
    """Make df the dataset at a path, and return its version's name. df may read the version before.

    With `based_on`, nothing counts if another commit came in between. One writer at a time is assumed otherwise.
    """
    spark = df.sparkSession
    before = current(spark, path)
    if based_on is not None and before != based_on:
        raise CommitError(f"{path} is at {before}, not at {based_on}")
    name = f"v-{int(_VERSION.fullmatch(before)[1]) + 1 if before else 1:010d}-{uuid.uuid4().hex[:8]}"
    _write(df, f"{path}/{name}")
    if current(spark, path) != before:
        raise CommitError(f"{path} was committed by another writer")
    try:
        _point(spark, path, name)
    except Py4JJavaError as failed:
        raise CommitError(f"the pointer of {path} could not be replaced") from failed
    if current(spark, path) != name:
        raise CommitError(f"the pointer of {path} was not replaced")
    try:
        _sweep(spark, path, name, keep)
    except Py4JJavaError:
        pass  # what is old can be swept by the next commit
    return name
