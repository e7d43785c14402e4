"""Readers of landed files: JSON, JSON lines, CSV, XML, name lists and checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one array or object; large harvests are better landed as lines, which Spark can split."""
    return spark.read.schema(schema).json(path, multiLine=True)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_object_values(spark: SparkSession, path: str, value: str) -> DataFrame:
    """The values of a file that is one object from keys to records, with their keys."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string,struct<{value}>>")).alias("key", "v")).select("key", "v.*")


def entries(rows: DataFrame, value: str) -> DataFrame:
    """A row for each record in a variant column: the elements of a list (key null, place from 0) or the values of an object (key, place).

    Values of any other kind, and null, give no row. The other columns are kept, but for those named key, place and record.
    """
    keep = [c for c in rows.columns if c not in (value, "key", "place", "record")]
    every = rows.sparkSession.tvf.variant_explode(F.col(value).outer())
    return rows.select(*keep, value).lateralJoin(every.select(F.col("pos").alias("place"), "key", F.col("value").alias("record"))).select(*keep, "key", "place", "record")


def json_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """(key, place, record) of files that are one list of records each, or one object from keys to records; the same files may be either.

    A record is a variant, or a struct where a schema is given. A file is one task's work; large harvests are better landed as lines.
    """
    whole = spark.read.option("singleVariantColumn", "v").option("multiLine", True).json(path)
    found = entries(whole, "v")
    return found if schema is None else found.withColumn("record", F.try_variant_get("record", "$", f"struct<{schema}>"))


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def xml(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    """Elements of an XML file, gzipped or not."""
    return spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", True).schema(schema).load(path)


def names(spark: SparkSession, path: str) -> DataFrame:
    """One name a line; blank lines and those that begin with # are none."""
    return spark.read.text(path).select(F.trim("value").alias("name")).filter("name <> '' and not startswith(name, '#')")


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_checkpoints(rows: DataFrame) -> DataFrame:
    """Rows of the last file of each prefix; the prefix is what stands before the date in a file's name."""
    named = rows.withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    named = named.withColumn("prefix", F.regexp_extract("_file", r"^(.*?)_\d{8}", 1))
    last = named.groupBy("prefix").agg(F.max("_file").alias("_file"))
    return named.join(last, ["prefix", "_file"], "left_semi").drop("_file")
