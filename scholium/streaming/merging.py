"""The merge by order of arrival, batch by batch: a batch meets the keys of the founders so far, not the master.

A record goes to the founder with its DOI, else to the one with its fingerprint (operators/dedup.founders). A row has two
keys and its place depends on both, through rows that come before it in the batch, so state by one key, as a streaming
operator keeps it, can't decide; the state here is two tables that only grow by files, and a batch joins with them:

    keys    (arrival, doi, fp) of the founders, by batch
    rows    the founders' own rows, by batch
    brought what the batch's records bring to each founder (dedup.contributions), by batch

A batch that is run again reads what came before it and overwrites its own files, so a restart repeats nothing. `_done`
holds the last whole batch, and is replaced when all three are written; readers stop there.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import versions
from ..operators import dedup
from ..storage import stored

DONE = "_done"


def last_batch(spark: SparkSession, folder: str) -> int:
    """The number of the last batch that is whole; -1 before the first."""
    fs, system, _ = versions._files(spark, folder)
    at = fs.Path(folder, DONE)
    if not system.exists(at):
        return -1
    stream = system.open(at)
    try:
        return int(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _finish(spark: SparkSession, folder: str, batch: int) -> None:
    fs, system, _ = versions._files(spark, folder)
    beside = f"{folder}/_next-{uuid.uuid4().hex}"
    stream = system.create(fs.Path(beside), False)
    stream.write(bytearray(str(batch).encode()))
    stream.close()
    versions._rename(spark, beside, f"{folder}/{DONE}")


def _so_far(spark: SparkSession, folder: str, name: str, before: int) -> DataFrame | None:
    """A table's rows of the batches before one."""
    return spark.read.parquet(f"{folder}/{name}").filter(F.col("batch") < before).drop("batch") if before > 0 else None


def merge_batch(batch: DataFrame, number: int, folder: str, arrival: str = "arrival", doi: str = "doi", fp: str = "fp", source: str = "source", fill: Sequence[str] = dedup.FILL, union: Sequence[str] = dedup.UNION) -> None:
    """Merge one batch into a folder. Arrivals in it come after those of the batches before; numbers go up by one from 0.

    Null DOIs meet nothing, null fingerprints are one key, as in dedup.merge(). A batch that is whole already is left as it is.
    """
    spark = batch.sparkSession
    if number <= last_batch(spark, folder):
        return
    rows = stored(batch, "merge-batch")
    own = rows.select(F.col(arrival).alias("arrival"), F.nullif(F.col(doi), F.lit("")).alias("doi"), F.col(fp).alias("fp"))
    known = _so_far(spark, folder, "keys", number)
    if known is not None:
        by_doi = known.join(own.select("doi").distinct(), "doi", "left_semi")
        by_fp = known.join(own.select(F.col("fp").alias("_fp")).distinct(), F.col("fp").eqNullSafe(F.col("_fp")), "left_semi")
        own = own.unionByName(by_doi.unionByName(by_fp).distinct())
    of = stored(dedup.founders(own), "merge-founders")
    joined = rows.join(of.select(F.col("arrival").alias("_arrival"), "founder"), rows[arrival] == F.col("_arrival")).drop("_arrival")
    founding = joined.filter(F.col("founder") == F.col(arrival)).drop("founder")
    keys = founding.select(F.col(arrival).alias("arrival"), F.nullif(F.col(doi), F.lit("")).alias("doi"), F.col(fp).alias("fp"))
    for name, table in (("keys", keys), ("rows", founding), ("brought", dedup.contributions(joined, arrival, source, fill, union))):
        table.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
    _finish(spark, folder, number)


def merged(spark: SparkSession, folder: str, arrival: str = "arrival") -> DataFrame | None:
    """The records after the last whole batch, as dedup.merge() gives them; None before the first."""
    n = last_batch(spark, folder)
    if n < 0:
        return None
    return dedup.assembled(_so_far(spark, folder, "rows", n + 1), dedup.combined(_so_far(spark, folder, "brought", n + 1)), arrival)


def changed(spark: SparkSession, folder: str, number: int, arrival: str = "arrival") -> DataFrame:
    """The records that a batch founded or brought something to, as they were after it."""
    touched = spark.read.parquet(f"{folder}/brought/batch={number}").select("founder")
    brought = _so_far(spark, folder, "brought", number + 1).join(touched, "founder", "left_semi")
    rows = _so_far(spark, folder, "rows", number + 1)
    return dedup.assembled(rows.join(touched, rows[arrival] == F.col("founder"), "left_semi"), dedup.combined(brought), arrival)


def merge_stream(rows: DataFrame, folder: str, checkpoint: str, **names) -> StreamingQuery:
    """Merge all that has landed, batch by batch, and stop. Rows carry their number of arrival."""

    def each(batch: DataFrame, number: int) -> None:
        merge_batch(batch, number, folder, **names)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
