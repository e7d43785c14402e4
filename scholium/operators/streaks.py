"""Streaks: how many rows in a row meet a condition, by key, in order.

Rows are sorted by key and order over all partitions, so one long key is many tasks' work. Each task carries its count
from row to row; what a partition hands on to the next one is a single row, and those are scanned at the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import stored


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to rows of one sorted partition: part, row, streak so far, whether it began with the partition."""
    part, row = TaskContext.get().partitionId(), 0
    key, streak, open_start = None, 0, True
    for batch in batches:
        m = batch.num_rows
        if not m:
            continue
        keys, flags = batch.column("_key").to_pylist(), batch.column("_flag").to_numpy(zero_copy_only=False)
        at = np.arange(m)
        new = np.array([a != b for a, b in zip(keys, [key, *keys])])
        new[0] |= row == 0
        begins = np.maximum.accumulate(np.where(new, at, -1))
        off = np.maximum.accumulate(np.where(~flags, at, -1))
        since = np.maximum(begins - 1, off)
        before = (begins < 0) & (off < 0)  # neither a new key nor an unflagged row in this batch yet
        streaks = np.where(before, at + 1 + streak, at - since)
        new_keys = np.cumsum(new) - (row == 0)  # the partition's first key has number 0
        first = (new_keys == 0) & open_start if row else new_keys == 0
        unbroken = first & (off < 0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(m, part)), pa.array(row + at), pa.array(streaks), pa.array(unbroken)], names=[*batch.schema.names, "_part", "_row", "_streak", "_open"])
        key, streak, open_start, row = keys[-1], int(streaks[-1]), bool(unbroken[-1]), row + m


def streaks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, name: str = "streak") -> DataFrame:
    """rows with how many flagged rows in a row end at each one, 0 for one that is not flagged. A null flag is false.

    Rows of one key and order may be counted in either order. Null keys are one key. Without keys all rows are one.
    """
    columns = rows.columns
    marked = rows.withColumns({"_flag": F.coalesce(flag, F.lit(False)), "_key": F.to_json(F.struct(*keys)) if keys else F.lit("")})
    by = [*keys, *order]
    ordered = marked.repartitionByRange(*by).sortWithinPartitions(*by)
    schema = T.StructType([*marked.schema.fields, *(T.StructField(n, t) for n, t in (("_part", T.LongType()), ("_row", T.LongType()), ("_streak", T.LongType()), ("_open", T.BooleanType())))])
    local = stored(ordered.mapInArrow(_scan, schema), "streaks")
    firsts = F.min_by("_key", "_row").alias("first")
    ends = local.groupBy("_part").agg(firsts, F.max_by(F.struct("_key", "_streak", "_open"), "_row").alias("last")).collect()  # a row a partition
    carries, key, streak = {}, None, 0
    for r in sorted(ends, key=lambda r: r["_part"]):
        carry = streak if r["first"] == key else 0
        carries[r["_part"]] = carry
        key, streak = r["last"]["_key"], r["last"]["_streak"] + (carry if r["last"]["_open"] else 0)
    carried = rows.sparkSession.createDataFrame(list(carries.items()), "_part long, _carry long")
    out = local.join(F.broadcast(carried), "_part", "left")
    return out.select(*columns, (F.col("_streak") + F.when(F.col("_open"), F.col("_carry")).otherwise(0)).alias(name))


def last_streaks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column) -> DataFrame:
    """(keys…, streak): the streak that each key's last row ends."""
    counted = streaks(rows.select(*dict.fromkeys([*keys, *order]), flag.alias("_on")), keys, order, F.col("_on"), "_n")
    place = F.struct(*order)
    return counted.groupBy(*keys).agg(F.max_by("_n", place).alias("streak"))
