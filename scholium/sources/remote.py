"""Sources that are asked part by part, as Spark data sources: parts are tasks, dates are pushed to the request, and a part that fails keeps what it got.

A source is two functions: `parts(since, until)` lists what to ask for (months, pages of a listing, names), and
`fetch(part, since, until)` yields rows. Both dates may be None. A task's row of status ends its part: how many rows it
gave, and what went wrong. So one failing part, or one that runs out of time, costs its own rest and nothing else; a lost
executor's parts are asked again by Spark.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual

Parts = Callable[[dt.date | None, dt.date | None], Iterable[Any]]
Fetch = Callable[[Any, dt.date | None, dt.date | None], Iterator[tuple]]

OK, ERROR, TIMEOUT, FAILED = "ok", "PARTIAL_ERROR", "PARTIAL_TIMEOUT", "FAILED"
STATUS = [T.StructField("_part", T.StringType()), T.StructField("_status", T.StringType()), T.StructField("_error", T.StringType()), T.StructField("_n", T.LongType())]


def register(spark: SparkSession, name: str, schema: T.StructType, parts: Parts, fetch: Fetch, date: str | None = None, budget_s: float | None = None) -> None:
    """Make `name` a format that spark.read knows. `date` is the column whose bounds are pushed to parts and fetch, and then hold.

    With a budget a part stops when its seconds are over; the row that is being fetched is waited for.
    """
    at = schema.fieldNames().index(date) if date else -1

    class Reader(DataSourceReader):
        def __init__(self) -> None:
            self.since: dt.date | None = None
            self.until: dt.date | None = None

        def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
            """Bounds of the date narrow the request. Status rows come with any request, so they are not asked for a date."""
            for f in filters:
                value = getattr(f, "value", None)
                if not date or f.attribute != (date,) or not (isinstance(f, IsNotNull) or type(value) is dt.date):
                    yield f
                    continue
                day = dt.timedelta(days=1)
                low = value if isinstance(f, (GreaterThanOrEqual, EqualTo)) else value + day if isinstance(f, GreaterThan) else None
                high = value if isinstance(f, (LessThanOrEqual, EqualTo)) else value - day if isinstance(f, LessThan) else None
                if low is None and high is None and not isinstance(f, IsNotNull):
                    yield f
                    continue
                if low is not None:
                    self.since = max(low, self.since or low)
                if high is not None:
                    self.until = min(high, self.until or high)

        def partitions(self) -> list[InputPartition]:
            return [InputPartition(p) for p in parts(self.since, self.until)] or [InputPartition(None)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            none, part, n, began = (None,) * len(schema), partition.value, 0, time.monotonic()
            if part is None:  # nothing to ask for
                return
            status, error = OK, None
            try:
                for row in fetch(part, self.since, self.until):
                    if date and (row[at] is None or self.since and row[at] < self.since or self.until and row[at] > self.until) and (self.since or self.until):
                        continue
                    n += 1
                    yield (*row, str(part), None, None, None)
                    if budget_s is not None and time.monotonic() - began > budget_s:
                        status, error = TIMEOUT, f"{budget_s:g} seconds exceeded"
                        break
            except Exception as e:  # noqa: BLE001  it is told in the part's status row
                status, error = ERROR if n else FAILED, f"{type(e).__name__}: {e}"[:500]
            yield (*none, str(part), status, error, n)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return T.StructType([*schema.fields, *STATUS])

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Reader()

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Source)


def since(spark: SparkSession, name: str, date: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Records and status rows of what a source has between two days."""
    rows = spark.read.format(name).load()
    for bound, holds in ((start, F.col(date) >= F.lit(start)), (end, F.col(date) <= F.lit(end))):
        rows = rows if bound is None else rows.filter(holds)
    return rows


def records(rows: DataFrame) -> DataFrame:
    """The records alone. Read them and statuses() from a stored table, or the source is asked twice."""
    return rows.filter("_status is null").drop(*[f.name for f in STATUS])


def statuses(rows: DataFrame) -> DataFrame:
    """(part, status, error, n), a row a part."""
    return rows.filter("_status is not null").select(*[F.col(f.name).alias(f.name[1:]) for f in STATUS])


def summary(rows: DataFrame) -> tuple[int, str, str]:
    """(records, status, error) of a source: ok, the first part's failure that left it partial, or FAILED if nothing came."""
    s = statuses(rows).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("status") != OK).alias("bad"), F.count(F.lit(1)).alias("parts"), F.count_if(F.col("status") == TIMEOUT).alias("late"),
        F.min(F.when(F.col("status") != OK, F.concat_ws(": ", "part", "error"))).alias("error"),
    ).first()
    status = OK if not s["bad"] else FAILED if not s["n"] and s["bad"] == s["parts"] else TIMEOUT if s["late"] == s["bad"] else ERROR
    return s["n"], status, "" if status == OK else f"{s['bad']} of {s['parts']} parts, {s['error']}"[:500]
