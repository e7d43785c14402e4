"""What the corpus operators share: table reading, held-out rows, text cells."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import stored  # noqa: F401

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows that no model may learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def text_slices(batches: Iterable[pa.RecordBatch], chars: int = 4_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of bounded text size; a single longer text makes a slice of its own."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if size and size + n > chars:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def text_list(column: pa.Array) -> list[str]:
    """Cell texts, with the empty text in the place of null."""
    return ["" if x is None else x for x in column.to_pylist()]
