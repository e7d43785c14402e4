"""The corpus pipeline: documents in one language, without repeated runs of lines, near copies and benchmark items, encoded.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and reread as the next one's
docs. All but the last return the columns that they were given, whatever their names. Texts are taken whole, however long.

Null and empty texts have no letter, so the first stage rejects them; of the rest, a text that line dedup left empty goes
through the later stages as one without words. Rows with a null id are not compared with others for lines and near
copies, and stay. Of repeated rows the near-copy stage keeps one. An empty table goes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholium.llm import bpe, decontaminate, language, linededup, simhash
from scholium.llm.common import stored, table


def one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, and those with less than half of their letters in one language."""
    return language.filtered(docs, language.train(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later repeated runs of lines; a document that was all repeated goes on with an empty text."""
    short = linededup.deduplicated(docs, boundary=linededup.BOUNDARY)
    return short.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else short


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that of the smallest id."""
    return simhash.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that contain a benchmark item."""
    return decontaminate.filtered(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.digests(docs)


STAGES = [
    ("language", one_language),
    ("line dedup", without_repeated_lines),
    ("near copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("bpe", encoded),
]

#: SQL can express neither the models nor the search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
