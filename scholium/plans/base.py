"""What the queries share: tables, and documents seen as papers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as papers: the first line is the title."""
    return table(spark, sf_dir, "documents").select("doc_id", F.get(F.split("text", "\n"), 0).alias("title"), "text", "lang", "source", "n_chars")


#: The same in SQL, as a common table expression, and the SQL of a normalised title and a plain one.
PAPERS = "papers as (select doc_id, split_part(text, chr(10), 1) as title, text, lang, source, n_chars from documents)"
NORMAL = r"regexp_replace(regexp_replace(trim(lower(trim(regexp_replace({0}, '\s+', ' ', 'g')))), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g')"
ALNUM = r"trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"
