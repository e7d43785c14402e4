"""Exports: compact records, bibliographies, tables, batch requests, reports."""

from __future__ import annotations

import json
from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import versions
from ..functions.text import author_line, bibtex_key, blank, character, export_url, last_first


def compact(papers: DataFrame, private: bool = False) -> DataFrame:
    """One struct `rec` a paper, with short names, in which what is missing is null, and its JSON."""
    none = lambda c: F.when(F.size(c) > 0, F.col(c))
    zero = lambda c: F.nullif(F.col(c), F.lit(0))
    authors = F.array_join(F.filter(F.transform("authors", lambda a: a["name"]), lambda n: F.coalesce(n, F.lit("")) != ""), ", ")
    fields = [
        ("t", F.coalesce("title", F.lit(""))), ("a", F.coalesce(authors, F.lit(""))), ("y", zero("year")), ("v", blank(F.col("venue"))), ("c", zero("citation_count")), ("r", F.coalesce("ai_relevance", F.lit(""))),
        ("s", blank(F.col("one_line_summary"))), ("n", blank(F.col("annotation"))), ("cat", F.coalesce("bu_category", F.lit(""))), ("sch", none("bu_schools")), ("bu", none("bu_author_names")), ("dom", none("domains")),
        ("sub", none("subfields")), ("u", blank(F.col("best_url"))), ("oa", F.when(F.col("is_open_access"), True)), ("doi", blank(F.col("doi"))), ("src", none("all_sources")),
    ]
    if private:
        fields.append(("abs", blank(F.col("abstract"))))
    return papers.select("index", F.struct(*[c.alias(n) for n, c in fields]).alias("rec")).withColumn("json", F.to_json("rec", {"ignoreNullFields": "true"}))


def script_lines(records: DataFrame) -> DataFrame:
    """Lines of a script that holds all records, in order, as many part files as there are tasks."""
    last = records.agg(F.max("index").alias("_last"))  # one row
    return records.join(F.broadcast(last)).select("index", F.concat(F.when(F.col("index") == 0, "window.DATA=[").otherwise(""), "json", F.when(F.col("index") == F.col("_last"), "];").otherwise(",")).alias("line"))


def bibtex_keys(papers: DataFrame, first_author: Column, year: Column, title: Column, order: str, unknown: str = "unknown") -> DataFrame:
    """papers with `key`: those that share one get b, c, … in order after the first, and on through all code points."""
    keyed = papers.withColumn("_key", bibtex_key(first_author, year, title, unknown))
    n = F.row_number().over(Window.partitionBy("_key").orderBy(order))
    return keyed.withColumn("key", F.concat("_key", F.when(n > 1, character(n + 96)).otherwise(""))).drop("_key")


def bibtex(papers: DataFrame, order: str = "index") -> DataFrame:
    """(order, key, entry)."""
    keyed = bibtex_keys(papers, F.get("authors", 0)["name"], F.col("year"), F.col("title"), order)
    kind = F.lower(F.coalesce("publication_type", F.lit("article")))
    entry = F.when(kind.rlike("preprint"), "misc").when(kind.rlike("proceedings|conference"), "inproceedings").when(kind.rlike("thesis|dissertation"), "phdthesis").otherwise("article")
    authors = F.array_join(F.transform("authors", lambda a: last_first(a["name"])), " and ")
    field = lambda n, c: F.concat(F.lit(f"  {n} = {{"), c, F.lit("}"))
    venue = F.concat(F.lit("  "), F.when(entry == "inproceedings", "booktitle").otherwise("journal"), F.lit(" = {"), blank(F.col("venue")), F.lit("}"))
    note = F.replace(F.replace(blank(F.col("annotation")), F.lit("{"), F.lit("\\{")), F.lit("}"), F.lit("\\}"))
    words = F.concat(blank(F.col("ai_relevance")), F.lit(", "), F.array_join("domains", ", "))
    body = F.concat_ws(",\n", field("title", F.coalesce("title", F.lit(""))), field("author", authors), field("year", F.nullif("year", F.lit(0)).cast("string")), venue, field("doi", blank(F.col("doi"))), field("url", blank(F.col("url"))), field("note", note), field("keywords", words))
    return keyed.select(order, "key", F.concat(F.lit("@"), entry, F.lit("{"), "key", F.lit(",\n"), body, F.lit("\n}\n")).alias("entry"))


def summary_table(papers: DataFrame) -> DataFrame:
    """The columns of the summary file."""
    return papers.select(
        "title", F.array_join(F.transform("authors", lambda a: a["name"]), "; ").alias("authors"), "year", "doi", "venue", "source", "publication_type", "citation_count", F.array_join("bu_schools", "; ").alias("schools"),
        F.array_join(F.slice("concepts", 1, 5), "; ").alias("concepts"), F.when(blank(F.col("abstract")).isNotNull(), "yes").otherwise("no").alias("has_abstract"), "url", "pdf_url",
    )


def export_table(papers: DataFrame) -> DataFrame:
    """The columns of the exchange file, in which a DOI is the best address."""
    join = lambda c: F.array_join(c, "; ").alias(c)
    return papers.select("index", "title", author_line(F.transform("authors", lambda a: a["name"])).alias("authors"), "year", "venue", "doi", export_url(F.col("pdf_url"), F.col("url"), F.col("doi")).alias("best_url"), "citation_count", "publication_type", "ai_relevance", "confidence", "publication_status", "one_line_summary", join("domains"), join("subfields"), "annotation", join("bu_schools"), "bu_category", join("bu_author_names"), join("all_sources"))


def bibliography(papers: DataFrame) -> DataFrame:
    """(section, heading, lines): papers by law, other and unclassified sections; those of both stand in two."""
    sections = F.when(F.col("bu_category") == "BOTH", F.array(F.lit("LAW"), F.lit("NON-LAW"))).when(F.col("bu_category").isin("LAW", "NON-LAW"), F.array("bu_category")).otherwise(F.array(F.lit("UNCLASSIFIED")))
    each = papers.withColumn("section", F.explode(sections))
    school = F.coalesce(F.get(F.filter("bu_schools", lambda s: ~F.contains(s, F.lit("Law"))), 0), F.lit("Unspecified"))
    domain = F.coalesce(F.get("domains", 0), F.lit("Other"))
    heading = F.when(F.col("section") == "NON-LAW", F.concat(school, F.lit(" / "), domain)).otherwise(domain)
    line = F.concat_ws(". ", F.concat(F.lit("- **"), "title", F.lit("**")), author_line(F.transform("authors", lambda a: a["name"])), F.concat_ws(", ", blank(F.col("venue")), F.nullif("year", F.lit(0)).cast("string")))
    ranked = each.withColumn("heading", heading).withColumn("_x", F.struct((-F.coalesce("year", F.lit(0))).alias("y"), (-F.coalesce("citation_count", F.lit(0))).alias("c"), F.col("index").alias("i"), line.alias("line")))
    return ranked.select("section", "heading", "_x.*").orderBy("section", "heading", "y", "c", "i").select("section", "heading", "line")


def batch_requests(papers: DataFrame, prompt: Column, model: str, system: str, most_tokens: int = 1024) -> DataFrame:
    """(custom_id, tokens, request): lines of a batch file and the tokens that they may cost."""
    from ..functions.text import tokens

    id = F.concat(F.lit("p_"), F.col("index").cast("string"), F.lit("_"), F.coalesce("source", F.lit("")))
    message = F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))
    params = F.struct(F.lit(model).alias("model"), F.lit(most_tokens).alias("max_tokens"), F.lit(system).alias("system"), message.alias("messages"))
    return papers.select(id.alias("custom_id"), tokens(prompt).alias("tokens"), F.to_json(F.struct(id.alias("custom_id"), params.alias("params"))).alias("request"))


def write_lines(lines: DataFrame, path: str) -> None:
    """A column of text as lines."""
    lines.write.mode("overwrite").text(path)


def save_master(master: DataFrame, path: str) -> str:
    """Commit the dataset as a new version (versions.py): a failed or killed save leaves the one before."""
    return versions.commit(master, path)


def read_master(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset as last saved; None if it never was."""
    return versions.read(spark, path)


def path_sizes(spark: SparkSession, path: str) -> tuple[int, str]:
    """(bytes of a folder's data files, 16 hexadecimal digits of the SHA-256 of their SHA-256 digests in the order of their names)."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = fs.Path(path)
    files = sorted((f for f in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at) if not f.getPath().getName().startswith(("_", "."))), key=lambda f: f.getPath().getName())
    hashed = spark.read.format("binaryFile").load([f.getPath().toString() for f in files]).select("path", F.sha2("content", 256).alias("h")) if files else None
    digests = sorted((r["path"], r["h"]) for r in hashed.collect()) if hashed is not None else []  # a row a file
    return sum(f.getLen() for f in files), sha256("".join(h for _, h in digests).encode()).hexdigest()[:16]


def parses_back(spark: SparkSession, path: str, n: int) -> bool:
    """Whether script_lines() as written hold as many readable records as they should, and no other line."""
    record = F.regexp_replace("value", r"^window\.DATA=\[|(,|\];)$", "")
    found = spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.get_json_object(record, "$").isNotNull()).alias("ok")).first()
    return found["lines"] == found["ok"] == n


def load_state(spark: SparkSession, path: str, defaults: dict) -> dict:
    """A run's state, with defaults for what it lacks; the defaults where there is none."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs):
        return dict(defaults)
    return defaults | json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))  # one small file


def save_state(spark: SparkSession, path: str, state: dict) -> None:
    spark.createDataFrame([(json.dumps(state, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def save_index(index: DataFrame, path: str, keys: Sequence[str]) -> None:
    """A key table, each key once, sorted within its files."""
    index.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def append_log(entry: DataFrame, path: str) -> None:
    entry.write.mode("append").csv(path, header=True)


def fill_counts(text: str, counts: dict[str, int]) -> str:
    """A page's text with the numbers before each named word replaced."""
    import re

    for word, n in counts.items():
        text = re.sub(rf"\d[\d,]*(?=\+? {re.escape(word)})", f"{n:,}", text)
    return text
