"""Deduplication and merging of records by DOI and title fingerprint.

Records carry an `arrival` number: what came first stays. The joins have one row a key on one side, so a key that very
many records share is split by Spark like any skewed key; minima are taken map-side first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, nulls last; of rows that tie one, by a hash of all columns. Null keys are one key.

    An aggregate that is combined before the shuffle, so of a hot key's rows each task hands on one; each task sorts its own
    rows by key for it. All columns of rows go through it: select what is needed first, or keys alone and join the rest.
    """
    hashable = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    place = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))], F.xxhash64(*hashable))
    first = rows.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*rows.columns), place).alias("_row"))
    return first.select("_row.*")


def anti_dedup(batch: DataFrame, targets: Sequence[DataFrame], doi: str = "doi", fp: str = "fp") -> DataFrame:
    """batch with `caught`: the number of the first target that has its DOI or its fingerprint, null for a new record.

    Each target has one or both of the columns doi and fp. Records within the batch are not compared with each other.
    """
    out = batch
    for name in (doi, fp):
        known = None
        for i, t in enumerate(targets):
            if name in t.columns:
                keys = t.select(F.col(name).alias("_key")).filter("_key is not null").withColumn("_n", F.lit(i))
                known = keys if known is None else known.union(keys)
        if known is not None:
            least = known.groupBy("_key").agg(F.min("_n").alias(f"_by_{name}"))
            out = out.join(least, out[name] == F.col("_key"), "left").drop("_key")
    found = [F.col(f"_by_{n}") for n in (doi, fp) if f"_by_{n}" in out.columns]
    caught = F.least(*found) if len(found) > 1 else found[0]
    return out.withColumn("caught", caught).drop(*[f"_by_{n}" for n in (doi, fp)])


def new_records(batch: DataFrame, targets: Sequence[DataFrame], doi: str = "doi", fp: str = "fp") -> DataFrame:
    return anti_dedup(batch, targets, doi, fp).filter("caught is null").drop("caught")


def founders(rows: DataFrame, arrival: str = "arrival", doi: str = "doi", fp: str = "fp") -> DataFrame:
    """(arrival, founder): for each row the arrival of the record it becomes part of, its own if it founds one.

    In order of arrival, a row goes to the founder that has its DOI, else to the one that has its fingerprint, else it
    founds a record under its own two keys; what merges registers none. Here all rows that are first among the
    undecided for both of their keys found at once, since nothing earlier can take them; rows that share a key with a
    founder are decided, and the rest goes on. Rounds follow the longest chain of rows that wait for one another.
    """
    keyed = stored(rows.select(F.col(arrival).alias("arrival"), F.nullif(F.col(doi), F.lit("")).alias("doi"), F.col(fp).alias("fp")), "dedup-keys")
    left, found = keyed, None
    while not left.isEmpty():
        by_doi = left.filter("doi is not null").groupBy("doi").agg(F.min("arrival").alias("by_doi"))
        by_fp = left.groupBy("fp").agg(F.min("arrival").alias("by_fp"))
        ranked = left.join(by_doi, "doi", "left").join(by_fp.withColumnRenamed("fp", "_fp"), F.col("fp").eqNullSafe(F.col("_fp"))).drop("_fp")
        first = stored(ranked.filter("by_fp = arrival and (by_doi is null or by_doi = arrival)").select("arrival", "doi", "fp"), "dedup-founders")
        found = first if found is None else found.union(first)
        rest = left.join(first.filter("doi is not null").select("doi"), "doi", "left_anti")
        left = stored(rest.join(first.select(F.col("fp").alias("_fp")), F.col("fp").eqNullSafe(F.col("_fp")), "left_anti").select("arrival", "doi", "fp"), "dedup-left")
    if found is None:
        return keyed.select("arrival", F.col("arrival").alias("founder"))
    of_doi = found.filter("doi is not null").select("doi", F.col("arrival").alias("of_doi"))
    of_fp = found.select(F.col("fp").alias("_fp"), F.col("arrival").alias("of_fp"))
    met = keyed.join(of_doi, "doi", "left").join(of_fp, F.col("fp").eqNullSafe(F.col("_fp")), "left")
    earlier = lambda c: F.when(F.col(c) <= F.col("arrival"), F.col(c))
    return met.select("arrival", F.coalesce(earlier("of_doi"), earlier("of_fp")).alias("founder"))


FILL = ("abstract", "doi", "url", "pdf_url", "venue", "citation_count")
UNION = ("concepts",)


def contributions(joined: DataFrame, arrival: str = "arrival", source: str = "source", fill: Sequence[str] = FILL, union: Sequence[str] = UNION) -> DataFrame:
    """(founder, _n, _sources, _fill_…, _union_…): what rows with a `founder` bring to each record, a row a record.

    Such rows of several batches can be put together by combined(). Of a field of `fill` the first value that is there
    in order of arrival counts, where empty texts and zeros are not; of `union` the set of all elements.
    """
    types = dict(joined.dtypes)
    there = lambda c: F.col(c).isNotNull() & (F.col(c) != (F.lit("") if types[c] == "string" else F.lit(0)))
    sums = [F.count(F.lit(1)).alias("_n"), F.collect_list(F.struct(F.col(arrival).alias("a"), F.col(source).alias("s"))).alias("_sources")]
    sums += [F.min(F.when(there(c), F.struct(F.col(arrival).alias("a"), F.col(c).alias("v")))).alias(f"_fill_{c}") for c in fill if c in types]
    sums += [F.array_distinct(F.flatten(F.collect_list(c))).alias(f"_union_{c}") for c in union if c in types]
    return joined.groupBy("founder").agg(*sums)


def combined(parts: DataFrame) -> DataFrame:
    """contributions() of several batches as one."""
    sums = [F.sum("_n").alias("_n"), F.flatten(F.collect_list("_sources")).alias("_sources")]
    sums += [F.min(c).alias(c) for c in parts.columns if c.startswith("_fill_")]
    sums += [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in parts.columns if c.startswith("_union_")]
    return parts.groupBy("founder").agg(*sums)


def assembled(founding: DataFrame, brought: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The founders' rows with what contributions() bring, and `all_sources` of those that anything merged into."""
    out = founding.join(brought.withColumnRenamed("founder", "_founder"), founding[arrival] == F.col("_founder"))
    value = {c: F.coalesce(F.col(f"_fill_{c}")["v"], F.col(c)) if f"_fill_{c}" in brought.columns else F.array_sort(f"_union_{c}") if f"_union_{c}" in brought.columns else F.col(c) for c in founding.columns}
    sources = F.when(F.col("_n") > 1, F.transform(F.array_sort("_sources"), lambda x: x["s"]))
    return out.select(*[v.alias(c) for c, v in value.items()], sources.alias("all_sources"))


def merge(rows: DataFrame, arrival: str = "arrival", doi: str = "doi", fp: str = "fp", source: str = "source", fill: Sequence[str] = FILL, union: Sequence[str] = UNION) -> DataFrame:
    """One row a record: the founder's, with `all_sources` if anything merged into it.

    Fields of `fill` take the first value that is there in order of arrival, where empty texts and zeros are not; those
    of `union` are the sorted set of all elements.
    """
    of = founders(rows, arrival, doi, fp)
    joined = rows.join(of.select(F.col("arrival").alias("_arrival"), "founder"), rows[arrival] == F.col("_arrival")).drop("_arrival")
    return assembled(rows, contributions(joined, arrival, source, fill, union), arrival)


def two_pass(rows: DataFrame, arrival: str = "arrival", doi: str = "doi", fp: str = "fp") -> DataFrame:
    """First by DOI, then by fingerprint among what stays: simpler than merge(), and not the same where chains cross."""
    has = F.nullif(F.col(doi), F.lit("")).isNotNull()
    by_doi = keep_first(rows.filter(has), [doi], [arrival]).unionByName(rows.filter(~has))
    return keep_first(by_doi, [fp], [arrival])


def insert_absent(index: DataFrame, entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """index and those of entries that it lacks, each once."""
    new = entries.select(*index.columns).dropDuplicates(list(keys)).join(index.select(*keys), list(keys), "left_anti")
    return index.unionByName(new)


def within_batch(rows: DataFrame, arrival: str = "arrival", doi: str = "doi", fp: str = "fp") -> DataFrame:
    """The founders only: what a batch sweep keeps."""
    of = founders(rows, arrival, doi, fp).filter("arrival = founder")
    return rows.join(of.select(F.col("arrival").alias("_arrival")), rows[arrival] == F.col("_arrival"), "left_semi")


def batch_counts(caught: DataFrame, names: Sequence[str]) -> DataFrame:
    """(target, n) for anti_dedup() rows, with `new` for what no target caught."""
    label = F.coalesce(*[F.when(F.col("caught") == i, F.lit(n)) for i, n in enumerate(names)], F.lit("new"))
    return caught.groupBy(label.alias("target")).agg(F.count(F.lit(1)).alias("n"))


def windowed_first(rows: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], most: int = 1) -> DataFrame:
    """The first few rows of each key; Spark limits each task's rows of a key before it shuffles them."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")
