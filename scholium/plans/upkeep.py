"""Queries of exports, audits and appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, export, maintain, match, quality
from .base import PAPERS, papers, query, table


@query("select page_id, url from pages where url <> '' and not contains(url, 'doi.org/')")
def q_links_to_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.links_to_check(table(spark, sf_dir, "pages")).select("page_id", "url")


@query(f"with {PAPERS} select 'p_' || doc_id || '_' || source as custom_id, cast(length(title) // 4 as bigint) as tokens from papers")
def q_batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir).withColumn("index", F.col("doc_id"))
    return export.batch_requests(rows, F.col("title"), "model", "system").select("custom_id", "tokens")


@query("""
with h as (select o_custkey, bool_or(o_orderpriority = '1-URGENT') as hit from orders group by 1)
select c_custkey as id, case when hit is null then 'unreachable' when hit then 'confirmed' else 'wrong' end as status from customer left join h on c_custkey = o_custkey
""")
def q_audit_affiliations(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return match.audit_affiliations(people, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("institution")), "1-urgent")


@query("""
with r as (select o_custkey, o_orderkey, o_orderpriority, row_number() over (partition by o_custkey order by o_orderkey) as n from orders qualify row_number() over (partition by o_custkey order by o_orderkey) <= 2)
select o_custkey as id, first(o_orderkey order by n) as hit from r where o_orderpriority = '1-URGENT' group by 1
""")
def q_name_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit("Ann Urgent").alias("name"))
    hits = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.concat(F.lit("A. "), "o_orderpriority").alias("name"), F.col("o_orderkey").alias("hit"), F.col("o_orderkey").alias("ord"))
    return match.name_hits(wanted, hits)


@query("select c_custkey from customer where c_mktsegment not in (select c_mktsegment from customer where c_custkey < 3)")
def q_missing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").withColumn("name", F.concat(F.lit("Ann "), "c_mktsegment"))
    return match.missing_names(people, people.filter("c_custkey < 3")).select("c_custkey")


@query("""
select cast(sum(o_custkey) as bigint) as harvested, count(*) filter (where o_orderstatus = 'F') as ok, count(*) filter (where o_orderstatus = 'O') as partial, count(*) filter (where o_orderstatus = 'P') as failed from orders
""")
def q_harvest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "PARTIAL_TIMEOUT").otherwise("FAILED")
    return maintain.harvest_totals(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("count"), status.alias("status")))


@query("""
with m as (select o_orderkey, cast(row_number() over (order by o_orderkey) - 1 as int) as index from orders where o_orderstatus = 'F')
select o_orderkey, index, '' as best_url from m union all
select o_orderkey, cast(row_number() over (order by o_orderkey) + (select count(*) from m) - 1 as int), 'https://doi.org/' || o_orderkey from orders where o_orderstatus <> 'F'
""")
def q_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.lit("").alias("pdf_url"), F.lit("").alias("url"), F.col("o_orderkey").cast("string").alias("doi"), F.lit("s").alias("source"))
    master = maintain.numbered(rows.filter("o_orderstatus = 'F'"), "o_orderkey").withColumn("best_url", F.lit("")).withColumn("all_sources", F.array("source"))
    return maintain.append(master, rows.filter("o_orderstatus <> 'F'"), "o_orderkey").select("o_orderkey", "index", "best_url")


@query(f"""
with {PAPERS}, e as (select unnest(case lang when 'en' then ['LAW', 'NON-LAW'] when 'de' then ['LAW'] when 'fr' then ['NON-LAW'] else ['UNCLASSIFIED'] end) as section, source from papers)
select section, case section when 'NON-LAW' then 'Arts / ' || source else source end as heading, count(*) as n from e group by 1, 2
""")
def q_bibliography(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("lang") == "en", "BOTH").when(F.col("lang") == "de", "LAW").when(F.col("lang") == "fr", "NON-LAW").otherwise("UNCLASSIFIED")
    rows = papers(spark, sf_dir).select(
        F.col("doc_id").alias("index"), "title", F.array(F.struct(F.col("source").alias("name"))).alias("authors"), F.lit(2020).alias("year"), F.lit("").alias("venue"), F.lit(1).alias("citation_count"), F.array("source").alias("domains"), F.array(F.lit("School of Law"), F.lit("Arts")).alias("bu_schools"), kind.alias("bu_category")
    )
    return export.bibliography(rows).groupBy("section", "heading").agg(F.count(F.lit(1)).alias("n"))


@query("""
select case when c_custkey > 120 or c_acctbal > 9500 then 'FAIL' else 'WARN' end as level, 'run' as check_name, c_custkey || ' added' as message from customer where c_custkey > 60 or c_acctbal > 9000
""")
def q_run_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("added"), F.col("c_acctbal").alias("cost"))
    return quality.run_sanity(runs, 60, 120, 9000.0, 9500.0)


@query("""
with k as (select doc_id, source || n_chars as doi, md5(split_part(text, chr(10), 1)) as fp from documents)
select a.doc_id from k a where not exists (select 1 from k b where b.doc_id < a.doc_id and b.fp = a.fp)
""")
def q_within_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("string").alias("doi"), F.md5(F.get(F.split("text", "\n"), 0)).alias("fp"))
    return dedup.within_batch(rows, "doc_id").select("doc_id")


@query(f"with {PAPERS} select doc_id, title, source as authors, 'no' as has_abstract, lang as concepts from papers")
def q_summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = papers(spark, sf_dir).select("doc_id", "title", F.array(F.struct(F.col("source").alias("name"))).alias("authors"), F.lit(2020).alias("year"), F.col("doc_id").cast("string").alias("doi"), none.alias("venue"), "source", none.alias("publication_type"), F.lit(0).alias("citation_count"), F.array("lang").alias("bu_schools"), F.array("lang").alias("concepts"), F.lit("").alias("abstract"), none.alias("url"), none.alias("pdf_url"))
    return export.summary_table(rows).select(F.col("doi").cast("long").alias("doc_id"), "title", "authors", "has_abstract", "concepts")
