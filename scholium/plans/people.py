"""Queries of rosters, profiles, and what is harvested by identifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import maintain, match
from ..sources import roster
from .base import query, table

_LAST = "'fam' || chr(97 + {0})"


def _last(nation: str):
    return F.concat(F.lit("fam"), F.char(F.col(nation) + 97))


def q_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names among the headings of all pages, each page a directory of its own; SQL has no selectors."""
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/]+)", 1).alias("school"), F.col("page_id").alias("ord"), F.col("url").alias("source_url"), F.lit(1).alias("page"), "html")
    return roster.roster(pages, (roster.Strategy("div.faculty-card", "h3"), roster.Strategy("article h1"), roster.Strategy("h1, h2")))[0]


query()(q_roster)


@query(f"""
with r as (select s_name, 'chris ' || {_LAST.format('s_nationkey')} as n, 'A' || s_suppkey as pid, {_LAST.format('s_nationkey')} as last from supplier),
c as (select 'A' || c_custkey as id, c_nationkey as works, case c_custkey % 3 when 0 then 'c' when 1 then 'christopher' else 'dana' end as first, c_custkey % 9 = 2 as alt, {_LAST.format('c_nationkey')} as last, c_custkey % 4 as place from customer)
select distinct n as name, pid as primary_id, id, works from r join c using (last) where works >= 10 and place <> 2 and id <> pid and (first <> 'dana' or alt)
""")
def q_split_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "supplier").select(F.concat_ws(" ", F.lit("chris"), _last("s_nationkey")).alias("name"), F.concat(F.lit("A"), F.col("s_suppkey").cast("string")).alias("openalex_id"))
    key = F.col("c_custkey")
    first = F.when(key % 3 == 0, "C.").when(key % 3 == 1, "Christopher").otherwise("Dana")
    others = F.when(key % 9 == 2, F.array(F.concat_ws(" ", F.lit("Chris P."), _last("c_nationkey"))))
    places = F.when(key % 4 == 0, F.array().cast("array<string>")).when(key % 4 == 1, F.array(F.lit("Near College"))).when(key % 4 == 2, F.array(F.lit("Far")))
    profiles = table(spark, sf_dir, "customer").select(F.concat(F.lit("A"), key.cast("string")).alias("id"), F.concat_ws(" ", first, _last("c_nationkey")).alias("display_name"), others.alias("alternatives"), F.col("c_nationkey").alias("works_count"), places.alias("last_institutions"))
    return match.split_profiles(people, profiles, ["near"])


def _histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    doi = F.concat_ws("-", F.col("o_custkey").cast("string"), "o_orderpriority")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("author_id"), F.col("o_orderpriority").alias("title"), F.lit("").alias("abstract"), doi.alias("doi"), F.md5(doi).alias("fp"), F.col("o_orderkey").alias("arrival"), F.year("o_orderdate").alias("year"), "o_orderstatus")


def _by_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = _histories(spark, sf_dir)
    people = table(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") > 0, F.col("c_custkey").cast("string")).alias("openalex_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("school"))
    return roster.by_author(papers.withColumn("author_id", F.col("author_id").cast("string")), people, papers.filter("o_orderstatus = 'P'").select("doi", "fp"), ["urgent", "high"])


_BY_AUTHOR = """k as (select o_custkey, o_orderkey, o_custkey || '-' || o_orderpriority as doi, o_orderstatus, o_orderpriority, year(o_orderdate) as y from orders),
h as (select min(o_orderkey) as arrival, doi from k join customer on c_custkey = o_custkey where c_acctbal > 0 and (o_orderpriority like '%URGENT%' or o_orderpriority like '%HIGH%') and doi not in (select doi from k where o_orderstatus = 'P') group by doi),
f as (select arrival, c_name, c_mktsegment, y from h join k on arrival = o_orderkey join customer on c_custkey = o_custkey)"""


@query(f"with {_BY_AUTHOR} select arrival, c_name as harvested_via, c_mktsegment as faculty_school from f")
def q_author_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_author(spark, sf_dir).select("arrival", F.col("_harvested_via").alias("harvested_via"), F.col("_faculty_school").alias("faculty_school"))


@query(f"with {_BY_AUTHOR} select c_mktsegment as value, count(*) as n from f group by 1 union all select cast(y // 10 * 10 as varchar), count(*) from f group by 1")
def q_author_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    schools, decades = roster.author_breakdown(_by_author(spark, sf_dir))
    return schools.select(F.col("school").alias("value"), "n").unionByName(decades.select(F.col("decade").cast("string").alias("value"), "n"))


@query("select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 5000 order by c_custkey limit 20)")
def q_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("openalex_id"), F.col("c_custkey").alias("ord"), "c_acctbal")
    papers = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("author_id"))
    return roster.backfill(papers, people.filter("c_acctbal > 5000").select("name", "ord"), people.select("name", "openalex_id")).select("o_orderkey")


@query("select 'A' || c_custkey as id, c_nationkey as works_count, case when c_custkey % 3 = 0 then '' else c_mktsegment end as last_institution from customer where c_custkey % 2 = 1")
def q_profile_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, none = F.col("c_custkey"), F.lit(None).cast("array<string>")
    last = F.when(key % 3 != 0, F.array(F.struct(F.col("c_mktsegment").alias("display_name")), F.struct(F.lit("b").alias("display_name"))))
    raw = table(spark, sf_dir, "customer").select(F.concat(F.lit("A"), key.cast("string")).alias("id"), F.concat(F.lit(" "), F.upper("c_name")).alias("display_name"), none.alias("display_name_alternatives"), F.col("c_nationkey").alias("works_count"), last.alias("last_known_institutions"))
    known = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_name").alias("name"))
    return roster.unknown_profiles(roster.profiles(raw), known).select("id", "works_count", "last_institution")


@query("select cast(b as bigint) as batch, count(*) as n, min(o_orderkey) as first, max(o_orderkey) as last from (select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 200 as b from orders) group by b")
def q_id_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roster.id_batches(table(spark, sf_dir, "orders"), "o_orderkey")
    return rows.select("batch", F.size("ids").cast("long").alias("n"), F.get("ids", 0).alias("first"), F.element_at("ids", -1).alias("last"))


@query("""
select c_custkey, case when c_custkey % 3 = 0 then 'Ann Leea' when c_custkey % 3 = 1 then 'Ann B Leea' else 'Zoe Leea' end as canonical, case when c_custkey % 3 = 0 then 1 when c_custkey % 3 = 1 then 2 else 0 end as tier from customer
""")
def q_canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    name = F.when(key % 3 == 0, "A. Leea").when(key % 3 == 1, "Annie Leea").otherwise("Zoe Leea")
    authors = table(spark, sf_dir, "customer").select(F.when(key % 3 == 0, key).alias("id"), name.alias("name"), F.lit(True).alias("is_bu"), "c_custkey")
    by_id = table(spark, sf_dir, "customer").select(key.alias("id"), F.lit("Ann Leea").alias("canonical"))
    alt = spark.range(1).select(F.lit("annie leea").alias("alt"), F.lit("Ann B Leea").alias("canonical"))
    by_key = spark.range(1).select(F.lit("none").alias("key"), F.lit("None").alias("canonical"))
    return match.canonical_names(authors, by_id, alt, by_key).select("c_custkey", "canonical", "tier")


@query("""
select s_suppkey, case when s_suppkey % 4 = 0 then 'held' else 'new' || s_suppkey end as abstract from supplier
""")
def q_fill_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    master = table(spark, sf_dir, "supplier").select("s_suppkey", key.cast("string").alias("doi"), F.when(key % 4 == 0, "held").when(key % 4 == 1, "").alias("abstract"))
    fresh = master.select("doi", F.concat(F.lit("new"), "doi").alias("abstract"))
    return maintain.fill_abstracts(master, fresh, most=1_000_000).select("s_suppkey", "abstract")


@query("""
select c_custkey, case when c_custkey % 2 = 0 then 'primary' else 'unknown' end as relevance from customer
""")
def q_batch_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    inputs = table(spark, sf_dir, "customer").select(key.alias("index"))
    answers = table(spark, sf_dir, "customer").filter("c_custkey % 4 <> 1").select(F.concat(F.lit("p_"), key.cast("string"), F.lit("_s")).alias("custom_id"), (key % 2 == 0).alias("ok"), F.lit('{"ai_relevance": "primary"}').alias("text"), F.lit(1).alias("input_tokens"), F.lit(1).alias("output_tokens"))
    return match.responses(inputs, answers).select(F.col("index").alias("c_custkey"), F.col("classification.ai_relevance").alias("relevance"))
