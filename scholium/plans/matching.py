"""Queries of deduplication, matching and upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup, filters, maintain, match
from .base import ALNUM, NORMAL, PAPERS, papers, query, table


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with two keys: the whole text's hash as a DOI, the normalised title's as the fingerprint."""
    return papers(spark, sf_dir).select("doc_id", F.col("doc_id").alias("arrival"), F.md5("text").alias("doi"), T.fingerprint(F.col("title")).alias("fp"), "title", "text", "lang", "source", "n_chars")


_KEYED = f"{PAPERS}, keyed as (select doc_id, md5(text) as doi, md5({NORMAL.format('title')}) as fp, title, text, lang, source, n_chars from papers)"
_TERMS = "|".join(dict.fromkeys(t.lower() for t in filters.TERMS))


@query(f"""
with {_KEYED}, first as (select * from keyed qualify row_number() over (partition by fp order by doc_id) = 1)
select lang, count(*) as n, cast(sum(n_chars) as bigint) as chars from first where regexp_matches(lower(title || ' ' || text), '{_TERMS}') group by lang
""")
def q_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _keyed(spark, sf_dir).select("doc_id", "fp", "lang", "n_chars", filters.keyword_hit("title", "text").alias("hit"))  # texts are read where they lie
    return dedup.keep_first(flagged, ["fp"], ["doc_id"]).filter("hit").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query(f"with {_KEYED} select doc_id, doi from keyed qualify row_number() over (partition by doi order by doc_id) = 1")
def q_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_first(_keyed(spark, sf_dir).select("doc_id", "doi"), ["doi"], ["doc_id"])


_CAUGHT = f"""
{_KEYED}, batch as (select * from keyed where source not in ('src1', 'src2', 'src3')),
t as (select doi, fp, case source when 'src1' then 0 when 'src2' then 1 else 2 end as n from keyed where source in ('src1', 'src2', 'src3')),
d as (select doi, min(n) as n from t group by doi), f as (select fp, min(n) as n from t group by fp),
caught as (select b.doc_id, least(coalesce(d.n, 9), coalesce(f.n, 9)) as c from batch b left join d using (doi) left join f using (fp))
"""


def _caught(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _keyed(spark, sf_dir)
    targets = [keyed.filter(F.col("source") == s).select("doi", "fp") for s in ("src1", "src2", "src3")]
    return dedup.anti_dedup(keyed.filter(~F.col("source").isin("src1", "src2", "src3")), targets)


@query(f"with {_CAUGHT} select doc_id from caught where c = 9")
def q_anti_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _caught(spark, sf_dir).filter("caught is null").select("doc_id")


@query(f"with {_CAUGHT} select case c when 0 then 'master' when 1 then 'rejected' when 2 then 'outside' else 'new' end as target, count(*) as n from caught group by 1")
def q_anti_dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.batch_counts(_caught(spark, sf_dir), ["master", "rejected", "outside"])


@query(f"""
with {_KEYED}, a as (select * from keyed qualify row_number() over (partition by doi order by doc_id) = 1)
select doc_id from a qualify row_number() over (partition by fp order by doc_id) = 1
""")
def q_two_pass_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.two_pass(_keyed(spark, sf_dir)).select("doc_id")


@query()
def q_exact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _keyed(spark, sf_dir).withColumn("doi", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.concat("source", F.col("n_chars").cast("string"))))
    rows = rows.withColumn("abstract", F.when(F.col("lang") == "de", "").otherwise(F.col("text"))).withColumn("concepts", F.array("lang")).withColumn("citation_count", F.col("n_chars") % 3)
    return dedup.merge(rows).select("doc_id", "doi", "abstract", "citation_count", F.array_join("concepts", ",").alias("concepts"), F.array_join("all_sources", ",").alias("sources"))


@query(f"with {PAPERS} select doc_id, source from papers where source = 'src1' union all (select doc_id, source from papers where lang = 'de' and source <> 'src1')")
def q_neg_index_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir).select("doc_id", "source", "lang")
    return dedup.insert_absent(rows.filter("source = 'src1'").select("doc_id", "source"), rows.filter("lang = 'de'"), ["doc_id"])


@query("select doc_id from documents where doc_id not in (select doc_id from labels where quality = 1)")
def q_kept_minus_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").filter("quality = 1"), "doc_id", "left_anti")


_RULES = [("brass|copper", "metal works"), ("^standard", "standard goods"), ("small|medium", "goods by size"), ("steel$", "steel works"), ("(plated|polished)", "finishing")]
_CASE = "case " + " ".join(f"when regexp_matches(lower(p_type), '{p}') then '{v}'" for p, v in _RULES) + " end"


@query(f"select p_partkey, {_CASE} as school from part")
def q_school_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", match.first_rule(F.col("p_type"), _RULES).alias("school"))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a roster, named for their nation."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == nation["n_nationkey"]).join(region, F.col("n_regionkey") == region["r_regionkey"])
    none = F.lit(None).cast("string")
    return rows.select(F.concat(F.lit("Ann "), F.translate("n_name", "0123456789_", "abcdefghij")).alias("name"), F.col("s_suppkey").cast("string").alias("openalex_id"), F.array().cast("array<string>").alias("alternate_openalex_ids"), F.col("r_name").alias("school"), none.alias("secondary_school"), F.col("s_suppkey").cast("int").alias("ord"), "s_acctbal", "s_suppkey")


def _orders_as_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark, sf_dir).select("s_suppkey", F.col("name").alias("_name"))
    lines = table(spark, sf_dir, "lineitem").join(people, F.col("l_suppkey") == people["s_suppkey"])
    author = F.struct(F.col("_name").alias("name"), F.col("l_shipinstruct_").alias("affiliation"), (F.col("l_returnflag") == "A").alias("is_bu"), F.col("l_suppkey").cast("string").alias("openalex_id"))
    lines = lines.withColumn("l_shipinstruct_", F.concat(F.lit("university of "), F.lower("l_linestatus")))
    return lines.groupBy(F.col("l_orderkey").alias("paper_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", author.alias("a")))), lambda x: x["a"]).alias("authors"))


_PEOPLE = "people as (select s_suppkey, 'Ann ' || translate(n_name, '0123456789_', 'abcdefghij') as name, r_name as school, s_acctbal from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"


@query(f"""
with {_PEOPLE}, roster as (select * from people where s_acctbal > 5000), alone as (select name from roster group by name having count(*) = 1),
a as (select l_orderkey, l_returnflag = 'A' or l_suppkey in (select s_suppkey from roster) or p.name in (select name from alone) as ok from lineitem join people p on l_suppkey = s_suppkey)
select l_orderkey as paper_id, count(*) as n_authors, count(*) filter (where ok) as n_verified from a group by 1 having bool_or(ok)
""")
def q_verify_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = match.verify_authors(_orders_as_papers(spark, sf_dir), _people(spark, sf_dir).filter("s_acctbal > 5000"))
    return kept.select("paper_id", F.size("authors").cast("long").alias("n_authors"), F.size(F.filter("authors", lambda a: a["is_bu"])).cast("long").alias("n_verified"))


@query(f"""
with {_PEOPLE}, roster as (select * from people where s_acctbal > 5000), keys as (select name, min(school) as school from roster group by name having count(distinct school) = 1),
a as (select l_orderkey, l_returnflag = 'A' as flagged, r.school as s1, l_linestatus, k.school as s3, r.s_suppkey is not null as known
  from lineitem join people p on l_suppkey = p.s_suppkey left join roster r on l_suppkey = r.s_suppkey left join keys k on k.name = p.name),
b as (select *, case when s1 is null and flagged then case when l_linestatus = 'O' then 'School of Law' end else s1 end as s2 from a),
c as (select *, coalesce(s2, case when flagged and (select count(*) from lineitem x where x.l_orderkey = b.l_orderkey) <= 30 then s3 end, case when flagged then 'Unit (unspecified)' end) as s from b),
d as (select l_orderkey, list_sort(list(distinct s) filter (where s is not null)) as ss, bool_or(s like '%Law%') as law, bool_or(s not like '%Law%') as other from c group by 1)
select l_orderkey as paper_id, array_to_string(list_filter(coalesce(ss, []), lambda x: len(ss) = 1 or x <> 'Unit (unspecified)'), ',') as schools,
  case when coalesce(law, false) and coalesce(other, false) then 'BOTH' when coalesce(law, false) then 'LAW' when coalesce(other, false) then 'NON-LAW' else 'UNCLASSIFIED' end as category from d
""")
def q_school_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = _people(spark, sf_dir).filter("s_acctbal > 5000")
    tagged = match.assign_schools(_orders_as_papers(spark, sf_dir), roster, [("university of o", "School of Law", "LAW")], ["this is nowhere"], "Unit (unspecified)")
    return tagged.select("paper_id", F.array_join("bu_schools", ",").alias("schools"), F.col("bu_category").alias("category"))


@query("select p_name, min(p_brand) as p_brand from part group by p_name having count(distinct p_brand) = 1")
def q_altname_unambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.unambiguous(table(spark, sf_dir, "part").select("p_name", "p_brand"), "p_name", "p_brand")


@query("""
select o_custkey, o_orderkey, n as n_candidates, n = 1 as rare from (select *, count(*) over (partition by o_custkey) as n from orders)
qualify row_number() over (partition by o_custkey order by (o_orderstatus = 'F') desc, o_totalprice desc, o_orderkey) = 1
""")
def q_resolve_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return match.resolve_best(rows, "o_custkey", F.col("o_orderstatus") == "F", F.col("o_totalprice"), "o_orderkey").select("o_custkey", "o_orderkey", "n_candidates", "rare")


@query(f"""
with {PAPERS}, t as (select doc_id, source, lang, list_filter(list_distinct(string_split({ALNUM.format('title')}, ' ')), lambda x: x <> '') as w from papers),
p as (select a.doc_id as id, b.doc_id as candidate, len(list_intersect(a.w, b.w)) / greatest(len(a.w), len(b.w)) as s, a.lang = b.lang as same
  from t a join t b on a.source = 'src1' and b.source <> 'src1' and len(a.w) > 0 and len(b.w) > 0 and len(a.w) between 0.85 * len(b.w) - 1e-9 and len(b.w) / 0.85 + 1e-9)
select id, candidate, round(s + 0.1 + case when same then 0.05 else 0 end, 6) as score from p where s >= 0.85 and same
qualify row_number() over (partition by id order by s desc, candidate) = 1
""")
def q_title_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir).select(F.col("doc_id").alias("id"), "title", F.lit(2020).alias("year"), F.array("lang").alias("surnames"), F.lit(0).alias("rank"), "source")
    return match.best_titles(rows.filter("source = 'src1'"), rows.filter("source <> 'src1'"))


_FRESH = "fresh as (select l_orderkey, cast(sum(l_quantity) as bigint) as n from lineitem group by l_orderkey)"


@query(f"""
with {_FRESH} select o_orderkey, coalesce(n, o_custkey % 120) as citation_count, coalesce(n <> o_custkey % 120, false) as changed,
case when o_custkey % 120 < 200 and n >= 200 then 200 when o_custkey % 120 < 100 and n >= 100 then 100 end as milestone from orders left join fresh on o_orderkey = l_orderkey
""")
def q_citation_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("doi"), (F.col("o_custkey") % 120).alias("citation_count"))
    fresh = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doi")).agg(F.sum("l_quantity").cast("long").alias("citation_count"))
    return maintain.refresh_citations(master, fresh, marks=(100, 200)).select("o_orderkey", "citation_count", "changed", "milestone")


@query(f"with {_FRESH} select case when n >= 200 then 200 else 100 end as milestone, count(*) as n from orders join fresh on o_orderkey = l_orderkey where (o_custkey % 120 < 100 and n >= 100) or n >= 200 group by 1")
def q_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_citation_refresh(spark, sf_dir).filter("milestone is not null").groupBy("milestone").agg(F.count(F.lit(1)).alias("n"))


@query("""
select o_orderkey, (o_orderstatus = 'P' or o_orderpriority = '1-URGENT') and o_custkey % 2 = 0 as updated,
case when (o_orderstatus = 'P' or o_orderpriority = '1-URGENT') and o_custkey % 2 = 0 then 'published' when o_orderstatus = 'P' then 'preprint' else 'other' end as publication_status,
case when (o_orderstatus = 'P' or o_orderpriority = '1-URGENT') and o_custkey % 2 = 0 then 'Journal ' || o_custkey else 'Server' end as venue from orders
""")
def q_preprint_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    status, kind = F.when(F.col("o_orderstatus") == "P", "preprint").otherwise("other"), F.when(F.col("o_orderpriority") == "1-URGENT", "posted-content").otherwise("article")
    master = orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("doi"), status.alias("publication_status"), kind.alias("publication_type"), F.lit("Server").alias("venue"))
    fresh = orders.filter("o_custkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("doi"), F.lit("journal").alias("source_type"), F.concat(F.lit("Journal "), F.col("o_custkey").cast("string")).alias("venue"))
    return maintain.update_preprints(master, fresh).select("o_orderkey", "updated", "publication_status", "venue")


@query("""
with s as (select c_mktsegment as school, c_name as name from customer where c_acctbal > 0 and c_mktsegment <> 'MACHINERY' and (c_mktsegment <> 'BUILDING' or c_acctbal > 9000)), o as (select c_mktsegment as school, c_name as name from customer),
n as (select school, count(*) as new from s group by school), m as (select school, count(*) as old from o group by school),
b as (select school from m left join n using (school) where new is null or (old > 10 and new < 0.5 * old))
select school, name from s union all select school, name from o where school in (select school from b) and lower(name) not in (select lower(name) from s)
""")
def q_roster_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("school"), F.col("c_name").alias("name"), "c_acctbal")
    scraped = old.filter("c_acctbal > 0 and school <> 'MACHINERY' and (school <> 'BUILDING' or c_acctbal > 9000)")
    return maintain.merge_roster(scraped, old).select("school", "name")


@query("""
with a as (select l_suppkey as id, count(distinct l_partkey) as n_ours from lineitem where l_returnflag = 'N' group by 1), b as (select l_suppkey as id, count(distinct l_partkey) as n_theirs from lineitem group by 1)
select id, coalesce(n_ours, 0) as n_ours, n_theirs, round(coalesce(n_ours, 0) / n_theirs, 2) as ratio from b left join a using (id) where n_theirs >= 2 and coalesce(n_ours, 0) / n_theirs <= 0.7
""")
def q_coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    works = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_partkey").cast("string").alias("work"), "l_returnflag")
    people = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return maintain.coverage_audit(people, works.filter("l_returnflag = 'N'").drop("l_returnflag"), works.drop("l_returnflag")).drop("missing")


@query(f"with {PAPERS} select doc_id from papers where source <> 'src1' and substring(regexp_replace(trim(regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')), '\\s+', ' ', 'g'), 1, 50) not in (select substring(regexp_replace(trim(regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')), '\\s+', ' ', 'g'), 1, 50) from papers where source = 'src1')")
def q_missing_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir)
    return maintain.missing_by_prefix(rows.filter("source <> 'src1'"), rows.filter("source = 'src1'")).select("doc_id")


@query("select o_orderkey, cast(row_number() over (order by o_orderkey) - 1 as int) as index from orders")
def q_reindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintain.numbered(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query("""
with p as (select c_custkey as id, translate(cast(c_custkey // 30 as varchar), '0123456789', 'klmnopqrst') as last, translate(n_name, '0123456789_ ', 'abcdefghij') as first from customer join nation on c_nationkey = n_nationkey),
q as (select s_suppkey as id, translate(cast(s_suppkey // 2 as varchar), '0123456789', 'klmnopqrst') as last, translate(n_name, '0123456789_ ', 'abcdefghij') as first from supplier join nation on s_nationkey = n_nationkey)
select p.id as l_id, q.id as r_id from p join q on p.last = q.last and (starts_with(lower(p.first), lower(q.first)) or starts_with(lower(q.first), lower(p.first)))
""")
def q_same_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    first = F.translate("n_name", "0123456789_ ", "abcdefghij")

    def letters(number: str) -> Column:  # last names that some thirty customers and two suppliers share, at any scale
        return F.translate(F.expr(f"cast({number} as string)"), "0123456789", "klmnopqrst")

    left = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == nation["n_nationkey"]).select(F.col("c_custkey").alias("id"), F.concat(first, F.lit(" "), letters("c_custkey div 30")).alias("name"))
    right = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == nation["n_nationkey"]).select(F.col("s_suppkey").alias("id"), F.concat(first, F.lit(" "), letters("s_suppkey div 2")).alias("name"))
    return match.same_person(left, right)
