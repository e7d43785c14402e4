"""Queries of counts for publication, reports and checks of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, text as T
from ..operators import analytics, filters, maintain, quality, report
from .base import PAPERS, papers, query, table

# Parts as papers of schools, in both forms.
_PARTS = """p as (select p_partkey, p_name as title, string_split(p_name, ' ') as schools, case p_size % 4 when 0 then 'LAW' when 1 then 'NON-LAW' when 2 then 'BOTH' end as cat, p_type as kind, p_brand as rel, p_size % 2 = 0 as ours,
1990 + p_size as year, p_partkey % 500 as cites, case when p_size % 3 = 0 then ['openalex', 'dblp'] when p_size % 3 = 1 then ['elsewhere'] else [] end as sources from part)"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    kind = F.when(size % 4 == 0, "LAW").when(size % 4 == 1, "NON-LAW").when(size % 4 == 2, "BOTH")
    sources = F.when(size % 3 == 0, F.array(F.lit("openalex"), F.lit("dblp"))).when(size % 3 == 1, F.array(F.lit("elsewhere"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("title"), F.split("p_name", " ").alias("bu_schools"), kind.alias("bu_category"), F.col("p_type").alias("publication_type"), F.col("p_brand").alias("ai_relevance"), F.array("p_type").alias("domains"), F.array("p_brand").alias("subfields"),
        (F.lit(1990) + size).alias("year"), (F.col("p_partkey") % 500).alias("citation_count"), F.array(F.struct(F.col("p_brand").alias("name"), (size % 2 == 0).alias("is_bu"))).alias("authors"), sources.alias("all_sources"), size.alias("size"),
    )


@query(f"with {_PARTS}, e as (select unnest(schools) as school, cat as category from p) select school, category, count(*) as n from e group by 1, 2")
def q_school_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.cross_counts(_parts(spark, sf_dir), "bu_schools", "bu_category")


@query(f"with {_PARTS}, e as (select unnest(case when cat is null then ['Unknown'] when cat = 'BOTH' then [] else schools end) as school from p) select school, count(*) as n from e group by 1")
def q_new_by_school(spark: SparkSession, sf_dir: str) -> DataFrame:
    schools = F.when(F.col("bu_category") == "BOTH", F.array().cast("array<string>")).when(F.col("bu_category").isNotNull(), F.col("bu_schools"))
    return analytics.new_by_value(_parts(spark, sf_dir).withColumn("s", schools), "s")


@query(f"""
with {_PARTS}, s as (select unnest(schools) as school from p), m as (select unnest(sources) as source from p)
select 'papers' as what, '' as label, count(*) as n from p union all select 'schools', '', count(distinct school) from s where school <> '' and not contains(lower(school), 'unspecified')
union all select 'roster', '', count(*) from supplier union all select 'with_id', '', count(*) from supplier where s_acctbal > 0
union all select 'mentions', case source when 'openalex' then 'OpenAlex' when 'dblp' then 'DBLP' else source end, count(*) from m group by 2
""")
def q_publication_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = table(spark, sf_dir, "supplier").select(F.when(F.col("s_acctbal") > 0, F.col("s_name")).otherwise("").alias("openalex_id"))
    return analytics.publication_counts(_parts(spark, sf_dir), roster)


_PLACES = ["Computer Science and Law", "School of Law", "ECE", "Medical School", "SPH", "Questrom", "Physics", "History"]


@query("""
select case c_nationkey % 8 when 0 then 'CS' when 1 then 'Law' when 2 then 'Engineering' when 3 then 'Medicine' when 4 then 'SPH' when 5 then 'Questrom' when 6 then 'CS' end as department, count(*) as n
from customer where c_nationkey % 8 <> 7 group by 1
""")
def q_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.get(F.array(*[F.lit(p) for p in _PLACES]), F.col("c_nationkey") % 8)
    return analytics.departments(table(spark, sf_dir, "customer").select(place.alias("affiliation")))


@query(f"with {_PARTS} select count(*) as n, count(*) filter (where len(sources) > 0) as multi_source from p")
def q_several_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.several_sources(_parts(spark, sf_dir))


@query('select event_type as source, count(*) as raw, count(*) filter (where value > 50) as "new", count(*) filter (where not coalesce(value > 50, false)) as dupes from events group by 1')
def q_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").withColumnRenamed("event_type", "source")
    return analytics.source_counts(raw, raw.filter("value > 50"))


def _top(section: str, values: str, most: int) -> str:
    return f"select '{section}' as section, value, n, null as pct from (select {values} as value, count(*) as n from p group by 1 order by n desc, value limit {most})"


@query(f"""
with {_PARTS}, t as (select count(*) as total from p), c as (select c.value, count(p.p_partkey) as n from (select unnest(['LAW', 'NON-LAW', 'BOTH', 'UNCLASSIFIED']) as value) c left join p on coalesce(p.cat, 'UNCLASSIFIED') = c.value group by 1),
s as (select unnest(schools) as value from p)
select 'category' as section, value, n, round(n * 100.0 / total, 1) as pct from c, t
union all select 'school', value, count(*), null from s group by value
union all {_top('type', 'kind', 15)}
union all select 'relevance', rel, count(*), round(count(*) * 100.0 / any_value(total), 1) from p, t group by rel
union all {_top('domain', 'kind', 20)}
union all {_top('subfield', 'rel', 20)}
union all select 'year', cast(year as varchar), n, null from (select year, count(*) as n from p group by 1 order by year desc limit 15)
union all select 'cited', title, cites, null from (select title, cites from p where cites > 0 order by cites desc, title limit 20)
union all select 'author', value, n, null from (select rel as value, count(*) as n from p where ours group by 1 order by n desc, value limit 30)
""")
def q_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.statistics(_parts(spark, sf_dir))


@query("""
with g as (select p_brand as name, p_partkey as k, p_name as title, p_size from part), o as (select name, count(*) as n_ours from g where p_size <= 20 group by 1), m as (select name, count(*) as n_missing from g where p_size > 20 group by 1)
select name, coalesce(n_ours, 0) as n_ours, coalesce(n_missing, 0) as n_missing, coalesce(least(n_ours, 5), 0) as shown from o full join m using (name)
""")
def q_audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_name").alias("title"), F.lit("index").alias("source"), "p_size")
    lines = report.audit_lines(rows.select("name"), rows.filter("p_size <= 20"), rows.filter("p_size > 20"))
    return lines.select("name", "n_ours", "n_missing", F.coalesce(F.size("titles"), F.lit(0)).cast("long").alias("shown"))


@query("""
with r as (select (c_custkey % 300) * 2 as added, 0.02 * (c_custkey % 600) as cost, c_nationkey % 4 as zero from customer), s as (select s_name as source, s_nationkey % 5 as f from supplier)
select case when added > 500 or cost > 10 then 'FAIL' else 'WARN' end as level, 'run' as check_name, added || ' added' as message from r where added > 200 or cost > 5
union all select 'FAIL', 'idle', 'nothing new for ' || (zero + 1) || ' weeks' from r where added = 0 and zero >= 2
union all select 'FAIL', 'source', source || ' failed ' || f || ' runs' from s where f >= 3
""")
def q_run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "customer").select(((F.col("c_custkey") % 300) * 2).alias("added"), (F.lit(0.02) * (F.col("c_custkey") % 600)).alias("cost"), (F.col("c_nationkey") % 4).alias("zero_weeks"))
    return quality.run_alerts(runs, table(spark, sf_dir, "supplier").select(F.col("s_name").alias("source"), (F.col("s_nationkey") % 5).alias("consecutive_failures")))


@query("""
with fresh as (select l_orderkey, cast(sum(l_quantity) as bigint) as n, bool_or(l_returnflag = 'R') as oa from lineitem group by l_orderkey),
m as (select o_orderkey, year(o_orderdate) >= 1996 as due, o_custkey % 120 as old, n, oa from orders left join fresh on o_orderkey = l_orderkey)
select o_orderkey, case when due then coalesce(n, old) else old end as citation_count, coalesce(due and n <> old, false) as changed, case when due then coalesce(oa, false) else false end as is_open_access from m
""")
def q_citation_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("doi"), (F.col("o_custkey") % 120).alias("citation_count"), F.year("o_orderdate").alias("year"), F.lit(False).alias("is_open_access"))
    fresh = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doi")).agg(F.sum("l_quantity").cast("long").alias("citation_count"), F.bool_or(F.col("l_returnflag") == "R").alias("is_open_access"))
    return maintain.refresh_citations(master, fresh, since=1996, open_access="is_open_access").select("o_orderkey", "citation_count", "changed", "is_open_access")


@query(f"with {PAPERS} select doc_id as confidence, substring(coalesce(title, ''), 1, 100) as title, substring(coalesce(text, ''), 1, 200) as abstract, lang as relevance, '' as summary, source as schools from papers")
def q_sample_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir).select("title", F.col("text").alias("abstract"), F.col("lang").alias("ai_relevance"), F.col("doc_id").alias("confidence"), F.lit(None).cast("string").alias("one_line_summary"), F.array("source").alias("bu_schools"))
    return maintain.sample_view(rows).withColumn("schools", F.array_join("schools", ";"))


@query("select p_partkey, case when p_size % 2 = 0 then p_type || ';' else '' end || p_size || ';' || p_size as concepts from part")
def q_flat_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    none, size = F.lit(None).cast("string"), F.col("p_size").cast("string")
    nested = F.array(F.array(F.when(F.col("p_size") % 2 == 0, F.col("p_type")), none), F.lit(None).cast("array<string>"), F.array(size, none, size))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(arrays.flat_texts(nested), ";").alias("concepts"))


@query("select p_partkey, array_to_string(list_sort(list_distinct(string_split(p_name || ' ' || p_type, ' '))), ';') as words from part")
def q_sorted_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(arrays.sorted_unique(F.split(F.concat_ws(" ", "p_name", "p_type"), " ")), ";").alias("words"))


@query("select o_orderpriority as kind, format('{:,}', count(*)) as n, case when count(*) > 0 then round(count(*) filter (where o_orderstatus = 'F') * 100.0 / count(*), 1) else 0.0 end as pct from orders group by 1")
def q_shown_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("kind")).agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("o_orderstatus") == "F").alias("part"))
    return rows.select("kind", T.thousands(F.col("all")).alias("n"), T.percent(F.col("part"), F.col("all")).alias("pct"))


@query("select doc_id from documents where lang = 'en' or source is null")
def q_needs_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.col("lang") == "en").alias("needs_model"), F.when(F.col("source").isNotNull(), "x").alias("ai_relevance"))
    return filters.needs_classification(rows).select("doc_id")


@query("select case when p_size % 3 = 0 then 'rejected' else 'kept' end as part, count(*) as n from part where p_size % 5 <> 0 group by 1")
def q_split_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 3 == 0, "not_relevant").when(F.col("p_size") % 3 == 1, "primary").alias("ai_relevance"), (F.col("p_size") % 5 == 0).alias("parse_error"))
    kept, rejected = filters.split_relevance(rows)
    return kept.select(F.lit("kept").alias("part")).unionByName(rejected.select(F.lit("rejected").alias("part"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("select p_partkey from part where p_type in ('ECONOMY', 'STANDARD') and (p_size % 3 = 0 or p_size % 3 = 1)")
def q_needs_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    venue = F.when(F.col("p_size") % 3 == 0, F.lit(None).cast("string")).when(F.col("p_size") % 3 == 1, "Pre-Print Server").otherwise("Journal")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.array("p_type").alias("all_sources"), venue.alias("venue"))
    return filters.needs_venue(rows, ["ECONOMY", "STANDARD"], ["pre print server"]).select("p_partkey")


@query("select c_custkey, c_nationkey < 3 as ambiguous from customer where c_custkey % 2 = 0 union all select c_custkey, false from customer where c_custkey % 2 = 1")
def q_ambiguous_surname(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.concat(F.lit("fam"), F.char(F.col("c_nationkey") + 97))
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat_ws(" ", F.lit("ann"), last)).otherwise(F.concat_ws(" ", F.lit("ann b"), last))
    return table(spark, sf_dir, "customer").select("c_custkey", filters.ambiguous_surname(name, ["fama", "famb", "famc"]).alias("ambiguous"))


@query("select p_partkey, 1990 + p_size as year, row_number() over (order by p_size desc, p_partkey % 500 desc, p_partkey) as place from part qualify place <= 50")
def q_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = analytics.newest_first(_parts(spark, sf_dir), order="p_partkey").limit(50)
    return ordered.select("p_partkey", "year", (F.monotonically_increasing_id() + 1).alias("place"))
