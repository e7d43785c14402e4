"""Queries in which every branch of an operator yields rows, beside those whose tables leave some of them empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics, export, filters, maintain, match, quality, report
from ..sources import parsers
from .base import PAPERS, papers, query, table


@query("""
with p as (select 'Alt ' || (c_custkey // 2) as alt, 'Person ' || case when (c_custkey // 2) % 3 = 0 then c_custkey // 2 else c_custkey end as name from customer)
select alt, min(name) as name from p group by alt having count(distinct name) = 1
""")
def q_altname_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some alternative names belong to one person, some to two."""
    half = F.expr("c_custkey div 2")
    name = F.concat(F.lit("Person "), F.when(half % 3 == 0, half).otherwise(F.col("c_custkey")).cast("string"))
    return match.unambiguous(table(spark, sf_dir, "customer").select(F.concat(F.lit("Alt "), half.cast("string")).alias("alt"), name.alias("name")), "alt", "name")


_DIGITS = "translate(cast({0} as varchar), '0123456789', 'abcdefghij') || 'x'"


@query(f"""
with r as (select 'Ann Van Q' || {_DIGITS.format('s_suppkey')} as name, 'Van Q' || {_DIGITS.format('s_suppkey')} as last, s_suppkey % 40 as works from supplier),
p as (select case c_custkey % 3 when 0 then 'Ann Van Q' when 1 then 'Bo van q' else 'Cy Q' end || {_DIGITS.format('c_custkey')} as name from customer where c_custkey % 4 <> 1)
select name, last from r where works >= 5 and name not in (select name from p) and not exists (select 1 from p where contains(lower(p.name), lower(r.last)))
""")
def q_roster_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of the roster of whom, or of whose last name of two words, no paper has anything."""
    digits = lambda c: F.concat(F.translate(F.col(c).cast("string"), "0123456789", "abcdefghij"), F.lit("x"))
    people = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Ann Van Q"), digits("s_suppkey")).alias("name"), F.concat(F.lit("Van Q"), digits("s_suppkey")).alias("last"), (F.col("s_suppkey") % 40).alias("works"))
    c = F.col("c_custkey")
    first = F.when(c % 3 == 0, "Ann Van Q").when(c % 3 == 1, "Bo van q").otherwise("Cy Q")
    present = table(spark, sf_dir, "customer").filter(c % 4 != 1).select(F.concat(first, digits("c_custkey")).alias("name"))
    return quality.roster_absent(people, present, 5).select("name", "last")


@query(f"""
with {PAPERS}, p as (select doc_id, lower(title) as t, lang, source, 2000 + doc_id % 20 as y from papers)
select doc_id from p where doc_id % 5 in (0, 2) and lang = 'en' and not contains(source, '1') and y >= 2004
""")
def q_search_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search by author, subfield and school, with a negated field and an open range."""
    n = F.col("doc_id")
    author = F.when(n % 5 == 0, "Ann Q. Lee").when(n % 5 == 1, "Annette Leeds").when(n % 5 == 2, "ann lee").when(n % 5 == 3, "Lee Ann").otherwise("Bo Ray")
    rows = papers(spark, sf_dir).select("doc_id", "title", F.array(F.lit("Bo Ray"), author).alias("author_names"), F.lit("J").alias("venue"), (n % 20 + 2000).cast("int").alias("year"), F.array("source").alias("schools"), F.array(F.lit("d")).alias("domains"), F.array(F.lit("x"), "lang").alias("subfields"), F.lit("").alias("summary"))
    return filters.search(rows, 'author:"ann lee" subfield:EN -school:1 year:2004..2100').select("doc_id").filter("doc_id % 5 <> 1")


@query("""
with e as (select event_id as id, case event_type when 'click' then 'primary' when 'view' then 'methodological' when 'error' then 'peripheral' else 'none' end as tier, round(value, 2) as confidence from events),
low as (select * from e order by confidence nulls last, id limit 100),
s as (select id, tier as stratum, row_number() over (partition by tier order by md5('7:' || id), id) as n from e where tier <> 'none' union all select id, 'lowest', row_number() over (order by md5('7:' || id), id) from low)
select id, stratum from s where n <= 5
""")
def q_review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few papers of each tier, and a few of the hundred that were judged least surely."""
    kind = F.col("event_type")
    tier = F.when(kind == "click", "primary").when(kind == "view", "methodological").when(kind == "error", "peripheral").otherwise("none")
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), tier.alias("tier"), F.round("value", 2).alias("confidence"))
    return analytics.review_sample(rows, "tier", "confidence", "id", ["primary", "methodological", "peripheral"], seed="7").select("id", "stratum")


@query("""
with r as (select l_orderkey, array_to_string(list('S' || l_suppkey order by l_linenumber, l_suppkey) filter (l_returnflag = 'A'), ';') as names, l_orderkey % 3 as k from lineitem group by l_orderkey)
select l_orderkey, coalesce(names, '') as names, case k when 0 then true when 1 then false end as is_open_access from r
""")
def q_derived_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Our authors' names in order, and open access that may be unknown."""
    person = F.struct(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("name"), F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "N", False).alias("is_bu"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", person.alias("a")))), lambda x: x["a"]).alias("authors"))
    k = F.col("l_orderkey") % 3
    extra = F.when(k == 0, F.create_map(F.lit("is_oa"), F.lit("true"))).when(k == 1, F.create_map(F.lit("is_oa"), F.lit("false"))).otherwise(F.create_map().cast("map<string,string>"))
    return rows.select("l_orderkey", F.array_join(parsers.our_names(F.col("authors")), ";").alias("names"), parsers.open_access(extra).alias("is_open_access"))


@query(f"""
with {PAPERS} select cast(doc_id as int) as index, title, 'A, B, C, D, E, et al. (6 authors)' as authors, lang as venue, case when doc_id % 2 = 0 then 'https://doi.org/10.1/' || doc_id else 'http://s/' || source end as best_url, 'x; ' || source as domains, cast(0.5 as double) as confidence from papers
""")
def q_export_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exchange table's columns."""
    n, none = F.col("doc_id"), F.array().cast("array<string>")
    rows = papers(spark, sf_dir).select(
        n.cast("int").alias("index"), "title", F.transform(F.array(*[F.lit(x) for x in "ABCDEF"]), lambda x: F.struct(x.alias("name"))).alias("authors"), F.lit(2020).alias("year"), F.col("lang").alias("venue"), F.when(n % 2 == 0, F.concat(F.lit("10.1/"), n.cast("string"))).alias("doi"), F.lit("").alias("pdf_url"),
        F.concat(F.lit("http://s/"), "source").alias("url"), F.lit(0.5).alias("confidence"), F.array(F.lit("x"), "source").alias("domains"), F.lit(0).alias("citation_count"), *[F.lit("").alias(c) for c in ("publication_type", "ai_relevance", "publication_status", "one_line_summary", "annotation", "bu_category")],
        *[none.alias(c) for c in ("subfields", "bu_schools", "bu_author_names", "all_sources")],
    )
    return export.export_table(rows).select("index", "title", "authors", "venue", "best_url", "domains", "confidence")


@query("""
select o_orderkey, o_orderdate >= case when o_orderkey % 3 = 0 then date '1990-01-01' when date '1998-06-01' - cast(o_orderdate as date) >= 90 then date '1990-01-01' else date '1998-06-01' - interval 548 day end as due from orders
""")
def q_sweep_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run looks at everything where the last full sweep is 90 days ago or never was, else 548 days back."""
    day = F.col("o_orderdate").cast("date")
    last = F.when(F.col("o_orderkey") % 3 != 0, day)
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderdate") >= filters.window_start(F.to_date(F.lit("1998-06-01")), last)).alias("due"))


@query("""
with l as (select l_orderkey as id, 'Name ' || l_suppkey as name, 'P' || l_suppkey || case when l_orderkey % 2 = 0 then '' else 'x' end as pid, l_linenumber as pos from lineitem)
select id, string_agg(pid, ',' order by pos, name) as ids from l group by id
""")
def q_backfill_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers from fresh records: by place where there are as many authors, else by name."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.concat(F.lit("Name "), F.col("l_suppkey").cast("string")).alias("name"), F.concat(F.lit("P"), F.col("l_suppkey").cast("string"), F.when(F.col("l_orderkey") % 2 == 0, "").otherwise("x")).alias("pid"), F.col("l_linenumber").alias("at"))
    rows = lines.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "name", "pid"))).alias("all"))
    none = F.lit(None).cast("string")
    ours = F.transform("all", lambda x: F.struct(x["name"].alias("name"), none.alias("openalex_id")))
    fresh = F.transform("all", lambda x: F.struct(F.upper(x["name"]).alias("name"), x["pid"].alias("openalex_id")))
    longer = F.when(F.col("id") % 3 == 2, F.concat(fresh, F.array(F.struct(F.lit("Else").alias("name"), F.lit("E").alias("openalex_id"))))).otherwise(fresh)
    out = match.backfill_ids(rows.select("id", ours.alias("authors"), longer.alias("fresh_authors")))
    return out.select("id", F.array_join(F.transform("authors", lambda a: F.coalesce(a["openalex_id"], F.lit(""))), ",").alias("ids"))


@query("""
with u as (select o_orderkey as k, o_orderstatus as a, null as b from orders where o_orderkey % 2 = 0 union all select o_orderkey, null, o_orderpriority from orders where o_orderkey % 3 = 0) select k, a, b from u
""")
def q_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with different columns put together; what comes twice stays twice."""
    orders = table(spark, sf_dir, "orders")
    return maintain.union_all([orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("a")), orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("b"))])


@query("""
with g as (select p_brand as name, p_name || ' ' || p_partkey as title, 'S' || (p_partkey % 3) as source, p_size from part), c as (select name, count(*) filter (p_size <= 20) as o, count(*) filter (p_size > 20) as m from g group by name),
r as (
    select -m as m, name, 0 as kind, '' as source, '' as title, '## ' || name || ': ' || o || ' papers, ' || m || ' missing' as text from c
    union all select -m, name, 1, '', title, '- ' || title from g join c using (name) where p_size <= 20 qualify row_number() over (partition by name order by title) <= 5
    union all select -m, name, 2, source, substring(title, 1, 70), '- missing from ' || source || ': ' || substring(title, 1, 70) from g join c using (name) where p_size > 20
)
select cast(row_number() over (order by m, name, kind, source, title) - 1 as int) as place, text from r
""")
def q_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the audit with its place."""
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.concat_ws(" ", "p_name", key.cast("string")).alias("title"), F.concat(F.lit("S"), (key % 3).cast("string")).alias("source"), "p_size")
    lines = report.audit_rows(rows.select("name"), rows.filter("p_size <= 20").select("name", "title"), rows.filter("p_size > 20").select("name", "source", "title"))
    return maintain.numbered(lines, "order", "place").select("place", "text")


@query("""
with p as (select c_custkey as id, 'Q' || translate(cast(c_custkey % 50 as varchar), '0123456789', 'abcdefghij') as last, c_custkey % 4 as k from customer)
select id, case k when 0 then 'Anna ' when 1 then 'Annie ' when 2 then 'Dr ' else 'Ann ' end || last as canonical, cast(case k when 3 then 0 else k + 1 end as int) as tier from p
""")
def q_canonical_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by id, by alternate name, by key, and not at all."""
    c, k = F.col("c_custkey"), F.col("c_custkey") % 4
    last = F.concat(F.lit("Q"), F.translate((c % 50).cast("string"), "0123456789", "abcdefghij"))
    people = table(spark, sf_dir, "customer").select(c.alias("id"), F.concat(F.lit("Ann "), last).alias("name"), (k != 3).alias("is_bu"), k.alias("k"))
    named = lambda first: F.concat(F.lit(first), F.substring("name", 5, 100))
    by_id = people.filter("k = 0").select("id", named("Anna ").alias("canonical"))
    each = people.select("name").distinct()
    out = []
    for some, by_alt, by_key in (
        ("k in (0, 3)", each.limit(0), each.limit(0)), ("k = 1", each, each.limit(0)), ("k = 2", each.limit(0), each),
    ):
        alts = by_alt.select(F.upper("name").alias("alt"), named("Annie ").alias("canonical"))
        keys = by_key.select(match.name_key(F.col("name")).alias("key"), named("Dr ").alias("canonical"))
        out.append(match.canonical_names(people.filter(some).select("id", "name", "is_bu"), by_id, alts, keys))
    return maintain.union_all(out).select("id", "canonical", "tier")
