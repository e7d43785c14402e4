"""Queries of counts, shares, trends, samples and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import analytics as A
from ..operators import quality as Q
from .base import query, table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))


@query("select value, count(*) as n from (select unnest(string_split(p_type, ' ')) as value from part) group by value")
def q_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.count_values(table(spark, sf_dir, "part").select(F.split("p_type", " ").alias("v")), "v")


@query("select cast(year(o_orderdate) as int) as year, count(*) as n from orders group by 1")
def q_year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.per_year(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")))


@query("select cast(year(o_orderdate) // 10 * 10 as int) as decade, count(*) as n from orders group by 1")
def q_decade_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.per_decade(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")))


@query("select o_orderpriority as value, count(*) as n, round(count(*) * 100.0 / (select count(*) from orders), 6) as pct from orders group by 1")
def q_category_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.share(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("select value, count(*) as n from (select source as value from documents) group by value order by n desc, value limit 10")
def q_top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top(A.count_values(table(spark, sf_dir, "documents").select(F.array("source").alias("v")), "v"), 10)


@query("""
with p as (select distinct l_orderkey, p_brand from lineitem join part on l_partkey = p_partkey where p_brand <> 'Brand#11')
select a.p_brand as a, b.p_brand as b, count(*) as n from p a join p b on a.l_orderkey = b.l_orderkey and a.p_brand < b.p_brand group by 1, 2
""")
def q_pair_collab(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    brands = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == part["p_partkey"]).groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("v"))
    return A.pairs(brands, "v", ["Brand#11"])


@query("select cast(l_suppkey as varchar) as name, count(*) as n from lineitem where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 5000) group by 1 having count(*) >= 5")
def q_new_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.array(F.col("l_suppkey").cast("string")).alias("v"))
    return A.new_names(rows, "v", table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(F.col("s_suppkey").cast("string").alias("name")))


@query("""
with e as (select lang, source, count(*) as n from documents group by 1, 2)
select lang, cast(sum(n) as bigint) as n, first(source order by n desc, source) as top, round(max(n) / sum(n), 6) as share, max(n) / sum(n) > 0.3 as flagged from e group by lang having sum(n) >= 20
""")
def q_source_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dominance(table(spark, sf_dir, "documents"), "lang", "source", most=0.3)


@query("""
with v as (select user_id, event_type, count(*) as votes, min(event_id) as f from events where event_type <> 'view' group by 1, 2), a as (select user_id, count(*) as total from events group by 1)
select user_id, event_type, votes from v join a using (user_id) where true qualify row_number() over (partition by user_id order by votes desc, f) = 1
""")
def q_majority_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").filter("event_type <> 'view'")
    votes = rows.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("votes"), F.min("event_id").alias("_f"))
    from ..operators.dedup import windowed_first

    return windowed_first(votes, ["user_id"], [F.desc("votes"), "_f"]).drop("_f")


@query("""
with v as (select user_id, event_type, count(*) as votes, min(event_id) as f from events where event_type <> 'view' group by 1, 2), a as (select user_id, count(*) as total from events group by 1),
b as (select user_id, event_type, votes, total from v join a using (user_id) where true qualify row_number() over (partition by user_id order by votes desc, f) = 1)
select user_id, event_type, votes from b where votes >= 2 or total <= 2
""")
def q_majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.majority(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id", "view")


@query("""
with w as (select strftime(ts, '%Y-%m') || '-W' || ((day(ts) - 1) // 7 + 1) as week, cast(count(*) as bigint) as added from events group by 1)
select week, added, case when added = 0 then '·' else repeat('█', cast(added * 30 // (select max(added) from w) as int)) end as bar from w
""")
def q_week_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.week_histogram(_events(spark, sf_dir).withColumn("one", F.lit(1)), "day", "one")


@query("""
with d as (select distinct user_id, cast(day(ts) as int) as day from events), r as (select user_id, unnest(generate_series(min(day), max(day))) as day from d group by user_id)
select user_id, cast(day as int) as day from r where (user_id, day) not in (select (user_id, day) from d)
""")
def q_year_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.gaps(table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").alias("day")), "user_id", "day")


@query("""
with c as (select event_type, cast(day(ts) as int) as run_no, count(*) as n from events group by 1, 2)
select event_type, run_no, n, round(avg(n) over w, 6) as avg_before, coalesce(n < 0.1 * round(avg(n) over w, 6) and round(avg(n) over w, 6) > 10, false) as degraded from c window w as (partition by event_type order by run_no rows between 5 preceding and 1 preceding)
""")
def q_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").groupBy("event_type", F.dayofmonth("ts").alias("run_no")).agg(F.count(F.lit(1)).alias("n"))
    return A.source_health(runs, "event_type").select("event_type", "run_no", "n", "avg_before", "degraded")


@query("""
with c as (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2), m as (select *, lag(n) over w as b, lead(n) over w as a, row_number() over w as i from c window w as (partition by event_type order by day))
select event_type, cast(day as varchar) as day, n from m where n < 60 and b > 60 and a > 60 and i > 2
""")
def q_neighbor_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _events(spark, sf_dir).groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n"))
    return A.dips(counts, "event_type", "day", few=60, many=60).select("event_type", F.col("day").cast("string").alias("day"), "n")


@query("""
with c as (select conv_id, turn, coalesce(sum(cast(length(text) // 4 as double) * 0.01) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0.0) as b from conversations)
select conv_id, turn, round(b, 6) as cost_before from c where b < 1.0
""")
def q_cost_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.under_cap(table(spark, sf_dir, "conversations"), "conv_id", "turn", T.tokens(F.col("text")) * 0.01, 1.0).select("conv_id", "turn", "cost_before")


@query("""
with a as (select user_id, count(*) as n_before from events where day(ts) <= 15 group by 1), b as (select user_id, count(*) as n_after from events where day(ts) > 15 group by 1),
m as (select user_id, coalesce(n_before, 0) as n_before, n_after from b left join a using (user_id))
select user_id, n_before, n_after, case when n_before > 0 then 'growth' else 'new' end as trend, case when n_before > 0 then cast(floor((n_after / n_before - 1) * 100 + 0.5) as bigint) end as growth_pct from m where (n_before > 0 and n_after > 1.5 * n_before) or (n_before = 0 and n_after >= 3)
""")
def q_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = lambda c: table(spark, sf_dir, "events").filter(c).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return A.trends(counted(F.dayofmonth("ts") <= 15), counted(F.dayofmonth("ts") > 15), "user_id", fresh=3)


@query("select o_orderkey, o_totalprice from orders where o_totalprice > 0 order by o_totalprice desc, o_orderkey limit 20")
def q_top_cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.most_cited(table(spark, sf_dir, "orders"), 20, "o_totalprice", "o_orderkey").select("o_orderkey", "o_totalprice")


@query("select lang, doc_id from documents qualify row_number() over (partition by lang order by md5('7:' || doc_id), doc_id) <= 5")
def q_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.stratified_sample(table(spark, sf_dir, "documents"), "lang", "doc_id", 5, "7").select("lang", "doc_id")


@query("select doc_id from documents order by md5('3:' || doc_id), doc_id limit 100")
def q_seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.sample(table(spark, sf_dir, "documents"), "doc_id", 100, "3").select("doc_id")


@query("select c_custkey, count(*) over (partition by c_nationkey) <= 3 as rare from customer")
def q_surname_rarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.surname_rarity(table(spark, sf_dir, "customer"), "c_nationkey").select("c_custkey", "rare")


@query("select c_mktsegment, count(*) as n, count(*) filter (where c_acctbal > 0) as matched, round(count(*) filter (where c_acctbal > 0) / count(*), 6) as rate from customer group by 1")
def q_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.match_rate(table(spark, sf_dir, "customer"), "c_mktsegment", F.col("c_acctbal") > 0)


@query("select count(*) as n, count(*) filter (where role not in ('system')) as n_relevant, cast(sum(length(text) // 4) as bigint) as tokens_in, cast(sum(length(text) // 8) as bigint) as tokens_out, round(sum(length(text) // 4) / 1e6 * 3 + sum(length(text) // 8) / 1e6 * 15, 6) as cost from conversations")
def q_cost_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.when(F.col("role") == "system", "not_relevant").otherwise("primary")
    rows = table(spark, sf_dir, "conversations").select(tier.alias("ai_relevance"), F.floor(F.length("text") / 4).alias("input_tokens"), F.floor(F.length("text") / 8).alias("output_tokens"))
    return A.cost_totals(rows)


@query("select count(*) as n, count(*) filter (where lang = 'de') as no_lang, count(*) filter (where source = 'src1') as no_source from documents")
def q_coverage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.when(F.col("lang") == "de", "").otherwise(F.col("lang")).alias("lang"), F.when(F.col("source") != "src1", F.col("source")).alias("source"))
    return A.nullish(rows, ["lang", "source"])


@query("""
with i as (select o_custkey, count(*) as n from orders group by 1) select c_custkey as id, coalesce(n, 0) as n from customer left join i on c_custkey = o_custkey where coalesce(n, 0) < 3
""")
def q_coverage_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    works = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("author_id"), F.lit("").alias("author_name"))
    return A.coverage_gap(people, works).select(F.col("id").cast("long").alias("id"), "n")


@query("select l_suppkey, count(distinct l_partkey) as n from lineitem group by 1")
def q_distinct_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("d"), F.col("l_partkey").cast("string"))).otherwise("").alias("doi"), F.concat(F.lit("f"), F.col("l_partkey").cast("string")).alias("fp"))
    return A.distinct_works(rows, "l_suppkey")


def _expected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    expected = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), (F.col("n_regionkey") * 3).alias("least"))
    counts = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return expected, counts


@query("""
with c as (select s_nationkey, count(*) as n from supplier group by 1), m as (select n_nationkey, n_regionkey * 3 as least, coalesce(n, 0) as n from nation left join c on n_nationkey = s_nationkey)
select case when n = 0 then 'FAIL' else 'WARN' end as level, 'anchor' as check_name, n_nationkey || ': ' || n || ' of ' || least as message from m where n = 0 or n < least
""")
def q_dq_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.anchors(*_expected(spark, sf_dir))


@query("""
with c as (select s_nationkey, count(*) as n from supplier group by 1) select 'FAIL' as level, 'minimum' as check_name, n_nationkey || ': ' || coalesce(n, 0) || ' under ' || n_regionkey * 3 as message from nation left join c on n_nationkey = s_nationkey where coalesce(n, 0) < n_regionkey * 3
""")
def q_dq_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.minimum(*_expected(spark, sf_dir))


@query("""
with o as (select l_orderkey, list_sort(list(distinct l_suppkey) filter (where l_returnflag = 'A')) as f, list_sort(list(distinct l_suppkey) filter (where l_linestatus = 'F')) as n from lineitem group by 1),
c as (select count(*) filter (where f is null) as a, count(*) filter (where coalesce(f, []) <> coalesce(n, [])) as b, count(*) filter (where n is null) as c from o)
select 'FAIL' as level, 'no_author' as check_name, cast(a as varchar) as message from c where a > 0 union all select 'FAIL', 'names_differ', cast(b as varchar) from c where b > 0 union all select 'WARN', 'no_school', cast(c as varchar) from c where c > 0
""")
def q_dq_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("l_suppkey").cast("string")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_returnflag") == "A", name)).alias("flagged"), F.collect_set(F.when(F.col("l_linestatus") == "F", name)).alias("listed"))
    return Q.consistency(rows, "flagged", "listed", "listed")


@query("""
with r as (select p_name as name, split_part(p_name, ' ', -1) as last, p_size from part where p_size >= 20), p as (select p_name as name from part where p_size < 10)
select name, last from r where name not in (select name from p) and not (length(last) > 3 and exists (select 1 from p where contains(lower(p.name), lower(r.last))))
""")
def q_dq_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    roster = part.select(F.col("p_name").alias("name"), F.element_at(F.split("p_name", " "), -1).alias("last"), F.col("p_size").alias("works"))
    return Q.roster_absent(roster, part.filter("p_size < 10").select(F.col("p_name").alias("name")), 20).select("name", "last")


@query("select 'WARN' as level, 'prolific' as check_name, l_suppkey || ': ' || count(*) as message from lineitem group by l_suppkey having count(*) > 610")
def q_dq_suspicious(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.array(F.col("l_suppkey").cast("string")).alias("names"), F.array("l_partkey").alias("authors"))
    return Q.suspicious(rows, "names", most=610)


@query("select 'FAIL' as level, 'dropped' as check_name, (select count(*) from orders) || ' to ' || count(*) as message from orders where o_orderstatus <> 'P' having count(*) < (select count(*) from orders) - 5")
def q_dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return Q.gate(orders, orders.filter("o_orderstatus <> 'P'"))
