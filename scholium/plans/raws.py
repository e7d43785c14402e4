"""Queries of the source parsers: raw records of each source, built from the tables as JSON of its shape, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources import parsers
from .base import query, table

ROR = "https://ror.org/ours"


def _landed(rows: DataFrame, schema: str, **fields: Column) -> DataFrame:
    """Raw records as they are read from a landed line: fields that are null are absent.

    A line is read once, as a generator's row: filters would otherwise be moved before the reading, and each read the line again.
    """
    named = F.struct(*[c.alias(n) for n, c in fields.items()])
    return rows.select(F.inline(F.array(F.from_json(F.to_json(named), schema))))


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _with(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(prefix), _text(c))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their suppliers in order of line."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))), lambda x: x["l_suppkey"]).alias("sup"))
    return table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))


_LINES = "o as (select o.*, sup from orders o join (select l_orderkey, list(l_suppkey order by l_linenumber, l_suppkey) as sup from lineitem group by l_orderkey) l on o_orderkey = l_orderkey)"


def _works(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    unit = lambda name, ror: F.struct(name.alias("display_name"), ror.alias("ror"))
    person = F.transform("sup", lambda s: F.struct(
        F.struct(_with("A", s).alias("id"), _with("Person ", s).alias("display_name")).alias("author"),
        F.when(s % 4 == 0, F.array().cast("array<struct<display_name:string,ror:string>>")).otherwise(F.array(unit(_with("U", s % 3), F.when(s % 3 == 0, ROR).otherwise("else")), unit(F.lit("V"), F.when(s % 5 == 0, ROR)))).alias("institutions"),
    ))
    return _landed(
        _orders(spark, sf_dir), schemas.OPENALEX, id=_with("W", n), title=F.when(n % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("Work <i>"), _text(n), F.lit("</i>"))), doi=F.when(n % 4 != 0, _with("https://doi.org/10.1/X", n)), publication_year=F.year("o_orderdate"),
        type=F.lit("article"), cited_by_count=F.col("o_custkey"), authorships=person, concepts=F.array(F.struct(F.col("o_orderstatus").alias("display_name"))), topics=F.array(F.struct(F.col("o_orderpriority").alias("display_name"))),
        abstract_inverted_index=F.create_map(F.lit("we"), F.array(F.lit(0), F.lit(2)), _with("go", n % 7), F.array(F.lit(1)), F.when(n % 6 == 0, "robotics").otherwise("home"), F.array(F.lit(3))), open_access=F.struct((n % 2 == 0).alias("is_oa"), F.when(n % 5 == 0, _with("http://p/", n)).alias("oa_url")),
        primary_location=F.struct(F.when(n % 3 != 0, _with("http://l/", n)).alias("landing_page_url"), F.struct(_with("J ", "o_orderpriority").alias("display_name")).alias("source")),
    )


_OURS = "(s % 4 <> 0 and (s % 3 = 0 or s % 5 = 0))"


@query(f"""
with {_LINES}
select 'W' || o_orderkey as source_id, 'Work ' || o_orderkey as title, case when o_orderkey % 4 <> 0 then '10.1/x' || o_orderkey end as doi, cast(year(o_orderdate) as int) as year, 'we go' || (o_orderkey % 7) || ' we ' || case when o_orderkey % 6 = 0 then 'robotics' else 'home' end as abstract,
    array_to_string(list_transform(sup, lambda s: 'A' || s || ':' || case when s % 4 = 0 then '' else 'U' || (s % 3) || '; V' end || case when {_OURS} then '*' else '' end), ',') as people, 'J ' || o_orderpriority as venue, o_orderstatus || ',' || o_orderpriority as concepts, o_custkey as citations,
    case when o_orderkey % 3 <> 0 then 'http://l/' || o_orderkey else 'W' || o_orderkey end as url, case when o_orderkey % 5 = 0 then 'http://p/' || o_orderkey end as pdf_url, cast(o_orderkey % 2 = 0 as varchar) as is_oa from o where o_orderkey % 10 <> 0
""")
def q_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsers.openalex(_works(spark, sf_dir), ROR)
    people = F.array_join(F.transform("authors", lambda a: F.concat(a["openalex_id"], F.lit(":"), a["affiliation"], F.when(a["is_bu"], "*").otherwise(""))), ",")
    return rows.select("source_id", "title", "doi", "year", "abstract", people.alias("people"), "venue", F.array_join("concepts", ",").alias("concepts"), F.col("citation_count").cast("long").alias("citations"), "url", "pdf_url", F.col("extra")["is_oa"].alias("is_oa"))


@query("select 'W' || o_orderkey as source_id from orders where o_orderkey % 10 <> 0 and o_orderkey in (select l_orderkey from lineitem) and (o_orderstatus = 'F' or o_orderpriority = '5-LOW')")
def q_concept_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsers.concept_sweep(parsers.openalex(_works(spark, sf_dir), ROR), ["F", "5-LOW"]).select("source_id")


@query("""
select l_partkey as source_id, 'k' || l_suppkey as matched_keyword from (select distinct l_partkey, l_suppkey from lineitem) qualify row_number() over (partition by l_partkey order by l_suppkey) = 1
""")
def q_keyword_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("keyword_order"), _with("k", "l_suppkey").alias("keyword"), F.col("l_partkey").alias("source_id")).distinct()
    return parsers.keyword_sweep(hits).select("source_id", "matched_keyword")


@query(f"""
with {_LINES}, w as (select *, list_filter(sup, lambda s: {_OURS}) as mine from o where o_orderkey % 10 <> 0 and o_orderkey % 4 <> 1),
k as (select * from w where o_orderkey % 6 = 0 and len(mine) > 0)
select 'W' || o_orderkey as source_id, array_to_string(list_transform(sup, lambda s: case when s % 4 = 0 then '' else 'U' || (s % 3) end), ',') as affiliations, array_to_string(list_transform(mine, lambda s: 'Person ' || s), ',') as ours from k
""")
def q_institution_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works that the master (every fourth order and one) lacks, on the subject, by an author of ours."""
    master = table(spark, sf_dir, "orders").filter("o_orderkey % 4 = 1").select(_with("10.1/x", "o_orderkey").alias("doi"))
    rows = parsers.institution_sweep(_works(spark, sf_dir), ROR, master, ["robotics", "no such"])
    return rows.select("source_id", F.array_join(F.transform("authors", lambda a: a["affiliation"]), ",").alias("affiliations"), F.array_join(parsers.our_names(F.col("authors")), ",").alias("ours"))


@query("""
select 'W' || o_orderkey as source_id from orders where o_orderkey % 10 <> 0 and o_orderkey in (select l_orderkey from lineitem) and o_orderpriority = '1-URGENT' and o_orderkey % 6 = 0 and o_orderkey % 4 <> 1 and o_orderdate >= date '1996-01-01'
""")
def q_source_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works of one source on the subject that the master lacks."""
    works = _works(spark, sf_dir)
    master = table(spark, sf_dir, "orders").filter("o_orderkey % 4 = 1").select(_with("10.1/x", "o_orderkey").alias("doi"))
    return parsers.source_papers(works, ROR, F.col("primary_location.source.display_name") == "J 1-URGENT", master, ["robotics"], since=1996).select("source_id")


@query(f"""
with {_LINES}, e as (select o_orderkey, o_custkey, unnest(sup) as s from o where o_orderkey % 10 <> 0), w as (select distinct o_orderkey, o_custkey, s % 3 as i from e where s % 4 <> 0)
select 'I' || i as id, count(*) as works, cast(sum(o_custkey) as bigint) as citations, any_value(authors) as authors from w join (select s % 3 as i, count(distinct s) as authors from e where s % 4 <> 0 group by 1) using (i) group by i
""")
def q_institution_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = _orders(spark, sf_dir).filter("o_orderkey % 10 <> 0").select(_with("W", "o_orderkey").alias("source_id"), F.col("o_custkey").alias("citation_count"), F.explode("sup").alias("s")).filter("s % 4 <> 0")
    rows = each.select("source_id", "citation_count", _with("I", F.col("s") % 3).alias("institution"), _with("A", "s").alias("author"))
    return parsers.institution_profiles(rows)


@query("""
with r as (select o_orderkey, case o_orderkey % 3 when 0 then '10.2139/' when 1 then '10.1101/' else '10.5/' end || o_orderkey as doi, 'Title ' || o_orderkey as title, cast(case when o_orderkey % 2 = 0 then year(o_orderdate) when o_orderkey % 5 = 0 then 2001 else 2002 end as int) as year,
    'Ann C' || (o_custkey % 9) as name, o_custkey % 9 = 4 as ours, o_custkey as cites from orders where o_orderkey % 7 <> 0)
select 'crossref' as source, doi, title, year, name, ours, 'J' as venue, 'text' as abstract, cites as citations from r where o_orderkey % 3 <> 0
union all select 'ssrn', doi, title, year, name, ours, 'SSRN Electronic Journal', 'text', cites from r where o_orderkey % 3 = 0
union all select 'biorxiv_medrxiv', doi, title, year, name, ours, case when o_orderkey % 4 = 1 then 'medRxiv' else 'bioRxiv' end, 'text', cites from r where o_orderkey % 3 = 1
""")
def q_registered_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One register of works read as three sources."""
    n = F.col("o_orderkey")
    dated = lambda year: F.struct(F.array(F.array(year, F.lit(3))).alias("date-parts"))
    prefix = F.when(n % 3 == 0, "10.2139/").when(n % 3 == 1, "10.1101/").otherwise("10.5/")
    unit = F.when(F.col("o_custkey") % 9 == 4, "Dept, Ours University").otherwise("Elsewhere")
    raw = _landed(
        table(spark, sf_dir, "orders"), schemas.CROSSREF, DOI=F.when(n % 7 != 0, F.concat(prefix, _text(n))), title=F.array(_with("Title ", n)), author=F.array(F.struct(F.lit("Ann").alias("given"), _with("C", F.col("o_custkey") % 9).alias("family"), F.array(F.struct(unit.alias("name"))).alias("affiliation"))),
        **{"published-print": F.when(n % 2 == 0, dated(F.year("o_orderdate"))), "published-online": F.when(n % 5 == 0, dated(F.lit(2001))), "created": dated(F.lit(2002)), "container-title": F.array(F.lit("J")), "is-referenced-by-count": F.col("o_custkey"), "group-title": F.when(n % 4 == 1, "medRxiv")}, abstract=F.lit("<jats:p>text</jats:p>"),
    )
    found = parsers.crossref(raw, "ours university").unionByName(parsers.ssrn(raw, "ours university")).unionByName(parsers.preprint_servers(raw, "ours university"))
    first = F.get("authors", 0)
    return found.select("source", "doi", "title", "year", first["name"].alias("name"), first["is_bu"].alias("ours"), "venue", "abstract", F.col("citation_count").cast("long").alias("citations"))


@query("""
select o_orderkey as doi, case when o_custkey % 8 < 3 then 0 when o_clerk < 3 then 1 end as ours from (select *, o_orderkey % 5 as o_clerk from orders) where o_orderpriority in ('1-URGENT', '5-LOW') and (o_custkey % 8 < 3 or o_clerk < 3)
""")
def q_venue_and_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works in two venues by someone whose last name the roster has; the first such author becomes ours."""
    person = lambda first, c: F.struct(F.concat(F.lit(first + " Last"), F.translate(_text(c), "01234567", "abcdefgh")).alias("name"), F.lit("").alias("affiliation"), F.lit(False).alias("is_bu"))
    works = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doi"), F.lower("o_orderpriority").alias("venue"), F.array(person("Ann", F.col("o_custkey") % 8), person("Bo", F.col("o_orderkey") % 5)).alias("authors"))
    faculty = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Somebody Last"), F.translate(_text(F.col("s_suppkey") % 3), "012", "abc")).alias("name"))
    found = parsers.by_venue_and_name(works, faculty, ["1-Urgent", "5-Low"])
    return found.select("doi", (F.array_position(F.transform("authors", lambda a: a["is_bu"]), True) - 1).cast("int").alias("ours"))


@query("""
with h as (select l_partkey as doi, 'Person ' || l_suppkey as name, l_orderkey * 10 + l_linenumber as ord, l_suppkey, l_quantity from lineitem), f as (select * from h qualify row_number() over (partition by doi order by ord) = 1)
select doi, name from f where l_suppkey % 3 = 0 and l_quantity < 25
""")
def q_faculty_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A work counts by the name that met it first, if that is of the roster and among its authors."""
    name = _with("Person ", "l_suppkey")
    works = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("doi"), name.alias("name"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.array(F.struct(F.when(F.col("l_quantity") < 25, F.upper(name)).otherwise("Other").alias("name"))).alias("authors"))
    faculty = table(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select(_with("Person ", "s_suppkey").alias("name"))
    return parsers.by_faculty_name(works, faculty).select("doi", "name")


@query("""
select o_orderkey as id, 'On ' || o_orderstatus as title, cast(year(o_orderdate) as int) as year, case when o_orderkey % 2 = 0 then 'AIM: part one part two' else 'part one part two' end as abstract, 'Ann C' || o_custkey as name, o_custkey % 6 = 0 as ours, case when o_orderkey % 3 = 0 then '10.1/p' || o_orderkey end as doi,
    o_orderpriority || ',word' as concepts, 'https://pubmed.ncbi.nlm.nih.gov/' || o_orderkey || '/' as url from orders
""")
def q_medical_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    part = lambda text, label: F.struct(F.lit(text).alias("_VALUE"), label.alias("_Label"))
    id = lambda kind, value: F.struct(value.alias("_VALUE"), F.lit(kind).alias("_IdType"))
    person = F.struct(_with("C", "o_custkey").alias("LastName"), F.lit("Ann").alias("ForeName"), F.array(F.struct(F.when(F.col("o_custkey") % 6 == 0, "Dept of Ours").otherwise("Else").alias("Affiliation"))).alias("AffiliationInfo"))
    article = F.struct(
        _with("On ", "o_orderstatus").alias("ArticleTitle"), F.struct(F.lit("J").alias("Title"), F.struct(F.struct(F.year("o_orderdate").alias("Year")).alias("PubDate")).alias("JournalIssue")).alias("Journal"),
        F.struct(F.array(part("part one", F.when(n % 2 == 0, "AIM")), part("part two", F.lit(None).cast("string"))).alias("AbstractText")).alias("Abstract"), F.struct(F.array(person).alias("Author")).alias("AuthorList"),
    )
    citation = F.struct(_text(n).alias("PMID"), article.alias("Article"), F.struct(F.array(F.struct(F.col("o_orderpriority").alias("DescriptorName"))).alias("MeshHeading")).alias("MeshHeadingList"), F.struct(F.array(F.lit("word")).alias("Keyword")).alias("KeywordList"))
    ids = F.struct(F.array(id("pii", F.lit("x")), id("doi", F.when(n % 3 == 0, _with("10.1/P", n)))).alias("ArticleId"))
    rows = parsers.pubmed(_landed(table(spark, sf_dir, "orders"), parsers.PUBMED, MedlineCitation=citation, PubmedData=F.struct(ids.alias("ArticleIdList"))), "ours")
    first = F.get("authors", 0)
    return rows.select(F.col("source_id").cast("long").alias("id"), "title", "year", "abstract", first["name"].alias("name"), first["is_bu"].alias("ours"), "doi", F.array_join("concepts", ",").alias("concepts"), "url")


@query("""
select distinct 'a' || o_custkey as id, cast(2000 + o_custkey % 20 as int) as year, o_custkey % 4 = 0 as ours, case when o_custkey % 3 = 0 then 'Ref ' || o_custkey else 'arXiv' end as venue, 'cs.AI,c' || (o_custkey % 5) as concepts, case when o_custkey % 2 = 0 then 'http://pdf/' || o_custkey end as pdf_url from orders
""")
def q_preprint_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a feed in which an id comes again and again."""
    c = F.col("o_custkey")
    link = lambda href, title: F.struct(href.alias("_href"), title.alias("_title"))
    raw = _landed(
        table(spark, sf_dir, "orders"), parsers.ARXIV, id=_with("http://arxiv.org/abs/a", c), title=_with("P ", c), summary=F.lit("s"), published=F.concat(_text(c % 20 + 2000), F.lit("-01-02T00:00:00Z")), author=F.array(F.struct(F.lit("Ann").alias("name"), F.when(c % 4 == 0, "Ours U").alias("affiliation"))),
        link=F.array(link(F.lit("http://x"), F.lit("abs")), link(F.when(c % 2 == 0, _with("http://pdf/", c)), F.lit("pdf"))), category=F.array(F.struct(F.lit("cs.AI").alias("_term")), F.struct(_with("c", c % 5).alias("_term"))), journal_ref=F.when(c % 3 == 0, _with("Ref ", c)),
    )
    rows = parsers.arxiv(raw, "ours u")
    return rows.select(F.col("source_id").alias("id"), "year", F.get("authors", 0)["is_bu"].alias("ours"), "venue", F.array_join("concepts", ",").alias("concepts"), "pdf_url")


@query("""
select 'p' || c_custkey as id, case when c_custkey % 3 = 0 then '10.1/s' || c_custkey end as doi, case when c_custkey % 2 = 0 then 'arxiv' else '' end || case when c_custkey % 5 = 0 then 'pubmed' else '' end as others, 'Ann:1' as people, c_mktsegment || ', Review' as kind, c_nationkey as citations from customer
""")
def q_graph_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    ids = F.struct(F.when(c % 3 == 0, _with("10.1/S", c)).alias("DOI"), F.when(c % 2 == 0, F.lit("2001")).alias("ArXiv"), F.when(c % 5 == 0, F.lit("77")).alias("PubMed"))
    raw = _landed(table(spark, sf_dir, "customer"), schemas.SEMANTIC, paperId=_with("p", c), title=_with("T ", c), citationCount=F.col("c_nationkey"), authors=F.array(F.struct(F.lit("1").alias("authorId"), F.lit("Ann").alias("name"))), externalIds=ids, publicationTypes=F.array("c_mktsegment", F.lit("Review")))
    rows = parsers.semantic_scholar(raw)
    person = F.get("authors", 0)
    return rows.select(F.col("source_id").alias("id"), "doi", F.array_join(F.array_sort(F.map_keys("extra")), "").alias("others"), F.concat(person["name"], F.lit(":"), person["s2_author_id"]).alias("people"), F.col("publication_type").alias("kind"), F.col("citation_count").alias("citations"))


@query("""
select distinct 'N' || (p_partkey % 700) as id, 'Grant ' || (p_partkey % 700) as title, cast(1990 + (p_partkey % 700) % 30 as int) as year, 'ANN P' || (p_partkey % 700) as name, array_to_string(list_transform(range(0, least(20, (p_partkey % 700) % 26)), lambda i: 't' || i), ',') as concepts, cast(1000 * (p_partkey % 700) as varchar) as award from part
""")
def q_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects that are reported more than once, with up to 26 terms."""
    k = F.col("p_partkey") % 700
    terms = F.array_join(F.transform(F.slice(F.sequence(F.lit(0), F.lit(29)), F.lit(1), (k % 26).cast("int")), lambda i: _with("t", i)), "; ")
    raw = _landed(
        table(spark, sf_dir, "part"), schemas.NIH, project_num=_with("N", k), project_title=_with("Grant ", k), pref_terms=F.concat(terms, F.lit(";")), project_start_date=F.concat(_text(k % 30 + 1990), F.lit("-03-01")), organization=F.struct(F.lit("O").alias("org_name")),
        principal_investigators=F.array(F.struct(F.concat(_with("P", k), F.lit(", ANN")).alias("full_name"))), award_amount=(k * 1000).cast("long"),
    )
    rows = parsers.grants(raw)
    return rows.select(F.col("source_id").alias("id"), "title", "year", F.get("authors", 0)["name"].alias("name"), F.array_join("concepts", ",").alias("concepts"), F.col("extra")["award_amount"].alias("award"))


@query("""
select distinct p_partkey % 900 as id, cast(1980 + (p_partkey % 900) % 40 as int) as year from part where (p_partkey % 900) % 4 = 1 and (p_partkey % 900) % 3 <> 2
""")
def q_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 900
    title = F.when(k % 3 == 0, "Deep learning of rocks").when(k % 3 == 1, "Rocks").otherwise("Tea")
    raw = _landed(table(spark, sf_dir, "part"), schemas.NSF, id=_text(k), title=title, abstractText=F.when(k % 3 == 1, "by robotics"), awardeeName=F.when(k % 4 == 1, "Trustees of OURS University").otherwise("Other"), startDate=F.concat(F.lit("01/02/"), _text(k % 40 + 1980)), pdPIName=F.lit("Ann"))
    return parsers.awards(raw, "ours university").select(F.col("source_id").cast("long").alias("id"), "year")


@query("""
select distinct 'u' || s_suppkey as id, 'Item ' || s_suppkey as title, cast(case when s_suppkey % 4 <> 0 then 1990 + s_suppkey % 40 end as int) as year, case s_suppkey % 3 when 0 then '10.1/d' || s_suppkey when 1 then '10.1/u' || s_suppkey end as doi, 'Ann S' || s_suppkey || ';Bo Ray' as people, 's' || s_nationkey || ',t' as concepts
from supplier where s_suppkey % 4 = 0 or 1990 + s_suppkey % 40 >= 2005
""")
def q_repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a repository since 2005; those without a year stay. Each is landed twice."""
    s = F.col("s_suppkey")
    values = lambda *c: F.array(*[F.struct(x.alias("value")) for x in c])
    metadata = F.map_filter(F.create_map(
        F.lit("dc.title"), values(_with("Item ", s)), F.lit("dc.contributor.author"), values(F.concat(_with("S", s), F.lit(", Ann")), F.lit("Ray, Bo")), F.lit("dc.date.issued"), F.when(s % 4 != 0, values(F.concat(_text(s % 40 + 1990), F.lit("-05")))),
        F.lit("dc.identifier.doi"), F.when(s % 3 == 0, values(_with("10.1/D", s))), F.lit("dc.identifier.uri"), values(F.lit("https://handle/1"), F.when(s % 3 == 1, _with("https://doi.org/10.1/U", s)).otherwise("https://handle/2")), F.lit("dc.subject"), values(_with("s", "s_nationkey"), F.lit("t")),
    ), lambda k, v: v.isNotNull())
    suppliers = table(spark, sf_dir, "supplier")
    raw = _landed(suppliers.union(suppliers), schemas.DSPACE, uuid=_with("u", s), metadata=metadata)
    rows = parsers.repository(raw, 2005)
    return rows.select(F.col("source_id").alias("id"), "title", "year", "doi", F.array_join(F.transform("authors", lambda a: a["name"]), ";").alias("people"), F.array_join("concepts", ",").alias("concepts"))


@query(r"""
select url as id, regexp_extract(html, '(?is)<title>([^<]*)</title>', 1) <> '' as titled, cast(case when page_id % 3 = 0 then 2000 + page_id % 20 end as int) as year, 'Ann P' || page_id || ';Bo Ray' as people, 'x,y z' as concepts from pages where page_id % 2 = 0
""")
def q_article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with meta elements of articles put before their own markup; every second one is by someone of ours."""
    p = F.col("page_id")
    tag = lambda name, c: F.concat(F.lit(f'<meta name="{name}" content="'), c, F.lit('"/>'))
    head = F.concat(
        tag("citation_title", F.nullif(F.regexp_extract("html", r"(?is)<title>([^<]*)</title>", 1), F.lit(""))), tag("citation_author", F.concat(_with("P", p), F.lit(", Ann"))), tag("citation_author_institution", F.when(p % 2 == 0, "School of Ours").otherwise("Else")), tag("citation_author", F.lit("Ray, Bo")),
        F.when(p % 3 == 0, tag("citation_publication_date", F.concat(F.lit("May "), _text(p % 20 + 2000)))).otherwise(""), tag("keywords", F.lit("x, y z")),
    )
    rows = parsers.commons_page(table(spark, sf_dir, "pages").select("url", F.concat(head, "html").alias("html")), "school of ours")
    return rows.select(F.col("source_id").alias("id"), F.col("title").isNotNull().alias("titled"), "year", F.array_join(F.transform("authors", lambda a: a["name"]), ";").alias("people"), F.array_join("concepts", ",").alias("concepts"))
