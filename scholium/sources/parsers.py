"""Parsers: raw records of each source to papers. The institution is a parameter everywhere."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import has
from ..functions.text import blank, first_last, inverted_text, normalize_clean, normalize_doi, once, sanitize
from ..functions.values import named, variant
from ..operators.dedup import keep_first, windowed_first
from ..operators.filters import has_term
from ..schemas import AUTHOR
from ..storage import stored


def _texts(c: Column | None = None) -> Column:
    none = F.array().cast("array<string>")
    return none if c is None else F.coalesce(F.filter(c, lambda x: x.isNotNull() & (x != "")), none)


def _author(name: Column, affiliation: Column | None = None, ours: Column | None = None, openalex: Column | None = None, orcid: Column | None = None, s2: Column | None = None) -> Column:
    text = lambda c: F.lit(None).cast("string") if c is None else c
    return F.struct(name.alias("name"), F.coalesce(text(affiliation), F.lit("")).alias("affiliation"), F.coalesce(ours if ours is not None else F.lit(False), F.lit(False)).alias("is_bu"), text(openalex).alias("openalex_id"), text(orcid).alias("orcid"), text(s2).alias("s2_author_id"))


def record(raw: DataFrame, harvested_at: str = "", **fields: Column) -> DataFrame:
    """Papers of one shape from the fields that a source has: cleaned, with keys, and defaults for the others."""
    none = lambda kind: F.lit(None).cast(kind)
    f = {k: fields.get(k, none("string")) for k in ("title", "doi", "abstract", "source", "source_id", "url", "pdf_url", "venue", "publication_type")}
    f |= {k: fields.get(k, none(kind)) for k, kind in (("authors", f"array<{AUTHOR}>"), ("year", "int"), ("concepts", "array<string>"), ("citation_count", "int"), ("extra", "map<string,string>"))}
    raw = raw.select(*[c.alias(f"_field_{k}") for k, c in f.items()])  # first of all, or a raw column would be taken for the field of its name
    raw = raw.withColumn("_field_title", sanitize(F.col("_field_title")))
    f = fields = {k: F.col(f"_field_{k}") for k in f}
    return raw.select(
        f["title"].alias("title"), normalize_clean(f["title"]).alias("title_normalized"), F.md5(normalize_clean(f["title"])).alias("title_fingerprint"),
        F.coalesce(fields.get("authors", none(f"array<{AUTHOR}>")), F.array().cast(f"array<{AUTHOR}>")).alias("authors"), fields.get("year", none("int")).cast("int").alias("year"), normalize_doi(f["doi"]).alias("doi"),
        sanitize(f["abstract"]).alias("abstract"), f["source"].alias("source"), f["source_id"].cast("string").alias("source_id"), f["url"].alias("url"), f["pdf_url"].alias("pdf_url"), sanitize(f["venue"]).alias("venue"),
        _texts(fields.get("concepts")).alias("concepts"), F.coalesce(fields.get("citation_count", none("int")).cast("int"), F.lit(0)).alias("citation_count"), f["publication_type"].alias("publication_type"),
        F.coalesce(fields.get("extra", none("map<string,string>")), F.create_map().cast("map<string,string>")).alias("extra"), F.lit(harvested_at).alias("harvested_at"),
    )


def openalex(raw: DataFrame, ror: str, harvested_at: str = "", affiliation: Callable[[Column], Column] | None = None) -> DataFrame:
    """Works of an open catalogue: an author is ours if any of their institutions is. Affiliations are all institutions' names unless asked otherwise."""
    units = affiliation or (lambda a: F.array_join(F.transform(a["institutions"], lambda i: i["display_name"]), "; "))
    author = lambda a: _author(a["author"]["display_name"], units(a), has(a["institutions"], lambda i: i["ror"] == ror), a["author"]["id"], a["author"]["orcid"])
    named = lambda c: F.coalesce(F.transform(c, lambda x: x["display_name"]), _texts())
    return record(
        raw.filter(blank(F.col("title")).isNotNull()), harvested_at, title=F.col("title"), authors=F.transform("authorships", author), year=F.col("publication_year"), doi=F.col("doi"), abstract=inverted_text(F.col("abstract_inverted_index")),
        source=F.lit("openalex"), source_id=F.col("id"), url=F.coalesce("primary_location.landing_page_url", "id"), pdf_url=F.col("open_access.oa_url"), venue=F.col("primary_location.source.display_name"),
        concepts=F.concat(named(F.col("concepts")), named(F.col("topics"))), citation_count=F.col("cited_by_count"), publication_type=F.col("type"), extra=F.create_map(F.lit("is_oa"), F.col("open_access.is_oa").cast("string")),
    )


def concept_sweep(works: DataFrame, names: Sequence[str]) -> DataFrame:
    return works.filter(has(F.col("concepts"), lambda c: c.isin(list(names))))


def our_names(authors: Column) -> Column:
    """Names of the authors that are ours, in order; one that stands twice does so here."""
    return F.transform(F.filter(authors, lambda a: F.coalesce(a["is_bu"], F.lit(False))), lambda a: a["name"])


def open_access(extra: Column) -> Column:
    """Whether a paper is open to all: true, false, or null where its source does not tell."""
    return extra["is_oa"].try_cast("boolean")


def institution_sweep(raw: DataFrame, ror: str, master: DataFrame, terms: Sequence[str], harvested_at: str = "") -> DataFrame:
    """All works of an institution in one sweep: on the subject, by an author of ours, new to the master and within the sweep.

    An author's affiliation is that of the first institution only; authors without a name are left out. Of works that share
    a DOI or a title the one of the smallest id stays.
    """
    from ..operators.dedup import new_records, within_batch
    from ..operators.maintain import numbered

    first = lambda a: F.coalesce(F.get(a["institutions"], 0)["display_name"], F.lit(""))
    named = openalex(raw.filter("id is not null"), ror, harvested_at, first).withColumn("authors", F.filter("authors", lambda a: blank(a["name"]).isNotNull()))
    text = F.concat_ws(" ", "title", F.coalesce("abstract", F.lit("")))
    kept = named.filter(has_term(text, terms) & (F.size(our_names(F.col("authors"))) > 0)).withColumnRenamed("title_fingerprint", "fp")
    fresh = stored(new_records(kept, [master]), "sweep")
    return within_batch(numbered(fresh, "source_id", "arrival")).drop("arrival").withColumnRenamed("fp", "title_fingerprint")


def source_papers(raw: DataFrame, ror: str, of_source: Column, master: DataFrame, terms: Sequence[str], since: int | None = None, harvested_at: str = "") -> DataFrame:
    """Works of one series or repository within the catalogue, on the subject and new to the master."""
    from ..operators.dedup import new_records

    text = F.concat_ws(" ", "title", F.coalesce("abstract", F.lit("")))
    rows = openalex(raw.filter(of_source), ror, harvested_at).filter(has_term(text, terms)).withColumnRenamed("title_fingerprint", "fp")
    rows = rows if since is None else rows.filter(F.col("year").isNull() | (F.col("year") >= since))
    return new_records(rows, [master]).withColumnRenamed("fp", "title_fingerprint")


def institution_profiles(rows: DataFrame) -> DataFrame:
    """(id, works, authors, citations) of institutions, from rows (source_id, citation_count, institution, author): a work counts once."""
    works = rows.groupBy("institution", "source_id").agg(F.max("citation_count").alias("c"))
    sums = works.groupBy("institution").agg(F.count(F.lit(1)).alias("works"), F.sum("c").alias("citations"))
    people = rows.groupBy("institution").agg(F.countDistinct("author").alias("authors"))
    return sums.join(people, "institution").select(F.col("institution").alias("id"), "works", "authors", "citations")


def keyword_sweep(hits: DataFrame) -> DataFrame:
    """One row an id, of the first keyword that found it: hits are (keyword_order, keyword, source_id, …)."""
    return windowed_first(hits, ["source_id"], ["keyword_order"]).withColumnRenamed("keyword", "matched_keyword").drop("keyword_order")


def _crossref_year() -> Column:
    part = lambda c: F.get(F.get(F.col(c)["date-parts"], 0), 0)
    return F.coalesce(part("published-print"), part("published-online"), part("created"))


def _crossref(raw: DataFrame, source: Column, venue: Column, institution: str, harvested_at: str) -> DataFrame:
    affiliation = lambda a: F.array_join(F.transform(a["affiliation"], lambda x: x["name"]), "; ")
    name = lambda a: F.trim(F.concat_ws(" ", a["given"], a["family"]))
    author = lambda a: _author(name(a), affiliation(a), F.contains(F.lower(affiliation(a)), F.lit(institution.lower())))
    return record(
        raw, harvested_at, title=F.get("title", 0), authors=F.transform("author", author), year=_crossref_year(), doi=F.col("DOI"), abstract=F.regexp_replace("abstract", "<[^>]+>", ""), source=source, source_id=F.col("DOI"),
        url=F.col("URL"), venue=venue, concepts=F.col("subject"), citation_count=F.col("is-referenced-by-count"), publication_type=F.col("type"),
    )


def crossref(raw: DataFrame, institution: str, harvested_at: str = "", preprints: str = "10.2139") -> DataFrame:
    """Registered works with a DOI, without the preprint server's."""
    kept = raw.filter(blank(F.col("DOI")).isNotNull() & ~F.startswith("DOI", F.lit(preprints)))
    return _crossref(kept, F.lit("crossref"), F.get("container-title", 0), institution, harvested_at)


def ssrn(raw: DataFrame, institution: str, harvested_at: str = "", prefix: str = "10.2139") -> DataFrame:
    return _crossref(raw.filter(F.startswith("DOI", F.lit(prefix))), F.lit("ssrn"), F.lit("SSRN Electronic Journal"), institution, harvested_at)


def preprint_servers(raw: DataFrame, institution: str, harvested_at: str = "", prefix: str = "10.1101") -> DataFrame:
    server = F.when(F.contains(F.lower(F.coalesce("group-title", F.lit(""))), F.lit("medrxiv")), "medRxiv").otherwise("bioRxiv")
    return _crossref(raw.filter(F.startswith("DOI", F.lit(prefix))), F.lit("biorxiv_medrxiv"), server, institution, harvested_at)


def by_faculty_name(works: DataFrame, faculty: DataFrame, order: str = "ord") -> DataFrame:
    """Works met under a name, of (doi, name, ord, …): a DOI counts where it is met first, and stays only if a work's authors have that name."""
    first = keep_first(works, ["doi"], [order])
    return first.join(faculty.select(F.col("name").alias("_n")).distinct(), first["name"] == F.col("_n"), "left_semi").filter(has(F.col("authors"), lambda a: F.contains(F.lower(a["name"]), F.lower("name"))))


def by_venue_and_name(works: DataFrame, faculty: DataFrame, venues: Sequence[str]) -> DataFrame:
    """Works in some venues with an author of a faculty member's last name, whose first such author becomes ours.

    Names meet by the last word of an author's name, an equality, so that works need not be held against every name.
    """
    from ..functions.text import surname

    kept = works.filter(F.lower("venue").isin([v.lower() for v in venues]))
    each = kept.select("doi", F.posexplode("authors").alias("at", "a")).withColumn("_last", surname(F.col("a.name")))
    hits = each.join(faculty.select(surname(F.col("name")).alias("_last")).distinct(), "_last", "left_semi").groupBy("doi").agg(F.min("at").alias("_at"))
    flagged = F.transform("authors", lambda a, i: a.withField("is_bu", F.coalesce(a["is_bu"], F.lit(False)) | (i == F.col("_at"))))
    return kept.join(hits, "doi").withColumn("authors", flagged).drop("_at")


PUBMED = (
    "MedlineCitation struct<PMID:string,Article:struct<ArticleTitle:string,Journal:struct<Title:string,JournalIssue:struct<PubDate:struct<Year:int>>>,Abstract:struct<AbstractText:array<struct<_VALUE:string,_Label:string>>>,"
    "AuthorList:struct<Author:array<struct<LastName:string,ForeName:string,AffiliationInfo:array<struct<Affiliation:string>>>>>,PublicationTypeList:struct<PublicationType:array<string>>>,"
    "MeshHeadingList:struct<MeshHeading:array<struct<DescriptorName:string>>>,KeywordList:struct<Keyword:array<string>>>, PubmedData struct<ArticleIdList:struct<ArticleId:array<struct<_VALUE:string,_IdType:string>>>>"
)


def pubmed(raw: DataFrame, institution: str, harvested_at: str = "") -> DataFrame:
    """Articles of the medical index, read by the XML source with the schema PUBMED."""
    a = "MedlineCitation.Article."
    section = lambda s: F.when(blank(s["_Label"]).isNotNull(), F.concat(s["_Label"], F.lit(": "), s["_VALUE"])).otherwise(s["_VALUE"])
    affiliation = lambda x: F.coalesce(F.array_join(F.transform(x["AffiliationInfo"], lambda i: i["Affiliation"]), "; "), F.lit(""))
    author = lambda x: _author(F.trim(F.concat_ws(" ", x["ForeName"], x["LastName"])), affiliation(x), F.contains(F.lower(affiliation(x)), F.lit(institution.lower())))
    doi = F.get(F.filter("PubmedData.ArticleIdList.ArticleId", lambda x: x["_IdType"] == "doi"), 0)["_VALUE"]
    concepts = F.concat(F.coalesce(F.transform("MedlineCitation.MeshHeadingList.MeshHeading", lambda m: m["DescriptorName"]), _texts()), F.coalesce("MedlineCitation.KeywordList.Keyword", _texts()))
    return record(
        raw, harvested_at, title=F.col(a + "ArticleTitle"), authors=F.transform(a + "AuthorList.Author", author), year=F.col(a + "Journal.JournalIssue.PubDate.Year"), doi=doi,
        abstract=F.array_join(F.transform(a + "Abstract.AbstractText", section), " "), source=F.lit("pubmed"), source_id=F.col("MedlineCitation.PMID"), url=F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), "MedlineCitation.PMID", F.lit("/")),
        venue=F.col(a + "Journal.Title"), concepts=concepts, publication_type=F.get(a + "PublicationTypeList.PublicationType", 0),
    )


ARXIV = "id string, title string, summary string, published string, author array<struct<name:string,affiliation:string>>, link array<struct<_href:string,_title:string>>, category array<struct<_term:string>>, doi string, journal_ref string"


def arxiv(raw: DataFrame, institution: str, harvested_at: str = "") -> DataFrame:
    """Entries of a preprint feed, read by the XML source with the schema ARXIV; an id once."""
    author = lambda x: _author(x["name"], x["affiliation"], F.contains(F.lower(F.coalesce(x["affiliation"], F.lit(""))), F.lit(institution.lower())))
    pdf = F.get(F.filter("link", lambda x: x["_title"] == "pdf"), 0)["_href"]
    return record(
        raw, harvested_at, title=F.col("title"), authors=F.transform("author", author), year=F.substring("published", 1, 4).try_cast("int"), doi=F.col("doi"), abstract=F.col("summary"), source=F.lit("arxiv"),
        source_id=F.element_at(F.split("id", "/abs/"), -1), url=F.col("id"), pdf_url=pdf, venue=F.coalesce("journal_ref", F.lit("arXiv")), concepts=F.transform("category", lambda c: c["_term"]), publication_type=F.lit("preprint"),
    ).dropDuplicates(["source_id"])


def semantic_scholar(raw: DataFrame, harvested_at: str = "") -> DataFrame:
    ids = F.map_filter(F.create_map(F.lit("arxiv"), F.col("externalIds.ArXiv"), F.lit("pubmed"), F.col("externalIds.PubMed")), lambda k, v: v.isNotNull())
    return record(
        raw, harvested_at, title=F.col("title"), authors=F.transform("authors", lambda a: _author(a["name"], s2=a["authorId"])), year=F.col("year"), doi=F.col("externalIds.DOI"), abstract=F.col("abstract"), source=F.lit("semantic_scholar"),
        source_id=F.col("paperId"), url=F.col("url"), pdf_url=F.col("openAccessPdf.url"), venue=F.col("venue"), concepts=F.col("fieldsOfStudy"), citation_count=F.col("citationCount"), publication_type=F.array_join("publicationTypes", ", "), extra=ids,
    )


def grants(raw: DataFrame, harvested_at: str = "") -> DataFrame:
    """Research projects: terms apart at semicolons, twenty at most; a project number once."""
    terms = F.slice(F.filter(F.transform(F.split("pref_terms", ";"), lambda t: F.trim(t)), lambda t: t != ""), 1, 20)
    author = lambda p: _author(first_last(p["full_name"]), F.col("organization.org_name"), F.lit(True))
    return record(
        raw.dropDuplicates(["project_num"]), harvested_at, title=F.col("project_title"), authors=F.transform("principal_investigators", author), year=F.substring("project_start_date", 1, 4).try_cast("int"), abstract=F.col("abstract_text"),
        source=F.lit("nih_reporter"), source_id=F.col("project_num"), concepts=terms, publication_type=F.lit("grant"), extra=F.create_map(F.lit("award_amount"), F.col("award_amount").cast("string")),
    )


def awards(raw: DataFrame, institution: str, harvested_at: str = "") -> DataFrame:
    """Awards to the institution that speak of the subject; an id once."""
    kept = raw.filter(F.contains(F.lower("awardeeName"), F.lit(institution.lower())) & has_term(F.concat_ws(" ", "title", "abstractText"))).dropDuplicates(["id"])
    return record(
        kept, harvested_at, title=F.col("title"), authors=F.array(_author(F.col("pdPIName"), F.col("awardeeName"), F.lit(True))), year=F.element_at(F.split("startDate", "/"), -1).try_cast("int"), abstract=F.col("abstractText"),
        source=F.lit("nsf_awards"), source_id=F.col("id"), publication_type=F.lit("grant"),
    )


def repository(raw: DataFrame, min_year: int | None = None, harvested_at: str = "") -> DataFrame:
    """Items of an institutional repository; an item without a year passes any bound."""
    every = lambda k: F.coalesce(F.transform(F.col("metadata")[k], lambda x: x["value"]), _texts())
    first = lambda k: F.get(F.col("metadata")[k], 0)["value"]
    uri = F.get(F.filter(every("dc.identifier.uri"), lambda u: F.contains(u, F.lit("doi.org/"))), 0)
    doi = F.coalesce(first("dc.identifier.doi"), F.element_at(F.split(uri, "doi.org/"), -1))
    out = record(
        raw.dropDuplicates(["uuid"]), harvested_at, title=first("dc.title"), authors=F.transform(every("dc.contributor.author"), lambda a: _author(first_last(a), ours=F.lit(True))), year=F.substring(first("dc.date.issued"), 1, 4).try_cast("int"), doi=doi,
        abstract=first("dc.description.abstract"), source=F.lit("openbu"), source_id=F.col("uuid"), url=first("dc.identifier.uri"), concepts=every("dc.subject"), publication_type=first("dc.type"),
    )
    return out if min_year is None else out.filter(F.col("year").isNull() | (F.col("year") >= min_year))


def meta(html: Column, name: str) -> Column:
    """All contents of meta elements of a name."""
    return F.regexp_extract_all(html, F.lit(rf'(?is)<meta[^>]*name=["\']{name}["\'][^>]*content=["\']([^"\']*)["\']'), 1)


def commons_page(pages: DataFrame, institution: str, html: str = "html", url: str = "url", harvested_at: str = "") -> DataFrame:
    """Article pages with meta elements; an author's institution is the one at their place, and one must be ours."""
    h = F.col(html)
    people = F.arrays_zip(meta(h, "citation_author").alias("n"), meta(h, "citation_author_institution").alias("i"))
    ours = lambda x: F.contains(F.lower(F.coalesce(x["i"], F.lit(""))), F.lit(institution.lower()))
    date = F.coalesce(F.get(meta(h, "citation_publication_date"), 0), F.get(meta(h, "citation_date"), 0))
    out = record(
        pages, harvested_at, title=F.get(meta(h, "citation_title"), 0), authors=F.transform(people, lambda x: _author(first_last(x["n"]), x["i"], ours(x))), year=F.nullif(F.regexp_extract(date, r"(\d{4})", 1), F.lit("")).try_cast("int"),
        doi=F.get(meta(h, "citation_doi"), 0), abstract=F.get(meta(h, "description"), 0), source=F.lit("scholarly_commons"), source_id=F.col(url), url=F.col(url), pdf_url=F.get(meta(h, "citation_pdf_url"), 0),
        venue=F.get(meta(h, "citation_journal_title"), 0), concepts=F.transform(F.split(F.get(meta(h, "keywords"), 0), ","), lambda t: F.trim(t)), publication_type=F.lit("article"),
    )
    return out.filter(has(F.col("authors"), lambda a: a["is_bu"]))


def dblp(raw: DataFrame, min_year: int | None = None, harvested_at: str = "") -> DataFrame:
    """Entries of a computing index. Their authors are JSON of any shape: one object, one text, lists of them, or under `author`; a key once."""
    people = once(variant(F.col("authors")), lambda v: once(F.coalesce(F.try_variant_get(v, "$.author", "variant"), v), lambda a: F.coalesce(named(a), _texts())))
    name = lambda a: F.regexp_replace(a, r"\s+\d{4}$", "")
    out = record(
        raw.dropDuplicates(["@key"]), harvested_at, title=F.regexp_replace("title", r"\.$", ""), authors=F.transform(people, lambda a: _author(name(a))), year=F.col("year").try_cast("int"),
        doi=F.col("doi"), source=F.lit("dblp"), source_id=F.col("@key"), url=F.col("ee"), venue=F.col("venue"), publication_type=F.col("type"),
    )
    return out if min_year is None else out.filter(F.col("year").isNull() | (F.col("year") >= min_year))


def index_dump(records: DataFrame, roster: DataFrame, master: DataFrame, ambiguous: Sequence[str], since: int | None = None, affiliation: str = "") -> DataFrame:
    """Papers of a full dump with an author of the roster, unless all names that match are ambiguous, that master lacks.

    A roster name of three words with an initial in the middle also matches without it. Authors that match are ours.
    The records are stored once, since they are read for their authors and again for what is kept.
    """
    from ..functions.text import folded, words
    from ..operators.dedup import new_records
    from ..operators.filters import ambiguous_surname

    parts = words(F.col("_n"))
    short = F.when((F.size(parts) == 3) & ((F.length(F.get(parts, 1)) <= 2) | F.endswith(F.get(parts, 1), F.lit("."))), F.concat_ws(" ", F.get(parts, 0), F.get(parts, 2)))
    known = roster.select(folded(F.col("name")).alias("_n")).filter("_n <> ''").select(F.explode(F.array_compact(F.array("_n", short))).alias("_n")).distinct()
    records = stored(records, "dump-records")
    each = records.select("source_id", F.posexplode("authors").alias("_at", "a")).select("source_id", "_at", folded(F.col("a.name")).alias("_n"))
    hits = each.join(known, "_n", "left_semi").groupBy(F.col("source_id").alias("_id")).agg(F.bool_or(~ambiguous_surname(F.col("_n"), ambiguous)).alias("_sure"), F.collect_set("_at").alias("_ours"))  # authors of one paper
    mine = lambda a, i: a.withField("is_bu", F.array_contains("_ours", i)).withField("affiliation", F.when(F.array_contains("_ours", i), F.lit(affiliation)).otherwise(a["affiliation"]))
    kept = records.join(hits.filter("_sure"), records["source_id"] == F.col("_id")).withColumn("authors", F.transform("authors", mine)).drop("_id", "_sure", "_ours")
    if since is not None:
        kept = kept.filter(F.col("year").isNull() | (F.col("year") >= since))
    had = master.select("doi", F.col("title_fingerprint").alias("fp"))
    return new_records(kept.withColumnRenamed("title_fingerprint", "fp"), [had]).withColumnRenamed("fp", "title_fingerprint")


def stop_at_old_pages(pages: DataFrame, page: str = "page", recent: str = "n_recent", most: int = 3, listing: Sequence[str] = ()) -> DataFrame:
    """Pages of each listing up to the place where `most` in a row had nothing recent; all of a listing without such a place."""
    from ..operators.streaks import streaks

    stops = streaks(pages.select(*listing, page, recent), listing, [page], F.col(recent) == 0, "_streak").filter(F.col("_streak") == most)
    if not listing:
        bound = stops.agg(F.min(page).alias("_stop"))  # one row
        return pages.join(F.broadcast(bound)).filter(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).drop("_stop")
    stops = stops.groupBy(*[F.col(c).alias(f"_of_{c}") for c in listing]).agg(F.min(page).alias("_stop"))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in listing]
    return pages.join(stops, same, "left").filter(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).select(*pages.columns)
