"""Parsers on small raw records."""

import gzip
import json

import pytest

from scholium import schemas
from scholium.sources import files, parsers

ROR = "https://ror.org/target"


@pytest.fixture
def landed(spark, tmp_path):
    def land(rows, schema):
        path = tmp_path / "raw.json"
        path.write_text("\n".join(json.dumps(r) for r in rows))
        return files.json_lines(spark, str(path), schema)

    return land


def test_catalogue(landed):
    work = {
        "id": "W1", "title": "A <i>b</i>", "doi": "https://doi.org/10.1/X", "publication_year": 2020, "type": "article", "cited_by_count": 3, "abstract_inverted_index": {"we": [0], "go": [1]},
        "authorships": [{"author": {"id": "A1", "display_name": "Ann", "orcid": None}, "institutions": [{"display_name": "U", "ror": ROR}, {"display_name": "V", "ror": "x"}]}, {"author": {"id": "A2", "display_name": "Bo"}, "institutions": []}],
        "concepts": [{"display_name": "C"}], "topics": [{"display_name": "T"}], "open_access": {"is_oa": True, "oa_url": "p"}, "primary_location": {"source": {"display_name": "J", "type": "journal"}},
    }
    r = parsers.openalex(landed([work, {"id": "W2", "title": None}], schemas.OPENALEX), ROR).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.title, r.doi, r.year, r.abstract, r.venue, r.concepts, r.citation_count, r.extra) == ("A b", "10.1/x", 2020, "we go", "J", ["C", "T"], 3, {"is_oa": "true"})
    assert [(a.name, a.affiliation, a.is_bu, a.openalex_id) for a in r.authors] == [("Ann", "U; V", True, "A1"), ("Bo", "", False, "A2")]


def test_registered_works(landed):
    rows = [
        {"DOI": "10.1/a", "title": ["T"], "author": [{"given": "Ann", "family": "Lee", "affiliation": [{"name": "Target University"}]}], "published-online": {"date-parts": [[2021, 2]]}, "created": {"date-parts": [[2022]]}, "abstract": "<p>x</p>", "container-title": ["J"], "subject": ["s"], "is-referenced-by-count": 4, "type": "article"},
        {"DOI": "10.2139/b", "title": ["S"]}, {"DOI": "10.1101/c", "title": ["P"], "group-title": "medRxiv"}, {"title": ["none"]},
    ]
    raw = landed(rows, schemas.CROSSREF)
    a = {r.doi: r for r in parsers.crossref(raw, "target university").collect()}
    assert set(a) == {"10.1/a", "10.1101/c"} and a["10.1/a"].year == 2021 and a["10.1/a"].authors[0].is_bu and a["10.1/a"].abstract == "x"
    assert [(r.source, r.venue) for r in parsers.ssrn(raw, "t").collect()] == [("ssrn", "SSRN Electronic Journal")]
    assert [r.venue for r in parsers.preprint_servers(raw, "t").collect()] == ["medRxiv"]


def test_xml_sources(spark, tmp_path):
    medical = tmp_path / "a.xml.gz"
    medical.write_bytes(gzip.compress(b"""<Set><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>T</ArticleTitle><Journal><Title>J</Title><JournalIssue><PubDate><Year>2019</Year></PubDate></JournalIssue></Journal>
      <Abstract><AbstractText Label="AIM">x</AbstractText><AbstractText>y</AbstractText></Abstract><AuthorList><Author><LastName>Lee</LastName><ForeName>Ann</ForeName><AffiliationInfo><Affiliation>Target U</Affiliation></AffiliationInfo></Author></AuthorList></Article>
      <MeshHeadingList><MeshHeading><DescriptorName>M</DescriptorName></MeshHeading></MeshHeadingList><KeywordList><Keyword>K</Keyword></KeywordList></MedlineCitation>
      <PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/Z</ArticleId></ArticleIdList></PubmedData></PubmedArticle></Set>"""))
    r = parsers.pubmed(files.xml(spark, str(medical), "PubmedArticle", parsers.PUBMED), "target u").first()
    assert (r.title, r.year, r.abstract, r.concepts, r.doi, r.authors[0].name, r.authors[0].is_bu) == ("T", 2019, "AIM: x y", ["M", "K"], "10.1/z", "Ann Lee", True)
    feed = tmp_path / "f.xml"
    feed.write_text('<feed><entry><id>http://arxiv.org/abs/2001.1v1</id><title>P</title><summary>s</summary><published>2020-01-02T00:00:00Z</published><author><name>Ann</name></author><link title="pdf" href="h"/><category term="cs.AI"/></entry></feed>')
    r = parsers.arxiv(files.xml(spark, str(feed), "entry", parsers.ARXIV), "t").first()
    assert (r.source_id, r.year, r.pdf_url, r.concepts, r.venue) == ("2001.1v1", 2020, "h", ["cs.AI"], "arXiv")


def test_other_sources(landed, spark):
    r = parsers.semantic_scholar(landed([{"paperId": "p", "title": "T", "year": 2020, "authors": [{"authorId": "1", "name": "Ann"}], "externalIds": {"DOI": "10.1/A", "ArXiv": "2"}, "publicationTypes": ["a", "b"], "citationCount": 2}], schemas.SEMANTIC)).first()
    assert (r.doi, r.extra, r.publication_type, r.authors[0].s2_author_id) == ("10.1/a", {"arxiv": "2"}, "a, b", "1")
    grant = {"project_num": "N", "project_title": "G", "pref_terms": "; ".join(f"t{i}" for i in range(30)) + ";", "project_start_date": "2018-03-01", "principal_investigators": [{"full_name": "LEE, ANN"}], "organization": {"org_name": "O"}}
    out = parsers.grants(landed([grant, grant], schemas.NIH)).collect()
    assert len(out) == 1 and len(out[0].concepts) == 20 and out[0].year == 2018 and out[0].authors[0].name == "ANN LEE"
    awards = [{"id": "1", "title": "Deep learning", "awardeeName": "Target University", "startDate": "01/02/2017", "pdPIName": "Ann"}, {"id": "2", "title": "Tea", "awardeeName": "Target University"}, {"id": "3", "title": "Deep learning", "awardeeName": "Other"}]
    assert [(r.source_id, r.year) for r in parsers.awards(landed(awards, schemas.NSF), "target").collect()] == [("1", 2017)]
    item = {"uuid": "u", "metadata": {"dc.title": [{"value": "T"}], "dc.contributor.author": [{"value": "Lee, Ann"}], "dc.date.issued": [{"value": "2015-01"}], "dc.identifier.uri": [{"value": "https://doi.org/10.1/q"}]}}
    old = {"uuid": "v", "metadata": {"dc.title": [{"value": "S"}]}}
    out = {r.source_id: r for r in parsers.repository(landed([item, old], schemas.DSPACE), 2016).collect()}
    assert set(out) == {"v"}
    r = parsers.repository(landed([item], schemas.DSPACE)).first()
    assert (r.doi, r.authors[0].name, r.authors[0].is_bu) == ("10.1/q", "Ann Lee", True)
    entries = [{"@key": "k", "title": "T.", "year": "2020", "authors": '[{"text": "Wei Wang 0001"}, {"text": "Ann"}]'}, {"@key": "m", "title": "S", "year": None, "authors": '{"text": "Bo"}'}]
    out = {r.source_id: (r.title, [a.name for a in r.authors]) for r in parsers.dblp(landed(entries, schemas.DBLP), 2019).collect()}
    assert out == {"k": ("T", ["Wei Wang", "Ann"]), "m": ("S", ["Bo"])}


def test_article_pages(spark):
    page = '<meta name="citation_title" content="T"><meta name="citation_author" content="Lee, Ann"><meta name="citation_author_institution" content="Target School"><meta name="citation_author" content="Ray, Bo"><meta name="citation_date" content="May 2016">'
    df = spark.createDataFrame([("u", page), ("v", page.replace("Target", "Other"))], "url string, html string")
    out = parsers.commons_page(df, "target school").collect()
    assert [(r.title, r.year, [a.name for a in r.authors], r.authors[0].is_bu) for r in out] == [("T", 2016, ["Ann Lee", "Bo Ray"], True)]


def test_sweeps(spark):
    hits = spark.createDataFrame([(2, "b", "x"), (1, "a", "x"), (2, "b", "y")], "keyword_order int, keyword string, source_id string")
    assert {r.source_id: r.matched_keyword for r in parsers.keyword_sweep(hits).collect()} == {"x": "a", "y": "b"}
    pages = spark.createDataFrame([(1, 2), (2, 0), (3, 0), (4, 0), (5, 3)], "page int, n_recent int")
    assert sorted(r.page for r in parsers.stop_at_old_pages(pages).collect()) == [1, 2, 3, 4]
    works = spark.createDataFrame([(1, "10.1/a", "Lee", [("Ann Ray",)]), (2, "10.1/a", "Ray", [("Ann Ray",)]), (3, "10.1/b", "Ray", [("Ann Ray",)])], "ord int, doi string, name string, authors array<struct<name:string>>")
    people = spark.createDataFrame([("Lee",), ("Ray",)], "name string")
    assert [r.doi for r in parsers.by_faculty_name(works, people).collect()] == ["10.1/b"]


def test_files(spark, tmp_path):
    (tmp_path / "names.txt").write_text("# list\nAnn Lee\n\nBo\n")
    assert [r.name for r in files.names(spark, str(tmp_path / "names.txt")).collect()] == ["Ann Lee", "Bo"]
    (tmp_path / "map.json").write_text('{"a": {"x": 1}, "b": {"x": 2}}')
    assert sorted(tuple(r) for r in files.json_object_values(spark, str(tmp_path / "map.json"), "x: int").collect()) == [("a", 1), ("b", 2)]
    for day, v in (("20260101", 1), ("20260201", 2)):
        (tmp_path / f"dblp_{day}.json").write_text(json.dumps({"v": v}))
    rows = spark.read.schema("v int").json(str(tmp_path / "dblp_*.json"))
    assert [(r.prefix, r.v) for r in files.latest_checkpoints(rows).collect()] == [("dblp", 2)]
    (tmp_path / "log.csv").write_text("timestamp,type\nt,weekly\n")
    assert files.csv(spark, str(tmp_path / "log.csv"), "timestamp string, type string").first().type == "weekly"
    assert files.json_array(spark, str(tmp_path / "map.json"), "a struct<x:int>").first().a.x == 1
