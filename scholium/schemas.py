"""Types of the records."""

from __future__ import annotations

AUTHOR = "struct<name:string,affiliation:string,is_bu:boolean,openalex_id:string,orcid:string,s2_author_id:string>"
PAPER = (
    f"title string, title_normalized string, title_fingerprint string, authors array<{AUTHOR}>, year int, doi string, abstract string, source string, source_id string, url string, "
    "pdf_url string, venue string, concepts array<string>, citation_count int, publication_type string, extra map<string,string>, harvested_at string"
)
ROSTER = "name string, title string, school string, secondary_school string, openalex_id string, alternate_openalex_ids array<string>, openalex_works int, is_rare_name boolean, source_url string, scraped_at string, ord int"
RUN_LOG = "timestamp string, type string, harvested int, deduped int, filtered int, classified int, added int, final_count int, cost_usd double, duration_s int, status string"
OPENALEX = (
    "id string, title string, doi string, publication_year int, type string, cited_by_count int, "
    "authorships array<struct<author:struct<id:string,display_name:string,orcid:string>,institutions:array<struct<display_name:string,ror:string>>>>, "
    "concepts array<struct<display_name:string>>, topics array<struct<display_name:string>>, abstract_inverted_index map<string,array<int>>, "
    "open_access struct<is_oa:boolean,oa_url:string>, primary_location struct<landing_page_url:string,source:struct<display_name:string,type:string>>"
)
CROSSREF = (
    "DOI string, title array<string>, author array<struct<given:string,family:string,affiliation:array<struct<name:string>>>>, `published-print` struct<`date-parts`:array<array<int>>>, "
    "`published-online` struct<`date-parts`:array<array<int>>>, created struct<`date-parts`:array<array<int>>>, abstract string, `container-title` array<string>, subject array<string>, "
    "`is-referenced-by-count` int, type string, URL string, `group-title` string"
)
SEMANTIC = (
    "paperId string, title string, abstract string, year int, venue string, citationCount int, url string, authors array<struct<authorId:string,name:string>>, externalIds struct<DOI:string,ArXiv:string,PubMed:string>, "
    "openAccessPdf struct<url:string>, fieldsOfStudy array<string>, publicationTypes array<string>"
)
NIH = "project_num string, project_title string, abstract_text string, pref_terms string, project_start_date string, contact_pi_name string, organization struct<org_name:string>, principal_investigators array<struct<full_name:string>>, award_amount long"
NSF = "id string, title string, abstractText string, awardeeName string, startDate string, pdPIName string, fundsObligatedAmt string"
DSPACE = "uuid string, handle string, metadata map<string,array<struct<value:string>>>"
DBLP = "`@key` string, title string, year string, venue string, doi string, ee string, type string, authors string"
