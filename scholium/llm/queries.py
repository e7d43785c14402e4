"""One query for each corpus operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, bytebpe, decontaminate, extraction, fillmiddle, language, licenses, linededup, simhash, telephony, tokenids, toxicity, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op3_tokenids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.digests(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs)).drop("spans")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"), boundary=linededup.BOUNDARY)


def op8_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.digests(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.components(whitening.transform(vectors, whitening.fit(vectors)))


def op12_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"))


def op13_fillmiddle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fillmiddle.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {"op1_licenses": op1_licenses, "op2_extraction": op2_extraction, "op3_tokenids": op3_tokenids, "op4_toxicity": op4_toxicity, "op5_decontaminate": op5_decontaminate, "op6_simhash": op6_simhash, "op7_linededup": op7_linededup, "op8_telephony": op8_telephony, "op9_language": op9_language, "op10_bpe": op10_bpe, "op11_whitening": op11_whitening, "op12_bytebpe": op12_bytebpe, "op13_fillmiddle": op13_fillmiddle}


OP5_SQL = r"""
with words as (
    select 'd' as side, row_number() over () as row, doc_id as id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents where text is not null
    union all
    select 'i', row_number() over (), item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') from benchmark where text is not null
), items as (
    select row, id, least(5, len(w)) as width, w from words where side = 'i' and len(w) > 0
), item_shingles as (
    select distinct row, id, width, array_to_string(w[p : p + width - 1], ' ') as s from items, unnest(range(1, len(w) - width + 2)) as t(p)
), sizes as (
    select row, id, count(*) as n_shingles from item_shingles group by all
), doc_shingles as (
    select distinct d.row, d.id, k.width, array_to_string(d.w[p : p + k.width - 1], ' ') as s
    from words d, (select distinct width from items) k, unnest(range(1, len(d.w) - k.width + 2)) as t(p) where d.side = 'd'
)
select d.id as doc_id, i.id as item_id, any_value(z.n_shingles) as n_shingles, count(*) as n_common, count(*) / any_value(z.n_shingles) as containment
from doc_shingles d join item_shingles i on d.s = i.s and d.width = i.width join sizes z on z.row = i.row
group by d.row, d.id, i.row, i.id having count(*) >= 0.8 * any_value(z.n_shingles) - 1e-9
"""


OP13_SQL = """
with units as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents
), drawn as (
    select doc_id, text, u, len(u) as n, cast('0x' || h[1:8] as bigint) % (len(u) + 1) as x, cast('0x' || h[9:16] as bigint) % (len(u) + 1) as y,
        cast('0x' || h[17:24] as bigint) % 100 as keep, cast('0x' || h[25:32] as bigint) % 100 as turn from units
), cut as (
    select doc_id, text, n, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or keep >= 90 then 'plain' when turn < 20 then 'spm' else 'psm' end as form,
        coalesce(array_to_string(u[1 : least(x, y)], ''), '') as prefix, coalesce(array_to_string(u[least(x, y) + 1 : greatest(x, y)], ''), '') as middle, coalesce(array_to_string(u[greatest(x, y) + 1 :], ''), '') as suffix from drawn
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256 from cut
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_licenses": licenses.scan_sql(), "op5_decontaminate": OP5_SQL, "op13_fillmiddle": OP13_SQL}
