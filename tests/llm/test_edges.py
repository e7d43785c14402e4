"""Every corpus operator over nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scholium.llm import bpe, decontaminate, extraction, language, licenses, linededup, simhash, telephony, tokenids, toxicity

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
TEXTS = [
    (1, "The cat sat on the mat and was happy about it."), (2, "Der Hund ist nicht im Haus und die Katze auch nicht."), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, "The cat sat on the mat and was happy about it."),
    (7, "The cat sat on the mat and was happy about it."), (None, "a row without an id"), (None, None), (8, "\n".join(["same line of words"] * 50)), (9, "日本語の文章です。 Mixed ΟΔΟΣ text <|endoftext|>"), (10, "123 456 !!! ---"), (-3, "x"),
]
CLASHING = ["fingerprint", "component_id", "hash", "row", "line", "ids", "score", "k", "fp", "h", "first", "toxic", "runs", "text_", "_id", "id", "words", "value", "part", "frame", "start", "payload", "media"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][n % 3], f"src{n % 2}", None if t is None else len(t)) for n, (i, t) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (6, 0), (7, None), (None, 1), (8, 1), (8, 0)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "the cat sat on the mat and was happy"), (2, None), (3, ""), (4, "..."), (None, "a row without an id"), (1, "the cat sat on the mat and was happy"), (5, "x")], "item_id long, text string")


def operators(benchmark, labels):
    return {
        "licenses": lambda d: licenses.scan(d),
        "tokenids": lambda d: tokenids.digests(d),
        "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels)),
        "simhash": lambda d: simhash.near_duplicates(d),
        "linededup": lambda d: linededup.report(d),
        "telephony": lambda d: telephony.digests(d),
        "language": lambda d: language.identify(d, language.train(d)),
        "bpe": lambda d: bpe.digests(d),
    }


@pytest.mark.parametrize("name", ["licenses", "tokenids", "toxicity", "simhash", "linededup", "telephony", "language", "bpe"])
def test_one_row_for_each_row(name, docs, labels, benchmark):
    out = operators(benchmark, labels)[name](docs).collect()
    assert sorted(map(str, (r["doc_id"] for r in out))) == sorted(str(i) for i, _ in TEXTS)
    assert operators(benchmark, labels)[name](docs.filter("false")).collect() == []


def test_equal_texts_have_equal_results(docs, labels, benchmark):
    for name in ("licenses", "toxicity", "simhash", "telephony", "language", "bpe"):
        out = operators(benchmark, labels)[name](docs).filter("doc_id in (1, 7)").drop("doc_id", "held_out").distinct()
        assert out.count() == 1, name


def test_decontamination(docs, benchmark):
    found = decontaminate.find(docs, benchmark)
    assert sorted((str(r.doc_id), str(r.item_id)) for r in found.collect()) == sorted([("1", "1")] * 2 + [("7", "1")] * 4 + [("None", "None"), ("-3", "5")])
    kept = decontaminate.filtered(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(["2", "3", "4", "5", "6", "8", "9", "10", "None"])
    assert decontaminate.find(docs.filter("false"), benchmark).count() == 0
    assert decontaminate.find(docs, benchmark.filter("false")).count() == 0
    assert decontaminate.filtered(docs, benchmark.filter("false")).count() == docs.count()


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (4, "u", "<article><p>One &amp;  two.</p></article>"), (4, "u", "<article><p>One &amp;  two.</p></article>"), (5, "u", "<article><p>" + "word " * 200_000 + "</p></article>"), (6, "u", "<" * 3000 + "<div " * 500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))
    out = extraction.extract(pages).collect()
    assert len(out) == len(rows)
    texts = {r.page_id: r.text for r in out}
    assert texts[1] == texts[2] == "" and texts[4] == "One & two." and len(texts[5]) == 999_999
    assert extraction.extract(pages.filter("false")).count() == 0


def test_pipeline_stages_keep_columns(spark, docs, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, str(tmp_path))
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        after.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
    assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() == now.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter("false"), str(tmp_path)).count() == 0
