"""Queries of titles over documents whose first lines are empty or odd, against their SQL."""

import duckdb
import pytest

from scholium.plans import registry

HEADS = [
    "", " ", "  \t", "\t", "The end of a line\r", "A tab \t ", "\tTab first", "Vertical\vtabs here\v", "Hard\xa0spaces here\xa0", "Café naivëté", "Half \xbd\xb2Ⅷ① numeral\xb2 x\xb3", "Join‍ers tie‿d wor＿ds", "...", "One",
    "Unknown", "unknown", "Form\ffeed lines", "Line ends \x85here", "a.b-c_d long_word", "The Deep End", "The  Deep End ", "Über Ärger ß",
]


@pytest.fixture
def folder(spark, tmp_path):
    texts = [f"{h}\nBody {i}" for i, h in enumerate(HEADS)] + ["", None, "Über Ärger ß"]
    rows = [(i, t, "ende"[i % 2 * 2 :][:2], f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts * 21)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def same(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    df = registry.queries()[name](spark, folder)
    want = con.execute(f"select {', '.join(df.columns)} from ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_keys(spark, folder):
    same(spark, folder, "q_bibtex_keys")


def test_blocks(spark, folder):
    same(spark, folder, "q_document")
