"""Fill-in-the-middle examples against the SQL, a plain version and the exact way back."""

import duckdb
import pytest
from pyspark.sql import functions as F

from scholium.llm import fillmiddle, queries

SMALL = "/root/testdata/sf0.001"


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    found = con.execute(queries.oracle_sql()["op13_fillmiddle"])
    names = [d[0] for d in found.description]
    got = queries.queries()["op13_fillmiddle"](spark, SMALL)
    assert got.columns == names
    got, want = sorted(map(tuple, got.collect())), sorted(found.fetchall())
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert len({r[0] for r in got}) == len(got)


@pytest.mark.parametrize("seed", [1, 7])
def test_way_back(spark, seed):
    rows = [(i, f"Word{i} and {i * 7} more, <P or S> \n日本語 {'x' * (i % 5)}" * (i % 4)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "has <M> a mark"), (None, "no id"), (None, None), (3, rows[3][1]), (1003, "a" * 400_000), (1004, "." * 400_000), (1005, "<<S"), (1006, "S>P>M>")]
    df = spark.createDataFrame([(*r, "clash", 2) for r in rows], "doc_id long, text string, output string, n int")
    got = fillmiddle.transform(df, seed=seed).withColumn("back", fillmiddle.restore("output", "form")).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.back == (texts[r.doc_id] or "")
        if r.form == "plain":
            assert r.prefix_chars is None and r.output == r.back
        else:
            p, m = r.back[: r.prefix_chars], r.back[r.prefix_chars : r.prefix_chars + r.middle_chars]
            s = r.back[len(p) + len(m) :]
            assert r.output == (f"<P>{p}<S>{s}<M>{m}" if r.form == "psm" else f"<S>{s}<P>{p}<M>{m}")
            assert not (p[-1:].isascii() and p[-1:].isalpha() and (m + s)[:1].isascii() and (m + s)[:1].isalpha())
    assert {r.form for r in got if r.doc_id in (1000, 1001, 1002)} == {"plain"}
    assert len({tuple(r) for r in got if r.doc_id == 3}) == 1
    assert sorted(r.back for r in got if r.doc_id is None) == ["", "no id"]
    assert fillmiddle.digests(df.filter("false")).count() == 0
    forms = {r.form for r in got}
    assert forms == {"plain", "psm", "spm"}


def test_digests_are_of_transform(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = fillmiddle.transform(df).withColumn("restored", fillmiddle.restore("output", "form"))
    one = one.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
    assert one.exceptAll(fillmiddle.digests(df)).count() == 0
