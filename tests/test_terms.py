"""Hits of terms against str.count, which counts places that don't overlap."""

import random

from pyspark.sql import functions as F

from scholium.operators import filters, terms


def test_against_count(spark):
    r = random.Random(1)
    lists = {"a": ["aba", "ab", "a", "aa", "ABAB", "aba"], "b": ["ba", "aba", ""], "none": []}
    rows = [(i, "".join(r.choices("abAB ", k=r.randint(0, 60)))) for i in range(300)] + [(1000, None), (None, "Aba"), (1000, "aaaa")]
    df = spark.createDataFrame([(*x, "clash", 5) for x in rows], "doc_id long, text string, term string, hits int")
    want = sorted((str(i), name, t, (x or "").lower().count(t)) for i, x in rows for name, some in lists.items() for t in {s.lower() for s in some if s} if t in (x or "").lower())
    assert sorted((str(a.doc_id), a.list, a.term, a.hits) for a in terms.term_hits(df, "doc_id", F.col("text"), lists).collect()) == want
    assert terms.term_hits(df.filter("false"), "doc_id", F.col("text"), lists).count() == 0
    assert terms.term_hits(df, "doc_id", F.col("text"), {}).count() == 0


def test_hits_are_what_the_keyword_filter_keeps(spark):
    texts = [(i, f"on {t.upper()}s") for i, t in enumerate(filters.TERMS)] + [(9001, "nothing of the kind"), (9002, "")]
    df = spark.createDataFrame(texts, "id int, text string")
    found = terms.term_hits(df, "id", F.col("text"), {"candidates": filters.TERMS}).select("id").distinct()
    kept = df.filter(filters.has_term(F.col("text"), filters.TERMS)).select("id")
    assert found.exceptAll(kept).count() == kept.exceptAll(found).count() == 0 and found.count() == len(filters.TERMS)
