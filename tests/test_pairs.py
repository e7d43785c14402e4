"""Pairs of names and titles against plain versions, on hot names and hot titles."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from scholium.operators import match
from scholium.sources import roster


@pytest.mark.parametrize("seed", [1, 2])
def test_beginnings(spark, seed):
    r = random.Random(seed)
    firsts = ["c", "ch", "chris", "christopher", "chr", "dana", "d", "do", "dorothy", "álex", "al"]
    side = lambda n: [(i, f"{r.choice(firsts)}{r.choice([' x', ''])} {r.choice(['hot', 'hot', 'hot', 'rare'])}") for i in range(n)] + [(n, ""), (n + 1, None), (n + 2, "hot")]
    left, right = side(60), side(50)
    fold = lambda n: (n or "").replace("á", "a").split()
    want = sorted((i, j) for i, a in left for j, b in right for x in [fold(a)] for y in [fold(b)] if x and y and x[-1] == y[-1] and (x[0].startswith(y[0]) or y[0].startswith(x[0])))
    got = match.same_person(spark.createDataFrame(left, "id int, name string"), spark.createDataFrame(right, "id int, name string"))
    assert sorted(map(tuple, got.collect())) == want


def test_a_hot_last_name_is_dealt_out(spark):
    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, "".join(r.choices(letters, k=8)) + " hot") for i in range(20_000)]
    df = spark.createDataFrame(rows, "id int, name string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        pairs = match.same_person(df, df)
        sizes = [n for (n,) in pairs.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) >= 20_000 and max(sizes) < 0.2 * sum(sizes)
        began = time.time()
        pairs.count()
        assert time.time() - began < 30
    finally:
        for key, value in (("spark.sql.adaptive.enabled", "true"), ("spark.sql.autoBroadcastJoinThreshold", "10485760"), ("spark.sql.shuffle.partitions", "4")):
            spark.conf.set(key, value)


def plain_best(ours, candidates, least=0.85):
    bag = lambda t: set(re.findall("[a-z0-9]+", (t or "").lower()))
    out = {}
    for i, title, year, names in ours:
        found = []
        for j, other, y, theirs, rank in candidates:
            a, b = bag(title), bag(other)
            if not a or not b or len(a & b) / max(len(a), len(b)) < least - 1e-12:
                continue
            known = bool(year) and bool(y)
            if known and abs(year - y) > 1:
                continue
            shared = bool(set(names or []) & set(theirs or []))
            if names and theirs and not shared:
                continue
            found.append((rank, -round(len(a & b) / max(len(a), len(b)) + (0.1 if known and year == y else 0) + (0.05 if shared else 0), 9), j))
        if found:
            rank, score, j = min(found)
            out[i] = (j, round(-score, 6))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_best_titles_against_all_pairs(spark, seed):
    r = random.Random(seed)
    words = "deep nets learn from few data and more of it in time for all".split()
    title = lambda: " ".join(r.sample(words, k=r.choice([2, 7, 8, 9, 10]))) if r.random() < 0.9 else r.choice([None, "", "Deep, nets!"])
    pool = [title() for _ in range(12)]
    cell = lambda: (r.choice([*pool, title()]), r.choice([None, 0, 2019, 2020, 2021, 2023]), r.choice([None, [], ["a"], ["b"], ["a", "b"], ["c"]]))
    ours = [(i, *cell()) for i in range(60)]
    candidates = [(1000 + j, *cell(), r.randrange(2)) for j in range(80)]
    a = spark.createDataFrame(ours, "id int, title string, year int, surnames array<string>")
    b = spark.createDataFrame(candidates, "id int, title string, year int, surnames array<string>, rank int")
    assert {x.id: (x.candidate, x.score) for x in match.best_titles(a, b).collect()} == plain_best(ours, candidates)


def test_ten_thousand_equal_titles_on_each_side(spark):
    ours = spark.range(10_000).select(F.col("id"), F.lit("Annual report of the institute").alias("title"), F.lit(2020).alias("year"), F.array(F.concat(F.lit("n"), (F.col("id") % 5000).cast("string"))).alias("surnames"))
    candidates = ours.select((F.col("id") + 1_000_000).alias("id"), "title", "year", "surnames", F.lit(0).alias("rank"))
    began = time.time()
    got = {x.id: x.candidate for x in match.best_titles(ours, candidates).collect()}
    assert time.time() - began < 60
    assert got == {i: 1_000_000 + i % 5000 for i in range(10_000)}


def test_cache_by_author(spark, tmp_path):
    asked = []

    def harvest(due):
        ids = sorted(x.author_id for x in due.collect())
        asked.append(ids)
        return due.filter("author_id <> 'none'").select("author_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"), F.lit(len(asked)).alias("run"))

    path = f"{tmp_path}/cache"
    people = lambda *x: spark.createDataFrame([(i,) for i in x], "author_id string")
    day = lambda d: F.lit(d).cast("date")
    read = lambda df: sorted(map(tuple, df.select("author_id", "n", "run").collect()))
    assert read(roster.cached(people(), path, harvest, day("2024-01-01"))) == []
    assert read(roster.cached(people("a", "b", "none", None), path, harvest, day("2024-01-01"))) == [(x, n, 2) for x in "ab" for n in (1, 2)]
    assert read(roster.cached(people("a", "c", "none"), path, harvest, day("2024-01-20"))) == [("a", 1, 2), ("a", 2, 2), ("c", 1, 3), ("c", 2, 3)]
    assert read(roster.cached(people("a", "b", "c"), path, harvest, day("2024-01-20"))) == [("a", 1, 2), ("a", 2, 2), ("b", 1, 2), ("b", 2, 2), ("c", 1, 3), ("c", 2, 3)]
    assert read(roster.cached(people("a", "c"), path, harvest, day("2024-02-05"))) == [("a", 1, 4), ("a", 2, 4), ("c", 1, 3), ("c", 2, 3)]
    assert asked == [[], ["a", "b", "none"], ["c"], ["a"]]


def test_sets_are_compared_as_they_are(spark):
    """Words of sets are plain already."""
    from scholium.operators import match

    left, right = (spark.createDataFrame([(t,)], "words string") for t in ("a b c d e f g", "a b c d e f h"))
    found = match.similar_sets(left, right, 0.8)
    assert "translate(" not in found._jdf.queryExecution().analyzed().toString()
    assert [(r["l"][-1], r["r"][-1], round(r["similarity"], 6)) for r in found.collect()] == [("g", "h", 0.857143)]
