"""Whitening against a plain computation over Python's whole numbers and numpy's covariance."""

import math

import duckdb
import numpy as np
import pytest

from scholium.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"


def plain(rows, k=16):
    """By vec_id position: n, deviation, whitened up to sign, explained."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for _, v in usable]
    distinct = sorted(set(xs))
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(d)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in distinct])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for (i, _), x in zip(usable, xs):
        apart = [n * a - s for a, s in zip(x, sums)]
        out.append((i, n, sum(a * a for a in apart), [float(np.array(apart) / n @ axes[:, j] / math.sqrt(values[j])) if values[j] > 1e-9 else None for j in range(min(k, d))], [values[j] / np.trace(covariance) for j in range(min(k, d))]))
    return out


def compare(got, want):
    """got: rows of components(); want: plain()'s. A component's sign is free, but one for all rows."""
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert sum(map(len, by.values())) == sum(len(w[3]) for w in want)
    signs = {}
    for i, n, deviation, whitened, explained in want:
        for j, (v, e) in enumerate(zip(whitened, explained), 1):
            r = next(r for r in by[i] if r.component == j)
            assert (r.n, r.deviation) == (n, deviation)
            if v is None:
                assert r.whitened is None
                continue
            if abs(v) > 1e-6:
                sign = signs.setdefault(j, math.copysign(1, v * r.whitened))
                assert r.whitened == pytest.approx(sign * v, rel=1e-6, abs=1e-7)
            assert r.explained == pytest.approx(e, rel=1e-9)
            assert r.identity_error <= 1e-9


def test_query_against_plain(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SMALL}/embeddings.parquet'").fetchall()
    compare(queries.queries()["op11_whitening"](spark, SMALL).collect(), plain(rows))


def test_copies_do_not_count(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(v) for v in r.normal(size=5) * [4, 3, 2, 1, 0.5]]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(400)]
    rows += [(5000, None), (5001, [1.0, None, 2.0, 3.0, 4.0]), (5002, [1.0, float("nan"), 2.0, 3.0, 4.0]), (5003, [float("-inf")] * 5), (5004, [])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, cell string, n int")
    got = whitening.components(whitening.transform(df, whitening.fit(df))).collect()
    compare(got, plain([x for x in rows if x[1] != []]))
    assert not {r.vec_id for r in got} & {5000, 5001, 5002, 5003, 5004}


def test_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 5.0]), (2, [0.5, 2.0]), (3, [7.0]), (4, [7.0]), (5, [1e300, 1.0, 2.0]), (6, [0.0, 1.0, 5.0]), (7, [1.0, -1e300, 2.0])], "vec_id long, embedding array<double>")
    got = whitening.components(whitening.transform(df, whitening.fit(df))).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted([("1", 1), ("1", 2)] * 2 + [("None", 1), ("None", 2), ("2", 1), ("2", 2), ("3", 1), ("4", 1)] + [(i, j) for i in "567" for j in (1, 2, 3)])
    alone = [r for r in got if r.vec_id in (3, 4)]
    assert all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in alone)
    assert all(r.whitened is None and r.explained == 0 for r in got if r.vec_id == 6 and r.component == 3)
    empty = df.filter("false")
    assert whitening.components(whitening.transform(empty, whitening.fit(empty))).count() == 0
    assert whitening.transform(df, whitening.fit(empty)).count() == 0


def test_exact_where_longs_do_not_hold():
    x = np.array([[1 << 40, -(1 << 52)], [3, 5]])
    n, sums = 1 << 30, [17, -(1 << 60)]
    apart = whitening.spread(x, n, sums)
    assert apart.tolist() == [[a * n - s for a, s in zip(row, sums)] for row in x.tolist()]
    assert whitening.deviation(apart) == [sum(v * v for v in row) for row in apart.tolist()]
    cells = whitening.packed(x)
    assert [len(c.as_py()) for c in cells] == [16, 4]
