"""Line dedup against a comparison of every run of lines with all earlier ones."""

import random
import re

from scholium.llm import linededup


def every_run(docs):
    cut = re.compile(linededup.BOUNDARY.replace(r"\p{Lu}", "[A-Z]").replace(r"\p{Ll}", "[a-z]"))
    lines = {i: cut.split(t) for i, t in sorted(docs.items())}
    seen, gone = set(), {i: set() for i in docs}
    for i, own in lines.items():
        plain = [x.strip(" \t\r\n") for x in own]
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                run = tuple(plain[a:b])
                if sum(len(x.encode()) + 1 for x in run) < linededup.LEAST:
                    continue
                if run in seen:
                    gone[i].update(range(a, b))
                seen.add(run)
    return {i: (len(gone[i]), "".join(x for k, x in enumerate(own) if k not in gone[i])) for i, own in lines.items()}


def found(spark, docs):
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    return {r.doc_id: (r.n_deleted, r.text) for r in linededup.report(df, boundary=linededup.BOUNDARY).collect()}


def test_lines_that_stood_alone_before(spark):
    line = lambda c, n: c * n + "\n"
    passage = line("b", 60) + line("x", 60) + line("c", 60)
    docs = {n: line("x", 60) for n in range(1)} | {n + 1: line(c, 60) for n, c in enumerate("bc")}
    docs |= {10: line("p", 30) + passage, 11: line("q", 30) + passage, 12: line("b", 60) + line("x", 60)}
    got = found(spark, docs)
    assert got[10] == (0, docs[10]) and got[11] == (4, line("q", 30)) and got[12] == (0, docs[12])


def test_every_run_of_lines(spark):
    r = random.Random(11)
    pool = ["".join(r.choices("abcdefgh ", k=r.choice([1, 5, 20, 50, 79, 100, 170]))).strip() for _ in range(14)] + [""]
    chunk = lambda: [r.choice(pool) for _ in range(r.randint(2, 12))]
    chunks = [chunk() for _ in range(12)]
    docs = {i: "\n".join(x for _ in range(r.randint(1, 5)) for x in (r.choice(chunks) if r.random() < 0.6 else chunk())) + "\n" for i in range(80)}
    want = every_run(docs)
    assert sum(n for n, _ in want.values()) > 300
    assert found(spark, docs) == want


def test_white_space_of_runs(spark):
    indented = "".join(f"            {c} = {n}\n" for n, c in enumerate("abcdefghijkl"))
    docs = {1: indented, 2: "z\n" + indented, 3: "\n".join("w" * 50 for _ in range(3)) + "\n" + "v" * 30, 4: "\r\n".join("  " + "w" * 50 for _ in range(3)) + "  \r\n" + "v" * 30}
    got = found(spark, docs)
    assert got[2] == (13, "z\n") and got[4][0] == 4 and got[1] == (0, indented) and got[3] == (0, docs[3])


def test_rows_of_one_id(spark):
    a, b = "a" * 200 + "\n", "b" * 200 + "\n"
    df = spark.createDataFrame([(1, a), (2, b + "own\n" + a), (2, a + "other\n"), (3, b)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in linededup.report(df).collect()) == [(1, a), (2, b + "own\n"), (2, "other\n"), (3, "")]


def test_lines_are_lines(spark):
    """Without BOUNDARY, against a model that knows line feeds only."""
    r = random.Random(11)
    pool = [" ".join(r.choices(["Alpha", "beta", "Gamma", "delta", "Epsilon."], k=r.randint(3, 9))) for _ in range(14)]
    chunks = [[r.choice(pool) for _ in range(r.randint(3, 9))] for _ in range(8)]
    docs = {i: "\n".join(x for _ in range(r.randint(1, 3)) for x in (r.choice(chunks) if r.random() < 0.6 else [r.choice(pool)])) + r.choice(["", "\n"]) for i in range(40)}
    seen, want = set(), {}
    for i, text in docs.items():
        own = text.splitlines(keepends=True) + ([""] if text.endswith("\n") else [])
        plain, gone = [x.strip(" \t\r\n") for x in own], set()
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                if sum(len(x.encode()) + 1 for x in plain[a:b]) >= linededup.LEAST:
                    if tuple(plain[a:b]) in seen:
                        gone.update(range(a, b))
                    seen.add(tuple(plain[a:b]))
        want[i] = (len(gone), "".join(x for k, x in enumerate(own) if k not in gone))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {x.doc_id: (x.n_deleted, x.text) for x in linededup.report(df).collect()} == want
    assert any(n for n, _ in want.values())
