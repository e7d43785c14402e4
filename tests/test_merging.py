"""Batches through the stream give what one merge over all rows gives."""

import json
import os
import random

import pytest

from scholium.operators import dedup
from scholium.streaming import ingest, merging

KIND = "arrival long, doi string, fp string, source string, title string, abstract string, url string, venue string, citation_count int, concepts array<string>"


def record(i, r):
    some = lambda *x: r.choice([None, "", *x])
    return {"arrival": i, "doi": some(*[f"d{k}" for k in range(25)]), "fp": f"f{r.randrange(40)}", "source": r.choice("abc"), "title": f"t{i}", "abstract": some(f"x{i}"), "url": some(f"u{i}"), "venue": None, "citation_count": r.choice([None, 0, i]), "concepts": r.choice([None, [], ["p"], ["q", "p"]])}


def same(got, want):
    key = lambda df: sorted(json.dumps(x.asDict(), sort_keys=True) for x in df.collect())
    assert key(got) == key(want.select(*got.columns))


@pytest.mark.parametrize("seed", [1, 2])
def test_three_batches(spark, tmp_path, seed):
    r = random.Random(seed)
    rows = [record(i, r) for i in range(120)]
    folder = f"file://{tmp_path}/state"
    assert merging.merged(spark, folder) is None
    for number, (a, b) in enumerate([(0, 50), (50, 70), (70, 120)]):
        merging.merge_batch(spark.createDataFrame(rows[a:b], KIND), number, folder)
        want = dedup.merge(spark.createDataFrame(rows[:b], KIND))
        same(merging.merged(spark, folder), want)
        of = {x.arrival: x.founder for x in dedup.founders(spark.createDataFrame(rows[:b], KIND)).collect()}
        touched = {of[i] for i in range(a, b)}
        assert {x.arrival for x in merging.changed(spark, folder, number).collect()} == touched
    merging.merge_batch(spark.createDataFrame(rows[:50], KIND), 0, folder)  # whole already
    same(merging.merged(spark, folder), dedup.merge(spark.createDataFrame(rows, KIND)))


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.write("\n".join(map(json.dumps, rows)))
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def test_stream_and_restart(spark, tmp_path, monkeypatch):
    r = random.Random(3)
    rows = [record(i, r) for i in range(90)]
    landing, folder, checkpoint = f"{tmp_path}/in", f"file://{tmp_path}/state", f"{tmp_path}/checkpoint"
    stream = lambda: ingest.landed(spark, landing, KIND, files=1)
    land(landing, "a.json", rows[:30])
    merging.merge_stream(stream(), folder, checkpoint).awaitTermination()
    same(merging.merged(spark, folder), dedup.merge(spark.createDataFrame(rows[:30], KIND)))

    land(landing, "b.json", rows[30:60])
    real = merging._finish
    with monkeypatch.context() as m:  # killed when all is written but the mark
        m.setattr(merging, "_finish", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivisionError"):
            merging.merge_stream(stream(), folder, checkpoint).awaitTermination()
    assert merging.last_batch(spark, folder) == 0
    same(merging.merged(spark, folder), dedup.merge(spark.createDataFrame(rows[:30], KIND)))

    def late(*a):  # killed between the mark and the checkpoint's commit
        real(*a)
        raise RuntimeError("late")

    with monkeypatch.context() as m:
        m.setattr(merging, "_finish", late)
        with pytest.raises(Exception, match="late"):
            merging.merge_stream(stream(), folder, checkpoint).awaitTermination()
    same(merging.merged(spark, folder), dedup.merge(spark.createDataFrame(rows[:60], KIND)))
    land(landing, "c.json", rows[60:])
    merging.merge_stream(stream(), folder, checkpoint).awaitTermination()
    assert merging.last_batch(spark, folder) == 2
    same(merging.merged(spark, folder), dedup.merge(spark.createDataFrame(rows, KIND)))
