"""SimHash near-duplicate groups, found with pivot distance tables.

A fingerprint has 64 bits, each the strict majority of that bit over the XXH64 values of a text's word shingles. Two
fingerprints within `radius` bits are linked; a component is what links reach.

The work is on distinct fingerprints, so copies of one text cost one row. Fingerprints meet under keys of some of
their bit blocks: of `blocks` blocks, at most `radius` hold a differing bit, so each linked pair agrees on all of the
other `blocks - radius`, and has one key in common whichever blocks those are. Under a key, the distances of each
fingerprint to many reference fingerprints (the pivots) are its row of the distance table: by the triangle inequality
two rows that differ by more than `radius` in any column can't be linked, and are discarded. Survivors are verified.
A key with more than `crowd` fingerprints is not compared: its fingerprints get more, narrower keys, and in the last
round a key fixes so many bits that it can hold no more than 2 ** 16 distinct fingerprints. No pair is lost, and what
one task compares is bounded whatever the data.

From each key come the edges of a spanning forest, at most one a fingerprint, never all pairs.

Null texts count as empty; a text with no word has fingerprint 0 and is linked like any other; one of fewer words than
a shingle has the whole sequence as its only shingle. Texts are taken whole, whatever their length; an empty table gives
an empty result. Repeated rows each get their result; a component of equal texts is no tie, it has the smallest of its
ids. Rows with a null id get the component of their fingerprint, whose id is the smallest non-null one in it (null if
there is none). Other columns are ignored, and kept by deduplicated() whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_list, text_slices
from .components import components

PIVOTS = np.array([xxhash.xxh64_intdigest(f"pivot {i}", 42) for i in range(32)], dtype=np.uint64)
#: Blocks by round; a key fixes all but `radius` of them.
ROUNDS = (6, 9, 16)


def fingerprint(text: str | None, width: int = 4) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - width + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)])
    counts = np.zeros(64, dtype=np.int64)
    hashes = np.frombuffer(raw, dtype=np.uint8).reshape(n, 8)
    for at in range(0, n, 65536):
        counts += np.unpackbits(hashes[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed 64-bit number, text_hash tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            fps = np.array([fingerprint(t, width) for t in text_list(part.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def _keys(fp: Column, blocks: int, radius: int) -> Column:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    spans = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    masks = [sum(spans[i] for i in some) for some in combinations(range(blocks), max(1, blocks - radius))]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.array(*[F.xxhash64(F.lit(j), fp.bitwiseAND(F.lit(m))) for j, m in enumerate(signed)])


def linked(keys: np.ndarray, fps: np.ndarray, radius: int, pivots: np.ndarray = PIVOTS) -> np.ndarray:
    """For rows sorted by key: the row that stands for each row's group among those of its key."""
    n = len(keys)
    label = np.arange(n)
    distance = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)

    def survivors(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = np.arange(len(i))
        for lo in range(0, len(pivots), 8):  # most pairs go at the first columns
            a, b = i[keep], j[keep]
            keep = keep[np.abs(distance[a, lo : lo + 8] - distance[b, lo : lo + 8]).max(axis=1, initial=0) <= radius]
        i, j = i[keep], j[keep]
        near = np.bitwise_count(fps[i] ^ fps[j]) <= radius
        return i[near], j[near]

    def join(i: np.ndarray, j: np.ndarray) -> None:
        while len(i):  # labels are roots here, and only a root is moved: what it stands for comes along
            a, b = label[i], label[j]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := label[label], label):
                label[:] = up
            open_ = label[i] != label[j]
            i, j = i[open_], j[open_]

    shift, at = 1, np.arange(n)
    while True:
        at = at[at + shift < n]
        at = at[keys[at] == keys[at + shift]]
        if not len(at):
            break
        for lo in range(0, len(at), 1 << 18):
            i = at[lo : lo + (1 << 18)]
            j = i + shift
            apart = label[i] != label[j]
            if apart.any():
                join(*survivors(i[apart], j[apart]))
        shift += 1
    return label


def _forest(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = np.empty(0, np.int64), np.empty(0, np.uint64)

        def edges(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            label = linked(k, f, radius)
            own = np.flatnonzero(label != np.arange(len(k)))
            f = f.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(f[own]), pa.array(f[label[own]])], names=["a", "b"])

        for batch in batches:
            k = np.concatenate((held_k, batch.column("k").to_numpy()))
            f = np.concatenate((held_f, batch.column("fp").to_numpy().view(np.uint64)))
            cut = int(np.searchsorted(k, k[-1])) if len(k) else 0  # the last key may go on in the next batch
            if cut:
                yield edges(k[:cut], f[:cut])
            held_k, held_f = k[cut:], f[cut:]
        if len(held_k):
            yield edges(held_k, held_f)

    return run


def rounds_for(n: int, radius: int, crowd: int) -> list[int]:
    """The rounds worth while for n distinct fingerprints: none whose keys would hold over `crowd` even if bits were spread evenly.

    A key of the first round fixes 2 of 6 blocks, 20 bits at least, so from some billion fingerprints on all of its keys
    would be crowded, and all fingerprints would go on; those start with the next round, whose keys fix 35 bits.
    """
    able = [b for b in ROUNDS if b > radius] or [radius + 1]
    fixed = lambda b: (64 // b) * max(1, b - radius)
    return [b for k, b in enumerate(able) if k == len(able) - 1 or n >> fixed(b) <= crowd]


def links(fps: DataFrame, radius: int = 4, crowd: int = 1024) -> DataFrame:
    """(a, b): edges whose components are those of all pairs of distinct fingerprints (column fp) within radius bits."""
    rounds = rounds_for(fps.count(), radius, crowd)
    found, rest = None, fps
    for n, blocks in enumerate(rounds):
        keyed = rest.select("fp", F.explode(_keys(F.col("fp"), blocks, radius)).alias("k"))
        sizes = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        last = n == len(rounds) - 1
        if not last:
            sizes = stored(sizes, "simhash-sizes")
            compared = keyed.join(sizes.filter(F.col("size") <= crowd).select("k"), "k")
        else:
            compared = keyed.join(sizes.select("k"), "k")
        edges = compared.repartition("k").sortWithinPartitions("k").mapInArrow(_forest(radius), "a long, b long")
        found = edges if found is None else found.union(edges)
        if last or sizes.filter(F.col("size") > crowd).isEmpty():
            break
        crowded = sizes.filter(F.col("size") > crowd).select("k")
        rest = stored(keyed.join(crowded, "k", "left_semi").select("fp").distinct(), "simhash-crowded")
    return found.distinct()


def _grouped(docs: DataFrame, text: str, id: str, width: int, radius: int, crowd: int) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for each row of docs; root tells apart components whose smallest ids are the same."""
    marked = stored(fingerprints(docs, text, id, width), "simhash-fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    groups = components(links(distinct.select("fp"), radius, crowd))
    rooted = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(rooted.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = 4, radius: int = 4, crowd: int = 1024) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs."""
    return _grouped(docs, text, id, width, radius, crowd).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = 4, radius: int = 4, crowd: int = 1024) -> DataFrame:
    """The rows of docs that stand for their group: that of the smallest id, once. Rows without id all stay.

    Rows that share an id are judged each by its own text: in different groups each can stay, in one group that of the
    smallest hash does.
    """
    groups = _grouped(docs, text, id, width, radius, crowd).filter("doc_id = component_id")
    kept = groups.groupBy("root", "component_id").agg(F.min("text_hash").alias("kept_hash"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id).cast("long").alias("row_id"), F.xxhash64(F.col(text)).alias("row_hash"))
    named = rows.join(kept, (F.col("row_id") == F.col("component_id")) & (F.col("row_hash") == F.col("kept_hash")), "left_semi").dropDuplicates(["row_id", "row_hash"])
    return named.union(rows.filter("row_id is null")).select("row.*")
