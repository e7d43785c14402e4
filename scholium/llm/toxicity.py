"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

A word is a path of letters from its beginning. At each place of the path both classes, toxic and ordinary, predict what
comes next: each from its own counts there, less a discount, and for the rest from the counts of all labelled texts
together, which back off in turn to what Kneser and Ney count: in how many different words a letter follows another.
So an expression that is rare in a class tells little. The logarithm of the two predictions' ratio is the evidence of
that place; under EVIDENCE in size, and where a class has not come by at all, it counts as none. A word's ratio is the
sum along its path, which is the log-likelihood ratio of the word, and its path ends where training texts end, so
unseen forms of a known stem count as the stem does. What a ratio has over STRONG counts: a text is judged by its mean
over all words, which is by the text's length, and by the three words with the most, so that a few expressions in a long
text show; a logistic regression makes a score between 0 and 1 of these four numbers. A word counts once a text. Of a
run of more than LONGEST letters, and of scripts without spaces, each letter begins a word of SPAN letters.

Counts are of all labelled rows that are not held out (crc32 of the id leaves 2 modulo 4). They stay distributed, by
word, and the ratios of paths are a stored table, so all that is learned grows with the corpus, and no n-grams share
buckets. Workers get a bit table of fixed size that tells which paths can have a ratio over STRONG: what passes it is
joined with the table. Only LETTER_PAIRS numbers and the regression's rows reach the driver. The regression is fitted
with counts of two thirds of the labelled rows on rows of the last third, on CALIBRATION rows of each class at most,
drawn by a hash of the id.

Null and empty texts get the score of a text without evidence; texts are read whole, whatever their length, and an
empty table gives an empty result. An id that is labelled more than once is toxic if any of its labels says so; null
labels and ids are ignored, and rows that share an id share its label. With no labels of one class, every score is the
share of toxic rows. Equal texts have equal scores; each row gets its result. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, stored, text_list, text_slices
from .language import _word, last_of

DISCOUNT = 0.75
#: Occurrences that the shared counts weigh beside a class's own.
BACKOFF = 4.0
#: Evidence of a place that counts, as a natural logarithm.
EVIDENCE = 0.25
#: What a word's ratio must have over it to count: a factor of e.
STRONG = 1.0
CALIBRATION = 10_000
THRESHOLD = 0.3
#: Bits of the tables of marked ids and of paths (8 MB).
FILTER_BITS = 1 << 26
LETTER_PAIRS = 1 << 16
#: Letters of a path whose counts are kept by one task, with all that begins with them.
STEM = 3
LONGEST = 40
SPAN = 8
#: Distinct words that a worker keeps from slice to slice.
MEMO_WORDS = 150_000
FEATURES = 4
END = b"\0"


@lru_cache(1)
def _unspaced() -> re.Pattern:
    """Letters of scripts that are written without spaces: Thai to Tibetan, Myanmar, Khmer, Han and Kana."""
    return re.compile("[฀-࿿က-႟ក-៿々-ヿㇰ-ㇿ㐀-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff]")


def terms(text: str) -> set[str]:
    """The different words of a text, in lower case."""
    low = text.lower()
    words = set(_word(last_of(low)).findall(low))
    unspaced = not low.isascii() and _unspaced().search(low) is not None
    cut = [w for w in words if len(w) > LONGEST or unspaced and _unspaced().search(w)]
    if cut:
        words.difference_update(cut)
        words.update(w[i : i + SPAN] for w in cut for i in range(len(w)))
    return words


def _beginnings(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every beginning of each cell, one after another, and where each cell's end."""
    sizes = np.array([len(c) for c in cells], dtype=np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(cells), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    out = np.empty(len(raw), dtype=np.uint64)
    order = np.argsort(-sizes, kind="stable")
    at, h = (ends - sizes)[order], np.full(len(cells), 0x9E3779B97F4A7C15, dtype=np.uint64)
    active = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), side="left")
    for i, n in enumerate(active.tolist()):
        place = at[:n] + i
        h = (h[:n] ^ raw[place]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        out[place] = h
    out *= np.uint64(0x94D049BB133111EB)
    return (out ^ (out >> np.uint64(32))).view(np.int64), ends


def _bits(df: DataFrame, column: Column) -> Broadcast:
    """A table of FILTER_BITS bits with those that the column names set, on all workers."""
    place = column + 1  # Spark numbers a bitmap's places from one
    parts = df.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in parts:
        bits[(r["bucket"] - 1) * len(r["bits"]) : r["bucket"] * len(r["bits"])] = np.frombuffer(r["bits"], dtype=np.uint8)
    return df.sparkSession.sparkContext.broadcast(bits)


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of labels to learn from."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    return marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("part", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4)


def _texts(docs: DataFrame, marks: DataFrame, text: str, id: str) -> DataFrame:
    """(doc_id, text) of documents that can have a mark.

    A bit table of fixed size, made of all marked ids, drops most of the others before their texts are shuffled; the
    join with marks decides.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    shared = _bits(marks, bit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("bit").to_numpy()
            there = (shared.value[at >> 3] >> (at & 7)) & 1
            yield batch.select(["doc_id", "text"]).filter(pa.array(there.astype(bool)))

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    return rows.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", bit.alias("bit")).mapInArrow(run, "doc_id long, text string")


COUNTS = [f"c{i}" for i in range(4)]  # the first two thirds' ordinary and toxic texts, then the last third's
WORD_COUNTS = "word string, " + ", ".join(f"{c} long" for c in COUNTS)


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, c0 to c3): in how many labelled texts of each third and class a word is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[Counter] = [Counter() for _ in COUNTS]

        def portion() -> pa.RecordBatch:
            every = list(dict.fromkeys(w for x in words for w in x))
            cells = [pa.array([x[w] for w in every], pa.int64()) for x in words]
            for x in words:
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *cells], names=["word", *COUNTS])

        for part in text_slices(batches, 1_000_000):
            for t, toxic, p in zip(text_list(part.column("text")), part.column("toxic").to_pylist(), part.column("part").to_pylist(), strict=True):
                words[2 * (p == 1) + toxic].update(terms(t))
            if sum(map(len, words)) > 100_000:
                yield portion()
        yield portion()

    return labelled.mapInArrow(run, WORD_COUNTS).groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _continuations(words: DataFrame) -> np.ndarray:
    """The probability of a byte after another (END before the first), by the number of different words that have the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = np.zeros(LETTER_PAIRS, dtype=np.int64)
        for batch in batches:
            raw = np.frombuffer(END + b"".join(w.encode() + END for w in batch.column("word").to_pylist()), dtype=np.uint8).astype(np.int64)
            kinds += np.bincount(raw[:-1] * 256 + raw[1:], minlength=LETTER_PAIRS)
        at = np.flatnonzero(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(kinds[at])], names=["pair", "n"])

    got = words.select("word").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    kinds = np.zeros(LETTER_PAIRS)
    kinds[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    kinds = kinds.reshape(256, 256)
    after = kinds.sum(axis=1, keepdims=True)
    different = (kinds > 0).sum(axis=1, keepdims=True)
    return (np.maximum(kinds - DISCOUNT, 0) + (DISCOUNT * different + 1) / 256) / (after + 1)


def evidence(counts: list[tuple[int, int]], low: list[float]) -> list[float]:
    """log P(next | toxic) - log P(next | ordinary) at a place, for what came next there with (ordinary, toxic) counts; low: of the shared letter pairs."""
    sums = [sum(c[k] for c in counts) for k in (0, 1)]
    if not sums[0] or not sums[1]:
        return [0.0] * len(counts)
    kinds = [sum(c[k] > 0 for c in counts) for k in (0, 1)]
    total, different = sum(sums), sum(a + b > 0 for a, b in counts)
    out = []
    for (a, b), q in zip(counts, low, strict=True):
        shared = (max(a + b - DISCOUNT, 0) + DISCOUNT * different * q) / total
        p0, p1 = ((max(n - DISCOUNT, 0) + (BACKOFF + DISCOUNT * kinds[k]) * shared) / (sums[k] + BACKOFF) for k, n in ((0, a), (1, b)))
        r = math.log(p1 / p0) if p0 > 0 and p1 > 0 else 0.0
        out.append(r if abs(r) >= EVIDENCE else 0.0)
    return out


def _paths(words: DataFrame, pairs: Broadcast, least: int, most: int | None = None) -> DataFrame:
    """(node, path, fitted, full): the paths with evidence there, and the nodes on them, of places behind the first `least` letters and before the end of the first `most`.

    Words with the same first `least` letters are in one task, in order: paths part where neighbours differ. A task
    holds the path to its last word, with what came next along it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = pairs.value
        found: list[tuple[bytes, float, float]] = []
        parted: list[tuple[int, list[tuple[int, tuple[int, ...]]]]] = []  # bytes before the place, what came next so far
        cell, word, now = b"", "", (0, 0, 0, 0)

        def settle(common: int) -> None:
            """Ends the places behind the first `common` bytes: nothing more comes there."""
            nonlocal now
            lo = len(word[:least].encode()) if len(word) >= least else len(cell)
            hi = len(cell) if most is None or len(word) < most else len(word[:most].encode())
            while parted and parted[-1][0] > common:
                depth, nexts = parted.pop()
                nexts.append((cell[depth], now))
                counts = [c for _, c in nexts]
                if lo <= depth < hi and any(c[1] or c[3] for c in counts):
                    q = low[cell[depth - 1] if depth else 0][[b for b, _ in nexts]].tolist()
                    fitted = evidence([(c[0], c[1]) for c in counts], q)
                    full = evidence([(c[0] + c[2], c[1] + c[3]) for c in counts], q)
                    found.extend((cell[:depth] + bytes((b,)), x, y) for (b, _), x, y in zip(nexts, fitted, full, strict=True) if x or y)
                now = tuple(map(sum, zip(*counts)))

        def portion() -> pa.RecordBatch:
            hashes, ends = _beginnings([p for p, _, _ in found])
            path = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(hashes))
            cells = [pa.array(hashes[ends - 1]), path, pa.array([x for _, x, _ in found], pa.float64()), pa.array([y for _, _, y in found], pa.float64())]
            found.clear()
            return pa.RecordBatch.from_arrays(cells, names=["node", "path", "fitted", "full"])

        for batch in batches:
            for next_word, *counts in zip(batch.column("word").to_pylist(), *(batch.column(c).to_pylist() for c in COUNTS)):
                following = next_word.encode() + END
                if cell:
                    common = len(commonprefix((cell, following)))
                    settle(common)
                    if not parted or parted[-1][0] < common:
                        parted.append((common, []))
                    parted[-1][1].append((cell[common], now))
                cell, word, now = following, next_word, tuple(counts)
            if len(found) > 50_000:
                yield portion()
        settle(-1)
        yield portion()

    return words.sortWithinPartitions("word").mapInArrow(run, "node long, path array<long>, fitted double, full double")


def paths(words: DataFrame, pairs: Broadcast) -> DataFrame:
    """(node, path, fitted, full) of all places: those behind the first STEM letters by these, those before by the first letter, the first itself in one task."""
    sums = [F.sum(c).alias(c) for c in COUNTS]
    stems = words.groupBy(F.left("word", F.lit(STEM)).alias("word")).agg(*sums)
    firsts = stems.groupBy(F.left("word", F.lit(1)).alias("word")).agg(*sums)
    deep = _paths(words.repartition(F.left("word", F.lit(STEM))), pairs, STEM)
    middle = _paths(stems.repartition(F.left("word", F.lit(1))), pairs, 1, STEM)
    return deep.union(middle).union(_paths(firsts.coalesce(1), pairs, 0, 1))


def ratios(found: DataFrame) -> DataFrame:
    """(node, depth, fitted, full) from stored paths() rows: the sums of evidence along each path, of those that make a difference to what is over STRONG."""
    on = found.select("node", F.explode("path").alias("at"))
    own = found.select(F.col("node").alias("at"), "fitted", "full")
    sums = on.join(own, "at").groupBy("node").agg(F.sum("fitted").alias("fitted_sum"), F.sum("full").alias("full_sum"))
    both = found.select("node", F.size("path").alias("depth"), "fitted", "full").join(sums, "node")
    largest = F.greatest("fitted_sum", "full_sum", F.col("fitted_sum") - F.col("fitted"), F.col("full_sum") - F.col("full"))
    return both.filter(largest > STRONG).select("node", "depth", F.round("fitted_sum", 9).alias("fitted"), F.round("full_sum", 9).alias("full"))


@dataclass
class Model:
    """The ratios of paths, the bit table of their nodes, and the regression."""

    nodes: DataFrame  # (node, depth, fitted, full)
    bits: Broadcast | None
    weights: np.ndarray  # of the features, then the constant
    share: float | None = None  # set if there is nothing to tell classes apart by


class _Finder:
    """Which words of texts can have a strong ratio, and at which nodes; keeps what it found from slice to slice."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.seen, self.nodes = bits, set(), {}

    def __call__(self, texts: list[str]) -> tuple[list[int], list[list[list[int]]]]:
        """The number of words of each text, and the nodes of each of its words that have any."""
        if len(self.seen) > MEMO_WORDS:
            self.seen, self.nodes = set(), {}
        found = [terms(t) for t in texts]
        new = sorted(set().union(*found) - self.seen)
        for lo in range(0, len(new), 100_000):
            some = new[lo : lo + 100_000]
            hashes, ends = _beginnings([w.encode() + END for w in some])
            bit = hashes & (FILTER_BITS - 1)
            there = np.flatnonzero((self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
            for w, h in zip(np.searchsorted(ends, there, side="right").tolist(), hashes[there].tolist(), strict=True):
                self.nodes.setdefault(some[w], []).append(h)
        self.seen.update(new)
        return [len(x) for x in found], [[self.nodes[w] for w in sorted(x & self.nodes.keys())] for x in found]


def _features(docs: DataFrame, bits: Broadcast, nodes: DataFrame, column: str, text: str, keep: list[str], name: str) -> DataFrame:
    """docs' columns of `keep`, and the features x0 to x3 of its texts, 0 for a text without strong words.

    Words that may be strong are joined with their ratios once for each different text.
    """
    key = [F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("key"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).alias("size")]
    rows = docs.select(*[F.col(c).cast("long").alias(c) for c in keep], *key, F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(bits.value)
        kind = pa.list_(pa.list_(pa.int64()))
        for part in text_slices(batches, 1_000_000):
            n, hits = finder(text_list(part.column("text")))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in (*keep, "key", "size")], pa.array(n, pa.int64()), pa.array(hits, kind)], names=[*keep, "key", "size", "n", "hits"])

    schema = "".join(f"{c} long, " for c in keep) + "key long, size int, n long, hits array<array<long>>"
    marked = stored(rows.mapInArrow(run, schema), name)
    some = marked.filter("size(hits) > 0")
    of_text = some.groupBy("key", "size").agg(F.first("n").alias("n"), F.first("hits").alias("hits"))
    at = of_text.select("key", "size", "n", F.posexplode("hits").alias("word", "nodes")).select("key", "size", "n", "word", F.explode("nodes").alias("node"))
    met = at.join(nodes.select("node", "depth", F.col(column).alias("r")), "node")
    words = met.groupBy("key", "size", "n", "word").agg(F.max(F.struct("depth", "r"))["r"].alias("r")).filter(F.col("r") > STRONG).withColumn("r", F.col("r") - STRONG)
    texts = words.groupBy("key", "size", "n").agg(F.sum("r").alias("all"), F.slice(F.sort_array(F.collect_list("r"), False), 1, 3).alias("top"))
    cells = [F.col("all") / F.col("n"), *[F.coalesce(F.get("top", F.lit(i)), F.lit(0.0)) for i in range(3)]]
    cells = [F.round(c, 9).alias(f"x{i}") for i, c in enumerate(cells)]
    joined = some.drop("n", "hits").join(texts.select("key", "size", *cells), ["key", "size"], "left").select(*keep, *[F.coalesce(f"x{i}", F.lit(0.0)).alias(f"x{i}") for i in range(FEATURES)])
    return marked.filter("size(hits) = 0").select(*keep, *[F.lit(0.0).alias(f"x{i}") for i in range(FEATURES)]).union(joined)


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression and its constant, by Newton steps with a small ridge."""
    scale = 1 / np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack((x * scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w * np.append(np.where(x.std(axis=0) > 0, scale, 0.0), 1.0)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", calibration: int = CALIBRATION) -> Model:
    marks = _marks(labels)
    texts = _texts(docs, marks, text, id)
    words = stored(word_counts(texts.join(marks, "doc_id")), "toxicity-words")
    pairs = docs.sparkSession.sparkContext.broadcast(_continuations(words))
    nodes = stored(ratios(stored(paths(words, pairs), "toxicity-paths")), "toxicity-ratios")
    bits = _bits(nodes, F.col("node").bitwiseAND(F.lit(FILTER_BITS - 1)))
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    nothing = np.zeros(FEATURES + 1)
    if not sizes.get(0) or not sizes.get(1):
        return Model(nodes, bits, nothing, float(min(1, sizes.get(1, 0))))
    last = [marks.filter((F.col("part") == 1) & (F.col("toxic") == c)).orderBy(F.xxhash64(F.lit("calibration"), "doc_id"), "doc_id").limit(calibration) for c in (0, 1)]
    drawn = texts.join(F.broadcast(last[0].union(last[1]).drop("part")), "doc_id")  # at most 2 * calibration ids
    got = _features(drawn, bits, nodes, "fitted", "text", ["toxic"], "toxicity-drawn").toArrow()
    y = got.column("toxic").to_numpy().astype(np.float64)
    if not 0 < y.sum() < len(y):
        return Model(nodes, bits, nothing, sizes[1] / (sizes[0] + sizes[1]))
    weights = _fit(np.column_stack([got.column(f"x{i}").to_numpy() for i in range(FEATURES)]), y)
    drawn_odds = math.log(y.sum() / (len(y) - y.sum()))
    weights[-1] += math.log(sizes[1] / sizes[0]) - drawn_odds  # the classes' shares among all labelled rows
    return Model(nodes, bits, weights)


def score(docs: DataFrame, model: Model, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if model.share is not None:
        found = rows.select("doc_id", F.lit(model.share).alias("score"))
    else:
        *weights, constant = model.weights.tolist()
        x = sum((F.col(f"x{i}") * F.lit(w) for i, w in enumerate(weights)), F.lit(constant))
        scored = 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(30.0)), F.lit(-30.0))))
        found = _features(rows, model.bits, model.nodes, "full", "text", ["doc_id"], "toxicity-texts").select("doc_id", scored.alias("score"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
