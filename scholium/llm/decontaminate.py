"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document if at least `least` of its distinct shingles (five words, lower-cased; the whole
item if it has fewer) occur in it. Items are parted by their number of shingles, powers of two apart, and each class has
sketches of its own. An item's sketch is its MinHash values from one permutation, as many as its size needs: of q
shingles a document that contains the item lacks at most q - ceil(least * q), so one more than that is enough for one
of them to be in the document, whatever the document's length. Documents go through the classes one by one, past those
whose items all need more shingles than the document has; what has a sketch value of an item is a candidate, and is
verified by exact shingle containment, word by word.

The benchmark is a stated query set: blocks of about BLOCK_CHARS characters of items are sent to the workers one
after another, and each goes through all documents. Nothing else leaves a task than the matches.

Items and documents that are null or have no word match nothing; empty tables match nothing, and no document goes for an
empty benchmark. Documents are read whole, however long. Repeated items match each for itself, repeated documents too,
so there are no ties; null ids stay null. Other columns are ignored by find() and kept by filtered().
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_list, text_slices

WORDS = 5
LEAST = 0.8
BLOCK_CHARS = 4_000_000
FILTER_BITS = 20
WORD = re.compile(r"\w+")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the shingles of word hashes; one position after another, empty if there are fewer words."""
    n = max(0, len(words) - width + 1)
    h = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        h = (h ^ words[i : i + n]) * _MIX[i % len(_MIX)]
        h ^= h >> np.uint64(29)
    return h


def needed(size: int, least: float) -> int:
    """How many of an item's shingles a document must have."""
    return max(1, math.ceil(least * size - 1e-9))


@dataclass
class _Class:
    """The items of one class of size: the fewest shingles that a document must have for any, their sketch values, and whose those are."""

    fewest: int
    values: np.ndarray
    posting: dict[int, list[int]]


class Index:
    """The sketches of a block of items, by width of shingle and class of size."""

    def __init__(self, items: list[tuple[int | None, str]], words: int, least: float) -> None:
        known = _Hashes()
        self.ids, self.shingles, self.least = [], [], least
        self.classes: dict[tuple[int, int], list[int]] = defaultdict(list)
        hashes: list[np.ndarray] = []
        for id, text in items:
            found = WORD.findall((text or "").lower())
            if not found:
                continue
            width = min(words, len(found))
            own = {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}
            ordered = sorted((int(shingle_hashes(np.array([known[w] for w in s], dtype=np.uint64), width)[0]), s) for s in own)
            self.classes[width, (len(own) - 1).bit_length()].append(len(self.ids))
            self.ids.append(id)
            self.shingles.append(frozenset(own))
            hashes.append(np.array([h for h, _ in ordered], dtype=np.uint64))
        self.sketches: dict[int, tuple[np.ndarray, list[_Class]]] = {}
        for (width, _), members in sorted(self.classes.items()):
            sketches = [(m, hashes[m][: len(hashes[m]) - needed(len(hashes[m]), least) + 1]) for m in members]  # the smallest: values of one permutation
            posting: dict[int, list[int]] = defaultdict(list)
            for m, sketch in sketches:
                for h in sketch.tolist():
                    posting[h].append(m)
            of_class = _Class(min(needed(len(hashes[m]), least) for m in members), np.sort(np.array(list(posting), dtype=np.uint64)), posting)
            marks, classes = self.sketches.setdefault(width, (np.zeros(1 << FILTER_BITS, dtype=np.uint64), []))
            marks[of_class.values >> np.uint64(64 - FILTER_BITS)] |= np.uint64(1 << len(classes))
            classes.append(of_class)

    def search(self, texts: list[str], known: _Hashes) -> list[list[tuple[int, int]]]:
        """For each text the items that it contains, as (item, shingles in common)."""
        words = [WORD.findall(t.lower()) for t in texts]
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        flat = np.fromiter((known[w] for x in words for w in x), dtype=np.uint64)
        sizes = np.array([len(x) for x in words], dtype=np.int64)
        ends = np.cumsum(sizes)
        candidates: dict[int, set[int]] = defaultdict(set)
        for width, (marks, classes) in self.sketches.items():
            h = shingle_hashes(flat, width)
            mark = marks[h >> np.uint64(64 - FILTER_BITS)]
            at = np.flatnonzero(mark)
            doc = np.searchsorted(ends, at, side="right")
            room = np.where(at + width <= ends[doc], sizes[doc] - width + 1, 0)  # shingles of the document, 0 between documents
            for n, c in enumerate(classes):
                own = np.flatnonzero((mark[at] >> np.uint64(n) & np.uint64(1)).astype(bool) & (room >= c.fewest))
                there = h[at[own]]
                hit = c.values[np.minimum(np.searchsorted(c.values, there), len(c.values) - 1)] == there
                for d, v in zip(doc[own[hit]].tolist(), there[hit].tolist(), strict=True):
                    candidates[d].update(c.posting[v])
        for d, items in candidates.items():
            own: dict[int, set[tuple[str, ...]]] = {}
            for m in sorted(items):
                wanted = self.shingles[m]
                width = len(next(iter(wanted)))
                if width not in own:
                    own[width] = set(zip(*(words[d][i:] for i in range(width))))
                common = len(wanted & own[width])
                if common >= needed(len(wanted), self.least):
                    out[d].append((m, common))
        return out


@lru_cache(1)
def _index(items: tuple[tuple[int | None, str], ...], words: int, least: float) -> Index:
    return Index(list(items), words, least)


def _blocks(benchmark: DataFrame, text: str, id: str, block_chars: int) -> Iterator[tuple[tuple[int | None, str], ...]]:
    items = benchmark.select(F.col(id).cast("long").alias("item_id"), F.col(text).alias("text")).filter("text is not null")
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(chars / block_chars))
    for b in range(n):
        yield tuple((r["item_id"], r["text"]) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect())


def _searches(items, words: int, least: float):
    """What gives, for slices of batches, the index and what it finds."""

    def run(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[Index, pa.RecordBatch, list[list[tuple[int, int]]]]]:
        index, known = _index(items.value, words, least), _Hashes()
        for part in text_slices(batches, column=column):
            if len(known) > 500_000:
                known.clear()
            yield index, part, index.search(text_list(part.column(column)), known)

    return run


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id", item: str = "item_id", item_text: str = "text", words: int = WORDS, least: float = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common, containment) for each document and item that it contains."""
    schema = "doc_id long, item_id long, n_shingles long, n_common long, containment double"
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in _blocks(benchmark, item_text, item, block_chars):
        search = _searches(docs.sparkSession.sparkContext.broadcast(block), words, least)

        def run(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            for index, part, matches in search(batches, "text"):
                ids = part.column("doc_id").to_pylist()
                rows = [(ids[d], index.ids[m], len(index.shingles[m]), n) for d, ms in enumerate(matches) for m, n in ms]
                cells = [list(c) for c in zip(*rows)] if rows else [[], [], [], []]
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cells], pa.array([r[3] / r[2] for r in rows], pa.float64())], names=["doc_id", "item_id", "n_shingles", "n_common", "containment"])

        of_block = rows.mapInArrow(run, schema)
        found = of_block if found is None else found.union(of_block)
    return found


def filtered(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", words: int = WORDS, least: float = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs that contain no item, with all their columns."""
    for block in _blocks(benchmark, item_text, item, block_chars):
        search = _searches(docs.sparkSession.sparkContext.broadcast(block), words, least)

        def run(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            for _, part, matches in search(batches, text):
                yield part.filter(pa.array([not m for m in matches]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
