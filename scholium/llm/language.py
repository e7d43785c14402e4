"""Language identification: script ranges, scores of words, and a Viterbi path with a switching penalty.

A word is a run of letters of one script; a run of over RUN letters, as in scripts without spaces, makes several words.
A word's script leaves only the languages that use it; a naive Bayes model over hashed character n-grams scores it
under those. The best path through the words of a text, where each change of language costs a penalty, labels spans.
A text's language is the one with most letters on the path, its score that share of the letters.

Training rows: non-null language, not held out (crc32 of the id leaves 2 modulo 4). The classifier is fitted on about
`sample` rows of each language, drawn by a hash of the id; all rows of a language with fewer. Every language is
learned. Only counts by n-gram bucket reach the driver, at most BUCKETS numbers a language; the model has as many, and
workers keep fewer words at a time the more languages there are.

Null texts and texts without a letter are `und` with score 0, as is every text if there is nothing to learn from; an
empty table gives an empty result. Texts are read whole, whatever their length. Ties go to the language that sorts
first. Each row gets its result; null ids are not held out. Other columns are ignored.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _ranges
from .common import held_out, is_held_out, text_list, text_slices

SAMPLE = 4000
#: Letters of a word at most; a longer run of letters is several words.
RUN = 48
BUCKETS = 1 << 15
#: Languages that a counting task holds before it passes its counts on.
HELD = 64
#: Scores, of words by languages, that a worker keeps from slice to slice; a slice has fewer characters than that by language.
KNOWN_SCORES = 8_000_000
LENGTHS = (1, 2, 3, 4)
PENALTY = 8.0
UNKNOWN = "und"
# First code points of Unicode ranges and their scripts ("" where letters are of no one script).
SCRIPTS = [
    (0x0041, "latin"), (0x02B0, ""), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"),
    (0x07C0, "nko"), (0x0800, ""), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"),
    (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1400, "canadian"), (0x1680, ""), (0x1780, "khmer"), (0x1800, "mongolian"), (0x1900, ""), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""),
    (0x2C60, "latin"), (0x2C80, "coptic"), (0x2D00, "georgian"), (0x2D30, "tifinagh"), (0x2D80, "ethiopic"), (0x2DE0, "cyrillic"), (0x2E00, "han"), (0x3040, "kana"), (0x3100, "bopomofo"),
    (0x3130, "hangul"), (0x3190, "han"), (0xA000, "yi"), (0xA4D0, ""), (0xA640, "cyrillic"), (0xA6A0, ""), (0xA720, "latin"), (0xA800, ""), (0xAC00, "hangul"), (0xD7B0, "hangul"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, ""), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, ""), (0x20000, "han"),
]
_STARTS = [a for a, _ in SCRIPTS]


def last_of(text: str) -> int:
    """A code point that no character of a text is after: patterns of fewer characters are faster."""
    if text.isascii():
        return 0x7F
    try:
        text.encode("latin-1")
        return 0xFF
    except UnicodeEncodeError:
        return 0xFFFF if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else sys.maxunicode


@lru_cache(4)
def _word(last: int = sys.maxunicode) -> re.Pattern:
    """Words of characters up to `last`: a letter, then letters and marks."""
    kinds: dict[str, list[int]] = {"L": [], "M": []}
    for c in range(last + 1):
        if (k := unicodedata.category(chr(c))[0]) in kinds:
            kinds[k].append(c)
    letter = _ranges(kinds["L"])
    return re.compile(f"[{letter}][{letter}{_ranges(kinds['M'])}]*")


@lru_cache(4)
def _runs(last: int = sys.maxunicode) -> re.Pattern:
    """Words of one script, of RUN letters at most, so that all of a long run is read; of characters up to `last`."""
    letters: dict[str, list[int]] = {"latin": []}
    marks = []
    for c in range(last + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            letters.setdefault(script(chr(c)), []).append(c)
        elif kind == "M":
            marks.append(c)
    more = _ranges(marks)
    kinds = "|".join(f"[{_ranges(x)}][{_ranges(x)}{more}]{{0,{RUN - 1}}}" for x in letters.values() if x)
    return re.compile(f"(?=[{_ranges(sorted(c for x in letters.values() for c in x))}])(?:{kinds})")


def script(word: str) -> str:
    """The script of a word's first letter, "" for none in particular."""
    at = bisect_right(_STARTS, ord(word[0])) - 1
    return SCRIPTS[at][1] if at >= 0 else ""


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts in the bytes of all, and (LENGTHS, bytes) the bucket of the n-gram from there on.

    BUCKETS itself stands for no n-gram, where the word ends before it.
    """
    cells = [f"<{w.lower()}>".encode() for w in words]
    raw = np.frombuffer(b"".join(cells), dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(c) for c in cells], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    left = np.repeat(starts + sizes, sizes) - np.arange(len(raw))
    out = np.full((len(LENGTHS), len(raw)), BUCKETS, dtype=np.int32)
    h = np.zeros(len(raw), dtype=np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        m = len(raw) - n + 1
        if m <= 0:
            break
        h = (h[:m] * np.uint64(0x100000001B3) + raw[n - 1 :] + np.uint64(n)) & np.uint64(0xFFFFFFFF)
        if n in LENGTHS:
            mixed = ((h * np.uint64(0x9E3779B1)) >> np.uint64(7)) % np.uint64(BUCKETS)
            out[LENGTHS.index(n), :m] = np.where(left[:m] >= n, mixed.astype(np.int32), BUCKETS)
    return starts, out


@dataclass
class Model:
    languages: list[str]
    gram: np.ndarray  # (BUCKETS, languages): log probabilities
    scripts: dict[str, np.ndarray]  # the languages that use a script

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(words, languages): half the log-likelihood of each word's n-grams, which overlap; 0 for the best."""
        out = np.zeros((len(words), len(self.languages)), dtype=np.float32)
        gram = np.concatenate((self.gram, np.zeros((1, len(self.languages)), np.float32)))
        step = max(1, 400_000 // max(1, len(self.languages)))
        for lo in range(0, len(words), step):
            starts, buckets = _grams(words[lo : lo + step])
            sums = sum((gram[b] for b in buckets[1:]), gram[buckets[0]])
            out[lo : lo + step] = 0.5 * np.add.reduceat(sums, starts, axis=0)
        for s in {script(w) for w in words} & self.scripts.keys():
            used = self.scripts[s]
            own = np.array([script(w) == s for w in words])
            if used.any() and not used.all():
                out[np.ix_(own, ~used)] = out[own].min(axis=1, initial=0, keepdims=True) - 50
        return out - out.max(axis=1, initial=-np.inf, keepdims=True)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", sample: int = SAMPLE) -> Model:
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = rows.groupBy("lang").count().collect()  # a row a language
    languages = sorted(r["lang"] for r in sizes)
    number = {x: n for n, x in enumerate(languages)}
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), {})
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, sample / r["count"]))])[F.col("lang")]
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}  # by language, HELD of them at a time
        scripts: Counter = Counter()

        def portion() -> pa.RecordBatch:
            places = [(n, np.flatnonzero(c)) for n, c in counts.items()]
            bucket = np.concatenate([*(at for _, at in places), np.full(len(scripts), -1)])
            lang = np.concatenate([*(np.full(len(at), n) for n, at in places), np.array([n for _, n in scripts], dtype=np.int64)])
            times = np.concatenate([*(counts[n][at] for n, at in places), np.array(list(scripts.values()), dtype=np.int64)])
            keys = [""] * (len(bucket) - len(scripts)) + [s for s, _ in scripts]
            counts.clear()
            scripts.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(bucket.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(times.astype(np.int64))], names=["script", "bucket", "lang", "n"])

        for part in text_slices(batches, 2_000_000):
            for t, x in zip(text_list(part.column("text")), part.column("lang").to_pylist(), strict=True):
                n = number[x]
                words = Counter(_runs(last_of(t)).findall(t))
                if words:
                    starts, buckets = _grams(list(words))
                    times = np.repeat(list(words.values()), np.diff([*starts.tolist(), buckets.shape[1]]))
                    own = counts.setdefault(n, np.zeros(BUCKETS, dtype=np.int64))
                    for b in buckets:
                        own += np.bincount(b, weights=times, minlength=BUCKETS + 1)[:BUCKETS].astype(np.int64)
                for w, k in words.items():
                    scripts[script(w), n] += k * len(w)
                if len(counts) >= HELD:
                    yield portion()
        yield portion()

    summed = drawn.mapInArrow(run, "script string, bucket int, lang int, n long").groupBy("script", "bucket", "lang").agg(F.sum("n").alias("n")).toArrow()
    bucket, n, count = (summed.column(c).to_numpy() for c in ("bucket", "lang", "n"))
    table = np.zeros((BUCKETS, len(languages)))
    grams = bucket >= 0
    table[bucket[grams], n[grams]] = count[grams]
    gram = np.log(table + 0.5) - np.log(table.sum(axis=0) + 0.5 * BUCKETS)
    letters: dict[str, np.ndarray] = {}
    keys = summed.column("script").filter(pa.array(~grams)).to_pylist()
    for s, k, c in zip(keys, n[~grams].tolist(), count[~grams].tolist(), strict=True):
        if s:
            letters.setdefault(s, np.zeros(len(languages)))[k] += c
    total = sum(letters.values(), np.zeros(len(languages)))
    return Model(languages, gram.astype(np.float32), {s: v > 0.01 * np.maximum(total, 1) for s, v in letters.items()})


def viterbi(scores: np.ndarray, words: np.ndarray, sizes: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best path through each text, all texts a word at a time.

    scores: (distinct words, languages); words: the word numbers of all texts, one text after another; sizes: words in
    each text. Returns a language number for each of words.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    longest_first = sizes[order]
    longest = int(longest_first[0]) if len(sizes) else 0
    active = np.searchsorted(-longest_first, -np.arange(longest), side="left")  # texts with more than t words
    path = np.zeros(len(words), dtype=np.int16)
    if not longest:
        return path
    from_best = np.zeros((len(words), scores.shape[1]), dtype=bool)
    best_before = np.zeros(len(words), dtype=np.int16)
    total = np.zeros((len(sizes), scores.shape[1]), dtype=np.float32)
    for t in range(longest):
        at = starts[: active[t]] + t
        now = total[: active[t]]
        if t:
            best_before[at] = now.argmax(axis=1)
            top = now.max(axis=1, keepdims=True)
            now -= top  # keeps totals small whatever the length
            from_best[at] = now < -penalty
            np.maximum(now, -penalty, out=now)
        now += scores[words[at]]
    state = total.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        path[at] = state[:n]
        if t:
            state[:n] = np.where(from_best[at, state[:n]], best_before[at], state[:n])
    return path


class _Numbered(dict):
    """Numbers new words as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _slice(model: Model) -> int:
    """Characters of a slice of texts."""
    return min(2_000_000, 4 * KNOWN_SCORES // max(1, len(model.languages)))


class _Labeller:
    """Labels slices of texts; keeps scores of words from slice to slice."""

    def __init__(self, model: Model, penalty: float) -> None:
        self.model, self.penalty = model, penalty
        self.known, self.table = _Numbered(), np.zeros((0, len(model.languages)), dtype=np.float32)

    def __call__(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        """Language, score and spans of each text."""
        model, out = self.model, []
        if len(self.known) * len(model.languages) > KNOWN_SCORES or len(self.known) > 200_000:
            self.known, self.table = _Numbered(), self.table[:0]
        found = [_runs(last_of(t)).findall(t) if model.languages else [] for t in texts]
        words = np.fromiter((self.known[w] for x in found for w in x), dtype=np.int64)
        letters = np.fromiter((len(w) for x in found for w in x), dtype=np.int64)
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        if len(self.known) > len(self.table):
            self.table = np.concatenate((self.table, model.word_scores(list(islice(self.known, len(self.table), None)))))
        path = viterbi(self.table, words, sizes, self.penalty)
        for n, end in zip(sizes.tolist(), np.cumsum(sizes).tolist(), strict=True):
            if not n:
                out.append((UNKNOWN, 0.0, []))
                continue
            own = path[end - n : end]
            of = np.bincount(own, weights=letters[end - n : end], minlength=len(model.languages))
            top = int(of.argmax())
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), n]
            out.append((model.languages[top], float(of[top] / of.sum()), [{"first": a, "words": b - a, "lang": model.languages[own[a]]} for a, b in zip(cuts, cuts[1:])]))
        return out


def identify(docs: DataFrame, model: Model, text: str = "text", id: str = "doc_id", penalty: float = PENALTY) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans): spans are (first word, words, lang), in text order."""
    schema = "doc_id long, held_out boolean, lang_pred string, score double, spans array<struct<first:int,words:int,lang:string>>"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = _Labeller(shared.value, penalty)
        for part in text_slices(batches, _slice(shared.value)):
            found = label(text_list(part.column("text")))
            held = [is_held_out(i) for i in part.column("doc_id").to_pylist()]
            cells = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), kind))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(held), *cells], names=["doc_id", "held_out", "lang_pred", "score", "spans"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def filtered(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """The rows of docs with a language, in which at least `least` of their letters are; with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = _Labeller(shared.value, penalty)
        for part in text_slices(batches, _slice(shared.value), text):
            yield part.filter(pa.array([x != UNKNOWN and s >= least for x, s, _ in label(text_list(part.column(text)))]))

    return docs.mapInArrow(run, docs.schema)
