"""BPE encoding and decoding with a transducer lexicon of the corpus's frequent words.

The vocabulary is that of a tokenizer file with word ends (NFC, lower case, white space dropped, words and symbol runs
apart, digits one by one). Words are counted over all documents; the most frequent ones are compiled, with their ids,
into a minimal acyclic transducer that each worker memory-maps. A word that the lexicon lacks is merged pair by pair
from its bytes. Results do not depend on which words are in the lexicon.

Texts with a character whose properties, or whose lower case's properties, changed since Unicode 3.2, or one of the
special tokens' strings, go through the tokenizers library as a whole, since versions of Unicode tables could differ.

Which words are the most frequent is found from histograms of bounded size, and only the lexicon's own words reach the
driver. Each worker maps the lexicon from an unnamed file of its own, made from the broadcast: nothing that another
worker, or a worker that takes over a lost one's tasks, would need.

Null and empty texts have no ids and decode to the empty text; an empty table gives an empty result. Texts are taken
whole, whatever their length, in slices of bounded size. Each row gets its result; repeated rows and null ids are
nothing special. Words that are equally frequent go into the lexicon in the order of a hash. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import stored, text_list, text_slices
from .lexicon import Lexicon, compile_lexicon

VOCABULARY = "word_bpe_49k.json"
#: Words in the lexicon at most: what bounds the compiled file, and so what is sent to workers (some 2 MB).
LEXICON_WORDS = 50_000
#: Distinct words that a worker keeps at hand at most.
MEMO_WORDS = 500_000
#: Words that a counting task holds before it passes its counts on.
COUNTED_WORDS = 300_000


def _ranges(chosen: list[int]) -> str:
    """The inside of a character class."""
    spans: list[list[int]] = []
    for c in chosen:
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


@lru_cache(1)
def _patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """What finds a character that isn't settled, what finds words in settled text, and the same for Latin-1 text."""
    old = unicodedata.ucd_3_2_0
    settled, letters, numbers = [], [], []

    def same(ch: str) -> bool:
        kind = unicodedata.category(ch)
        return kind not in ("Cn", "Cs", "Co") and kind == old.category(ch) and not "\x1c" <= ch <= "\x1f" and ch != "\x85"

    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if all(map(same, ch + ch.lower())):
            settled.append(c)
            kind = unicodedata.category(ch)
            if kind[0] == "L":
                letters.append(c)
            elif kind[0] == "N":
                numbers.append(c)

    def words(last: int) -> re.Pattern:
        letter, number = (_ranges([c for c in x if c <= last]) for x in (letters, numbers))
        return re.compile(f"[{letter}]+|'(?:s|t|re|ve|m|ll|d)|[{number}]|[^\\s{letter}{number}]+")

    return re.compile(f"[^{_ranges(settled)}]"), words(sys.maxunicode), words(0xFF)


@lru_cache(1)
def _byte_chars() -> list[str]:
    """A printable character for each byte: printable Latin-1 bytes stand for themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Bpe:
    """A vocabulary file of words with word ends: splitting, exact merging and decoding."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.token[i] = t
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def words(self, text: str) -> list[str] | None:
        """The words of a text; None if only the library can tell them."""
        unsettled, word, latin = _patterns()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if unsettled.search(text) or "<|" in text and any(s in text for s in self.special):
            return None
        text = text.replace("Σ", "σ").lower()  # each character by itself: no final form
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return word.findall(text)
        return latin.findall(text)

    def merge(self, word: str) -> list[int]:
        """The ids of one word, merged pair by pair from its bytes by the library's model."""
        chars = _byte_chars()
        return [t.id for t in self.library.model.tokenize("".join([chars[b] for b in word.encode("utf-8", "surrogatepass")]))]

    def decode(self, ids: Iterable[int]) -> str:
        """What the file's decoding gives: the tokens with a space between."""
        return " ".join(map(self.token.__getitem__, ids))


@lru_cache(2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


class _Memo(dict):
    """ids as little-endian 32-bit numbers by word; the lexicon answers first, merging after it."""

    def __init__(self, model: Bpe, lexicon: Lexicon) -> None:
        self.model, self.lexicon = model, lexicon

    def __missing__(self, word: str) -> bytes:
        ids = self.lexicon.get(word)
        if ids is None:
            ids = self.model.merge(word)
        found = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def rest(self) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()


@lru_cache(1)  # workers outlive tasks: one lexicon's words are enough to keep
def _memo(path: str, compiled: bytes) -> _Memo:
    return _Memo(bpe(path), Lexicon(compiled))


def word_counts(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(word, n) over all documents. Counts leave a task summed by word, in portions of bounded size."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts = bpe(path), Counter()

        def portion() -> pa.RecordBatch:
            known = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return known

        for part in text_slices(batches):
            for t in text_list(part.column("text")):
                counts.update(model.words(t) or ())
                if len(counts) > COUNTED_WORDS:
                    yield portion()
        yield portion()

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, text: str = "text", path: str | None = None, most: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the words that are most frequent in docs, `most` at most.

    A histogram of counts tells where to cut; of the words there, which are equally frequent to ten bits, those with
    the smallest hashes are taken, by a second histogram.
    """
    model = bpe(path or public_tokenizers.path(VOCABULARY))
    bits = F.greatest(F.length(F.bin("n")) - 10, F.lit(0))
    place = bits * 1024 + F.expr("shiftright(n, greatest(length(bin(n)) - 10, 0))").cast("int")
    words = word_counts(docs, text, path).filter("n > 1 and length(word) <= 64").select("word", place.alias("place"), F.pmod(F.xxhash64("word"), F.lit(1 << 16)).alias("draw"))
    words = stored(words, "lexicon-words")

    def cut(part: DataFrame, column: str, room: int, descending: bool) -> tuple[int | None, int]:
        """The first value whose words don't all fit, and how much room those before it leave."""
        for r in sorted(part.groupBy(column).count().collect(), key=lambda r: r[column], reverse=descending):
            if r["count"] > room:
                return r[column], room
            room -= r["count"]
        return None, room

    last, room = cut(words, "place", most, True)
    chosen = words
    if last is not None:
        tied = words.filter(F.col("place") == last)
        draw, _ = cut(tied, "draw", room, False)
        chosen = words.filter(F.col("place") > last).union(tied.filter(F.col("draw") < draw))
    return compile_lexicon((r["word"], model.merge(r["word"])) for r in chosen.select("word").collect())


def encode(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = None, lexicon: bytes | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian unsigned 32-bit numbers, and their decoded text."""
    path = path or public_tokenizers.path(VOCABULARY)
    compiled = docs.sparkSession.sparkContext.broadcast(frequent_words(docs, text, path) if lexicon is None else lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(path, compiled.value)
        model = memo.model
        for part in text_slices(batches, 2_000_000):
            counts, ids, decoded = [], [], []
            for t in text_list(part.column("text")):
                words = model.words(t)
                if words is None:
                    found = model.library.encode(t, add_special_tokens=False).ids
                    raw, back = np.asarray(found, dtype="<u4").tobytes(), model.decode(found)
                else:
                    memo.rest()
                    raw = b"".join(map(memo.__getitem__, words))
                    back = model.decode(np.frombuffer(raw, dtype="<u4").tolist())
                counts.append(len(raw) // 4)
                ids.append(raw)
                decoded.append(back)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def digests(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encode()'s rows."""
    return encode(docs, text, id, path).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
