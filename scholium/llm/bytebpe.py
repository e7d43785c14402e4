"""Byte-level BPE encoding and decoding by longest matches, in time linear in the text.

The vocabulary is a file of ranks (a base64 token and its rank a line); an id is a rank. Each match of a splitting
pattern is encoded by itself. Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton of the tokens
finds the longest token that begins at each byte. Encoding goes from left to right: it takes the longest token that is
compatible with the token before it and from whose end the rest can still be encoded, then the next shorter one, and
steps back over a token whose end leads nowhere. Two adjacent tokens are compatible if merging by ranks would leave the
border between them alone. That is a matter of the two tokens only, so answers are kept by pair, and a sequence whose
neighbours are all compatible is the one that merging by ranks gives. Each end is given up once at most.

This holds for vocabularies that training makes, in which merging a token's own bytes gives the token; another is an
error when it is loaded. Which characters are letters, numbers and white space is asked of the tiktoken library, so its
Unicode tables count, whatever they are.

Null and empty texts have no ids and decode to nothing; an empty table gives an empty result. Texts are taken whole,
whatever their length, in slices of bounded size; a match of a million bytes takes a byte and four more for each of its
bytes while it is encoded. Each row gets its result; repeated rows and null ids are nothing special, and equal texts have
equal results. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_list, text_slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Distinct matches that a worker keeps at hand at most, and the longest that it keeps, in bytes.
MEMO_MATCHES, MEMO_BYTES = 500_000, 64
#: Pairs of tokens whose compatibility a worker keeps at hand at most.
MEMO_PAIRS = 1_000_000


def _spans(chars: Iterable[str], last: int = sys.maxunicode) -> str:
    """The inside of a character class, of characters up to a code point."""
    spans: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if c > last:
            break
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


@lru_cache(4)
def splitters(pattern: str) -> tuple[re.Pattern, re.Pattern]:
    """A pattern of \\p{L}, \\p{N} and \\s with the tiktoken library's classes spelled out; for any text, and for Latin-1."""
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    classes = {c: bytes(tiktoken.Encoding("class", pat_str=c, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode() for c in (r"\p{L}", r"\p{N}", r"\s")}

    def spelled(last: int) -> re.Pattern:
        inside = {c: _spans(chars, last) for c, chars in classes.items()}
        out, depth = [], 0
        for piece in re.findall(r"\\p\{\w\}|\\.|\[\^?|\]|.", pattern, re.S):
            depth += piece.startswith("[") - (piece == "]")
            if piece.lower() == r"\s" and piece != r"\s":
                out.append(f"[^{inside[r'\s']}]")
            elif piece in inside:
                out.append(inside[piece] if depth else f"[{inside[piece]}]")
            else:
                out.append(piece)
        return re.compile("".join(out))

    return spelled(sys.maxunicode), spelled(0xFF)


class Ranks:
    """A vocabulary: how its tokens come about by merging, and the automaton that finds them."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("each byte must be a token")
        self.ranks = ranks
        self.token: dict[int, bytes] = {r: t for t, r in ranks.items()}
        #: By rank: the two tokens that it is merged from; a single byte stays itself.
        self.left: dict[int, int] = {r: r for r in ranks.values()}
        self.right = dict(self.left)
        #: By rank: the longest shorter token that it begins with; -1 for none.
        self.shorter: dict[int, int] = {}
        self.length = {r: len(t) for t, r in ranks.items()}
        self._merged: dict[tuple[int, int], int] = {}
        self._known: dict[int, bool] = {}
        reached: dict[bytes, int] = {bytes([b]): ranks[bytes([b])] for b in range(256)}
        for rank, token in sorted((r, t) for t, r in ranks.items() if len(t) > 1):
            for cut in range(len(token) - 1, 0, -1):
                a, b = reached.get(token[:cut]), reached.get(token[cut:])
                if a is not None and b is not None and self._border(a, b):
                    self.left[rank], self.right[rank] = a, b
                    self._merged[a, b] = rank
                    reached[token] = rank
                    break
            else:
                raise ValueError(f"merging does not reach token {rank}")
        automaton = ahocorasick.Automaton()
        for token, rank in reached.items():
            self.shorter[rank] = next((reached[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in reached), -1)
            automaton.add_word(token.decode("latin-1"), rank)
        automaton.make_automaton()
        self._matches = automaton.iter

    def _border(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between tokens a and b alone.

        Both are taken apart, the later merge first. Where two parts meet that would merge, they did so before anything
        that came later; of merges with one rank the one further left comes first.
        """
        merged, left, right = self._merged, self.left, self.right
        before = sys.maxsize  # only merges that come before this rank could have happened at the border
        while True:
            together = merged.get((a, b))
            if together is not None and together < before:
                return False
            whole_a, whole_b = left[a] == a, left[b] == b
            if whole_a and whole_b:
                return True
            if whole_b or not whole_a and a > b:
                before, a = a, right[a]
            else:
                before, b = b + 1, left[b]

    def _learn(self, pair: int) -> bool:
        """Whether two tokens are compatible, kept under the pair, the first token's rank in the upper bits."""
        if len(self._known) > MEMO_PAIRS:
            self._known.clear()
        found = self._known[pair] = self._border(pair >> 32, pair & 0xFFFFFFFF)
        return found

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one match."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        length, shorter, known, learn = self.length, self.shorter, self._known.get, self._learn
        longest = array("I", bytes(4 * len(piece)))
        for end, rank in self._matches(piece.decode("latin-1")):
            longest[end + 1 - length[rank]] = rank  # a later end is a longer token
        dead = bytearray(len(piece) + 1)
        token = longest[0]
        ids, at = [], 0
        while True:
            end = at + length[token]
            if not dead[end]:
                fits = True
                if ids:
                    pair = ids[-1] << 32 | token
                    fits = known(pair)
                    if fits is None:
                        fits = learn(pair)
                if fits:
                    ids.append(token)
                    if end == len(piece):
                        return ids
                    at, token = end, longest[end]
                    continue
            token = shorter[token]
            while token < 0:  # nothing fits here: the token before it must be a shorter one
                dead[at] = 1
                last = ids.pop()
                at -= length[last]
                token = shorter[last]


@lru_cache(2)
def load(path: str) -> Ranks:
    with open(path, "rb") as f:
        return Ranks({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f.read().splitlines()) if token})


class _Memo(dict):
    """ids as little-endian 32-bit numbers by match."""

    def __init__(self, model: Ranks) -> None:
        self.model = model

    def __missing__(self, match: str) -> bytes:
        piece = match.encode("utf-8", "surrogatepass")
        ids = self.model.encode(piece)
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_BYTES:
            self[match] = found
        return found

    def rest(self) -> None:
        if len(self) > MEMO_MATCHES:
            self.clear()


@lru_cache(1)  # workers outlive tasks
def _memo(path: str) -> _Memo:
    return _Memo(load(path))


def encode(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian unsigned 32-bit numbers, and the bytes that they decode to."""
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, (any_text, latin) = _memo(path), splitters(pattern)
        token = memo.model.token
        for part in text_slices(batches, 2_000_000):
            counts, ids, decoded = [], [], []
            for t in text_list(part.column("text")):
                memo.rest()
                try:
                    t.encode("latin-1")
                    split = latin
                except UnicodeEncodeError:
                    split = any_text
                raw = b"".join(map(memo.__getitem__, split.findall(t)))
                counts.append(len(raw) // 4)
                ids.append(raw)
                decoded.append(b"".join(map(token.__getitem__, np.frombuffer(raw, dtype="<u4").tolist())))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encode()'s rows."""
    return encode(docs, text, id, path, pattern).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
