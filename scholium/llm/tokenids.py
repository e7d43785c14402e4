"""Token-ID output: texts as ids of a byte-level BPE, in files of range-coded blocks.

Documents are put in the order of their ids by range, so every file holds a range of them; a file's rows are frames
(mixcoder) of whole documents, with the ids and lengths of their documents. A document's ids end with END. The files
are Parquet in the shared folder, written by Spark, so a lost executor costs its tasks only. Reading decodes each
frame by itself; where a document starts in all ids follows from what its frame says of its file, and from the sums of
the files before, a row a file.

Texts are cut into the tokenizer's words, many texts at once, and each different word is encoded by the tokenizers library's
model, as a rule once a worker; texts with a special token's string, or a character whose properties changed since Unicode 3.2, go through the library
as a whole. Null texts are empty: their only id is END. Null ids come first, and rows of equal ids follow one another
in the order of their texts' hashes. Other columns are ignored. An empty table makes no frame.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import mixcoder
from .bpe import _byte_chars, _patterns
from .common import stored, text_list, text_slices

VOCABULARY = "byte_bpe_50k.json"
END = 2
#: Ids of a frame, about; a longer document makes a longer frame.
FRAME = 2 * mixcoder.BLOCK
MEMO_WORDS = 1_000_000
#: Characters that are cut into words at once, about.
PIECE = 4_000_000


#: Kinds of characters; what is set behind a text has one of its own.
END_OF_TEXT, LETTER, NUMBER, OTHER, SPACE, UNSETTLED = range(6)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """The kind of each code point."""
    kinds = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if (k := unicodedata.category(ch)[0]) in "LN":
            kinds[c] = LETTER if k == "L" else NUMBER
        elif ch.isspace():
            kinds[c] = SPACE
    unsettled, _, _ = _patterns()
    kinds[[ord(ch) for ch in unsettled.findall("".join(map(chr, range(sys.maxunicode + 1))))]] = UNSETTLED
    return kinds


def _starts(code: np.ndarray, kind: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where words begin in texts' code points and their kinds, with one more behind each text, at ends, that is a word of its own.

    A word is ` ?` and letters, numbers or others; or 's, 't, 'm, 'd, 're, 've, 'll that no space or other precedes; or white
    space, whose last character is left out if a word follows."""
    starts = np.ones(len(code), dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    starts[ends] = True
    before = kind == SPACE
    plain = ~before
    plain[ends] = False
    before = before[:-1] & plain[1:]  # white space before a word
    starts[:-1] |= before
    before &= code[:-1] == 0x20
    starts[1:] &= ~before
    at = np.flatnonzero(code == 0x27)
    at = at[starts[at]]
    one = code[at + 1]
    two = code[np.minimum(at + 2, len(code) - 1)]
    short = at[np.isin(one, [0x73, 0x74, 0x6D, 0x64])]
    long = at[np.isin(one, [0x72, 0x76]) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)]
    starts[short + 1] = starts[long + 1] = False
    starts[short + 2] = starts[long + 3] = True
    return np.flatnonzero(starts)


_CUT = re.compile(r"(?<=\S)\s")


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of PIECE characters, about, that no word spans."""
    at = 0
    while len(text) - at > PIECE and (m := _CUT.search(text, at + PIECE)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


class _Encoder:
    """Texts to ids. Ids of words are kept, by their bytes: of those met of late, and of those before them."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.chars = "".join(_byte_chars())
        self.packed = [i.to_bytes(2, "little") for i in range(1 << 16)]
        self.late: dict[bytes, bytes] = {}
        self.early: dict[bytes, bytes] = {}

    def words(self, words: list[bytes]) -> list[bytes]:
        """Words' ids as little-endian 16-bit numbers."""
        found = list(map(self.late.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.late) + len(new) > MEMO_WORDS // 2:
            self.early, self.late = self.late, {}
        late, early, packed, tokenize = self.late, self.early.get, self.packed, self.library.model.tokenize
        shown = b"".join([words[i] for i in new]).decode("latin-1").translate(self.chars)
        at = 0
        for i in new:
            word = words[i]
            ids = early(word)
            if ids is None:
                ids = b"".join([packed[t.id] for t in tokenize(shown[at : at + len(word)])])
            late[word] = found[i] = ids
            at += len(word)
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        unsettled, _, _ = _patterns()
        out: list[np.ndarray] = [np.zeros(0, dtype="<u2")] * len(texts)
        whole, plain = [], []
        for i, text in enumerate(texts):
            if "<|" in text and any(s in text for s in self.special) or len(text) > PIECE and unsettled.search(text):
                whole.append(i)
            elif len(text) > PIECE:
                out[i] = np.concatenate([self._ids([piece])[0][0] for piece in _pieces(text)])
            elif text:
                plain.append(i)
        if plain:
            found, odd = self._ids([texts[i] for i in plain])
            for i, ids in zip(plain, found, strict=True):
                out[i] = ids
            whole += [plain[k] for k in odd]
        for i in whole:
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, dtype="<u2")
        return out

    def _ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """The ids of texts, and which of them only the library can tell."""
        joined = "\0".join([*texts, ""])
        code = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        kind = _kinds()[code]
        kind[ends] = END_OF_TEXT
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(kind == UNSETTLED))).tolist() if kind.max() == UNSETTLED else []
        starts = _starts(code, kind, ends)
        own = np.searchsorted(starts, ends)  # the words that are ends of texts
        data = joined.encode()
        if len(data) > len(code):
            starts = np.flatnonzero(np.frombuffer(data, dtype=np.int8) >= -64)[starts]  # bytes that begin a character
        offsets = np.append(starts, len(data)).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        known = words.dictionary
        _, offsets, data = known.buffers()
        cuts, data = np.frombuffer(offsets, dtype=np.int64)[known.offset :][: len(known) + 1].tolist(), data.to_pybytes()
        ids = self.words([data[a:b] for a, b in zip(cuts, cuts[1:])])
        size = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) >> 1
        at, which = np.cumsum(size, dtype=size.dtype) - size, words.indices.to_numpy()
        size = size[which]
        size[own] = 0
        after = np.cumsum(size, dtype=size.dtype)
        place = np.repeat(at[which] - after + size, size)
        place += np.arange(len(place), dtype=size.dtype)
        return np.split(np.frombuffer(b"".join(ids), dtype="<u2")[place], after[own][:-1]), odd


@lru_cache(1)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def frames(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = None, end: int = END, frame: int = FRAME) -> DataFrame:
    """(part, first, n_ids, doc_ids, lengths, ids): frames in the order of (part, first), the ids before it in its part."""
    path = path or public_tokenizers.path(VOCABULARY)
    schema = "part int, first long, n_ids long, doc_ids array<long>, lengths array<long>, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, first = _encoder(path), TaskContext.get().partitionId(), 0
        own: list[np.ndarray] = []
        ids: list[int | None] = []
        size = 0

        def done() -> pa.RecordBatch:
            nonlocal first, size
            lengths = [len(x) for x in own]
            packed = mixcoder.encode(np.concatenate(own))
            cells = [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([packed], pa.binary())]
            first, size = first + size, 0
            own.clear()
            ids.clear()
            return pa.RecordBatch.from_arrays(cells, names=["part", "first", "n_ids", "doc_ids", "lengths", "ids"])

        for piece in text_slices(batches, PIECE):
            for found, i in zip(encoder.encode(text_list(piece.column("text"))), piece.column("doc_id").to_pylist(), strict=True):
                own.append(np.append(found, np.uint16(end)))
                ids.append(i)
                size += len(own[-1])
                if size >= frame:
                    yield done()
        if own:
            yield done()

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ("doc_id", F.xxhash64("text"))  # the hash lets rows of one id, or none, be split
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return ordered.mapInArrow(run, schema)


def write(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = None, end: int = END, frame: int = FRAME) -> DataFrame:
    """The files of frames(), written to the shared folder, as a frame that reads them."""
    return stored(frames(docs, text, id, path, end, frame), "token-ids")


def read(written: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of written frames: ids as little-endian unsigned 32-bit numbers."""
    sizes = written.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.select("part", before.alias("part_start"))  # as many rows as files, that is as writing had tasks
    placed = written.join(F.broadcast(parts), "part").select((F.col("part_start") + F.col("first")).alias("start"), "doc_ids", "lengths", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, doc_ids, lengths, packed = (batch.column(i)[row].as_py() for i in range(4))
                ids, at = mixcoder.decode(packed), 0
                for lo in range(0, len(lengths), 2000):
                    starts, cells = [], []
                    for n in lengths[lo : lo + 2000]:
                        starts.append(start + at)
                        cells.append(ids[at : at + n].tobytes())
                        at += n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[lo : lo + 2000], pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths[lo : lo + 2000], pa.int64()), pa.array(cells, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"]
                    )

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def digests(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what was written and read back."""
    return read(write(docs, text, id, path)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
