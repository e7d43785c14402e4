"""Telephony audio columns: mu-law and A-law by lookup tables, IMA ADPCM blocks with numpy across blocks.

A payload is a cell's bytes with zero bytes appended up to a positive multiple of 64. It is stored as the samples of a
WAVE file, one byte a sample for the two laws; for ADPCM 64 bytes are one block (a 16-bit predictor, a step index and
a spare byte, then 120 four-bit codes). Reading takes the stored file apart again, expands it to 16-bit PCM, doubles
the rate by linear interpolation, and computes features; everything is in integers, so equal files have equal values.
The resampled samples are stored as a WAVE file of 16-bit PCM beside the media.

Null and empty texts make the payload of 64 zero bytes. Long texts are expanded piece by piece, with the same result.
Each row gets its result, whatever its id; a null id stays null, and repeated rows have equal results, so there are no
ties. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_list, text_slices

BLOCK = 64
RATE = 8000
#: Characters or bytes of a slice of rows, and bytes that are expanded at a time: a multiple of BLOCK.
SLICE = 1_000_000
PIECE = 1 << 19
FORMATS = {"alaw": 6, "mulaw": 7, "adpcm": 0x11}
PCM = 1
# The step sizes and index changes of IMA ADPCM.
STEPS = np.array(
    [
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494,
        544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487,
        12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
    ],
    dtype=np.int32,
)
INDEX_CHANGE = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, dtype=np.int32)


@lru_cache(1)
def law_tables() -> dict[str, np.ndarray]:
    """The 16-bit PCM value of each of the 256 codes of either law."""
    code = np.arange(256)
    u = ~code & 0xFF
    mulaw = ((((u & 15) << 3) + 132) << ((u >> 4) & 7)) - 132
    a = code ^ 0x55
    exponent, mantissa = (a >> 4) & 7, (a & 15) << 4
    alaw = np.where(exponent == 0, mantissa + 8, (mantissa + 264) << np.maximum(exponent - 1, 0))
    return {"mulaw": np.where(u & 128, -mulaw, mulaw).astype(np.int16), "alaw": np.where(a & 128, alaw, -alaw).astype(np.int16)}


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """(n, 64) bytes to (n, 121) samples: one step of all blocks at a time."""
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], len(STEPS) - 1).astype(np.int32)
    out = np.empty((2 * (BLOCK - 4) + 1, len(blocks)), dtype=np.int16)
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for n in range(2 * (BLOCK - 4)):
        code = (codes[n >> 1] >> (4 * (n & 1))) & 15
        step = STEPS[index]
        change = step >> 3
        change += np.where(code & 4, step, 0)
        change += np.where(code & 2, step >> 1, 0)
        change += np.where(code & 1, step >> 2, 0)
        value += np.where(code & 8, -change, change)
        np.clip(value, -32768, 32767, out=value)
        index += INDEX_CHANGE[code]
        np.clip(index, 0, len(STEPS) - 1, out=index)
        out[n + 1] = value
    return np.ascontiguousarray(out.T)


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % BLOCK or (0 if data else BLOCK))


def wave_file(payload: bytes, codec: str = "mulaw", rate: int = RATE) -> bytes:
    """A WAVE file with the payload as its samples; codec pcm is of 16-bit ones."""
    if codec == "pcm":
        fmt, count = struct.pack("<HHIIHH", PCM, 1, rate, 2 * rate, 2, 16), len(payload) // 2
    elif codec == "adpcm":
        samples = 2 * (BLOCK - 4) + 1
        fmt = struct.pack("<HHIIHHHH", FORMATS[codec], 1, rate, rate * BLOCK // samples, BLOCK, 4, 2, samples)
        count = len(payload) // BLOCK * samples
    else:
        fmt = struct.pack("<HHIIHHH", FORMATS[codec], 1, rate, rate, 1, 8, 0)
        count = len(payload)
    parts = [(b"fmt ", fmt), (b"fact", struct.pack("<I", count)), (b"data", payload)]
    body = b"WAVE" + b"".join(name + struct.pack("<I", len(x)) + x + bytes(len(x) % 2) for name, x in parts)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def wave_payload(media: bytes) -> tuple[str, int, bytes]:
    """Codec, rate and payload of a stored file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, codec, rate = 12, None, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if name == b"fmt ":
            kind, rate = struct.unpack_from("<HxxI", media, at + 8)
            codec = ({PCM: "pcm"} | {v: k for k, v in FORMATS.items()})[kind]
        elif name == b"data":
            if codec is None:
                raise ValueError("a WAVE file without a format")
            return codec, rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAVE file without samples")


def upsampled(pcm: np.ndarray, ends: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Twice the rate, with the mean of neighbours between them; ends: where each piece ends in pcm, after: the sample that follows it."""
    out = np.empty(2 * len(pcm), dtype=np.int16)
    out[::2] = pcm
    following = np.empty_like(pcm)
    following[:-1] = pcm[1:]
    following[ends - 1] = after
    out[1::2] = (pcm.astype(np.int32) + following) >> 1
    return out


class _Measure:
    """Energy, peak, sign changes and CRC-32 of one recording, from its pieces in order."""

    __slots__ = ("energy", "n", "peak", "turns", "negative")

    def __init__(self) -> None:
        self.energy, self.n, self.peak, self.turns, self.negative = 0, 0, 0, 0, None

    def __str__(self) -> str:
        return f"{self.energy // self.n}/{self.peak}/{self.turns}"


def _measure(into: list[_Measure], pcm: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
    """Adds a piece of each of some recordings."""
    wide = pcm.astype(np.int32)
    peak = np.maximum.reduceat(np.abs(wide), starts)
    energy = np.add.reduceat(np.square(wide, dtype=np.int64), starts)
    below = pcm < 0
    turned = np.zeros(len(pcm), dtype=np.int32)
    turned[1:] = below[1:] != below[:-1]
    turned[starts] = 0
    turns = np.add.reduceat(turned, starts)
    cells = zip(into, energy.tolist(), peak.tolist(), turns.tolist(), (ends - starts).tolist(), below[starts].tolist(), below[ends - 1].tolist(), strict=True)
    for m, e, p, t, n, first, last in cells:
        m.energy, m.n, m.peak = m.energy + e, m.n + n, max(m.peak, p)
        m.turns += t + (m.negative is not None and m.negative != first)
        m.negative = last


def _pieces(sizes: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """(recording, from, to) in groups of PIECE bytes at most; a longer recording is cut between blocks."""
    group, room = [], PIECE
    for i, size in enumerate(sizes):
        at = 0
        while at < size:
            n = min(size - at, room)
            group.append((i, at, at + n))
            at, room = at + n, room - n
            if not room:
                yield group
                group, room = [], PIECE
    if group:
        yield group


def pcm_file(pcm: bytes, media: bytes) -> bytes:
    """The stored form of a recording's resampled samples: 16-bit PCM at twice the rate of its media."""
    return wave_file(pcm, "pcm", 2 * wave_payload(media)[1])


def expanded(files: list[bytes], pcm: bool = True) -> list[tuple[bytes, bytes | None, str]]:
    """(payload, pcm, feature) of stored files; the work is done by pieces, so that memory follows PIECE and the files' own size.

    feature: the codec and rate; mean square, peak and sign changes as expanded; the same for the codes taken by the
    other law and as ADPCM blocks; CRC-32 of pcm and of the ADPCM samples. pcm: 16-bit little-endian at twice the rate,
    None unless asked for.
    """
    laws, each = law_tables(), 2 * (BLOCK - 4) + 1
    found = [wave_payload(m) for m in files]
    measures = [{k: _Measure() for k in FORMATS} for _ in found]
    sums, blocks, sound = [0] * len(found), [0] * len(found), [[] for _ in found]
    for group in _pieces([len(p) for _, _, p in found]):
        codes = np.frombuffer(b"".join([found[i][2][a:b] for i, a, b in group]), dtype=np.uint8)
        ends = np.cumsum([b - a for _, a, b in group])
        starts = ends - [b - a for _, a, b in group]
        wave = {k: table[codes] for k, table in laws.items()}
        wave["adpcm"] = decode_adpcm(codes.reshape(-1, BLOCK)).reshape(-1)
        edges = {k: (starts // BLOCK * each, ends // BLOCK * each) if k == "adpcm" else (starts, ends) for k in wave}
        for k, x in wave.items():
            _measure([measures[i][k] for i, _, _ in group], x, *edges[k])
        for k in {found[i][0] for i, _, _ in group}:
            lo, hi = edges[k]
            after = wave[k][hi - 1].copy()  # the last sample of a recording stands twice
            for n, (i, _, b) in enumerate(group):
                rest = found[i][2][b : b + BLOCK]
                if rest:
                    after[n] = int.from_bytes(rest[:2], "little", signed=True) if k == "adpcm" else laws[k][rest[0]]
            doubled = upsampled(wave[k], hi, after)
            for (i, _, _), a, b in zip(group, lo.tolist(), hi.tolist(), strict=True):
                if found[i][0] == k:
                    raw = doubled[2 * a : 2 * b].astype("<i2").tobytes()
                    sums[i] = zlib.crc32(raw, sums[i])
                    if pcm:
                        sound[i].append(raw)
        for (i, _, _), a, b in zip(group, *(x.tolist() for x in edges["adpcm"]), strict=True):
            blocks[i] = zlib.crc32(wave["adpcm"][a:b].astype("<i2").tobytes(), blocks[i])
    out = []
    for (codec, rate, payload), m, s, b, parts in zip(found, measures, sums, blocks, sound, strict=True):
        kinds = " ".join(f"{k} {m[k]}" for k in sorted(m))
        out.append((payload, b"".join(parts) if pcm else None, f"{codec} {rate} {kinds} pcm {s:08x} blocks {b:08x}"))
    return out


def store(docs: DataFrame, text: str = "text", id: str = "doc_id", codec: str = "mulaw") -> DataFrame:
    """(doc_id, n_bytes, media): the text's UTF-8 as the samples of a stored file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE):
            data = [t.encode() for t in text_list(part.column("text"))]
            media = pa.array([wave_file(padded(d), codec) for d in data], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(d) for d in data], pa.int64()), media], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def read(stored: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload, media, pcm, pcm_media, feature) of store()'s rows: the samples, and the file that stores them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE, "media"):
            media = part.column("media").to_pylist()
            payload, pcm, feature = zip(*expanded(media), strict=True)
            sound = [pcm_file(p, m) for p, m in zip(pcm, media, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(payload, pa.binary()), part.column("media"), pa.array(pcm, pa.binary()), pa.array(sound, pa.binary()), pa.array(feature)],
                names=["doc_id", "n_bytes", "payload", "media", "pcm", "pcm_media", "feature"],
            )

    return stored.mapInArrow(run, "doc_id long, n_bytes long, payload binary, media binary, pcm binary, pcm_media binary, feature string")


def digests(docs: DataFrame, text: str = "text", id: str = "doc_id", codec: str = "mulaw") -> DataFrame:
    """Sizes and hashes of what store() keeps and read() gets back, with the features; the files themselves stay in the task.

    pcm_media_bytes is the size of the file of resampled samples, pcm_sha256 the hash of the samples read back from it.
    """
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm_media_bytes long, pcm_sha256 string"
    names = [c.split()[0] for c in schema.split(", ")]

    def row(data: bytes, media: bytes, payload: bytes, pcm: bytes, feature: str) -> tuple:
        sound = pcm_file(pcm, media)
        samples = wave_payload(sound)[2]
        return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(sound), hashlib.sha256(samples).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE):
            data = [t.encode() for t in text_list(part.column("text"))]
            media = [wave_file(padded(d), codec) for d in data]
            rows = [row(d, m, *x) for d, m, x in zip(data, media, expanded(media), strict=True)]
            kinds = [pa.string() if "sha256" in n or n == "feature" else pa.int64() for n in names[1:]]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)]], names=names)

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
