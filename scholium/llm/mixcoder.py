"""An adaptive context-mixing range coder for token ids, run on many streams in step.

A block of ids is coded by itself: its models begin anew and its checksum is its own. It is cut into streams of as many
ids each, which share the block's models. For each id, the order-2 and order-1 contexts (the ids before it in its stream)
each predict an id with a confidence; the surer one is the candidate. Whether it is right has a probability that is a
logistic mix, with weights that learn, of what orders 2, 1 and 0 have seen. If it is wrong, the id's cell follows under
adaptive order-0 frequencies, and its place in the cell, all of whose places are alike; cells hold few ids where ids are
frequent. Both are one decision of a range coder with 52-bit state and 16-bit words.

Models learn from all streams after a run of ids, short runs first. So what is the same for all ids of a run is worked out
once and looked up in small tables: the mix by both confidences, and what each value of a decision means. A writer, who
knows all ids, works on a whole run at once, but for the coder's range; a reader does a step of all streams at a time.
All arithmetic is in integers, or in floats that are exact, so any machine reads what another wrote.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

MAGIC = b"TIDS0003"
BLOCK = 4096 * 509
#: Streams of a block at most, and ids of a stream at least if it isn't the only one.
STREAMS, SHORTEST = 4096, 500
SLOTS = 1 << 17
RUN = 16
#: Ids of a block that models all learn from; later they do from a share of each run's steps, which goes round.
ALL, SHARE = 1 << 18, 4
CELLS = 1024
#: Bits of the probability that a candidate is right, of a cell's, and of both.
MIX, CELL = 12, 15
BOTH = MIX + CELL
STATE = 52  # so that a quotient's floor is that of the nearest float
TOP = STATE - 16  # the range has more bits than this before a decision
MASK = (1 << STATE) - 1
#: What a cell's count begins with and what an id adds to it.
FIRST, STEP = 1, 16


@lru_cache(1)
def _logistic() -> tuple[np.ndarray, np.ndarray]:
    """squash: 4096 points from -8 to 8 to a 12-bit probability; stretch, its inverse."""
    squash = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-(x - 2048) / 256))))) for x in range(4096)], dtype=np.int64)
    stretch = np.array([-2047 if p == 0 else min(2047, max(-2047, round(256 * math.log(p / (4096 - p))))) for p in range(4096)], dtype=np.int64)
    return squash, stretch


@lru_cache(1)
def _cells() -> tuple[np.ndarray, np.ndarray]:
    """Each cell's first id and, in the four bits above its 16, those of its width, and each id's cell. Widths are powers of two that grow with the id."""
    for sixteenths in range(1, 160):
        first, bits, at = [], [], 0
        while at < 65536:
            bits.append(max(0, ((at + 64) * sixteenths >> 10).bit_length() - 1))
            first.append(at)
            at += 1 << bits[-1]
        if len(first) <= CELLS:
            break
    of = np.searchsorted(first, np.arange(65536), side="right") - 1
    return np.array([b << 16 | a & 0xFFFF for a, b in zip(first, bits, strict=True)], dtype=np.int64), of


#: Of a key (both predict the same, order-2 confidence, order-1 confidence): what each order looks at, and whether order 2 names the candidate.
_KEYS = np.arange(32)
_TWO, _ONE, _SEEN = _KEYS >> 2 & 3, _KEYS & 3, (_KEYS >> 4) * 4 + ((_KEYS >> 2 & 3) > 0) * 2 + ((_KEYS & 3) > 0)
_FIRST = _TWO >= _ONE
#: A right candidate as a cell: it comes behind all cells.
HIT = 1 << CELL << 36 | 1 << CELL << 20
#: How many words a range lacks, by its exponent as a float's; what those words hold.
_DUE = np.array([(e < 1023 + TOP) + (e < 1023 + TOP - 16) + (e < 1023 + TOP - 32) for e in range(2048)])
_LOW = np.array([(1 << 16 * k) - 1 for k in range(4)])


class _Models:
    """What a block has seen."""

    def __init__(self) -> None:
        self.inner, self.of = _cells()
        # per context a predicted id and above its 16 bits how often it was right of late: two bits of order 1, then two of order 2
        self.one = np.zeros(65536, dtype=np.int32)
        self.two = np.zeros(SLOTS, dtype=np.int32)
        self.chance = [np.array(c) for c in ([2048, 16384, 32768, 49152], [2048, 16384, 32768, 49152], [2048, 8192, 8192, 8192, 2048, 32768, 32768, 49152])]  # 16 bits: that a prediction is right
        self.told = [np.full(len(c), 4) for c in self.chance]
        self.weight = np.full(3, 1 << 15)
        self.counts = np.full(len(self.inner), FIRST)
        self._mix()
        self._share()

    def _mix(self) -> None:
        """The probability that a candidate is right, by key, and what is left for others."""
        squash, stretch = _logistic()
        self.inputs = np.stack([stretch[c >> 4][k] for c, k in zip(self.chance, (_TWO, _ONE, _SEEN), strict=True)])
        self.mixed = squash[np.clip((self.weight @ self.inputs >> 16) + 2048, 0, 4095)]
        self.rest = (1 << MIX) - self.mixed

    def _share(self) -> None:
        """Of each cell the frequencies before it, its own, its width's bits and its first id, from the top in one number."""
        before = np.zeros(len(self.counts) + 1, dtype=np.int64)
        np.cumsum(self.counts, out=before[1:])
        before = before * ((1 << CELL) - len(self.counts)) // before[-1] + np.arange(len(before))
        own = np.diff(before)
        self.cell = before[:-1] << 36 | own << 20 | self.inner
        self.own = own

    def look(self, before: np.ndarray, last: np.ndarray, slots: np.ndarray, held: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The candidates after two ids. Into the other arrays go order 2's slots, what both contexts hold, and the keys."""
        np.multiply(before, 0x85EBCA77, out=slots)
        slots += last * 0x9E3779B1
        slots >>= 14
        slots &= SLOTS - 1
        two, one = held
        np.take(self.two, slots, out=two, mode="clip")
        np.take(self.one, last, out=one, mode="clip")
        same = two ^ one
        same &= 0xFFFF
        sure = two | one
        sure >>= 16
        sure += (same == 0).view(np.int8) << 4
        key[...] = sure
        return np.where(_FIRST[key], two, one) & 0xFFFF

    def learn(self, x: np.ndarray, last: np.ndarray, slots: np.ndarray, held: np.ndarray, key: np.ndarray, hit: np.ndarray) -> None:
        """Take in ids of a run; of those that share a context the last counts, as numpy assigns in order."""
        small = x.astype(np.int32)
        for memory, at, was, bit in ((self.two, slots, held[0], 18), (self.one, last, held[1], 16)):
            guess = was & 0xFFFF
            right = guess == small
            wrong = np.where(was >= 2 << bit, guess, small)  # sure enough to stay when wrong
            wrong |= 1 << bit
            was += 1 << bit
            guess |= 3 << bit
            np.minimum(was, guess, out=was)
            memory[at.reshape(-1)] = np.where(right, was, wrong).reshape(-1)
        n, h = np.bincount((key + (hit.view(np.int8) << 5)).reshape(-1), minlength=64).reshape(2, 32)
        n += h
        self.weight += (self.inputs @ ((h << MIX) - n * self.mixed)) // x.size >> 4
        for k, by in enumerate((_TWO, _ONE, _SEEN)):
            a, b = (np.bincount(by, weights=v).astype(np.int64) for v in (n, h))
            self.told[k] = np.minimum(self.told[k] + a, 1 << 18)
            self.chance[k] += ((b << 16) - a * self.chance[k]) // np.maximum(self.told[k], a + 1)
        self._mix()
        self.counts += STEP * np.bincount(self.of[x[~hit]], minlength=len(self.counts))
        self._share()


def _runs(steps: int, streams: int) -> Iterator[tuple[int, int, slice]]:
    """Where a run begins, how many steps it has, and which of them models learn from."""
    at, n = 0, 4
    while at < steps:
        n = min(n, steps - at)
        some = at // RUN % SHARE * n // SHARE
        yield at, n, slice(n) if at * streams < ALL else slice(some, some + n // SHARE + 1)
        at, n = at + n, min(2 * n, RUN)


def _shape(n: int) -> tuple[int, int]:
    """Steps and streams of a block of n ids."""
    streams = max(1, min(STREAMS, n // SHORTEST))
    return -(-n // streams), streams


def _write(ids: np.ndarray) -> list[bytes]:
    """The words of streams of as many ids each: ids is (steps, streams)."""
    steps, lanes = ids.shape
    models, every = _Models(), np.arange(lanes)
    before = np.zeros((steps + 2, lanes), dtype=np.int64)
    before[2:] = ids
    width = 5 * steps // 2 + 8  # an id takes 38 bits at most
    words = np.zeros((lanes, width), dtype=np.int32)
    flat = words.reshape(-1)
    low, size = np.zeros(lanes, dtype=np.int64), np.full(lanes, 1 << (STATE - 1), dtype=np.int64)
    at = every * width + 1  # word 0 takes a carry out of the first
    lows, ats, due = (np.empty((RUN, lanes), dtype=kind) for kind in (np.int64, np.int64, np.int8))
    room = np.empty((RUN, lanes), dtype=np.int64), np.empty((2, RUN, lanes), dtype=np.int32), np.empty((RUN, lanes), dtype=np.int64)
    step = np.empty(lanes, dtype=np.int64)
    for t, n, learnt in _runs(steps, lanes):
        x, last = before[t + 2 : t + 2 + n], before[t + 1 : t + 1 + n]
        slots, held, key = room[0][:n], room[1][:, :n], room[2][:n]
        hit = models.look(before[t : t + n], last, slots, held, key) == x
        cell = np.where(hit, HIT, models.cell[models.of[x]])
        rest = models.rest[key]
        starts, sizes = rest * (cell >> 36), np.where(hit, (1 << MIX) - rest, rest) * (cell >> 20 & 0xFFFF)
        shifts, places = cell >> 16 & 15, (x - (cell & 0xFFFF)) * ~hit
        for i in range(n):
            part = size >> BOTH
            low += np.multiply(part, starts[i], out=step)
            part *= sizes[i]
            part >>= shifts[i]
            low += np.multiply(part, places[i], out=step)
            k = _words_due(part)
            lows[i], ats[i], due[i] = low, at, k
            at += k
            k <<= 4
            low <<= k
            low &= MASK
            size = np.left_shift(part, k, out=part)
        some, to, k = lows[:n].reshape(-1), ats[:n].reshape(-1), due[:n].reshape(-1)
        carry = to[some > MASK] - 1  # into the word before, which may be of this run
        for j in range(3):
            out = np.flatnonzero(k > j)
            some, to, k = some[out], to[out], k[out]
            flat[to + j] = (some >> (TOP - 16 * j)) & 0xFFFF
        np.add.at(flat, carry, 1)
        models.learn(x[learnt], last[learnt], slots[learnt], held[:, learnt], key[learnt], hit[learnt])
    flat[at] = (low + (1 << TOP) - 1) >> TOP  # a number within the range, and zeros behind it
    count = at - every * width + 1
    while len(over := np.flatnonzero(flat > 0xFFFF)):
        flat[over] &= 0xFFFF
        np.add.at(flat, over - 1, 1)
    return [w[1:n].astype("<u2").tobytes() for w, n in zip(words, count.tolist(), strict=True)]


def _words_due(size: np.ndarray) -> np.ndarray:
    """How many words a range lacks."""
    return _DUE[size.astype(np.float64).view(np.int64) >> 52]


def _read(payloads: list[bytes], steps: int) -> np.ndarray:
    """The ids (steps, streams) of words that _write() gave."""
    lanes = len(payloads)
    models, every = _Models(), np.arange(lanes)
    width = max(map(len, payloads), default=0) // 2 + 8 + 3 * RUN
    w = np.zeros((lanes, width), dtype=np.int64)
    for i, p in enumerate(payloads):
        w[i, : len(p) // 2] = np.frombuffer(p[: len(p) // 2 * 2], dtype="<u2")
    window = w << TOP  # the STATE bits from each word on
    for k, shift in ((1, TOP - 16), (2, TOP - 32)):
        window[:, :-k] |= w[:, k:] << shift
    window[:, :-3] |= w[:, 3:] >> (48 - TOP)
    window = window.reshape(-1)
    at, end = every * width, every * width + width - 4 - 3 * RUN
    low, size = window.take(at), np.full(lanes, 1 << (STATE - 1), dtype=np.int64)
    out = np.zeros((steps + 2, lanes), dtype=np.int64)
    room = np.empty((RUN, lanes), dtype=np.int64), np.empty((2, RUN, lanes), dtype=np.int32), np.empty((RUN, lanes), dtype=np.int64)
    hits = np.empty((RUN, lanes), dtype=bool)
    for t, n, learnt in _runs(steps, lanes):
        slots, held, keys = room[0][:n], room[1][:, :n], room[2][:n]
        by_share = np.append(np.repeat(models.cell, models.own), HIT)
        for i in range(n):
            key, hit = keys[i], hits[i]
            candidate = models.look(out[t + i], out[t + i + 1], slots[i], held[:, i], key)
            rest = models.rest[key]
            part = size >> BOTH
            share = (low / part).astype(np.int64)
            share = (share / rest).astype(np.int64)
            np.minimum(share, 1 << CELL, out=share)
            np.equal(share, 1 << CELL, out=hit)
            cell = by_share[share]
            own = cell >> 20
            own &= 0xFFFF
            own *= np.where(hit, (1 << MIX) - rest, rest)
            rest *= cell >> 36
            rest *= part
            low -= rest
            part *= own
            own = cell >> 16
            own &= 15
            part >>= own
            place = (low / part).astype(np.int64)
            low -= part * place
            place += cell
            place &= 0xFFFF
            out[t + i + 2] = np.where(hit, candidate, place)
            k = _words_due(part)
            at += k
            new = window[at]
            new &= _LOW[k]
            k <<= 4
            low <<= k
            low |= new
            size = np.left_shift(part, k, out=part)
        np.minimum(at, end, out=at)  # a damaged block can ask for more words than there are
        models.learn(out[t + 2 : t + n + 2][learnt], out[t + 1 : t + n + 1][learnt], slots[learnt], held[:, learnt], keys[learnt], hits[:n][learnt])
    return out[2:]


def _pack(ids: np.ndarray) -> bytes:
    """A block: sizes of its streams, their words. The last streams are filled up with zeros."""
    steps, lanes = _shape(len(ids))
    table = np.zeros(steps * lanes, dtype=np.uint16)
    table[: len(ids)] = ids
    payloads = _write(np.ascontiguousarray(table.reshape(lanes, steps).T))
    return struct.pack(f"<{lanes}I", *map(len, payloads)) + b"".join(payloads)


def _unpack(block: bytes, n: int) -> np.ndarray:
    steps, lanes = _shape(n)
    at, payloads = 4 * lanes, []
    if len(block) < at:
        raise ValueError("a block without its sizes")
    for size in struct.unpack_from(f"<{lanes}I", block):
        payloads.append(block[at : at + size])
        at += size
    return np.ascontiguousarray(_read(payloads, steps).astype(np.uint16).T).reshape(-1)[:n].astype("<u4")


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A frame of ids under 65536: header, sizes and checksums of its blocks, the blocks."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if len(ids) and int(ids.max()) > 0xFFFF:
        raise ValueError("an id of more than 16 bits")
    cuts = [ids[s : s + block] for s in range(0, len(ids), block)]
    packed = [_pack(x) for x in cuts]
    heads = [struct.pack("<III", len(x), len(p), zlib.crc32(x.tobytes())) for x, p in zip(cuts, packed, strict=True)]
    return MAGIC + struct.pack("<III", len(ids), block, len(cuts)) + b"".join(heads) + b"".join(packed)


def decode(frame: bytes) -> np.ndarray:
    """The ids of a frame; each block is held against its checksum."""
    if frame[:8] != MAGIC:
        raise ValueError("not a frame of token ids")
    total, block, count = struct.unpack_from("<III", frame, 8)
    at, found = 20 + 12 * count, [np.zeros(0, dtype="<u4")]
    for i in range(count):
        n, size, crc = struct.unpack_from("<III", frame, 20 + 12 * i)
        if n != min(block, total - i * block):
            raise ValueError(f"block {i} is not of as many ids as it says")
        found.append(_unpack(frame[at : at + size], n))
        at += size
        if zlib.crc32(found[-1].tobytes()) != crc:
            raise ValueError(f"block {i} is damaged")
    out = np.concatenate(found)
    if len(out) != total:
        raise ValueError("a frame with ids missing")
    return out
