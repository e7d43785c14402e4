"""A minimal acyclic transducer from words to id sequences, in one memory-mapped file.

Words share prefixes and suffixes: equal right languages are one state (incremental construction over sorted words).
Each arc carries how many words sort before its target's, so the sum along a path is the word's ordinal, and the
ordinal finds its output. File layout, little endian: magic, six counts and a CRC-32 of the rest, then the arrays in
ARRAYS order. A Lexicon maps a file without a name on its worker's own disk, which it writes from the bytes it was given
and which goes with the mapping; no other process reads it.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import zlib
from collections.abc import Iterable

import numpy as np

MAGIC = b"LEXT0001"
ARRAYS = (("first_arc", "<u4"), ("final", "u1"), ("label", "u1"), ("target", "<u4"), ("before", "<u4"), ("output_at", "<u4"), ("output", "<u4"))


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self) -> None:
        self.arcs: dict[int, _State] = {}
        self.final = False
        self.number = -1
        self.words = 0

    def key(self) -> tuple:
        return (self.final, *((c, id(s)) for c, s in self.arcs.items()))


def compile_lexicon(entries: Iterable[tuple[str, list[int]]]) -> bytes:
    """The file's bytes for (word, ids); words are distinct. Empty input gives a lexicon without words."""
    sorted_entries = sorted((w.encode("utf-8", "surrogatepass"), ids) for w, ids in entries)
    root, register, path = _State(), {}, []
    path.append(root)
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            child = path.pop()
            label = last[len(path) - 1]
            path[-1].arcs[label] = register.setdefault(child.key(), child)

    for word, _ in sorted_entries:
        common = len(os.path.commonprefix((last, word)))
        close(common)
        for c in word[common:]:
            state = _State()
            path[-1].arcs[c] = state
            path.append(state)
        path[-1].final = True
        last = word
    close(0)

    order: list[_State] = []
    stack: list[tuple[_State, bool]] = [(root, False)]
    while stack:  # children before parents
        state, done = stack.pop()
        if done:
            state.number = len(order)
            state.words = state.final + sum(s.words for s in state.arcs.values())
            order.append(state)
        elif state.number == -1:
            state.number = -2
            stack.append((state, True))
            stack.extend((s, False) for s in state.arcs.values() if s.number == -1)
    first, label, target, before = [0], [], [], []
    for state in order:
        passed = int(state.final)
        for c in sorted(state.arcs):
            label.append(c)
            target.append(state.arcs[c].number)
            before.append(passed)
            passed += state.arcs[c].words
        first.append(len(label))
    at = np.cumsum([0, *(len(ids) for _, ids in sorted_entries)])
    data = {
        "first_arc": first, "final": [s.final for s in order], "label": label, "target": target, "before": before,
        "output_at": at, "output": [i for _, ids in sorted_entries for i in ids],
    }
    body = b"".join(np.asarray(data[n], dtype=t).tobytes() for n, t in ARRAYS)
    counts = np.array([len(order), len(label), len(sorted_entries), len(data["output"]), root.number, zlib.crc32(body)], dtype="<u4")
    return MAGIC + counts.tobytes() + body


class Lexicon:
    """A compiled lexicon, mapped from a file of this process that goes when the mapping does."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a lexicon")
        states, arcs, words, outputs, self._root, crc = np.frombuffer(data, "<u4", 6, 8).tolist()
        if zlib.crc32(data[32:]) != crc:
            raise ValueError("the lexicon is damaged")
        with tempfile.NamedTemporaryFile() as f:
            f.write(data)
            f.flush()
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = {"first_arc": states + 1, "final": states, "label": arcs, "target": arcs, "before": arcs, "output_at": words + 1, "output": outputs}
        at = 32
        for name, kind in ARRAYS:
            end = at + sizes[name] * np.dtype(kind).itemsize
            setattr(self, "_" + name, memoryview(self._map)[at:end].cast("I" if kind == "<u4" else "B"))
            if name == "label":
                self._labels_at = at
            at = end
        self.words, self.states = words, states

    def get(self, word: str) -> list[int] | None:
        """The ids of a word, or None for one that isn't in the lexicon."""
        state, ordinal, base = self._root, 0, self._labels_at
        first, before, target, find = self._first_arc, self._before, self._target, self._map.find
        for c in word.encode("utf-8", "surrogatepass"):
            arc = find(c.to_bytes(), base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            ordinal += before[arc]
            state = target[arc]
        if not self._final[state]:
            return None
        return self._output[self._output_at[ordinal] : self._output_at[ordinal + 1]].tolist()
