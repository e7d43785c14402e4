"""Words of many texts cut at once, and the pace of the coder, against the library and sorting."""

from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scholium.llm import mixcoder, tokenids

CHARS = "aB zé'’stmdrevl 's're 'll\n\t   　,.12٣ñ漢字😀\0\"<|>ǅ½\x1c͸"
PARTS = [" 's", "'s", "'t", "'ll", "'re", "'ve", "''s", " ''s", "\n's", "  's", "'S", "'d5", "a's's", "  ", "\n", "\n\n", " \n a", "\t\ta", " ", "<|endoftext|>", "5's", "é's", "'lla", "'rex", "x' s", "a", "  a", "'"]


@pytest.mark.parametrize("piece", [tokenids.PIECE, 40])
def test_words_of_many_texts(monkeypatch, piece):
    monkeypatch.setattr(tokenids, "PIECE", piece)
    path = public_tokenizers.path(tokenids.VOCABULARY)
    library, encoder, r = Tokenizer.from_file(path), tokenids._Encoder(path), random.Random(piece)
    for some in (CHARS, PARTS):
        for _ in range(40):
            texts = ["".join(r.choice(some) for _ in range(r.choice((0, 1, 2, 3, 5, 30, 90)))) for _ in range(40)]
            for text, ids in zip(texts, encoder.encode(texts), strict=True):
                assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert encoder.encode([]) == []


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokenids, "MEMO_WORDS", 20)
    path = public_tokenizers.path(tokenids.VOCABULARY)
    library, encoder = Tokenizer.from_file(path), tokenids._Encoder(path)
    for lo in (0, 3, 30, 33, 0):
        texts = [" ".join(f"{chr(97 + i % 26)}x{i}" for i in range(lo, lo + 8))]
        assert encoder.encode(texts)[0].tolist() == library.encode(texts[0], add_special_tokens=False).ids
        assert len(encoder.late) + len(encoder.early) < 60


@pytest.mark.parametrize("n", [1, 999, 1000, 40_000, 300_000])
def test_blocks_of_any_shape(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 65535)
    for block in (mixcoder.BLOCK, 150_000):
        frame = mixcoder.encode(ids, block)
        assert np.array_equal(mixcoder.decode(frame), ids)
        with pytest.raises(ValueError, match="as many ids"):
            mixcoder.decode(frame[:23] + bytes([frame[23] ^ 1]) + frame[24:])
        with pytest.raises(ValueError):
            mixcoder.decode(frame[:28] + bytes([frame[28] ^ 1]) + frame[29:])
        with pytest.raises(ValueError):
            mixcoder.decode(frame[: 20 + 12 * -(-n // block)])


def test_range_coder_pace():
    """A million ids, there and back, take no longer than eight sorts of them."""
    ids = np.minimum(np.random.default_rng(1).zipf(1.2, 1 << 20), 65535)

    def seconds(work):
        taken = []
        for _ in range(4):
            began = time.process_time()
            work()
            taken.append(time.process_time() - began)
        return min(taken)

    assert seconds(lambda: mixcoder.decode(mixcoder.encode(ids))) < 8 * seconds(lambda: np.argsort(ids, kind="stable"))
