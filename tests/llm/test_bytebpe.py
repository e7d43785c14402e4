"""Byte-level BPE against the tiktoken library."""

import hashlib
import random
import sys

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from scholium.llm import bytebpe, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return bytebpe.load(public_tokenizers.path(bytebpe.VOCABULARY))


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoding(model):
    return library(model.ranks)


def test_query_against_library(spark, encoding):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.queries()["op12_bytebpe"](spark, SMALL).collect()}
    texts = dict(duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall())
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = encoding.encode_ordinary(text or "")
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_matches(model, encoding):
    r = random.Random(1)
    tokens = list(model.ranks)
    for k in range(20_000):
        piece = [bytes(r.choices(b"abcdethn aeiou", k=r.randint(1, 30))), b"".join(r.choices(tokens, k=r.randint(1, 6))), bytes(r.randrange(256) for _ in range(r.randint(1, 30)))][k % 3]
        assert list(model.encode(piece)) == encoding._encode_single_piece(piece)
    for token, rank in model.ranks.items():
        assert model.encode(token) == [rank]


def test_long_matches_take_linear_time(model, encoding):
    r = random.Random(2)
    for piece in (b"a" * 200_000, b" " * 200_000, b"ab" * 100_000, bytes(r.choices(b"etaoin", k=200_000)), b"\xff" * 50_000):
        assert list(model.encode(piece)) == encoding._encode_single_piece(piece)


def test_splitting(model, encoding):
    whole, latin = bytebpe.splitters(public_tokenizers.PATTERN)
    r = random.Random(3)
    memo = bytebpe._Memo(model)
    any_char = lambda: r.choice([r.randrange(32, 128), r.randrange(0x3000), r.randrange(0x10000, 0x1FFFF), r.randrange(sys.maxunicode), 32, 32, 10, 39, 115, 0xA0, 0x85, 0x1C])
    for _ in range(5000):
        text = "".join(chr(c) for c in (any_char() for _ in range(30)) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(b"".join(map(memo.__getitem__, whole.findall(text))), "<u4").tolist() == encoding.encode_ordinary(text)
        low = "".join(c for c in text if c <= "\xff")
        assert latin.findall(low) == whole.findall(low)


def test_any_vocabulary():
    """Vocabularies of random merges, with ids that are not in a row."""
    r = random.Random(4)
    for _ in range(60):
        ranks = {bytes([b]): 2 * b for b in range(256)}
        for k in range(r.randint(0, 40)):
            ids = library(ranks)._encode_single_piece(bytes(r.choices(b"abc", k=60)))
            at = r.randrange(len(ids) - 1)
            token = {v: t for t, v in ranks.items()}
            ranks.setdefault(token[ids[at]] + token[ids[at + 1]], 1000 + 3 * k)
        own, other = bytebpe.Ranks(ranks), library(ranks)
        for _ in range(300):
            piece = bytes(r.choices(b"abc", k=r.randint(1, 40)))
            assert own.encode(piece) == other._encode_single_piece(piece), (ranks, piece)


def test_vocabularies_that_merging_does_not_make():
    ranks = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError):
        bytebpe.Ranks({t: v for t, v in ranks.items() if v})
    with pytest.raises(ValueError):
        bytebpe.Ranks(ranks | {b"abc": 300})


def test_rows(spark, encoding):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a row"), (4, "日本語 ΟΔΟΣ <|endoftext|> don't"), (4, "日本語 ΟΔΟΣ <|endoftext|> don't"), (5, "x" * 300_000), (6, "\x00\x85 ")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, ids string, n_tokens int")
    got = bytebpe.encode(df).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    texts = dict(rows)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == encoding.encode_ordinary(texts[r.doc_id] or "") and bytes(r.decoded).decode() == (texts[r.doc_id] or "") and r.n_tokens == len(r.ids) // 4
    assert bytebpe.digests(df.filter("false")).count() == 0
