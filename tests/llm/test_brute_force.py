"""The corpus operators against plain versions, exact round trips and held-out rows."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from scholium.llm import bpe, decontaminate, extraction, language, lexicon, licenses, linededup, mixcoder, queries, simhash, telephony, tokenids, toxicity
from scholium.llm.common import is_held_out

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall())


def rows(spark, name):
    return queries.queries()[name](spark, SMALL).collect()


def slow_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 4 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_simhash(spark, texts):
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    groups = slow_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op6_simhash")}
    assert got == {i: (f"{fps[i]:016x}", groups[i]) for i in texts}


@pytest.mark.parametrize("crowd", [2, 8, 1024])
def test_simhash_crowded_keys(spark, crowd):
    r = random.Random(5)
    fps = set()
    for _ in range(12):
        center = r.getrandbits(64)
        for _ in range(25):
            x = center
            for _ in range(r.randint(0, 5)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    groups = slow_components({f: f for f in fps})
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {x.node: x.root for x in simhash.components(simhash.links(df, 4, crowd)).collect()}
    by_root: dict = {}
    for f in fps:
        by_root.setdefault(groups[f], set()).add(signed(f))
    want = {frozenset(g) for g in by_root.values() if len(g) > 1}
    found: dict = {}
    for node, root in got.items():
        found.setdefault(root, set()).add(node)
    assert {frozenset(g) for g in found.values()} == want


def test_bpe(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows(spark, "op10_bpe")}
    for i, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_bpe_odd_characters():
    model = bpe.bpe(public_tokenizers.path(bpe.VOCABULARY))
    r = random.Random(3)
    odd = ["", "İstanbul ΟΔΟΣ", "a\x1cb\x85c", "<|startoftext|> x <|endoftext|>", "don't WE'RE ''s", "é é ﬁ ½²", "x" * 3000] + ["".join(chr(r.choice([r.randrange(32, 0x600), r.randrange(32, 0x3000), r.randrange(0x10000, 0x1FFFF)])) for _ in range(60)) for _ in range(200)]
    told = 0
    for text in odd:
        words = model.words(text)
        if words is not None:
            told += 1
            assert [i for w in words for i in model.merge(w)] == model.library.encode(text, add_special_tokens=False).ids
    assert told > 3


def test_lexicon():
    r = random.Random(1)
    entries = {"".join(r.choices("abcé", k=r.randint(1, 9))): [r.randrange(1 << 32) for _ in range(r.randint(1, 4))] for _ in range(3000)}
    built = lexicon.Lexicon(lexicon.compile_lexicon(entries.items()))
    assert built.words == len(entries) and built.states < sum(map(len, entries))
    assert all(built.get(w) == ids for w, ids in entries.items())
    assert all(built.get(w) is None for w in ("", "d", "aé" * 9))
    empty = lexicon.Lexicon(lexicon.compile_lexicon([]))
    assert empty.get("a") is None and empty.get("") is None
    broken = bytearray(lexicon.compile_lexicon(entries.items()))
    broken[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        lexicon.Lexicon(bytes(broken))


def test_token_ids(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path(tokenids.VOCABULARY))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op3_tokenids")}
    at = 0
    for i in sorted(texts):
        ids = np.array([*t.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        assert got[i] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_range_coder(n):
    r = np.random.default_rng(n)
    for ids in (r.integers(0, 65536, n), np.minimum(r.zipf(1.2, n), 65535), np.full(n, 65535), np.tile([5, 6, 7, 50256], n)[:n], np.zeros(n, int)):
        frame = mixcoder.encode(ids, block=256)
        assert np.array_equal(mixcoder.decode(frame), ids)
        if n > 2:
            broken = bytearray(frame)
            broken[-4] ^= 0x55
            broken[30] ^= 1
            with pytest.raises(ValueError):
                mixcoder.decode(bytes(broken))
    with pytest.raises(ValueError):
        mixcoder.encode(np.array([65536]))


def test_range_coder_gains():
    ids = np.tile(np.arange(300), 60)
    assert len(mixcoder.encode(ids)) < len(ids) // 2


def test_range_coder_keeps_pace():
    """A million ids, there and back, take no longer than a few dozen sorts of them."""
    ids = np.minimum(np.random.default_rng(1).zipf(1.2, 1 << 20), 65535)

    def seconds(work):
        taken = []
        for _ in range(2):
            began = time.process_time()
            work()
            taken.append(time.process_time() - began)
        return min(taken)

    assert seconds(lambda: mixcoder.decode(mixcoder.encode(ids))) < 30 * seconds(lambda: np.argsort(ids, kind="stable"))


#: Of a plainer winnowing, whose windows are of three lines.
WINDOW, SHORT, LONG = 3, 16, 80


def slow_line_dedup(docs):
    cut = re.compile(r"(?<=\n)|(?<= )(?=[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ])")
    lines = {i: cut.split(t) for i, t in docs.items()}
    plain = {i: [x.strip(" \t\r\n") for x in x_] for i, x_ in lines.items()}
    size = {i: [len(x.encode()) for x in x_] for i, x_ in lines.items()}

    def signed(s):
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        return h - (1 << 64) if h >= 1 << 63 else h

    first, marks = {}, {}
    for i in sorted(docs):
        rank = [(n < SHORT, signed(s), -k) for k, (s, n) in enumerate(zip(plain[i], size[i]))]
        chosen = {-min(rank[a : a + WINDOW])[2] for a in range(max(1, len(rank) - WINDOW + 1))} | {k for k, n in enumerate(size[i]) if n >= LONG}
        marks[i] = sorted(k for k in chosen if plain[i][k])
        for k in marks[i]:
            first.setdefault(plain[i][k], (i, k))
    low = lambda i, k: signed(plain[i][k]) & 0xFFFF if 0 <= k < len(plain[i]) else None
    out = {}
    for i in docs:
        met = set()
        for k in marks[i]:
            j, q = first[plain[i][k]]
            before, after = low(i, k - 1), low(i, k + 1)
            if (j, q) != (i, k) and (size[i][k] >= linededup.LEAST or before is not None and before == low(j, q - 1) or after is not None and after == low(j, q + 1)):
                met.add((j, q - k))
        gone = set()
        for j, d in met:
            run = []
            for k in range(len(plain[i]) + 1):
                if k < len(plain[i]) and 0 <= k + d < len(plain[j]) and plain[i][k] == plain[j][k + d]:
                    run.append(k)
                else:
                    if run and sum(size[i][x] for x in run) >= linededup.LEAST:
                        gone.update(run)
                    run = []
        out[i] = (len(gone), "".join(x for k, x in enumerate(lines[i]) if k not in gone))
    return out


def test_line_dedup(spark, texts):
    assert {r.doc_id: (r.n_deleted, r.text) for r in rows(spark, "op7_linededup")} == slow_line_dedup(texts)


def test_line_dedup_passages(spark):
    r = random.Random(2)
    words = lambda n: " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(n))
    passage = ". ".join(words(9).capitalize() for _ in range(7)) + "."
    docs = {0: f"{words(30)} {passage} {words(30)}", 1: f"{words(40)}\n{passage}\n{words(20)}", 2: words(80), 3: f"Own text {words(10)}. {passage}"}
    df = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, other string")
    out = {x.doc_id: x.text for x in linededup.deduplicated(df, boundary=linededup.BOUNDARY).collect()}
    assert out[0] == docs[0] and out[2] == docs[2]
    assert passage not in out[1] and passage not in out[3] and out[3].startswith("Own text")
    assert linededup.deduplicated(df, boundary=linededup.BOUNDARY).columns == df.columns


def test_decontamination_finds_items_in_long_documents(spark):
    r = random.Random(4)
    words = lambda n: ["".join(r.choices("abcdefgh", k=4)) for _ in range(n)]
    items = {i: words(r.choice([1, 3, 5, 6, 12, 40, 90])) for i in range(60)}
    docs = {}
    for d in range(80):
        body, item = words(r.choice([3, 50, 4000])), list(items[r.randrange(60)])
        for _ in range(r.choice([0, 0, 1, 2, 6])):
            item[r.randrange(len(item))] = "changed"
        at = r.randrange(len(body))
        docs[d] = " ".join(body[:at] + item + body[at:])
    shingles = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    want = set()
    for d, t in docs.items():
        for i, w in items.items():
            k = min(5, len(w))
            own = shingles(w, k)
            if len(own & shingles(t.split(), k)) >= 0.8 * len(own) - 1e-9:
                want.add((d, i))
    a = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(w).upper()) for i, w in items.items()], "item_id long, text string")
    assert want and {(x.doc_id, x.item_id) for x in decontaminate.find(a, b).collect()} == want
    assert {(x.doc_id, x.item_id) for x in decontaminate.find(a, b, block_chars=2000).collect()} == want


def test_telephony(spark, texts):
    for r in rows(spark, "op8_telephony"):
        data = texts[r.doc_id].encode()
        payload = data + bytes(-len(data) % 64) or bytes(64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        media = telephony.wave_file(payload)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())


def test_telephony_codecs(spark):
    laws = telephony.law_tables()
    assert laws["mulaw"][[0xFF, 0x7F, 0x80, 0x00]].tolist() == [0, 0, 32124, -32124]
    assert laws["alaw"][[0xD5, 0x55, 0xAA, 0x2A]].tolist() == [8, -8, 32256, -32256]
    block = np.random.default_rng(0).integers(0, 256, (5, 64)).astype(np.uint8)
    for b, got in zip(block, telephony.decode_adpcm(block), strict=True):
        value, index = int(np.int16(int(b[0]) | int(b[1]) << 8 if b[1] < 128 else (int(b[0]) | int(b[1]) << 8) - 65536)), min(88, int(b[2]))
        want = [value]
        for byte in b[4:].tolist():
            for code in (byte & 15, byte >> 4):
                step = int(telephony.STEPS[index])
                change = step // 8 + step * (code >> 2 & 1) + step // 2 * (code >> 1 & 1) + step // 4 * (code & 1)
                value = max(-32768, min(32767, value - change if code & 8 else value + change))
                index = max(0, min(88, index + [-1, -1, -1, -1, 2, 4, 6, 8][code & 7]))
                want.append(value)
        assert got.tolist() == want
    df = spark.createDataFrame([(1, "a" * 100), (2, None)], "doc_id long, text string")
    for codec in telephony.FORMATS:
        out = {r.doc_id: r for r in telephony.read(telephony.store(df, codec=codec)).collect()}
        assert out[1].payload == b"a" * 100 + bytes(28) and out[2].payload == bytes(64) and out[1].feature.startswith(codec)
        assert len(out[1].pcm) == (128 * 4 if codec != "adpcm" else 2 * 121 * 4)
        assert telephony.wave_payload(out[1].pcm_media) == ("pcm", 2 * telephony.RATE, out[1].pcm)
        seen = {r.doc_id: r for r in telephony.digests(df, codec=codec).collect()}
        assert all((seen[i].pcm_sha256, seen[i].pcm_media_bytes) == (hashlib.sha256(out[i].pcm).hexdigest(), len(out[i].pcm_media)) for i in (1, 2))


def test_language(spark):
    out = language.identify
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = out(docs, language.train(docs)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if is_held_out(i)}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_language_spans():
    scores = np.array([[0, -20.0], [-20.0, 0], [-1.0, 0]], dtype=np.float32)
    words = np.array([0, 0, 2, 0, 1, 1, 1])
    assert language.viterbi(scores, words, np.array([7])).tolist() == [0, 0, 0, 0, 1, 1, 1]
    assert language.viterbi(scores, np.array([2, 0, 1]), np.array([1, 2]), penalty=30).tolist()[0] == 1


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    from itertools import product

    for _ in range(30):
        scores = r.normal(size=(4, 3)).astype(np.float32) * 5
        words = r.integers(0, 4, 6)
        cost = lambda p: sum(scores[w, s] for w, s in zip(words, p)) - 3.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023,E731
        best = max(map(cost, product(range(3), repeat=6)))
        assert cost(language.viterbi(scores, words, np.array([6]), 3.0)) == pytest.approx(best, abs=1e-3)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scores = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    held = [(r.toxic, scores[r.doc_id]) for r in labels.collect() if scores[r.doc_id].held_out]
    assert all(0 <= s.score <= 1 and s.predicted == int(s.score >= 0.3) for _, s in held)
    pairs = [(a.score, b.score) for x, a in held for y, b in held if x == 1 and y == 0]
    assert sum(a > b for a, b in pairs) > 0.85 * len(pairs)


def test_licenses_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = sorted(con.execute(licenses.scan_sql()).fetchall())
    assert sorted(tuple(r) for r in rows(spark, "op1_licenses")) == want


def test_license_texts(spark):
    assert all(any(a in s for a in licenses.ANCHORS) for s in licenses.known_sentences())
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\n// of this software and associated documentation files (the \"Software\"), to deal\n// in the Software without restriction, including without limitation the rights\n// to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n// copies of the Software, and to permit persons to whom the Software is\n// furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    cases = {
        1: (mit, "MIT"), 2: ("Foo\nThis work is licensed under the GNU General Public License, version 3.\nBar", "GPL-3.0-only"), 3: ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), 4: ("Released under the MIT License. All rights reserved.", "MIT,All-Rights-Reserved"),
        5: ("We talked about the license of a driver.", ""), 6: ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GPL-2.0-or-later"),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id long, text string")
    assert {r.doc_id: r.licenses for r in licenses.scan(df).collect()} == {i: x for i, (_, x) in cases.items()}


def test_extraction():
    field = extraction.train()
    test = extraction.training_pages(80, seed=99)
    right = sum(a == b for p, y in test for a, b in zip(field.decode(extraction.features(p)), y, strict=True))
    assert right > 0.99 * sum(len(y) for _, y in test)
    page = "<html><head><title>T</title><script>x('</p>')</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Head &eacute;</h1><p><b>One <i>tw</i>o.<br>Three<p>Four.</p><div class='ad'>Buy now.</div><section class=comments><p>I like it a lot.</p></section></article><footer>&copy; me</footer>"
    assert extraction.main_text(page, field) == "Head é One two. Three Four."


def test_extraction_is_viterbi():
    from itertools import product

    r = np.random.default_rng(0)
    for _ in range(20):
        field = extraction.Field(r.normal(size=(5, 2)), r.normal(size=(2, 2)) * 2)
        page = [[0, 1], [2], [3, 4], [1], [0, 4]]
        cost = lambda p: sum(field.emission[f, s].sum() for f, s in zip(page, p)) + sum(field.transition[a, b] for a, b in zip(p, p[1:]))  # noqa: B023,E731
        assert cost(field.decode(page)) == pytest.approx(max(map(cost, product((0, 1), repeat=5))))


def test_pipeline_against_stages(spark, texts):
    got = {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r.doc_id for r in language.filtered(docs, language.train(docs)).select("doc_id").collect()}
    short = {i: t for i, (_, t) in slow_line_dedup({i: texts[i] for i in kept}).items()}
    groups = slow_components({i: slow_fingerprint(t) for i, t in short.items()})
    alone = {i: short[i] for i in groups if groups[i] == i}
    items = [t for (t,) in duckdb.sql(f"select text from '{SMALL}/benchmark.parquet'").fetchall()]
    words = lambda t: re.findall(r"\w+", t.lower())
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    leaked = {i for i, t in alone.items() if any(len(s & shingles(words(t))) >= 0.8 * len(s) for s in map(shingles, map(words, items)) if s)}
    assert got == set(alone) - leaked
