"""Long words, long texts, many languages and hot lines: all of a text counts, and models against plain versions."""

import math
import random
import sys
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from scholium.llm import bpe, language, linededup, simhash, telephony, toxicity
from scholium.llm.common import is_held_out

SF = "/root/testdata/sf0.01"


def plain_ratios(texts, toxic, fitted):
    """Each word's log-likelihood ratio, from dictionaries of beginnings."""
    T = toxicity
    counts = defaultdict(lambda: [0, 0])
    vocabulary = set()
    for i, t in texts.items():
        if i in toxic and not is_held_out(i):
            vocabulary |= T.terms(t)
            if not (fitted and zlib.crc32(str(i).encode()) % 4 == 1):
                for w in T.terms(t):
                    counts[w][toxic[i]] += 1
    follows = defaultdict(int)
    for w in vocabulary:
        cell = b"\0" + w.encode() + b"\0"
        for a, b in zip(cell, cell[1:]):
            follows[a, b] += 1
    after, different = defaultdict(int), defaultdict(int)
    for (a, _), n in follows.items():
        after[a] += n
        different[a] += 1
    low = lambda a, b: (max(follows.get((a, b), 0) - T.DISCOUNT, 0) + (T.DISCOUNT * different[a] + 1) / 256) / (after[a] + 1)
    nexts = defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for w, c in counts.items():
        cell = w.encode() + b"\0"
        for k in range(len(cell)):
            for j in (0, 1):
                nexts[cell[:k]][cell[k]][j] += c[j]

    def ratio(word):
        cell, total = word.encode() + b"\0", 0.0
        for k in range(len(cell)):
            at = nexts.get(cell[:k])
            if at is None or cell[k] not in at or len(at) < 2 and sum(map(sum, at.values())) == 0:
                continue
            sums = [sum(c[j] for c in at.values()) for j in (0, 1)]
            if not all(sums):
                continue
            if len(at) == 1:
                continue  # words don't part here
            kinds = [sum(c[j] > 0 for c in at.values()) for j in (0, 1)]
            q = low(cell[k - 1] if k else 0, cell[k])
            shared = (max(sum(at[cell[k]]) - T.DISCOUNT, 0) + T.DISCOUNT * len(at) * q) / sum(sums)
            p = [(max(at[cell[k]][j] - T.DISCOUNT, 0) + (T.BACKOFF + T.DISCOUNT * kinds[j]) * shared) / (sums[j] + T.BACKOFF) for j in (0, 1)]
            r = math.log(p[1] / p[0])
            total += r if abs(r) >= T.EVIDENCE else 0.0
        return total

    return ratio


def test_toxicity_against_a_plain_version(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    toxic = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    ratio = plain_ratios(texts, toxic, False)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for i, t in texts.items():
        words = toxicity.terms(t)
        over = sorted((r - toxicity.STRONG for r in map(ratio, words) if r > toxicity.STRONG), reverse=True)
        x = np.array([sum(over) / max(1, len(words)), *(over + [0.0] * 3)[:3]])
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(x @ model.weights[:-1] + model.weights[-1]))), abs=1e-6), i


def test_toxicity_recall(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, labels)).filter("held_out").collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if r.doc_id in got]
    toxic, ordinary = ([p for x, p in held if x == c] for c in (1, 0))
    assert sum(toxic) >= 0.9 * len(toxic) and sum(ordinary) <= 0.02 * len(ordinary)


def test_toxicity_reads_all_of_long_words(spark):
    r = random.Random(3)
    word = lambda n: "".join(r.choices("abdefghiklnoprstu", k=n))
    rows = [(i, i % 2) for i in range(400)]
    han = lambda n: "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(n))
    docs = [(i, " ".join([word(r.randint(2, 7)) for _ in range(30)] + (["vileword", "坏词语"] if toxic else []) + [han(6)])) for i, toxic in rows]
    probes = [(1000, word(5000)), (1001, word(2500) + "vileword" + word(2500)), (1002, han(3000)), (1003, han(1500) + "坏词语" + han(1500)), (1004, "VILEWORD"), (1005, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame(rows, "doc_id long, toxic int"))
    got = {x.doc_id: x.score for x in toxicity.score(spark.createDataFrame(probes, "doc_id long, text string"), model).collect()}
    assert got[1001] > got[1000] and got[1003] > got[1002] and got[1004] > 0.3 and got[1005] < 0.3


def test_language_reads_all_of_long_runs(spark):
    r = random.Random(1)
    pool = {"aa": "abcdef", "bb": "uvwxyz"}
    text = lambda x, n: "".join(r.choices(pool[x], k=n))
    docs = spark.createDataFrame([(i, " ".join(text(x, 6) for _ in range(30)), x) for i, x in enumerate(["aa", "bb"] * 60)], "doc_id long, text string, lang string")
    model = language.train(docs)
    probes = spark.createDataFrame([(1, text("aa", 50) + text("bb", 5000)), (2, text("bb", 50) + text("aa", 5000)), (3, "漢" * 30 + text("aa", 100))], "doc_id long, text string")
    got = {x.doc_id: x for x in language.identify(probes, model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[3].lang_pred) == ("bb", "aa", "aa")
    assert sum(s["words"] for s in got[1].spans) == math.ceil(5050 / language.RUN)


def test_two_hundred_languages(spark):
    r = random.Random(2)
    syllables = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(4000)]
    own = {f"l{n:03d}": syllables[20 * n : 20 * n + 20] for n in range(200)}
    text = lambda x: " ".join("".join(r.choices(own[x], k=2)) for _ in range(25))
    rows = [(i, text(x), x) for i, x in enumerate(sorted(own) * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert len(model.languages) == 200
    got = language.identify(docs, model).collect()
    truth = {i: x for i, _, x in rows}
    assert sum(x.lang_pred == truth[x.doc_id] for x in got if x.held_out) > 0.95 * sum(x.held_out for x in got)


def test_a_hundred_thousand_equal_lines(spark):
    df = spark.createDataFrame([(1, "the same line again\n" * 100_000), (2, "own words\n" + "the same line again\n" * 50_000)], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r.text for r in linededup.report(df).collect()}
    assert time.time() - began < 20
    assert len(got[1]) < 400 and got[2] == "own words\n"


def test_equal_lines_between_blank_ones(spark):
    verse = "".join(f"{x} {x}\n\n" for x in "abcdefghijklmnopqrstuvwxyz") * 1
    docs = {1: verse, 2: "other\n" + verse}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.report(df).collect()}
    verse_bytes = len(verse.encode())
    assert got[1] == verse and (got[2] == "other\n" if verse_bytes >= linededup.LEAST else got[2] == docs[2])


def test_simhash_stage_keeps_rows_of_one_id_by_their_own_text(spark):
    words = lambda s: " ".join(f"{s}{i}" for i in range(60))
    rows = [(1, words("a"), "x"), (1, words("b"), "x"), (1, words("b"), "y"), (2, words("a"), "x"), (3, words("c"), "x"), (None, words("c"), "x")]
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], "doc_id long, text string, other string, _kept string, row int, component_id int")
    out = simhash.deduplicated(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text[:1]) for r in out.collect()) == [("1", "a"), ("1", "b"), ("3", "c"), ("None", "c")]


def test_bpe_of_letters_whose_lower_case_is_newer():
    model = bpe.bpe(public_tokenizers.path(bpe.VOCABULARY))
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if not 0xD800 <= c < 0xE000 and ch.lower() != ch:
            for text in (f"a{ch}b", f"﻿{ch}", f"!{ch}1 {ch}"):
                words = model.words(text)
                assert words is None or [i for w in words for i in model.merge(w)] == model.library.encode(text, add_special_tokens=False).ids


def test_lexicon_has_the_most_frequent_words(spark, monkeypatch):
    words = [f"w{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(300)]
    text = " ".join(w for n, w in enumerate(words) for _ in range(2 + n // 10))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    taken = []
    monkeypatch.setattr(bpe, "compile_lexicon", lambda entries: taken.extend(w for w, _ in entries) or b"")
    bpe.frequent_words(df, most=25)
    assert set(words[-20:]) <= set(taken) and len(taken) <= 25 and set(taken) <= set(words[-30:])
    taken.clear()
    bpe.frequent_words(df, most=1000)
    assert sorted(taken) == words


def test_telephony_features_sample_by_sample(monkeypatch):
    r = random.Random(5)
    laws = telephony.law_tables()
    files = {codec: [telephony.wave_file(telephony.padded(bytes(r.randrange(256) for _ in range(n))), codec) for n in (0, 10, 64, 700, 1500)] for codec in telephony.FORMATS}

    def plain(media):
        codec, rate, payload = telephony.wave_payload(media)
        waves = {k: [int(t[b]) for b in payload] for k, t in laws.items()}
        waves["adpcm"] = telephony.decode_adpcm(np.frombuffer(payload, np.uint8).reshape(-1, 64)).reshape(-1).tolist()
        kinds = []
        for k in sorted(waves):
            w = waves[k]
            kinds.append(f"{k} {sum(x * x for x in w) // len(w)}/{max(map(abs, w))}/{sum((a < 0) != (b < 0) for a, b in zip(w, w[1:]))}")
        w = waves[codec]
        doubled = [y for a, b in zip(w, [*w[1:], w[-1]]) for y in (a, (a + b) >> 1)]
        pcm = np.array(doubled, "<i2").tobytes()
        return payload, pcm, f"{codec} {rate} {' '.join(kinds)} pcm {zlib.crc32(pcm):08x} blocks {zlib.crc32(np.array(waves['adpcm'], '<i2').tobytes()):08x}"

    for piece in (64, 192, 1 << 19):
        monkeypatch.setattr(telephony, "PIECE", piece)
        for codec in files:
            assert telephony.expanded(files[codec]) == [plain(m) for m in files[codec]]
