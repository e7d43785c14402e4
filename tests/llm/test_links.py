"""Links under a key against plain union-find."""

import numpy as np

from scholium.llm import simhash


def test_chains_keep_every_link():
    r = np.random.default_rng(7)
    for _ in range(400):
        fps = [int(r.integers(1 << 62))]
        while len(fps) < 24:  # chains: each a few bits from an earlier one
            x = fps[int(r.integers(len(fps)))]
            for b in r.choice(64, int(r.integers(1, 6)), replace=False):
                x ^= 1 << int(b)
            fps.append(x)
        fps = np.array(fps, dtype=np.uint64)[r.permutation(24)]
        keys = np.sort(r.integers(0, 2, 24))
        root = list(range(24))
        for _ in range(24):
            for a in range(24):
                for b in range(24):
                    if keys[a] == keys[b] and int(fps[a] ^ fps[b]).bit_count() <= 4:
                        root[a] = root[b] = min(root[a], root[b])
        assert simhash.linked(keys, fps, 4).tolist() == root


def test_rounds_follow_the_number_of_fingerprints():
    assert simhash.rounds_for(10_000_000, 4, 1024) == [6, 9, 16]
    assert simhash.rounds_for(100_000_000_000, 4, 1024) == [9, 16]
    assert simhash.rounds_for(1 << 62, 4, 1024) == [16]
    for n in (10_000_000, 1_000_000_000, 10_000_000_000, 1_000_000_000_000):  # keys of the first round hold few enough, so not all rows come again
        first = simhash.rounds_for(n, 4, 1024)[0]
        assert n / 2 ** ((64 // first) * (first - 4)) <= 1025
