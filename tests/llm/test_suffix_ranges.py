"""Suffix runs by range: equal prefixes stay together, order is kept, hot passages and collisions change nothing."""

import random

import numpy as np
import pytest

from pagewright.llm import suffix_dedup
from tests.llm.test_operators import brute_repeats, docs, prose


def test_ranges_keep_order_and_equal_prefixes_together():
    rng = random.Random(2)
    data = np.frombuffer(prose(rng, 4000, 60).encode(), np.uint8)
    at = np.array(sorted(rng.sample(range(len(data) - 200), 3000)))
    cuts = sorted({bytes(data[a : a + suffix_dedup.K]) for a in at[::300].tolist()})
    h = np.arange(3000, dtype=np.uint64)
    got = suffix_dedup.ranged(data, at, h, cuts, len(cuts) + 1)
    prefixes = [bytes(data[a : a + suffix_dedup.K]) for a in at.tolist()]
    order = sorted(range(3000), key=lambda k: prefixes[k])
    assert (np.diff(got[order]) >= 0).all() and len(set(got.tolist())) == len(cuts) + 1
    by_prefix = {}
    for p, b in zip(prefixes, got.tolist()):
        assert by_prefix.setdefault(p, b) == b


@pytest.mark.parametrize("ranges", [1, 3, 4096])
def test_hot_passages_match_brute_force(spark, monkeypatch, ranges):
    monkeypatch.setattr(suffix_dedup, "MOST_RANGES", ranges)
    rng = random.Random(ranges)
    hot, rows = prose(rng, 60, 300), []
    for i in range(90):
        t = prose(rng, rng.randint(0, 20), 300)
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, 120)
            t += rng.choice([" ", "|", "~"]) + hot[a : a + rng.randint(80, 240)]
        rows.append((i, t))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.repeats(docs(spark, rows), 1500, 4000).collect()}
    assert got == brute_repeats(rows)


def test_collisions_of_hashes_lose_nothing(monkeypatch):
    """With every hash equal, bytes alone tell."""
    monkeypatch.setattr(suffix_dedup, "powers", lambda base, n: np.zeros(n, np.uint64))
    rng = np.random.default_rng(3)
    n = 40
    before = rng.integers(97, 99, (n, suffix_dedup.LEFT)).astype(np.uint8)
    before[20:] = before[:20]
    group, shared = np.zeros(n, np.int64), np.full(n, 100)
    shared[0] = 0
    left, right, rank = np.full(n, suffix_dedup.LEFT), np.full(n, 100), rng.permutation(n)
    got = {(int(m), int(a)) for member, first, last in suffix_dedup.marked(group, shared, before, left, right, rank) for m, a in zip(member, first)}
    want = set()
    for o in range(suffix_dedup.LEFT + 1):
        for m in range(n):
            if any(rank[k] < rank[m] and (before[k, suffix_dedup.LEFT - o :] == before[m, suffix_dedup.LEFT - o :]).all() for k in range(n)):
                want.add((m, o))
    assert got == want
