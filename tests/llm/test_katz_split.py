"""Katz scores with very frequent words split over partitions, and where nearly all mass is seen."""

import random

import numpy as np
import pytest

from pagewright.llm import katz
from tests.llm.test_operators import brute_katz, docs, prose


@pytest.mark.parametrize("order,hot", [(3, 5), (3, 60), (4, 20), (3, 0)])
def test_split_words_change_nothing(spark, order, hot):
    rng = random.Random(order + hot)
    rows = [(i, " ".join(rng.choice(["the", "the", "of", f"w{rng.randrange(50)}", f"v{rng.randrange(900)}"]) for _ in range(rng.randint(0, 40)))) for i in range(150)]
    rows += [(800 + i, prose(rng, 30, 20)) for i in range(20)] + [(900, None), (901, "the the the"), (902, "unknown words of the end")]
    got = {r.doc_id: tuple(r)[1:] for r in katz.score(docs(spark, rows), order, block_bytes=2000, bucket_bytes=4000, hot=hot).collect()}
    want = brute_katz(rows, order)
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][:4] == want[i][:4] and got[i][4:] == pytest.approx(want[i][4:], abs=1e-9)


def test_weights_stay_finite_where_rounding_leaves_no_unseen_mass():
    """A context that has seen every word but the unknown one: no probability passes 1."""
    words = 4000
    totals = [katz.Totals(10**15, words, 1e-15, 10**15), katz.Totals(10**15, words)]
    totals[1].discounts[1:] = 1 - 0.5 / np.arange(1, 6)
    names = np.arange(words + 2)
    last = np.append([0, 0], np.full(words, 10**15 // words))
    grams = katz.Grams(names, last, [np.full(words + 1, 2), np.arange(1, words + 2)], np.append(0, np.ones(words, np.int64)), np.zeros(words + 1, bool))
    p = katz.evaluated(grams, totals, {}, {})
    assert np.isfinite(p).all() and (p <= 1).all() and (p > 0).all()


def test_counts_keep_64_bits():
    t = katz.Totals.of(np.array([100, 50, 30, 20, 15, 12, 10**13, 10**6]))
    assert t.tokens == 10**13
    total, few, mass = katz.summed(np.array([0, 0, 1]), np.array([5_000_000_000, 1, 7]), np.array([0.5, 0.1, 0.2]), 2)
    assert total.tolist() == [5_000_000_001, 7] and few[0, 0] == 1
