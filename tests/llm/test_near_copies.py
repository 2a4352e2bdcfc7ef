"""Near copies against brute force, and which document of a group stays."""

import random
from collections import defaultdict

import numpy as np

from pagewright.llm import near_copies
from tests.llm.test_operators import docs, empty, odd, parts_by_brute_force, prose  # noqa: F401


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_set(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def least_of_each(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8 - 1e-9:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    least = defaultdict(lambda: 1 << 60)
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(least[top(i)], doc)
    return set(least.values())


def test_near_copies_at_four_fifths_match_brute_force(spark):
    import corpus_pipeline

    rng = random.Random(23)
    rows = []
    for i in range(40):
        t = prose(rng, 200, 3000).split()
        for c in range(rng.randint(1, 5)):
            u = list(t)
            for _ in range(rng.randint(0, 6)):
                u[rng.randrange(len(u))] = f"edited{rng.randrange(10**6)}"
            rows.append((i * 10 + c, " ".join(u).title()))
        t = u
    rows += [(5000, ""), (5001, None), (5002, "one two"), (5003, "One  two")]
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = sorted(r.doc_id for r in stage(spark, docs(spark, rows), "").collect())
    assert kept == sorted(least_of_each(rows)) and len(kept) < len(rows) - 40


def test_chains_are_followed_and_nothing_else():
    keys = np.array([7, 3, 9, 5, 1], np.int64)
    sets = [np.arange(k, k + 100, dtype=np.uint64) for k in (0, 10, 20, 31, 500)]
    # 90 of 110 shared is over 0.8; 89 of 111 is just over, 80 of 120 is not
    assert near_copies.clusters(keys, sets).tolist() == [3, 3, 3, 3, 1]
    assert near_copies.clusters(keys, [sets[0], sets[2], sets[4], sets[3], sets[1]]).tolist() == [1, 1, 9, 1, 1]
    assert near_copies.clusters(keys[:2], [sets[0], sets[2]]).tolist() == [7, 3]


def test_unlike_documents_of_one_id_or_none_stay(spark, odd):  # noqa: F811
    rng = random.Random(5)
    texts = [prose(rng, 80, 3000) for _ in range(4)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[0]), (8, texts[2]), (8, texts[3]), (8, texts[3]), (9, texts[3])]
    kept = near_copies.representatives(docs(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, texts[0]), (0, texts[1]), (8, texts[2]), (8, texts[3])])
    stay = near_copies.representatives(odd)
    assert stay.columns == odd.columns and sorted(r.doc_id for r in stay.collect()) == [1, 4, 5, 6, 7, 8, 9]
    assert near_copies.representatives(empty(spark)).count() == 0
