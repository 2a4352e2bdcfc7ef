"""What the fitted operators learn from, and plain computations of what they learn."""

import math
import random

import numpy as np
import pytest

from pagewright.llm import language, quality, toxicity
from tests.llm.test_operators import DOCS, odd  # noqa: F401


@pytest.mark.parametrize("text", ["² ½ ①", "12 34", "?! --", "٣ ٤", "_ ² _"])
def test_texts_without_letters_are_und(spark, text):
    rows = [(i, "lor mip sum", "aa", "s", 0) for i in range(12)] + [(100 + i, "kra zik", "bb", "s", 0) for i in range(12)]
    model = language.fit(spark.createDataFrame(rows, DOCS))
    got = language.apply(spark.createDataFrame([(1, text, None, "s", 0), (2, text + " lor", None, "s", 0)], DOCS), model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["und", "aa"]


def test_sample_is_bounded_and_the_same_for_any_partitioning(spark):
    rng = random.Random(3)
    rows = [(None if i % 3 else i, f"w{rng.randrange(10**6)} " * rng.randint(1, 30), rng.choice(["aa", "aa", "bb"]), "s", 0) for i in range(900)]
    rows += [(5, "one text", "cc", "s", 0)] * 500 + [(6, "x" * 5000, "cc", "s", 0)]
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, DOCS).select(F.xxhash64("doc_id", "lang", "text").alias("h"), "lang", "text")
    got = [sorted((r.h, r.lang) for r in language.chosen(f, 40, 1000, 3000).collect()) for f in (frame.repartition(7), frame.coalesce(1))]
    assert got[0] == got[1]
    size = {h: n for h, n in frame.select("h", F.octet_length("text")).collect()}
    for lang in ("aa", "bb", "cc"):
        own = [h for h, y in got[0] if y == lang]
        assert 0 < len(own) <= 40 and sum(size[h] for h in own) < 6000
        if lang != "cc":
            lowest = sorted(r.h for r in frame.where(F.col("lang") == lang).collect() if size[r.h] <= 3000)
            assert own == lowest[: len(own)]


def test_path_lengths_match_a_walk_through_each_tree():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (300, 5)), rng.normal(9, 1, (4, 5)), np.zeros((30, 5))])
    forest, seen = quality.Forest.grow(x, 20, 64, 3, (0, 3))
    assert seen.sum(1).tolist() == [64] * 20
    harmonic = lambda n: sum(1 / k for k in range(1, n + 1))
    usual = lambda n: 2 * harmonic(n - 1) - 2 * (n - 1) / n if n > 1 else 0
    got, unseen = forest.scores(x), forest.scores(x, seen)
    for row in (0, 5, 299, 301, 303, 310):
        paths = []
        for t in range(20):
            inside, node, depth = seen[t].copy(), 0, 0
            while (f := forest.feature[t, node]) >= 0:
                right = x[row, (0, 3)[f]] >= forest.value[t, node]
                inside &= (x[:, (0, 3)[f]] >= forest.value[t, node]) == right
                node, depth = 2 * node + 1 + right, depth + 1
            paths.append(depth + usual(int(inside.sum())))
        assert got[row] == pytest.approx(2 ** (-np.mean(paths) / usual(64)), rel=0.02)
        own = [p for p, s in zip(paths, seen[:, row]) if not s]
        assert unseen[row] == pytest.approx(2 ** (-np.mean(own) / usual(64)), rel=0.02)
    assert got[300:304].min() > np.median(got) + 0.1


def test_thresholds_need_bad_rows_above_them():
    rng = np.random.default_rng(4)
    good, bad = rng.uniform(0.3, 0.5, 1000), np.append(rng.uniform(0.6, 0.8, 40), [0.31] * 5)
    scores, labels = np.concatenate([good, bad]), np.arange(1045) >= 1000
    t = quality.calibrated(scores, labels, 0.002)
    assert ((scores >= t) & labels).sum() == 40 and not ((scores >= t) & ~labels).any()
    # bad rows that look like good ones: no threshold catches them without as many good ones
    assert quality.calibrated(np.append(good, good[:5]), labels[:1005], 0.002) == math.inf
    assert quality.calibrated(good, np.zeros(1000, bool), 0.002) == math.inf and quality.calibrated(np.zeros(0), np.zeros(0, bool), 0.1) == math.inf


def test_repeats_reject_where_they_tell(spark):
    from tests.llm.test_operators import docs, labels, prose

    rng = random.Random(8)
    rows = []
    for i in range(500):
        lines = [prose(rng, 12, 9000) for _ in range(8)]
        rows.append((i, "\n".join(lines + lines[:3] * (i % 10 == 0))))
    d = docs(spark, rows)
    forests = quality.fit(d, labels(spark, [(i, int(i % 10 != 0), None) for i in range(0, 500) if i % 3]))
    kept = {r.doc_id: r.kept for r in quality.apply(d, forests).collect()}
    held = range(0, 500, 3)
    assert not any(kept[i] for i in held if i % 10 == 0) and all(kept[i] for i in held if i % 10)


def test_machine_is_the_plain_sum_over_pairs():
    rng = np.random.default_rng(6)
    m = toxicity.Machine({}, 0.3, rng.normal(0, 1, 12), rng.normal(0, 1, (12, 4)), 1.7, -0.2)
    rows = [sorted(rng.choice(12, n, replace=False).tolist()) for n in (0, 1, 2, 5, 12)]
    for r, got in zip(rows, m.scores(rows)):
        raw = 0.3 + sum(m.weight[i] for i in r) + sum(float(m.factors[i] @ m.factors[j]) for i in r for j in r if i < j)
        assert got == pytest.approx(1 / (1 + math.exp(-(1.7 * raw - 0.2))))


def test_calibration_puts_the_best_cut_at_the_decision():
    rng = np.random.default_rng(7)
    m = toxicity.Machine({}, 0.0, rng.normal(0, 1, 40), np.zeros((40, 1)))
    rows = [sorted(rng.choice(40, 8, replace=False).tolist()) for _ in range(400)]
    raw = m.raw(rows)
    y = raw + rng.normal(0, 1.5, 400) > 2
    toxicity.calibrate(m, rows, y)
    best = max(2 * (y & (raw >= t)).sum() / ((raw >= t).sum() + y.sum()) for t in raw)
    cut = m.scores(rows) >= toxicity.DECISION
    assert 2 * (y & cut).sum() / (cut.sum() + y.sum()) == pytest.approx(best)


@pytest.mark.parametrize("either", [True, False])
def test_toxicity_learns_labels_that_no_single_term_shows(spark, either):
    """Label 1: exactly one of two words, or both or none; factors at zero do no better than chance."""
    from tests.llm.test_operators import docs, labels, prose

    rng = random.Random(15)
    rows, marks = [], []
    for i in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((i, prose(rng, 30, 2000) + " blorgface" * a + " zanties" * b))
        marks.append((i, 1, int((a != b) == either)))
    d = docs(spark, rows)
    machine = toxicity.fit(d, labels(spark, marks))
    got = {r.doc_id: r for r in toxicity.apply(d, machine).collect()}
    held = [i for i in got if got[i].held_out]
    assert np.mean([got[i].predicted == marks[i][2] for i in held]) > 0.95
    machine.factors[:] = 0
    plain = {r.doc_id: r.score for r in toxicity.apply(d, machine).collect()}
    cuts = sorted({plain[i] for i in held})
    assert max(np.mean([(plain[i] >= c) == marks[i][2] for i in held]) for c in cuts) < 0.7


def test_repeated_labelled_ids_stay_within_the_bound(spark):
    from tests.llm.test_operators import docs, labels, prose

    rng = random.Random(16)
    d = docs(spark, [(i % 4, prose(rng, 60) + " bad" * (i % 4 == 1)) for i in range(400)])
    seen = []
    real = toxicity.train

    def spy(rows, *a, **k):
        seen.append(len(rows))
        return real(rows, *a, **k)

    toxicity.train = spy
    try:
        toxicity.fit(d, labels(spark, [(i, 1, int(i == 1)) for i in range(400)]), (30, 50))
    finally:
        toxicity.train = real
    assert not seen or seen[0] <= 80


def test_labelled_rows_beyond_a_sample_teach(spark):
    from tests.llm.test_operators import docs, labels, prose

    # the only bad rows are those whose ids hash highest, behind 12,000 good ones
    rng = random.Random(9)
    ids = [r.id for r in spark.sql("SELECT id FROM range(12300) ORDER BY xxhash64(id)").collect()]
    junk = set(ids[12_000:])
    d = docs(spark, [(i, prose(rng, 60, 9000).replace("w", "w#$" if i in junk else "w")) for i in ids])
    forests = quality.fit(d, labels(spark, [(i, int(i not in junk), None) for i in ids]))
    kept = {r.doc_id: r.kept for r in quality.apply(d, forests).collect()}
    assert not any(kept[i] for i in junk) and sum(kept[i] for i in ids[:12_000]) >= 0.99 * 12_000


def test_forests_are_those_of_a_plain_fit_on_all_rows(spark):
    from tests.llm.test_operators import docs, labels, prose

    rng = random.Random(10)
    texts = [" ".join(w.upper() if rng.random() < 0.02 + 0.5 * (i % 9 == 0) * rng.random() else w for w in prose(rng, 55, 9000).split()) for i in range(2000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7])] * 30 + [(9, texts[9])] * 5 + [(None, texts[3]), (11, "too short")]
    marks = labels(spark, [(i, int(i % 9 != 0), None) for i in range(2000) if i % 4])
    got = [quality.fit(d, marks, trees=40, rows_per_tree=16) for d in (docs(spark, rows).repartition(7), docs(spark, rows[::-1]).coalesce(1))]
    known = quality.labelled(docs(spark, rows), marks).collect()
    assert len(known) == len({r.key for r in known}) == 1500 + 30 + 5
    keys, x, bad = np.array([r.key for r in known]).view(np.uint64), np.array([r.features for r in known]), np.array([r.bad for r in known])
    place = np.array([quality.places(keys, bad, 0.02 * (~bad).sum() / bad.sum(), t) for t in range(280, 320)])
    bags = place <= np.sort(place)[:, 15:16]
    assert (bags.sum(1) == 16).all() and (bags & bad).any(0).sum() > 5
    for k, columns in enumerate((quality.CHARACTERS, quality.REPEATS)):
        plain = quality.Forest.grow(x, 40, 16, 7, columns, bags)[0]
        threshold = quality.calibrated(plain.scores(x, bags), bad, 0.002)
        for forests in got:
            assert (forests[k].feature == plain.feature).all() and (forests[k].value == plain.value).all()
            assert forests[k].threshold == pytest.approx(threshold, abs=1e-12)
    assert math.isfinite(got[0][0].threshold)


@pytest.mark.parametrize("most", [0.0, 0.01, 0.2, 1.0])
def test_thresholds_of_counts_are_those_of_all_rows(spark, most):
    rng = np.random.default_rng(11)
    cases = []
    for _ in range(12):
        n, width = int(rng.integers(1, 1500)), 10.0 ** -int(rng.integers(1, 9))
        bad = rng.random(n) < rng.choice([0.02, 0.3, 0.6])
        cases.append((np.round(0.4 + width * (rng.random(n) + 0.5 * bad * rng.random()), 9), bad))
    # good rows lead and bad ones catch up; the other way round; one score for all
    cases += [(np.array([0.9, 0.8, 0.7, 0.6, 0.5]), np.array([0, 1, 1, 1, 0]) > 0), (np.array([0.9, 0.8, 0.7, 0.6]), np.array([1, 0, 0, 1]) > 0), (np.zeros(4), np.array([1, 1, 1, 0]) > 0)]
    rows = [(k, round(s * 1e9), int(not b), int(b)) for k, case in enumerate(cases) for s, b in zip(*(c.tolist() for c in case))]
    counts = spark.createDataFrame(rows, "forest int, score long, good long, bad long").groupBy("forest", "score").agg({"good": "sum", "bad": "sum"})
    got = quality.thresholds(counts.selectExpr("forest", "score", "`sum(good)` AS good", "`sum(bad)` AS bad"), most)
    for k, (scores, bad) in enumerate(cases):
        assert got.get(k, math.inf) == pytest.approx(quality.calibrated(scores, bad, most), abs=1e-12)
