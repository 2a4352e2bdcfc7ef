"""Toxicity: a factorization machine over hashed terms.

Terms of a document are its distinct words and their beginnings, hashed.  The machine adds to linear
weights an inner product of factors for each pair of terms, so that pairs such as an insult and the
mention of a group count beyond their sum.  Its terms are those that tell by themselves and those that
tell in pairs: the latter are found by trying each pair of common terms in the sample.  It
is fitted on a bounded sample of labelled rows; whole texts are scored.  Scores are calibrated on labelled rows that the fit did not see, and scaled so that
the decision of best F1 there lies at `DECISION`.

Null and empty texts have no terms and get the machine's bias, like any text without telling terms.
Rows repeat as given; an empty table gives an empty result; without labelled rows of both kinds every
score is the share of label 1 (0 without labels).  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import Memo, bounded_sample, fold, latest_labels

BUCKETS = 1 << 20
DECISION = 0.7
#: Letters case-folded, all ASCII signs turned into spaces.
CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 or 48 <= c <= 57 else 32 for c in range(256))
#: Lengths in bytes of beginnings that are terms.
BEGINNINGS = (3, 4, 5, 6)


def terms(word: bytes) -> list[int]:
    """Hashed terms of one word: itself and its beginnings."""
    return [xxhash.xxh32_intdigest(b"w" + word) % BUCKETS, *(xxhash.xxh32_intdigest(b"b" + word[:n]) % BUCKETS for n in BEGINNINGS if len(word) > n)]


def words(text: bytes | None) -> set[bytes]:
    return set((text or b"").translate(CLEAN).split())


@dataclass
class Machine:
    """Weights of the chosen terms; a document's terms count once each."""

    place: dict[int, int]
    bias: float
    weight: np.ndarray
    factors: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, rows: list) -> np.ndarray:
        """Log-odds of lists of term places."""
        flat = np.fromiter((x for r in rows for x in r), np.int64)
        ends = np.cumsum([0, *map(len, rows)])

        def sums(values):
            total = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, 0)])
            return total[ends[1:]] - total[ends[:-1]]

        v = self.factors[flat]
        return self.bias + sums(self.weight[flat, None])[:, 0] + 0.5 * (sums(v) ** 2 - sums(v * v)).sum(1)

    def scores(self, rows: list) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(rows) + self.shift, -30, 30)))


def support(rows: list[np.ndarray], size: int) -> np.ndarray:
    return np.bincount(np.concatenate(rows or [np.zeros(0, np.int64)]), minlength=size)


def telling_terms(rows: list[np.ndarray], y: np.ndarray, least_z: float, least_rows: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Terms whose odds differ between the labels, by the z of their log odds ratio, largest first; and all z."""
    pos, neg = support([r for r, t in zip(rows, y) if t], BUCKETS), support([r for r, t in zip(rows, y) if not t], BUCKETS)
    p, n, np_, nn = pos + 0.5, neg + 0.5, y.sum() + 1.0, (~y).sum() + 1.0
    z = np.abs(np.log(p / (np_ - p + 0.5)) - np.log(n / (nn - n + 0.5))) / np.sqrt(1 / p + 1 / n)
    z[pos + neg < least_rows] = 0
    best = np.argsort(-z, kind="stable")
    return best[z[best] >= least_z], z


def paired_terms(rows: list[np.ndarray], y: np.ndarray, screened: int, most: int, least_z: float, least_rows: int = 20) -> np.ndarray:
    """Terms of pairs that tell what neither tells alone, those of the clearest pairs first.

    Such a pair's odds of label 1 are higher where both terms are than where one or none is, or differ between rows
    with one of them and rows with both or none; its z is the least of the differences of log odds that this takes.
    All pairs of the `screened` terms that are nearest to being in half of the rows are tried; of terms that are in
    the same rows one stands for all.
    """
    seen = support(rows, BUCKETS)
    # a random number for each row: terms of equal sums are in the same rows
    mark = np.random.default_rng(9).integers(1, 1 << 40, len(rows)).astype(float)
    flat = np.concatenate(rows or [np.zeros(0, np.int64)])
    sums = np.bincount(flat, np.repeat(mark, [len(r) for r in rows]), BUCKETS)
    common = np.flatnonzero((seen >= least_rows) & (seen <= len(rows) - least_rows))
    common = common[np.sort(np.unique(sums[common], return_index=True)[1])]
    common = common[np.argsort(-np.minimum(seen[common], len(rows) - seen[common]), kind="stable")][:screened]
    if not len(common):
        return common
    place = np.full(BUCKETS, -1)
    place[common] = np.arange(len(common))
    sides = []  # for each label: which of its rows have which terms
    for label in (True, False):
        own = [place[r] for r, t in zip(rows, y) if bool(t) == label]
        x = np.zeros((len(own), len(common)), np.float32)
        for k, at in enumerate(own):
            x[k, at[at >= 0]] = 1
        sides.append((x, x.sum(0)))
    found = []
    for start in range(0, len(common), 128):  # in strips, so that memory holds few of the pairs
        part = slice(start, start + 128)
        odds, spread = [0.0] * 4, [0.0] * 4  # of the rows with both terms, with one, with the other, with none
        for (x, one), sign in zip(sides, (1, -1)):
            both = x[:, part].T @ x
            cells = both, one[part, None] - both, one[None, :] - both, len(x) - one[part, None] - one[None, :] + both
            for k, cell in enumerate(cells):
                odds[k] = odds[k] + sign * np.log(cell + np.float32(0.5))
                spread[k] = spread[k] + 1 / (cell + np.float32(0.5))

        def beyond(i, j, odds=odds, spread=spread):
            return (odds[i] - odds[j]) / np.sqrt(spread[i] + spread[j])

        one_without, other_without = beyond(0, 1), beyond(0, 2)
        together = np.minimum.reduce([one_without, other_without, beyond(0, 3)])
        alike = np.minimum.reduce([one_without, other_without, beyond(3, 1), beyond(3, 2)])
        apart = np.minimum.reduce([-one_without, -other_without, beyond(1, 3), beyond(2, 3)])
        z = np.maximum.reduce([together, alike, apart])
        a, b = np.nonzero(z >= least_z)
        later = b > a + start
        found.append(np.stack([z[a, b], a + start, b], 1)[later])
    found = np.concatenate(found)
    order = found[np.argsort(-found[:, 0], kind="stable"), 1:].astype(np.int64)
    return common[list(dict.fromkeys(order.ravel().tolist()))[:most]]


def chosen_terms(rows: list[np.ndarray], y: np.ndarray, most: int, least_z: float, screened: int = 2048, most_paired: int = 256, least_pair_z: float = 4.0) -> dict[int, int]:
    """At most `most` terms, of which up to most_paired are there for pairs."""
    pairs = paired_terms(rows, y, screened, min(most // 4, most_paired), least_pair_z)
    alone = telling_terms(rows, y, least_z)[0][: most - len(pairs)]
    return {t: k for k, t in enumerate(dict.fromkeys([*pairs.tolist(), *alone.tolist()]))}


def train(rows: list, y: np.ndarray, size: int, place: dict[int, int], factors: int = 8, epochs: int = 40, rate: float = 0.05, decay: float = 1e-4, seed: int = 3) -> Machine:
    """Logistic loss, adaptive steps over shuffled minibatches; rows: places of chosen terms."""
    rng = np.random.default_rng(seed)
    m = Machine(place, float(np.log((y.sum() + 1) / ((~y).sum() + 1))), np.zeros(size), rng.normal(0, 0.02, (size, factors)))
    past_w, past_v, past_b = np.full(size, 1e-6), np.full((size, factors), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 256):
            part = [rows[i] for i in order[k : k + 256]]
            flat = np.fromiter((x for r in part for x in r), np.int64)
            of = np.repeat(np.arange(len(part)), [len(r) for r in part])
            error = 1 / (1 + np.exp(-np.clip(m.raw(part), -30, 30))) - y[order[k : k + 256]]
            g = np.bincount(flat, error[of], size) / len(part) + decay * m.weight
            total = np.zeros((len(part), m.factors.shape[1]))
            np.add.at(total, of, m.factors[flat])
            gv = decay * m.factors
            np.add.at(gv, flat, error[of, None] * (total[of] - m.factors[flat]) / len(part))
            past_w += g * g
            past_v += gv * gv
            past_b += error.mean() ** 2
            m.weight -= rate * g / np.sqrt(past_w)
            m.factors -= rate * gv / np.sqrt(past_v)
            m.bias -= rate * error.mean() / np.sqrt(past_b)
    return m


def calibrate(m: Machine, rows: list, y: np.ndarray) -> None:
    """Logistic scaling of log-odds by Newton steps, then a shift that puts the cut of best F1 at DECISION."""
    if y.all() or not y.any():
        return
    s, w = m.raw(rows), np.array([1.0, 0.0])
    x = np.stack([s, np.ones_like(s)], 1)
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (w - [1, 0]))
    m.scale, m.shift = max(float(w[0]), 0.05), float(w[1])
    order = np.argsort(-s, kind="stable")
    hits, ends = np.cumsum(y[order]), np.append(np.diff(s[order]) < 0, True)
    f1 = np.where(ends, 2 * hits / (np.arange(1, len(s) + 1) + y.sum()), 0)
    k = int(f1.argmax())
    below = s[order[k + 1]] if k + 1 < len(s) else s[order[k]] - 1
    m.shift = float(np.log(DECISION / (1 - DECISION)) - m.scale * (s[order[k]] + below) / 2)


def _terms_of(batches):
    for batch in batches:
        ids, texts, labels = (batch.column(c).to_pylist() for c in ("doc_id", "text", "label"))
        memo = Memo(terms)
        got = [np.unique(np.array([t for w in words(x) for t in memo[w]], np.int32)) for x in texts]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(got, pa.list_(pa.int32())), pa.array(labels, pa.int32())], ["doc_id", "terms", "label"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: tuple[int, int] = (2500, 5000), most_terms: int = 8192, least_z: float = 3.0) -> Machine:
    """Fit on bounded samples, sample_rows giving the most rows of label 1 and of label 0: those whose ids hash lowest.

    A fifth of them, by another hash, don't train but calibrate.
    """
    known = latest_labels(labels, "toxic").where(fold(F.col("doc_id"), 3) != 1)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    got: list = []
    for label, most in zip((1, 0), sample_rows):
        rows = texts.join(bounded_sample(known.where(F.col("label") >= 1 if label else F.col("label") < 1), most), "doc_id").select("doc_id", "text", F.lit(label).alias("label"))
        # ids may repeat among documents: the bound holds before rows reach the driver
        part = rows.mapInArrow(_terms_of, "doc_id long, terms array<int>, label int").orderBy(F.xxhash64("doc_id"), "doc_id", "terms").limit(most).toArrow()
        values, ends = part.column("terms").combine_chunks(), part.column("doc_id").to_pylist()
        flat, cuts = values.flatten().to_numpy(), np.cumsum([0, *(len(x) for x in values)])
        got += sorted(((i, flat[a:b].astype(np.int64), label) for i, a, b in zip(ends, cuts[:-1], cuts[1:])), key=lambda r: (xxhash.xxh64_intdigest(str(r[0])), r[1].tobytes()))
    y = np.array([r[2] for r in got], bool)
    if not len(y) or y.all() or not y.any():
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        return Machine({}, float(np.log(share / (1 - share))), np.zeros(1), np.zeros((1, 1)))
    held_back = np.array([xxhash.xxh64_intdigest(str(r[0]), 1) % 5 == 0 for r in got])
    place = chosen_terms([r[1] for r, h in zip(got, held_back) if not h], y[~held_back], most_terms, least_z)
    rows = [[place[t] for t in r[1].tolist() if t in place] for r in got]
    machine = train([r for r, h in zip(rows, held_back) if not h], y[~held_back], max(1, len(place)), place)
    calibrate(machine, [r for r, h in zip(rows, held_back) if h], y[held_back])
    return machine


def apply(docs: DataFrame, machine: Machine) -> DataFrame:
    """A score for every whole text."""

    def score(batches):
        place = machine.place
        memo = Memo(lambda w: [place[t] for t in terms(w) if t in place])
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = set()
                for w in words(text):
                    if telling := memo[w]:
                        found.update(telling)
                rows.append(sorted(found))
                memo.trim()
            s = machine.scores(rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= DECISION).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), (fold(F.col("doc_id"), 3) == 1).alias("held_out")).mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
