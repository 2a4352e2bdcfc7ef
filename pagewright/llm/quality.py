"""Quality rules: isolation forests over rule statistics, thresholds calibrated from labelled rows.

Statistics of the whole text are computed in one pass over its bytes.  Isolation trees are small by definition:
each is grown on a few rows of its own, drawn from all labelled documents.  One forest is on statistics of
characters and one on repeats; a document's mean path length gives its anomaly score.  Each forest's threshold
is set on all labelled rows, scored by the trees that did not see them: above it more bad rows than good ones
lie, and hardly any good row.  Where no threshold does that (repeats that are as common in good rows), the
forest has none.

Nulls, empty texts: all counts are 0, base_failed is true (fewer than 50 words), kept false.
Repeated rows give repeated results; an empty table gives an empty result; without labelled rows of
both kinds no threshold can be set and only the base rules apply.  Further columns are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import SPACES, give_back, stored
from pagewright.sources.blocks import spread

#: Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MOST_REPEAT_PERCENT = 50, 50

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Mean word length, shares of symbols and of capitals; shares of repeated lines and of words in repeated windows.
FEATURES = 5
#: What each forest sees.
CHARACTERS, REPEATS = (0, 1, 2), (3, 4)
#: Scores have 9 digits, so they are counted as whole numbers; a bin holds 2^15 of them, and there are 30,518 bins.
UNIT, BIN = 10**9, 2**15
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, anomaly double"


def occurring(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found at least twice in the text."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    often = {g for g, n in Counter(grams).items() if n > 1}
    total, end = 0, 0
    for i, g in enumerate(grams):
        if g in often:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def statistics(data: bytes) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """The five counts of the contract, and the forest's features."""
    words = data.split()
    n = len(words)
    points = len(data) - occurring(data, CONTINUATION)
    spaces = occurring(data, SPACES)
    lines = [x for x in data.split(b"\n") if x.strip()]
    duplicates = len(lines) - len(set(lines))
    symbols, repeated = occurring(data, SYMBOLS), repeat_words(words)
    chars = points - spaces
    features = [chars / max(n, 1), symbols / max(chars, 1), occurring(data, UPPER) / max(chars, 1), duplicates / max(len(lines), 1), repeated / max(n, 1)]
    return (n, chars, symbols, duplicates, repeated), features


#: Bytes 0x80-0xBF continue a code point in UTF-8.
CONTINUATION = bytes(range(0x80, 0xC0))


def base_fails(n: int, repeated: int) -> bool:
    return n < MIN_WORDS or 100 * repeated > MOST_REPEAT_PERCENT * n


def expected_path(n):
    """Mean path length of an unsuccessful search in a binary search tree of n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + 0.5772156649) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as heaps: children of node i are 2i+1 and 2i+2; feature -1 marks a leaf, whose value is its path length."""

    feature: np.ndarray
    value: np.ndarray
    rows: int
    columns: tuple[int, ...] = CHARACTERS
    threshold: float = np.inf

    @classmethod
    def grow(cls, x: np.ndarray, trees: int, rows: int, seed: int, columns: tuple[int, ...] = CHARACTERS, bags: np.ndarray | None = None) -> tuple[Forest, np.ndarray]:
        """The forest on these columns, and which rows each tree has seen: at most half of them, or those that bags marks."""
        rng = np.random.default_rng(seed)
        rows, x = min(rows, -(-len(x) // 2)) if bags is None else rows, x[:, columns]
        seen = np.zeros((trees, len(x)), bool)
        depth = max(1, int(np.ceil(np.log2(max(rows, 2)))))
        feature = np.full((trees, 2 ** (depth + 1) - 1), -1, np.int32)
        value = np.zeros(feature.shape)
        for t in range(trees):
            bag = rng.choice(len(x), rows, replace=False) if bags is None else np.flatnonzero(bags[t])
            seen[t, bag] = True
            todo = [(0, 0, x[bag])]
            while todo:
                node, level, part = todo.pop()
                low, high = part.min(0), part.max(0)
                free = np.flatnonzero(high > low)
                if level == depth or len(part) < 2 or not free.size:
                    value[t, node] = level + expected_path(len(part))
                    continue
                f = int(rng.choice(free))
                cut = rng.uniform(low[f], high[f])
                feature[t, node], value[t, node] = f, cut
                left = part[:, f] < cut
                todo += [(2 * node + 1, level + 1, part[left]), (2 * node + 2, level + 1, part[~left])]
                for child, kids in ((2 * node + 1, left), (2 * node + 2, ~left)):
                    if not kids.any():
                        todo = [x for x in todo if x[0] != child]
                        value[t, child] = level + 1
        return cls(feature, value, rows, columns), seen

    def scores(self, x: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
        """2 to the minus mean path length over its expectation: near 1 for rows that few splits set apart.

        seen: a tree says nothing on rows it has seen; a row that all trees have seen gets 0.
        """
        total, asked = np.zeros(len(x)), np.full(len(x), len(self.feature)) if seen is None else (~seen).sum(0)
        at, x = np.arange(len(x)), x[:, self.columns]
        for t, (feature, value) in enumerate(zip(self.feature, self.value)):
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[at, np.maximum(f, 0)] >= value[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += value[node] if seen is None else np.where(seen[t], 0.0, value[node])
        # equal paths averaged over different numbers of trees differ in the last bits
        return np.round(np.where(asked > 0, 2.0 ** (-total / np.maximum(asked, 1) / max(float(expected_path(self.rows)), 1e-9)), 0.0), 9)


def calibrated(scores: np.ndarray, bad: np.ndarray, most_good_lost: float) -> float:
    """The threshold with most bad rows from it on, of those with at most that share of the good rows and fewer good than bad ones.

    It lies halfway to the next score below.  Infinite where there is none.
    """
    order = np.argsort(-scores, kind="stable")
    s, lost, caught = scores[order], np.cumsum(~bad[order]), np.cumsum(bad[order])
    ends = np.append(np.diff(s) < 0, True)[: len(s)]
    allowed = ends & (lost <= int(most_good_lost * (~bad).sum())) & (caught > lost)
    if not allowed.any():
        return np.inf
    k = int(np.argmax(np.where(allowed, caught, 0)))
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0.0)) / 2)


def rejected(forests: list[Forest], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether any forest rejects a row, and its largest score."""
    scores = np.array([f.scores(x) for f in forests]).reshape(len(forests), len(x))
    return (scores >= np.array([f.threshold for f in forests])[:, None]).any(0), scores.max(0, initial=0.0)


def thresholds(counts: DataFrame, most_good_lost: float) -> dict[int, float]:
    """What calibrated() gives for each forest, from its good and bad rows by score: (forest, score, good, bad), scores as whole numbers.

    Rows stay where they are: the driver adds up bins, each bin runs on from there, and no bin has more than BIN scores.
    """
    inside = F.floor(F.col("score") / BIN).cast("long")
    bins = counts.groupBy("forest", inside.alias("bin")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
    before = []
    for k in sorted({b.forest for b in bins}):
        lost, caught, most = 0, 0, int(most_good_lost * sum(b.good for b in bins if b.forest == k))
        for b in sorted((b for b in bins if b.forest == k), key=lambda b: -b.bin):
            # elsewhere too many good rows lie above, or no bad row that could outnumber them ends here
            if lost <= most and b.bad and caught + b.bad > lost:
                before.append((k, b.bin, lost, caught, most))
            lost, caught = lost + b.good, caught + b.bad
    if not before:
        return {}
    offsets = counts.sparkSession.createDataFrame(before, "forest int, bin long, lost long, caught long, most long")
    above = Window.partitionBy("forest", "bin").orderBy(F.desc("score"))
    ends = counts.withColumn("bin", inside).join(F.broadcast(offsets), ["forest", "bin"])
    ends = ends.select("forest", "score", "most", (F.col("lost") + F.sum("good").over(above)).alias("lost"), (F.col("caught") + F.sum("bad").over(above)).alias("caught"))
    best = ends.where("lost <= most and caught > lost").groupBy("forest").agg(F.max(F.struct("caught", "score")).alias("best")).select("forest", "best.score").collect()
    if not best:
        return {}
    lower = F.lit(False)
    for k, score in best:
        lower |= (F.col("forest") == k) & (F.col("score") < score)
    below = dict(counts.where(lower).groupBy("forest").agg(F.max("score")).collect())
    return {k: (score + below.get(k, 0)) / 2 / UNIT for k, score in best}


def _features(batches):
    for batch in batches:
        out = [(i, statistics(t or b"")) for i, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")))]
        out = [(i, f) for i, (counts, f) in out if not base_fails(counts[0], counts[4])]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.list_(pa.float64())))], ["doc_id", "features"])
    give_back()


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """key, features and bad of all labelled rows that pass the base rules (the others are rejected anyway, and teach nothing).

    Statistics, not texts, are moved to the labels.  Rows that repeat are numbered, so each has a key of its own; of an
    id's labels, which have no features, the largest is number 1.  One exchange and one sort serve both windows.
    """
    known = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).where("doc_id is not null")
    rows = rows.mapInArrow(_features, "doc_id long, features array<double>").unionByName(known, allowMissingColumns=True).repartition("doc_id")
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "features").orderBy(F.desc("label")))).where("features is not null or copy = 1")
    rows = rows.withColumn("label", F.max("label").over(Window.partitionBy("doc_id"))).where("features is not null and label is not null")
    return rows.select(F.xxhash64("doc_id", "features", "copy").alias("key"), "features", (F.col("label").cast("int") < 1).alias("bad"))


def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, features and bad of a batch of labelled()."""
    keys, bad = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "bad"))
    return keys.view(np.uint64), batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES), bad


def places(keys: np.ndarray, bad: np.ndarray, weight: float, tree: int) -> np.ndarray:
    """Where each row stands in a tree's draw, from 0; the lowest are drawn.  Bad rows have a chance of weight to one.

    Hashes of a row's key and the tree (SplitMix64): the same for any partitioning.
    """
    z = keys + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) / 2.0**64 / np.where(bad, weight, 1.0)


def fit(docs: DataFrame, labels: DataFrame, trees: int = 150, rows_per_tree: int = 256, share_bad: float = 0.02, most_good_lost: float = 0.002, seed: int = 7) -> list[Forest] | None:
    """Grow and calibrate the forests on all labelled rows; None without any.

    Each tree draws its rows_per_tree rows from all labelled rows, at most half of them.  Trees isolate what is rare, so
    bad rows are drawn as if they were share_bad times the good ones: enough to widen the range of each statistic, too
    few to form a cluster of their own.  Thresholds count every labelled row.  The driver gets only rows that stand low
    in some tree's draw, fewer than 2 * trees * rows_per_tree for the defaults, and counts.
    """
    rows = spread(stored(labelled(docs, labels), "quality"))
    size = {r.bad: r.n for r in rows.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    if not size:
        return None
    if len(size) < 2:
        return []
    weight = min(1.0, max(1.0, share_bad * size[False]) / size[True])
    chances = size[False] + weight * size[True]
    per_tree = min(rows_per_tree, int(-(-chances // 2)))
    draws = range(seed * trees, (seed + 1) * trees)
    # so many rows are expected below it that fewer than per_tree do not occur
    low = (per_tree + 12 * per_tree**0.5 + 30) / chances

    def lowest(batches):
        for batch in batches:
            keys, _, bad = arrays(batch)
            chosen = np.zeros(len(keys), bool)
            for t in draws:
                chosen |= places(keys, bad, weight, t) < low
            yield batch.filter(pa.array(chosen))

    keys, x, bad = arrays(rows.mapInArrow(lowest, rows.schema).toArrow().combine_chunks().to_batches()[0])
    cuts, bags = np.zeros(trees), np.zeros((trees, len(keys)), bool)
    for t, draw in enumerate(draws):
        p = places(keys, bad, weight, draw)
        cuts[t] = np.partition(p, per_tree - 1)[per_tree - 1]
        bags[t] = p <= cuts[t]
    forests = [Forest.grow(x, trees, per_tree, seed, columns, bags)[0] for columns in (CHARACTERS, REPEATS)]

    def score(batches):
        for batch in batches:
            keys, x, bad = arrays(batch)
            seen = np.array([places(keys, bad, weight, draw) <= cut for draw, cut in zip(draws, cuts)])
            for k, forest in enumerate(forests):
                s = np.rint(forest.scores(x, seen) * UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), k, np.int32)), pa.array(s), pa.array(bad)], ["forest", "score", "bad"])

    is_bad = F.col("bad").cast("long")
    counts = rows.mapInArrow(score, "forest int, score long, bad boolean").groupBy("forest", "score").agg(F.sum(1 - is_bad).alias("good"), F.sum(is_bad).alias("bad"))
    for k, threshold in thresholds(stored(counts, "quality-scores"), most_good_lost).items():
        forests[k].threshold = threshold
    return forests


def verdicts(texts: list[bytes | None], forests: list[Forest] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts, base_failed, kept and anomaly of each text."""
    out = [statistics(t or b"") for t in texts]
    counts = np.array([x[0] for x in out], np.int64).reshape(-1, 5)
    failed = np.array([base_fails(n, r) for n, _, _, _, r in counts.tolist()], bool)
    gone, anomaly = rejected(forests or [], np.array([x[1] for x in out]).reshape(-1, FEATURES))
    return counts, failed, ~failed & ~gone, anomaly


def apply(docs: DataFrame, forests: list[Forest] | None) -> DataFrame:
    """The counts and the verdict of every document."""

    def score(batches):
        for batch in batches:
            counts, failed, kept, anomaly = verdicts(batch.column("text").to_pylist(), forests)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), pa.array(kept), pa.array(anomaly)], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(score, SCHEMA)


def kept_documents(docs: DataFrame, forests: list[Forest] | None) -> DataFrame:
    """The documents with all their columns, without those that are rejected.

    The verdict is given in the same pass as a column, so that no join by id is needed: repeated ids stay apart.
    """
    name = f"kept_{uuid.uuid4().hex}"

    @F.pandas_udf("boolean")
    def verdict(texts):
        import pandas as pd

        return pd.Series(verdicts([None if t is None else bytes(t) for t in texts], forests)[2], dtype=bool)

    return docs.withColumn(name, verdict(F.col("text").cast("binary"))).where(F.col(name)).drop(name)
