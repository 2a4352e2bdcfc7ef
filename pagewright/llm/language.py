"""Language ID: a linear-chain conditional random field labels every word of code-switched text.

A word's features are its affixes and n-grams (bytes of the lower-cased word between marks, of 2 to 5
bytes, those at a mark being affixes) and the word itself as a lexicon entry, all hashed.  Transitions
between the labels of neighbouring words are learned.  Forward-backward gives each word's label
probabilities; their mean over the words with a letter names the document's language.

Chains are cut into blocks whose transfer matrices are multiplied out side by side; sweeping over the
blocks' ends makes the result exact for texts of any length.

`und` with score 0 where the text is null or has no letter, or no language was learned.  Rows repeat as
given; an empty table gives an empty result; rows with a null lang teach nothing.  Extra columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import fold, portions

BITS = 18
GRAMS = (2, 3, 4, 5)
MARK = 10
BLOCK = 32
ASCII_LETTERS = bytes(c for c in range(256) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").split()


def lettered(word: bytes) -> bool:
    """Whether the word has a letter of any script."""
    if word.isascii():
        return word.translate(None, ASCII_LETTERS) != word
    return any(map(str.isalpha, word.decode("utf-8", "replace")))


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, flat, and where each word's begin; words without a letter have none."""
    empty = np.zeros(0, np.int64)
    kept = [w if lettered(w) else b"" for w in words]
    data = np.frombuffer(b"\n" + b"\n".join(kept) + b"\n" + b"\n" * max(GRAMS), np.uint8)
    size = np.array([len(w) for w in kept], np.int64)
    start = np.cumsum(size + 1) - size  # of each word's first byte; the byte before is a mark
    n = len(data) - max(GRAMS)
    owner = np.repeat(np.arange(len(words)), size + 1)[: n - 1]  # by position of a gram's first byte, its mark included
    marks = data == MARK
    code, inner, out_f, out_w = data[:n].astype(np.uint64), np.zeros(n, bool), [empty], [empty]
    for k in range(1, max(GRAMS)):
        inner |= marks[k - 1 : n + k - 1] if k > 1 else False
        code = code * np.uint64(0x9E3779B97F4A7C15) + data[k : n + k].astype(np.uint64) + np.uint64(1)
        if k + 1 in GRAMS:
            at = np.flatnonzero(~inner[: len(owner)] & ~(marks[: len(owner)] & marks[k : len(owner) + k]) & (size[owner] > 0))
            hashed = (code[at] ^ (code[at] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out_f.append((hashed >> np.uint64(64 - BITS)).astype(np.int64))
            out_w.append(owner[at])
    # the lexicon entry: a sum over the word's bytes of powers by place
    place = np.arange(len(owner)) - (start[owner] - 1)
    power = np.uint64(0x9E3779B97F4A7C15) ** (np.minimum(place, 1 << 20).astype(np.uint64) + np.uint64(1))
    held = np.flatnonzero(size > 0)
    if len(held):
        sums = np.add.reduceat((data[: len(owner)].astype(np.uint64) + np.uint64(7)) * power, start[held] - 1)
        # reduceat runs to the next start: marks and empty words between add what depends on no other word
        ends = np.append(start[held][1:] - 1, len(owner))
        extra = ends - (start[held] + size[held])
        if extra.any():
            sums = np.array([int(((data[a - 1 : a + z].astype(np.uint64) + np.uint64(7)) * power[a - 1 : a + z]).sum(dtype=np.uint64)) if e else int(s) for s, a, z, e in zip(sums, start[held], size[held], extra)], np.uint64)
        mixed = (sums ^ (sums >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        out_f.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
        out_w.append(held)
    f, w = np.concatenate(out_f), np.concatenate(out_w)
    order = np.argsort(w, kind="stable")
    return f[order], np.searchsorted(w[order], np.arange(len(words) + 1))


@dataclass
class Field:
    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, words: list[bytes]) -> np.ndarray:
        """Log-potentials of each word's labels: its features' weights over the root of their number."""
        f, cut = features(words)
        total = np.concatenate([np.zeros((1, len(self.labels))), np.cumsum(self.weights[f], 0, dtype=np.float64)])
        number = np.diff(cut)
        return (total[cut[1:]] - total[cut[:-1]]) / np.sqrt(np.maximum(number, 1))[:, None]


def marginals(emissions: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Label probabilities of all words of all chains, which lie one behind another; every length is at least 1."""
    labels = emissions.shape[1]
    # no potential is below exp(-60) times its word's largest: eight steps without rescaling stay in range
    e = np.exp(np.maximum(emissions - emissions.max(1, keepdims=True), -60))
    a = np.exp(moves - moves.max())
    blocks = -(-lengths // BLOCK)
    first = np.cumsum(blocks) - blocks
    chain = np.repeat(np.arange(len(lengths)), blocks)
    begin = (np.cumsum(lengths) - lengths)[chain] + (np.arange(blocks.sum()) - first[chain]) * BLOCK
    filled = np.minimum(BLOCK, (np.cumsum(lengths))[chain] - begin)
    at = begin[:, None] + np.minimum(np.arange(BLOCK), filled[:, None] - 1)
    real = np.arange(BLOCK) < filled[:, None]
    x = e[at]  # block, step, label
    full = real.all(0)
    # transfer of each block: from the label before it to that of its last word
    transfer = np.broadcast_to(np.eye(labels), (len(x), labels, labels)).copy()
    for t in range(BLOCK):
        step = (transfer.reshape(-1, labels) @ a).reshape(transfer.shape) * x[:, t, None, :]
        if t % 8 == 7:
            step /= step.max((1, 2), keepdims=True)
        transfer = step if full[t] else np.where(real[:, t, None, None], step, transfer)
    transfer /= transfer.max((1, 2), keepdims=True)
    # over the ends of blocks, all chains side by side
    before, after = np.full((len(x), labels), 1.0), np.full((len(x), labels), 1.0)
    for k in range(1, int(blocks.max())):
        rows = first[blocks > k] + k
        v = (before[rows - 1][:, None, :] @ transfer[rows - 1])[:, 0]
        before[rows] = v / v.max(1, keepdims=True)
    last = first + blocks - 1
    for k in range(1, int(blocks.max())):
        rows = last[blocks > k] - k
        v = (transfer[rows + 1] @ after[rows + 1][:, :, None])[:, :, 0]
        after[rows] = v / v.max(1, keepdims=True)
    forward = np.empty_like(x)
    v = before
    start = np.zeros(len(x), bool)
    start[first] = True
    for t in range(BLOCK):
        moved = v @ a
        if t == 0:
            moved[start] = 1.0
        moved *= x[:, t]
        if t % 8 == 7:
            moved /= moved.max(1, keepdims=True)
        v = moved if full[t] else np.where(real[:, t, None], moved, v)
        forward[:, t] = v
    backward = np.empty_like(x)
    v = after
    for t in range(BLOCK - 1, -1, -1):
        backward[:, t] = v
        moved = (v * x[:, t]) @ a.T
        if t % 8 == 0:
            moved /= moved.max(1, keepdims=True)
        v = moved if full[t] else np.where(real[:, t, None], moved, v)
    p = forward * backward
    p /= p.sum(2, keepdims=True)
    out = np.empty_like(e)
    out[at[real]] = p[real]
    return out


def train(samples: list[tuple[str, str]], steps: int = 240, batch: int = 256, length: int = 32, rate: float = 0.5, seed: int = 5) -> Field:
    """Maximum likelihood on stretches of labelled texts; some are joined from two languages to teach switches."""
    rng = np.random.default_rng(seed)
    labels = sorted({y for _, y in samples})
    known: dict[bytes, int] = {}
    texts = [np.array([known.setdefault(w, len(known)) for w in tokens(t)], np.int64) for t, _ in samples]
    y = np.array([labels.index(v) for (_, v), t in zip(samples, texts) if len(t)])
    texts = [t for t in texts if len(t)]
    field = Field(labels, np.zeros((1 << BITS, len(labels)), np.float32), np.zeros((len(labels), len(labels))))
    if not texts:
        return field
    f, cut = features(list(known))
    past, past_moves = np.full(field.weights.shape, 1e-6, np.float32), np.full(field.moves.shape, 1e-6)
    # each language is drawn as often as any other
    share = (1 / np.bincount(y, minlength=len(labels)))[y]
    share /= share.sum()
    n_labels = len(labels)
    for _ in range(steps):
        docs = rng.choice(len(texts), (batch, 2), p=share)
        turn = np.where(rng.random(batch) < 0.3, rng.integers(1, length, batch), length)
        ids, gold = np.zeros((batch, length), np.int64), np.zeros((batch, length), np.int64)
        for r in range(batch):
            for d, a, b in ((docs[r, 0], 0, turn[r]), (docs[r, 1], turn[r], length)):
                if b > a:
                    t = texts[d]
                    o = rng.integers(0, max(1, len(t) - (b - a) + 1))
                    ids[r, a:b] = np.resize(t[o : o + b - a], b - a)
                    gold[r, a:b] = y[d]
        used, back = np.unique(ids, return_inverse=True)
        sizes = cut[used + 1] - cut[used]
        flat = np.repeat(cut[used] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        owner, root = np.repeat(np.arange(len(used)), sizes), np.sqrt(np.maximum(sizes, 1))
        em = np.zeros((len(used), n_labels))
        np.add.at(em, owner, field.weights[f[flat]])
        em /= root[:, None]
        e = em[back.reshape(batch, length)]
        e, a = np.exp(e - e.max(2, keepdims=True)), np.exp(field.moves - field.moves.max())
        alpha, beta = np.empty_like(e), np.ones_like(e)
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for t in range(1, length):
            v = (alpha[:, t - 1] @ a) * e[:, t]
            alpha[:, t] = v / v.sum(1, keepdims=True)
        for t in range(length - 2, -1, -1):
            v = (beta[:, t + 1] * e[:, t + 1]) @ a.T
            beta[:, t] = v / v.sum(1, keepdims=True)
        p = alpha * beta
        p /= p.sum(2, keepdims=True)
        pair = alpha[:, :-1, :, None] * a * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        g_moves = np.zeros_like(field.moves)
        np.add.at(g_moves, (gold[:, :-1], gold[:, 1:]), 1.0)
        g_moves = (g_moves - pair.sum((0, 1))) / batch - 1e-3 * field.moves
        g_word = np.zeros((len(used), n_labels))
        np.add.at(g_word, back.ravel(), (np.eye(n_labels)[gold] - p).reshape(-1, n_labels))
        at, inverse = np.unique(f[flat], return_inverse=True)
        g = np.zeros((len(at), n_labels), np.float32)
        np.add.at(g, inverse, ((g_word / root[:, None])[owner] / batch).astype(np.float32))
        past[at] += g * g
        field.weights[at] += rate * g / np.sqrt(past[at])
        past_moves += g_moves**2
        field.moves += rate * 0.2 * g_moves / np.sqrt(past_moves)
    return field


class Labeller:
    """Labels words of many texts at once; emissions of distinct words are held, up to a bound."""

    def __init__(self, field: Field, most_words: int = 500_000):
        self.field, self.most = field, most_words
        self.known: dict[bytes, int] = {}
        self.table = np.zeros((1024, len(field.labels)), np.float32)
        self.has_letter = np.zeros(1024, bool)

    def ids(self, texts: list[list[bytes]]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        new = list({w for t in texts for w in t}.difference(known))
        if new:
            base = len(known)
            need = base + len(new)
            if need > len(self.table):
                size = max(need, 2 * len(self.table))
                self.table = np.resize(self.table, (size, self.table.shape[1]))
                self.has_letter = np.resize(self.has_letter, size)
            for k in range(0, len(new), 50_000):
                part = new[k : k + 50_000]
                self.table[base + k : base + k + len(part)] = self.field.emissions(part)
                self.has_letter[base + k : base + k + len(part)] = [lettered(w) for w in part]
            known.update(zip(new, range(base, need)))
        return np.fromiter((known[w] for t in texts for w in t), np.int64)

    def probabilities(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Of all words of all (non-empty) texts in a row: label probabilities, and whether they have a letter."""
        at = self.ids(texts)
        return marginals(self.table[at].astype(np.float64), np.array([len(t) for t in texts]), self.field.moves), self.has_letter[at]

    def documents(self, texts: list[list[bytes]]) -> list[tuple[str, float]]:
        out = [("und", 0.0)] * len(texts)
        full = [k for k, t in enumerate(texts) if t]
        if not full or not self.field.labels:
            return out
        p, letters = self.probabilities([texts[k] for k in full])
        starts = np.cumsum([0, *(len(texts[k]) for k in full[:-1])])
        total, number = np.add.reduceat(p * letters[:, None], starts), np.add.reduceat(letters.astype(np.int64), starts)
        for k, v, n in zip(full, total, number):
            if n:
                out[k] = (self.field.labels[int(v.argmax())], float(min(1.0, v.max() / n)))
        return out


def chosen(rows: DataFrame, per_language: int, most_rows: int, most_bytes: int) -> DataFrame:
    """h and lang of the rows to learn from: those of each language whose hashes are lowest, at most most_rows in all.

    Hashes are spread evenly, so of a language with many rows only those in a low enough part of their range are ranked,
    about four times as many as are wanted: no text is moved, and few rows meet in a language's rank.  Equal rows count
    once, also in what is known of a language's size.  A row counts while those before it in its language have under most_bytes of text, and if it has no more itself.
    """
    narrow = rows.select("h", "lang", F.octet_length("text").alias("n")).where(F.col("n") <= most_bytes)
    counts = narrow.groupBy(F.col("lang").alias("l")).agg(F.approx_count_distinct("h").alias("rows")).orderBy(F.desc("rows"), "l").limit(most_rows)
    low = (F.col("h") / float(1 << 64) + 0.5) * F.col("rows") < 4.0 * per_language
    few = narrow.join(F.broadcast(counts), F.col("lang") == F.col("l")).where(low | (F.col("rows") <= 4 * per_language)).select("h", "lang", "n").distinct()
    whole = Window.partitionBy("lang").orderBy("h")
    first = few.withColumn("place", F.row_number().over(whole)).where(F.col("place") <= per_language)
    first = first.withColumn("before", F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, -1))).where(F.coalesce("before", F.lit(0)) < most_bytes)
    return first.orderBy("place", "lang").limit(most_rows).select("h", "lang")


def fit(docs: DataFrame, per_language: int = 400, most_rows: int = 20_000, most_bytes: int = 4_000_000) -> Field:
    """Learn from at most per_language whole texts of each lang, those whose hashes are lowest, outside fold 1 of 3.

    They have at most 2 * most_bytes bytes a language: what the driver holds has that bound for each of the at most
    most_rows / per_language languages that are learned in full.
    """
    rows = docs.where((fold(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.xxhash64("doc_id", "lang", "text").alias("h"), "lang", "text")
    keys = F.broadcast(chosen(rows, per_language, most_rows, most_bytes).withColumnsRenamed({"h": "k", "lang": "l"}))
    got = rows.join(keys, (F.col("h") == F.col("k")) & (F.col("lang") == F.col("l")), "left_semi").dropDuplicates(["h", "lang"])
    return train(sorted((r.text, r.lang) for r in got.select("text", "lang").collect()))


def apply(docs: DataFrame, field: Field) -> DataFrame:
    """The language of every whole text."""

    def label(batches):
        labeller = Labeller(field)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got = [x for a, b in portions(texts) for x in labeller.documents([tokens(t) for t in texts[a:b]])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(F.col("doc_id"), 3) == 1).alias("held_out")).mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")
