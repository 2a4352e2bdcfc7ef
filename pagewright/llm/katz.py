"""LM scoring: a Katz backoff model with Good-Turing discounts and exactly normalised backoff weights.

Texts are read once, into blocks of word numbers.  Counts live in tables partitioned by word, then by context:

1. A block asks each partition of words for the numbers and training counts of its distinct words.
2. It sends its distinct n-grams of the highest order with their training counts to the partition of the word before
   the last.  All shorter contexts of an n-gram end with that word too, so that partition can count every order.  It
   keeps the merged n-grams, and which of them each block asked for, as one row of a table; counts of counts are added
   up over all partitions.
3. With the discounts of every order the partition evaluates the recursion for each of its n-grams,

       P(w | h) = d(c) c(hw) / c(h)  if hw was seen, else  a(h) P(w | shorter h)

   a(h) being the mass that discounts leave over, divided by the lower order's mass of what was not seen, and answers
   each block with a probability for each n-gram.

Words that are very frequent as contexts (over `hot` training tokens) are split: their n-grams are dealt by the two
words before the last.  Their pairs with the last word, partial by partition, are added up in a table of their own,
dealt by pair; the totals of these few contexts (at most tokens / hot) go to all partitions.

A context whose followers were all seen too often for a discount counts once more, which leaves 1/(c(h)+1).  The words
never seen share one class, which gets the mass that the unigrams' discounts leave.  The mass of what was not seen is
never less than that class's, so that rounding can't blow up a weight.

Words are known by 64-bit hashes until they have numbers.  Counts have 64 bits.

A null text counts as empty: one token, the end.  A null doc_id is in no fold: such rows train.  Rows repeat as
given.  An empty table gives an empty result; where nothing trains, every token has probability 1 by the model and
1 / (0 + 0 + 1) by the base.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.blocks import NO_ID, blocks, dealt, id_array, packed, unpacked
from pagewright.llm.common import give_back, stored, work_folder

#: Counts up to DISCOUNTED are discounted.
DISCOUNTED = 5
START, UNKNOWN, FIRST = 0, 1, 2
#: No word is a space: its hash stands for a text's end.
END = b" "
ODD = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
ASKED = "bucket long, block long, blob binary"
#: Rows of a partition: its counts of counts by order, and what it keeps or answers.
KEPT = "kind int, block long, bucket long, counts array<array<long>>, blob binary"
COUNTS, ANSWER, GRAMS, PAIRS, TOTALS = range(5)


def numbered(folds: int, left_out: int):
    """Packs a block: ids, whether held out, sizes, tokens as numbers of the block's distinct words, these by hash; and the hashes."""

    def pack(ids: np.ndarray, texts: list[bytes]) -> tuple[bytes, bytes]:
        known: dict[bytes, int] = {END: 0}
        parts, sizes = [np.zeros(0, np.uint32)], []
        for text in texts:
            words = text.lower().split()
            parts.append(np.array([known.setdefault(w, len(known)) for w in words] + [0], np.uint32))
            sizes.append(len(words) + 1)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
        order = np.argsort(hashes)
        held = np.array([i != NO_ID and zlib.crc32(str(i).encode()) % folds == left_out for i in ids.tolist()], np.uint8)
        return packed(ids, held, np.array(sizes, np.int64), np.concatenate(parts), order.astype(np.uint32)), packed(np.diff(hashes[order], prepend=np.uint64(0)))

    return pack


@dataclass
class Tokens:
    """A block's tokens as numbers of its distinct words, where texts begin, and the words' order by hash."""

    ids: np.ndarray
    held_out: np.ndarray
    of: np.ndarray
    starts: np.ndarray
    order: np.ndarray

    @classmethod
    def read(cls, blob: bytes) -> Tokens:
        ids, held, sizes, of, order = unpacked(blob, np.int64, np.uint8, np.int64, np.uint32, np.uint32)
        return cls(ids, held.astype(bool), of.astype(np.int64), np.cumsum(sizes) - sizes, order.astype(np.int64))

    @property
    def trains(self) -> np.ndarray:
        """Whether each token is of a training text."""
        return np.repeat(~self.held_out, np.diff(np.append(self.starts, len(self.of))))


@dataclass
class Totals:
    """Of one order: discounts by count (index 0 unused), number of tokens and of seen entries."""

    tokens: int = 0
    seen: int = 0
    left: float = 0.0
    whole: int = 1
    discounts: np.ndarray = field(default_factory=lambda: np.ones(DISCOUNTED + 1))

    @classmethod
    def of(cls, histogram: np.ndarray) -> Totals:
        """histogram: entries seen 1, 2, ... DISCOUNTED + 1 times, tokens, entries seen."""
        n = histogram[: DISCOUNTED + 1].astype(float)
        d = np.ones(DISCOUNTED + 1)
        r = np.arange(1, DISCOUNTED + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            cut = (DISCOUNTED + 1) * n[DISCOUNTED] / n[0]
            d[1:] = ((r + 1) * n[1:] / n[:-1] / r - cut) / (1 - cut)
        if not (np.isfinite(d).all() and (d[1:] > 0).all() and (d[1:] < 1).all()):
            d[1:] = 1 - 0.5 / r  # too few counts of counts for Good-Turing's estimate
        return cls(int(histogram[-2]), int(histogram[-1]), d)

    def discount(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= DISCOUNTED, self.discounts[np.minimum(counts, DISCOUNTED)], 1.0)


def histogram(counts: np.ndarray) -> np.ndarray:
    """Entries seen 1 .. DISCOUNTED + 1 times, the sum of counts, entries seen."""
    few = np.bincount(np.minimum(counts, DISCOUNTED + 2), minlength=DISCOUNTED + 3)
    return np.concatenate([few[1 : DISCOUNTED + 2], [counts.sum(), (counts > 0).sum()]]).astype(np.int64)


def ask_words(buckets: int):
    """Per block and bucket, a range of hashes, distinct words' hashes and their training counts."""

    def run(batches):
        for batch in batches:
            for number, blob, words in zip(*(batch.column(c).to_pylist() for c in ("block", "blob", "words"))):
                t, hashes = Tokens.read(blob), np.cumsum(unpacked(words, np.uint64)[0], dtype=np.uint64)
                counts = np.bincount(t.of[t.trains], minlength=len(t.order))[t.order]
                cuts = np.searchsorted(hashes, np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64))
                cuts = np.concatenate([[0], cuts, [len(hashes)]])
                full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                rows = [packed(np.diff(hashes[cuts[b] : cuts[b + 1]], prepend=np.uint64(0)), counts[cuts[b] : cuts[b + 1]]) for b in full]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([number] * len(full), pa.int64()), pa.array(rows, pa.binary())], ["bucket", "block", "blob"])

    return run


def kept_rows(rows: list[tuple]) -> pa.Table:
    """Rows of (kind, block, bucket, counts, blob)."""
    types = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary())
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["kind", "block", "bucket", "counts", "blob"])


def answer_words(buckets: int):
    """For each block's words of a bucket, their numbers and total counts; frequent words get small numbers."""

    def run(table: pa.Table) -> pa.Table:
        bucket, numbers = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
        asked = [(np.cumsum(h, dtype=np.uint64), c) for h, c in (unpacked(x, np.uint64, np.int64) for x in table.column("blob").to_pylist())]
        words, back = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True)
        counts = added(back, np.concatenate([c for _, c in asked]), len(words))
        place = np.empty(len(words), np.int64)
        place[np.lexsort((words, -counts))] = np.arange(len(words))
        names = np.where(counts > 0, FIRST + place * buckets + bucket, UNKNOWN)
        cuts = np.cumsum([0, *(len(h) for h, _ in asked)])
        rows = [(ANSWER, n, bucket, None, packed(names[back[a:b]], counts[back[a:b]])) for n, a, b in zip(numbers, cuts[:-1], cuts[1:])]
        return kept_rows([(COUNTS, -1, bucket, [histogram(counts).tolist()], None), *rows])

    return run


def added(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers, in 64 bits."""
    if values.sum(dtype=float) < 1 << 52:
        return np.bincount(of, values, n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, of, values)
    return out


def distinct(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of numbers below `size`: the first of each distinct row, in order of the columns, and which it is of every row."""
    if size ** len(columns) < 1 << 63:
        key = columns[0].astype(np.int64)
        for c in columns[1:]:
            key = key * size + c
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        return first, back
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back


class Asked:
    """A block's distinct n-grams and how they are dealt, given its words' numbers and counts."""

    def __init__(self, tokens: Tokens, answers: pa.Table, n: int, buckets: int, hot: int):
        self.tokens = tokens
        found = sorted((b, x) for kind, b, x in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "blob"))) if kind == ANSWER)
        names, counts = np.zeros(len(tokens.order), np.int64), np.zeros(len(tokens.order), np.int64)
        # buckets are ranges of hashes: one behind another they are all words in order
        names[tokens.order], counts[tokens.order] = (np.concatenate(x) for x in zip(*(unpacked(blob, np.int64, np.int64) for _, blob in found)))
        self.counts = counts[tokens.of]
        if n == 1:
            return
        # numbers in this block, in the order of the words' own; what lies before a text is START, as frequent as the end
        self.names, number = np.unique(np.append(names, START), return_inverse=True)
        self.count_of = np.zeros(len(self.names), np.int64)
        self.count_of[number] = np.append(counts, counts[0])
        word = number[tokens.of]
        place = np.arange(len(word)) - np.repeat(tokens.starts, np.diff(np.append(tokens.starts, len(word))))
        columns = []
        for k in range(1, n):
            w = np.full(len(word), number[-1])
            w[k:] = word[: len(word) - k] if k < len(word) else word[:0]
            w[place < k] = number[-1]
            columns.append(w)
        first, self.back = distinct([*columns, word], len(self.names))
        #: of each n-gram the words before the last, the nearest first, then the last
        self.grams = [c[first] for c in (*columns, word)]
        key = self.names[self.grams[0]].astype(np.uint64) * ODD
        if n > 2:
            far = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + self.names[self.grams[1]].astype(np.uint64) * ODD
            self.split = self.count_of[self.grams[0]] > hot
            key = np.where(self.split, far ^ (far >> np.uint64(31)), key)
        self.order, self.cuts = dealt(key, buckets)

    def requests(self, buckets: int):
        """(bucket, blob) of what is asked: words' numbers and counts, n-grams of these, their training counts, and which have a split word."""
        count = np.bincount(self.back[self.tokens.trains], minlength=len(self.grams[0]))
        for b in range(buckets):
            part = self.order[self.cuts[b] : self.cuts[b + 1]]
            if len(part):
                used, columns = np.unique(np.stack([g[part] for g in self.grams]), return_inverse=True)
                columns = columns.reshape(len(self.grams), -1)
                split = self.split[part] if len(self.grams) > 2 else np.zeros(len(part), bool)
                yield b, packed(np.diff(self.names[used], prepend=0), self.count_of[used], np.diff(columns[0], prepend=0).astype(np.int32), columns[1:].astype(np.uint32).ravel(), count[part], np.packbits(split))

    def probabilities(self, answers: pa.Table) -> np.ndarray:
        """Of every token, from the partitions' answers."""
        p = np.empty(len(self.grams[0]))
        for kind, bucket, blob in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "blob"))):
            if kind == GRAMS:
                values, which = unpacked(blob, np.float64, np.uint32)
                p[self.order[self.cuts[bucket] : self.cuts[bucket + 1]]] = values[which]
        return p[self.back]


@dataclass
class Grams:
    """A partition's merged n-grams, sorted: columns are numbers of `names`; `last` has the unigram counts of names."""

    names: np.ndarray
    last: np.ndarray
    columns: list[np.ndarray]
    counts: np.ndarray
    #: whether the word before the last is split over partitions
    split: np.ndarray

    def contexts(self, k: int) -> np.ndarray:
        """Which context of order k (of its k - 1 words) each n-gram has."""
        new = np.zeros(len(self.counts), bool)
        for c in self.columns[: k - 1]:
            new[1:] |= c[1:] != c[:-1]
        return np.cumsum(new)

    def pairs(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of order k: each context-word pair's first n-gram, which pair every n-gram has, and the pairs' counts."""
        if k == len(self.columns):
            every = np.arange(len(self.counts))
            return every, every, self.counts
        first, back = distinct([self.contexts(k), self.columns[-1]], len(self.counts) + len(self.names) + 1)
        return first, back, added(back, self.counts, len(first))

    def packed(self) -> bytes:
        columns = [np.diff(c.astype(np.int64), prepend=0).astype(np.int32) for c in self.columns[:-1]]
        return packed(np.diff(self.names, prepend=0), self.last, *columns, self.columns[-1].astype(np.uint32), self.counts, np.packbits(self.split))

    @classmethod
    def unpacked(cls, blob: bytes, n: int) -> Grams:
        names, last, *columns, counts, split = unpacked(blob, np.int64, np.int64, *[np.int32] * (n - 1), np.uint32, np.int64, np.uint8)
        return cls(np.cumsum(names), last, [*(np.cumsum(c, dtype=np.int64) for c in columns[:-1]), columns[-1].astype(np.int64)], counts, np.unpackbits(split, count=len(counts)).astype(bool))


def ask_grams(n: int, buckets: int, hot: int, folder: str, files: int):
    """Per block and bucket, distinct n-grams; what is known of the block's words is read from the folder, blocks aren't moved."""

    def run(batches):
        for batch in batches:
            for number, blob in zip(batch.column("block").to_pylist(), batch.column("blob").to_pylist()):
                answers = filed_rows(folder, files, "block", number)
                rows = list(Asked(Tokens.read(blob), answers, n, buckets, hot).requests(buckets))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([number] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "block", "blob"])
                del answers, rows
                give_back()

    return run


def merge_grams(n: int, buckets: int):
    """One row with a partition's n-grams and which of them each block asked for; its counts of counts; pairs of split words."""

    def run(table: pa.Table) -> pa.Table:
        give_back()
        bucket, numbers = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
        parts = [unpacked(x, np.int64, np.int64, np.int32, np.uint32, np.int64, np.uint8) for x in table.column("blob").to_pylist()]
        cuts = np.cumsum([0, *(len(p[4]) for p in parts)])
        names = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]))
        last = np.zeros(len(names), np.int64)
        columns = [np.empty(cuts[-1], np.int32 if len(names) < 1 << 31 else np.int64) for _ in range(n)]
        counted, split = np.empty(cuts[-1], np.int64), np.empty(cuts[-1], bool)
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            own, counts_of, first_word, others, count, flags = parts[k]
            parts[k] = None  # each is let go as soon as it has been read
            place = np.searchsorted(names, np.cumsum(own))
            last[place] = counts_of
            columns[0][a:b] = place[np.cumsum(first_word, dtype=np.int64)]
            for column, x in zip(columns[1:], others.reshape(n - 1, -1)):
                column[a:b] = place[x]
            counted[a:b], split[a:b] = count, np.unpackbits(flags, count=b - a)
        first, back = distinct(columns, len(names))
        counts, split = added(back, counted, len(first)), split[first]
        columns = [c[first].astype(np.int64) for c in columns]
        grams = Grams(names, last, columns, counts, split)
        found = []
        for k in range(2, n + 1):
            at, _, c = grams.pairs(k)
            found.append(histogram(c[~split[at]] if k == 2 else c).tolist())
        lists = [np.diff(back[a:b], prepend=0).astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:])]
        whole = packed(np.array(numbers, np.int64), np.diff(cuts), np.concatenate(lists))
        rows = [(COUNTS, -1, bucket, found, None), (GRAMS, len(whole), bucket, None, whole + grams.packed())]
        if split.any():
            at, _, c = grams.pairs(2)
            at, c = at[split[at]], c[split[at]]
            v, w = names[grams.columns[0][at]], names[grams.columns[-1][at]]
            order, cut = dealt((v.astype(np.uint64) * ODD ^ w.astype(np.uint64)) * ODD, buckets)
            for b in range(buckets):
                part = order[cut[b] : cut[b + 1]]
                if len(part):
                    rows.append((PAIRS, b, bucket, None, packed(v[part], w[part], c[part], last[grams.columns[-1][at[part]]])))
        return kept_rows(rows)

    return run


def split_pairs(t: Totals):
    """Counts of the pairs of split words for every partition that has them, and these words' totals here."""

    def run(table: pa.Table) -> pa.Table:
        to, parts = table.column("bucket").to_pylist(), [unpacked(x, *[np.int64] * 4) for x in table.column("blob").to_pylist()]
        own = table.column("block")[0].as_py()
        v, w, c, u = (np.concatenate([p[k] for p in parts]) for k in range(4))
        first, back = distinct([np.unique(v, return_inverse=True)[1], np.unique(w, return_inverse=True)[1]], len(v) + 1)
        counts = added(back, c, len(first))
        words, of = np.unique(v[first], return_inverse=True)
        total, few, mass = summed(of, counts, unigram(u[first], t), len(words))
        cuts = np.cumsum([0, *(len(p[0]) for p in parts)])
        rows = [(COUNTS, -1, own, [histogram(counts).tolist()], None), (TOTALS, -1, own, None, packed(words, total, few, mass))]
        rows += [(PAIRS, own, b, None, packed(*parts[k][:2], counts[back[x:y]])) for k, (b, x, y) in enumerate(zip(to, cuts[:-1], cuts[1:]))]
        return kept_rows(rows)

    return run


def unigram(counts: np.ndarray, t: Totals) -> np.ndarray:
    """Probabilities of words by their counts; unknown words have all the mass that discounts leave."""
    return np.where(counts > 0, t.discount(counts) * counts / t.whole, t.left if t.tokens else 1.0)


def summed(of: np.ndarray, counts: np.ndarray, lower: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each context: its count, how many of its followers were seen 1, 2, ... times, the lower order's mass of those seen."""
    few = np.stack([np.bincount(of[counts == r], minlength=contexts) for r in range(1, DISCOUNTED + 1)], 1)
    return added(of, counts, contexts), few, np.bincount(of, np.where(counts > 0, lower, 0.0), contexts)


def evaluated(g: Grams, totals: list[Totals], pairs: list[np.ndarray], words: dict) -> np.ndarray:
    """The probability of each n-gram. pairs: words, words behind them and counts, for split words; words: their totals."""
    p = unigram(g.last[g.columns[-1]], totals[0])
    unknown = np.array([totals[0].left if totals[0].tokens else 1.0])  # of each context of the order below
    below = np.zeros(len(g.counts), np.int64)
    for k in range(2, len(g.columns) + 1):
        t, context = totals[k - 1], g.contexts(k)
        heads = np.flatnonzero(np.diff(context, prepend=-1))
        first, back, counts = g.pairs(k)
        of, lower = context[first], p[first]
        if k == 2 and pairs:
            at = np.flatnonzero(g.split[first])
            keys = np.searchsorted(g.names, pairs[0]) * len(g.names) + np.searchsorted(g.names, pairs[1])
            order = np.argsort(keys)
            counts[at] = pairs[2][order[np.searchsorted(keys, g.columns[0][first[at]] * len(g.names) + g.columns[-1][first[at]], sorter=order)]]
        total, few, mass = summed(of, counts, lower, len(heads))
        if k == 2 and words:
            for h in np.flatnonzero(g.split[heads]):
                total[h], few[h], mass[h] = words[int(g.names[g.columns[0][heads[h]]])]
        unseen = unknown[below[heads]]
        held = (few * np.arange(1, DISCOUNTED + 1) * (1 - t.discounts[1:])).sum(1)  # counts that discounts take away
        whole = np.maximum(total + (held <= 0), 1)
        weight = np.where(held > 0, held, 1.0) / whole / np.maximum(1 - mass, unseen)
        raised = np.where(counts > 0, t.discount(counts) * counts / whole[of], weight[of] * lower)
        p = np.minimum(np.where(total[of] == 0, lower, raised), 1.0)[back]
        unknown, below = np.where(total == 0, unseen, weight * unseen), context
    return p


def filed(rows: DataFrame, key: str, files: int, name: str) -> str:
    """Rows of (kind, block, bucket, blob) in a folder for each remainder of the key: who needs a key's rows reads them there."""
    path = work_folder(rows.sparkSession, name)
    rows = rows.select("kind", "block", "bucket", "blob", F.pmod(key, F.lit(files)).alias("file"))
    rows.repartition(files, "file").sortWithinPartitions("file", key).write.partitionBy("file").parquet(path)
    return path


def filed_rows(folder: str, files: int, key: str, value: int) -> pa.Table:
    """The rows of one key, in no order."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    own = f"{base}/file={value % files}"
    names = ["kind", "block", "bucket", "blob"]
    if store.get_file_info(own).type == fs.FileType.NotFound:
        return pa.table({c: [] for c in names})
    return pq.read_table(own, filesystem=store, columns=names, filters=[(key, "=", value)], partitioning=None)


def answer_grams(n: int, totals: list[Totals], words: dict, folder: str | None, files: int):
    """For each block the probabilities of what it asked for. Columns: bucket, block (where the lists end), blob."""

    def pairs(bucket: int) -> list[np.ndarray]:
        found = [unpacked(x, *[np.int64] * 3) for x in filed_rows(folder, files, "bucket", bucket).column("blob").to_pylist()] if folder else []
        return [np.concatenate(x) for x in zip(*found)]

    def run(batches):
        for batch in batches:
            for bucket, end, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "blob"))):
                numbers, sizes, lists = unpacked(blob[:end], np.int64, np.int64, np.int32)
                known = pairs(bucket)
                # 41 bits of each probability: a sum of a million logarithms is off by less than 1e-6
                p = evaluated(Grams.unpacked(blob[end:], n), totals, known, words)
                p = ((p.view(np.uint64) + np.uint64(0x800)) & ~np.uint64(0xFFF)).view(np.float64)
                rows, at = [], 0
                for size in sizes.tolist():
                    # probabilities repeat: each is sent once, and which it is of every n-gram
                    values, which = np.unique(p[np.cumsum(lists[at : at + size])], return_inverse=True)
                    rows.append(packed(values, which.astype(np.uint32)))
                    at += size
                del p, known
                give_back()
                m = len(rows)
                yield pa.RecordBatch.from_arrays([pa.array([GRAMS] * m, pa.int32()), pa.array(numbers), pa.array([bucket] * m, pa.int64()), pa.array(rows, pa.binary())], ["kind", "block", "bucket", "blob"])

    return run


def totals_of(rows: DataFrame, orders: int, first_order: bool) -> list[Totals]:
    """Adds up the partitions' counts of counts, a few numbers each, on the executors."""
    size = DISCOUNTED + 3
    h = rows.where(F.col("kind") == COUNTS).agg(*[F.sum(F.get(F.get("counts", F.lit(j)), F.lit(k))) for j in range(orders) for k in range(size)]).first()
    out = []
    for j in range(orders):
        counts = np.array([x or 0 for x in h[j * size : (j + 1) * size]], np.int64)
        t = Totals.of(counts)
        held = float((counts[:DISCOUNTED] * np.arange(1, DISCOUNTED + 1) * (1 - t.discounts[1:])).sum())
        # where all words are frequent, unknown words count once
        t.whole = max(1, t.tokens + (held <= 0))
        t.left = (held if held > 0 else 1.0) / t.whole if first_order else 0.0
        out.append(t)
    return out


def scores(n: int, totals: list[Totals], buckets: int, hot: int):
    """The rows of a block's documents."""

    def run(key, own: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        parts = []
        for blob in own.column("blob").to_pylist():
            e = Asked(Tokens.read(blob), answers, n, buckets, hot)
            t, tokens, seen = e.tokens, totals[0].tokens, totals[0].seen
            p = unigram(e.counts, totals[0]) if n == 1 else e.probabilities(answers)
            sizes = np.diff(np.append(t.starts, len(t.of)))
            base = np.add.reduceat(np.log10((e.counts + 1) / (tokens + seen + 1)), t.starts)
            score = np.add.reduceat(np.log10(np.maximum(p, 1e-300)), t.starts)
            known = np.add.reduceat((e.counts > 0).astype(np.int64), t.starts)
            parts.append(pa.Table.from_arrays([id_array(t.ids), pa.array(t.held_out), pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), tokens)), pa.array(base), pa.array(score)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(parts)

    return run


def split_totals(rows: DataFrame) -> dict:
    """Totals of the split words: at most tokens / hot entries."""
    out: dict = {}
    for r in rows.where(F.col("kind") == TOTALS).select("blob").toLocalIterator():
        words, total, few, mass = unpacked(bytes(r.blob), np.int64, np.int64, np.int64, np.float64)
        for w, t, f, m in zip(words.tolist(), total.tolist(), few.reshape(-1, DISCOUNTED), mass.tolist()):
            a = out.get(w)
            out[w] = (t, f, m) if a is None else (a[0] + t, a[1] + f, a[2] + m)
    return out


def score(docs: DataFrame, order: int = 2, folds: int = 7, left_out: int = 2, block_bytes: int = 6_000_000, bucket_bytes: int = 7_000_000, hot: int = 500_000) -> DataFrame:
    """Score every whole text by a model of that order, learned from all texts outside the fold left out."""
    source = blocks(docs, block_bytes, numbered(folds, left_out), ("blob", "words"))
    size = source.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = max(8, -(-size // bucket_bytes))
    words = stored(source.select("block", "blob", "words").mapInArrow(ask_words(buckets), ASKED).groupBy("bucket").applyInArrow(answer_words(buckets), KEPT), "word-counts")
    source = source.select("block", "blob")
    totals = totals_of(words, 1, True)
    answers = words.where(F.col("kind") == ANSWER).select("kind", "block", "bucket", "blob")
    if order > 1:
        files = min(max(1, source.count()), 10_000)
        asked = source.mapInArrow(ask_grams(order, buckets, hot, filed(answers, "block", files, "words"), files), ASKED)
        grams = stored(asked.groupBy("bucket").applyInArrow(merge_grams(order, buckets), KEPT), "n-grams")
        pairs = grams.where(F.col("kind") == PAIRS).select("block", "bucket", "blob")
        rows = grams.where(F.col("kind") == COUNTS)
        split, folder, files = {}, None, min(buckets, 10_000)
        if not pairs.isEmpty():
            summed_up = stored(pairs.groupBy("block").applyInArrow(split_pairs(totals[0]), KEPT), "split-words")
            split = split_totals(summed_up)
            rows = rows.unionByName(summed_up.where(F.col("kind") == COUNTS))
            folder = filed(summed_up.where(F.col("kind") == PAIRS), "bucket", files, "split-pairs")
        totals += totals_of(rows, order - 1, False)
        kept = grams.where(F.col("kind") == GRAMS).select("bucket", "block", "blob")
        answers = answers.unionByName(kept.mapInArrow(answer_grams(order, totals, split, folder, files), "kind int, block long, bucket long, blob binary"))
    return source.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scores(order, totals, buckets, hot), SCHEMA)
