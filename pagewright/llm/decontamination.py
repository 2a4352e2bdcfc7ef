"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact containment.

Items are partitioned by the number of their distinct shingles, in powers of two.  For each partition, every
document is cut into windows of up to four times an item's size, overlapping by half, and each window gets
MinHash values; within a window, an item of that partition that is contained in the document has a Jaccard
similarity of at least 0.19 if it lies together.  One equal value of 64 makes the document a candidate for the
item (missed with probability 1e-6; scattered passages are about as likely to be met).  Items of up to three
shingles are contained only whole, so they are looked up by one of their hashes and never missed.  Candidates are verified
on the shingles themselves: at least 0.8 of the item's distinct shingles must be in the whole document.

Shingles are of five words, without case and ASCII signs; a shorter text's only shingle is all its words.
Items and texts that are null or have no words match nothing.  Repeated items and documents each give their
own rows; empty tables an empty result.  `clean_documents` keeps all columns.
"""

from __future__ import annotations

import pickle
import uuid
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import Memo, held, portions, work_folder
from pagewright.llm.toxicity import CLEAN

WIDTH, SHARE, SLOTS = 5, 0.8, 64
#: Items of so many shingles must be contained whole to reach SHARE.
SHORT = 3
SCHEMA = "doc_id long, item_id long, n_shared long, n_item long, containment double"
ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(CLEAN).split()


def shingles(parts: list[bytes]) -> set[bytes]:
    """Distinct shingles as bytes."""
    if not parts:
        return set()
    joined = b" ".join(parts)
    if len(parts) <= WIDTH:
        return {joined}
    ends = list(accumulate(len(w) + 1 for w in parts))
    return {joined[a : b - 1] for a, b in zip([0, *ends], ends[WIDTH - 1 :])}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(texts: list[list[bytes]], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all texts in a row, and where each text's begin."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.fromiter((memo[w] for t in texts for w in t), np.uint64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    number = np.where(sizes > WIDTH, sizes - WIDTH + 1, np.minimum(sizes, 1))
    total = np.zeros(len(ids), np.uint64)
    for k in range(min(WIDTH, len(ids))):
        total[: len(ids) - k] = total[: len(ids) - k] * ODD + ids[k:]
    cuts = np.cumsum(number) - number
    at = np.arange(number.sum()) - np.repeat(cuts, number) + np.repeat(starts, number)
    out = mixed(total[at])
    for k in np.flatnonzero((sizes > 0) & (sizes < WIDTH)):
        v = np.uint64(sizes[k])
        for w in ids[starts[k] : starts[k] + sizes[k]]:
            v = np.uint64((int(v) * int(ODD) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        out[cuts[k]] = mixed(np.array([v]))[0]
    return out, np.append(cuts, number.sum())


class Index:
    """MinHash values of a bounded block of items, by partition and slot."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids, self.shingles = [], []
        rng = np.random.default_rng(11)
        self.factors = rng.integers(1, 1 << 63, SLOTS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.added = rng.integers(0, 1 << 63, SLOTS).astype(np.uint64)
        memo = Memo(lambda w: xxhash.xxh64_intdigest(w))
        by_class: dict[int, list[tuple[int, np.ndarray]]] = {}
        short: list[tuple[np.uint64, int]] = []
        for item_id, text in items:
            parts = words(text)
            if found := shingles(parts):
                h = hashed([parts], memo)[0]
                if len(found) <= SHORT:
                    short.append((h.min(), len(self.ids)))
                else:
                    by_class.setdefault(len(found).bit_length() - 1, []).append((len(self.ids), h))
                self.ids.append(item_id)
                self.shingles.append(found)
        short.sort()
        #: least hash of each short item, sorted, and the items
        self.short = np.array([x for x, _ in short], np.uint64), [k for _, k in short]
        #: partition: (slot values sorted, their items, a table of low 16 bits that occur), for each slot
        self.parts: dict[int, list] = {}
        for c, rows in by_class.items():
            self.parts[c] = []
            for f, a in zip(self.factors, self.added):
                values = np.array([self.slot(h, f, a).min() for _, h in rows], np.uint64)
                order = np.argsort(values, kind="stable")
                seen = np.zeros(1 << 16, bool)
                seen[values & np.uint64(0xFFFF)] = True
                self.parts[c].append((values[order], np.array([k for k, _ in rows])[order], seen))

    @staticmethod
    def slot(h: np.ndarray, factor: np.uint64, added: np.uint64) -> np.ndarray:
        x = h * factor + added
        return x ^ (x >> np.uint64(32))

    def candidates(self, h: np.ndarray, cuts: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs of which a window shares a MinHash value with an item of its partition, or the text a short item's hash."""
        found: set[tuple[int, int]] = set()
        classes = sorted(self.parts)
        number = np.diff(cuts)
        if len(self.short[0]):
            left, right = (np.searchsorted(self.short[0], h, side) for side in ("left", "right"))
            at = np.flatnonzero(left < right)
            for text, a, b in zip(np.repeat(np.arange(len(number)), number)[at], left[at], right[at]):
                found.update((int(text), k) for k in self.short[1][a:b])
        if not classes or not number.sum():
            return found
        layers = []  # of each partition: owner of each block, and the starts in the layer below
        size, owner, below = number, None, None
        for c in range(classes[0], classes[-1] + 1):
            blocks = -(-number // (2 << c))
            first = np.cumsum(blocks) - blocks
            owner = np.repeat(np.arange(len(number)), blocks)
            nth = np.arange(blocks.sum()) - first[owner]
            base = cuts[:-1] if below is None else below
            width = (2 << c) if below is None else 2
            layers.append((c, owner, base[owner] + nth * width))
            below = first
        for k, (factor, added) in enumerate(zip(self.factors, self.added)):
            low = self.slot(h, factor, added)
            for c, owner, starts in layers:
                low = np.minimum.reduceat(low, starts)
                if c not in self.parts:
                    continue
                window = low.copy()
                same = owner[1:] == owner[:-1]
                window[:-1][same] = np.minimum(low[:-1], low[1:])[same]
                values, items, seen = self.parts[c][k]
                at = np.flatnonzero(seen[window & np.uint64(0xFFFF)])
                left, right = np.searchsorted(values, window[at], "left"), np.searchsorted(values, window[at], "right")
                for w, a, b in zip(at[left < right], left[left < right], right[left < right]):
                    found.update((int(owner[w]), int(i)) for i in items[a:b])
        return found

    def matches(self, texts: list[list[bytes]], memo: Memo, share: float = SHARE):
        """(text, item id, shared, of the item) for every verified candidate, in order."""
        h, cuts = hashed(texts, memo)
        last, own = -1, set()
        for text, item in sorted(self.candidates(h, cuts)):
            if text != last:
                last, own = text, shingles(texts[text])
            shared = len(own & self.shingles[item])
            if shared >= share * len(self.shingles[item]) - 1e-9:
                yield text, self.ids[item], shared, len(self.shingles[item])


def index_files(benchmark: DataFrame, most_items: int = 20_000) -> list[str]:
    """Indexes of the items in blocks of about most_items, dealt by hash, as files in the shared folder.

    Only one block is on the driver at a time; a worker holds at most the last few that it has read.
    """
    from pyarrow import fs

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where(F.col("text").isNotNull())
    blocks = max(1, -(-rows.count() // most_items))
    store, base = fs.FileSystem.from_uri(folder := work_folder(benchmark.sparkSession, "items"))
    store.create_dir(base, recursive=True)
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        index = Index([(r.item_id, bytes(r.text)) for r in part.orderBy("item_id").collect()])
        with store.open_output_stream(f"{base}/{k}.pickle") as file:
            file.write(pickle.dumps(index))
    return [f"{folder}/{k}.pickle" for k in range(blocks)]


def opened(path: str) -> Index:
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_stream(place) as file:
        return pickle.loads(file.read())


def matched(texts: list[bytes | None], files: list[str], memo: Memo):
    """(text, item id, shared, of the item) of a batch, in portions that are larger where several indexes are read for each."""
    for a, b in portions(texts, 2_000_000 if len(files) == 1 else 8_000_000):
        parts = [words(x) for x in texts[a:b]]
        for path in files:
            index = held(path, lambda path=path: opened(path))
            yield from ((a + t, *found) for t, *found in index.matches(parts, memo))
        memo.trim()


def contaminated(docs: DataFrame, benchmark: DataFrame, most_items: int = 20_000) -> DataFrame:
    """A row for each document and item that it contains; one pass over the documents."""
    files = index_files(benchmark, most_items)

    def run(batches):
        memo = Memo(xxhash.xxh64_intdigest)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows = [(ids[t], i, s, n, s / n) for t, i, s, n in matched(texts, files, memo)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.float64() if k == 4 else pa.int64()) for k in range(5)], ["doc_id", "item_id", "n_shared", "n_item", "containment"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, SCHEMA)


def clean_documents(docs: DataFrame, benchmark: DataFrame, most_items: int = 20_000) -> DataFrame:
    """The documents with all columns, without those that contain an item."""
    files, name = index_files(benchmark, most_items), f"clean_{uuid.uuid4().hex}"

    @F.pandas_udf("boolean")
    def clean(texts):
        import pandas as pd

        bad = {t for t, *_ in matched([None if x is None else bytes(x) for x in texts], files, Memo(xxhash.xxh64_intdigest))}
        return pd.Series([k not in bad for k in range(len(texts))], dtype=bool)

    return docs.withColumn(name, clean(F.col("text").cast("binary"))).where(F.col(name)).drop(name)
