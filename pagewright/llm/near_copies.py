"""The SimHash operator at a Jaccard similarity of 0.8 or more of sets of five-word shingles.

Texts of equal sets are one set.  Sets whose fingerprints differ in at most 3 bits meet at the anchors of
`simhash`.  At a similarity of 0.8 fingerprints differ in 10 bits of 64 in the mean and anchors within reach of 14
bits would be most of the code, so sets also meet by MinHash: each gives 40 bands of five MinHash values; sets that share a band are
candidates (a pair at exactly 0.8 shares none with probability 2e-7, a closer pair less often).  Candidates hang
on the least set of their band, never in all pairs; each component of these links is one group.  In its group each
set is compared exactly, on 64-bit hashes of the shingles, with every set that has not been reached: all pairs of
the similarity asked for are linked there, whatever band they share.

Words are what op5 takes: without case, split at white space; a shorter text's only shingle is all its words.
Null texts and texts without words are one set.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import held, stored
from pagewright.llm.components import components
from pagewright.llm.decontamination import ODD, mixed
from pagewright.llm.simhash import SEED, digest, links, one_of_each

WIDTH, LEAST, BANDS, ROWS, BITS = 5, 0.8, 40, 5, 3


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = (text or b"").lower().split()
    joined = b" ".join(words)
    if len(words) <= width:
        parts = [joined] if words else []
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        parts = [joined[a : b - 1] for a, b in zip([0, *ends], ends[width - 1 :])]
    hashes = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((hashes(p, SEED) for p in parts), np.uint64, len(parts)))


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, set in more than half of the set's hashes; signed."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes)).tobytes(), "big", signed=True)


class Sketch:
    """BANDS hashes of ROWS MinHash values each."""

    def __init__(self):
        rng = np.random.default_rng(17)
        self.factors = (rng.integers(1, 1 << 63, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.added = rng.integers(0, 1 << 63, BANDS * ROWS).astype(np.uint64)[:, None]

    def bands(self, h: np.ndarray) -> np.ndarray:
        least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
        for k in range(0, len(h), 2048):
            x = h[None, k : k + 2048] * self.factors + self.added
            x ^= x >> np.uint64(32)
            least = np.minimum(least, x.min(axis=1))
        total = np.arange(BANDS, dtype=np.uint64)
        for column in least.reshape(BANDS, ROWS).T:
            total = mixed(total * ODD + column)
        return total.view(np.int64)


def sets(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, and of its set of shingles: key, fingerprint, bands (none where it is empty)."""

    def run(batches):
        sketch = held("near copies", Sketch)
        for batch in batches:
            keys, bands, prints = [], [], []
            for t in batch.column("text").to_pylist():
                h = shingles(t)
                keys.append(xxhash.xxh64_intdigest(h.tobytes(), SEED))
                bands.append(sketch.bands(h).tobytes() if len(h) else b"")
                prints.append(fingerprint(h))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(prints, pa.int64()), pa.array(bands, pa.binary())], ["doc_id", "digest", "key", "fp", "bands"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, "doc_id long, digest string, key long, fp long, bands binary")


def _bands(batches):
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        bands = batch.column("bands").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(bands), np.int64)), pa.array(np.repeat(keys, [len(b) // 8 for b in bands]))], ["band", "key"])


def _hung(batches):
    """Over rows sorted by band and key: each further key of a band with the first."""
    band, first = None, None
    for batch in batches:
        b, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "key"))
        if not len(b):
            continue
        new = np.append(b[0] != band, np.diff(b) != 0)
        at = np.maximum.accumulate(np.where(new, np.arange(len(b)), -1))
        head = np.where(at < 0, first if first is not None else 0, key[np.maximum(at, 0)])
        band, first = b[-1], head[-1]
        other = head != key
        yield pa.RecordBatch.from_arrays([pa.array(key[other]), pa.array(head[other])], ["a", "b"])


def clusters(keys: np.ndarray, members: list[np.ndarray], least: float = LEAST) -> np.ndarray:
    """Of each set the least key of its component, links being all pairs of that similarity."""
    n, sizes = len(keys), np.array([len(m) for m in members], np.int64)
    _, ids, counts = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    cuts = np.append(0, np.cumsum(sizes))
    left, root = np.ones(n, bool), keys.copy()

    def postings():
        take = left[owner] & (counts[ids] > 1)
        i, o = ids[take], owner[take]
        order = np.argsort(i, kind="stable")
        return o[order], np.searchsorted(i[order], np.arange(len(counts) + 1)), left.sum()

    of, starts, standing = postings()
    for k in range(n):
        if not left[k]:
            continue
        left[k], reached, stack = False, [k], [k]
        while stack:
            x = stack.pop()
            own = ids[cuts[x] : cuts[x + 1]]
            number = starts[own + 1] - starts[own]
            at = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + np.repeat(starts[own], number)
            met, shared = np.unique(of[at], return_counts=True)
            found = met[left[met] & (shared >= least * (sizes[x] + sizes[met] - shared) - 1e-9)]
            left[found] = False
            reached += found.tolist()
            stack += found.tolist()
            if 2 * left.sum() < standing:
                of, starts, standing = postings()
        root[reached] = keys[reached].min()
    return root


def _settled(group: pa.Table) -> pa.Table:
    keys = group.column("key").to_numpy()
    return pa.table({"key": keys, "near": clusters(keys, [np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()])})


def _hashes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("key"), pa.array([shingles(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())], ["root", "key", "hashes"])


def by_anchors(single: DataFrame) -> DataFrame:
    """Links of sets by their fingerprints: each set with the least one of its fingerprint, these with each other."""
    heads = single.groupBy("fp").agg(F.min("key").alias("head"))
    same = single.join(heads.withColumnRenamed("fp", "f"), F.col("fp") == F.col("f")).where(F.col("key") != F.col("head")).select(F.col("key").alias("a"), F.col("head").alias("b"))
    pairs = links(heads.select("fp"), BITS)
    a, b = (heads.select(F.col("fp").alias(f"f{c}"), F.col("head").alias(f"h{c}")) for c in "ab")
    return same.unionByName(pairs.join(a, F.col("a") == F.col("fa")).join(b, F.col("b") == F.col("fb")).select(F.col("ha").alias("a"), F.col("hb").alias("b")))


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, digest and root of every document: root is one key for each component of near copies."""
    found = stored(sets(docs), "shingle-sets")
    single = found.groupBy("key").agg(F.min("digest").alias("digest"), F.first("bands").alias("bands"), F.first("fp").alias("fp"))
    rows = single.select("key", "bands").mapInArrow(_bands, "band long, key long")
    by_bands = rows.repartition("band").sortWithinPartitions("band", "key").mapInArrow(_hung, "a long, b long")
    roots = components(by_bands.unionByName(by_anchors(single.where(F.length("bands") > 0).select("key", "fp"))))
    roots = roots.unionByName(roots.select(F.col("root").alias("key"), "root").distinct())
    asked = single.select("key", "digest").join(roots.withColumnRenamed("key", "k"), F.col("key") == F.col("k")).select("digest", "key", "root")
    # one text of each set that has a candidate
    texts = docs.select(digest().alias("d"), F.col("text").cast("binary").alias("text")).join(asked, F.col("d") == F.col("digest")).groupBy("root", "key").agg(F.first("text").alias("text"))
    near = texts.mapInArrow(_hashes, "root long, key long, hashes binary").groupBy("root").applyInArrow(_settled, "key long, near long")
    near = stored(near.where(F.col("key") != F.col("near")), "near-copies").withColumnRenamed("key", "k")
    return found.join(near, F.col("key") == F.col("k"), "left").select("doc_id", "digest", F.coalesce("near", "key").alias("root"))


def representatives(docs: DataFrame) -> DataFrame:
    """The documents with all columns, one of each component of near copies: that with the least doc_id."""
    return one_of_each(docs, grouped(docs))
