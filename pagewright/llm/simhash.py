"""SimHash near-duplicates by anchor-point covering.

A covering code's words are the anchors: every value of the first 23 bits lies within 3 bits of exactly one
word of the binary Golay code (radius 3), at home there.  Two fingerprints that differ in at most t bits lie
within 3 + t bits of the anchor at which either is at home.  So each distinct fingerprint is kept at its home
anchor and sent to all anchors within 3 + t, and compared there with those at home: no link is missed.

Anchors with many homes are refined: the next 23 bits get anchors of the same code, with what is left of t, so
that the number of comparisons stays in proportion while fingerprints grow.  Each anchor gives at most one link
for each fingerprint sent to it (to the least of its part there), never all pairs.

Texts without words (null, empty) have fingerprint zero and link like any other.  Repeated rows and ids keep a
row each; a component's id is its least doc_id that isn't null.  An empty table gives an empty result.  Other
columns are not read by `linked`; `representatives` keeps them.
"""

from __future__ import annotations

import uuid
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import held, stored
from pagewright.llm.components import components

SEED = 42
LENGTH, RADIUS, WIDTH = 23, 3, 3
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the Golay code.
GENERATOR, DEGREE = 0xAE3, 11


def fingerprint(text: bytes, width: int = WIDTH) -> bytes:
    """64 bits, big-endian: those set in more than half of the hashes of the text's shingles."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return bytes(8)
    joined = b" ".join(words)
    if n <= width:
        parts = [joined]
    else:
        ends = list(accumulate((len(w) + 1 for w in words)))
        parts = [joined[a : b - 1] for a, b in zip([0, *ends], ends[width - 1 :])]
    digest, total = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for k in range(0, len(parts), 1 << 15):
        hashes = np.frombuffer(b"".join([digest(p, SEED) for p in parts[k : k + (1 << 15)]]), np.uint8)
        total += np.add.reduce(np.unpackbits(hashes.reshape(-1, 8), axis=1), axis=0, dtype=np.int32)
    return np.packbits(2 * total > len(parts)).tobytes()


def fingerprints(docs: DataFrame, width: int = WIDTH, digests: bool = False) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every whole text, and its digest if asked for."""
    own = ["doc_id", "digest"] if digests else ["doc_id"]

    def run(batches):
        for batch in batches:
            got = b"".join([fingerprint(t or b"", width) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], pa.array(np.frombuffer(got, ">i8").astype(np.int64))], [*own, "fp"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[digest().alias(c) for c in own[1:]], F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id long, {'digest string, ' if digests else ''}fp long")


class Cover:
    """The Golay code by syndromes: for each, the error patterns up to `reach` bits, lightest first."""

    def __init__(self, reach: int):
        at = np.zeros(LENGTH, np.int64)
        for i in range(LENGTH):
            v = 1 << i
            for b in range(i, DEGREE - 1, -1):
                if v >> b & 1:
                    v ^= GENERATOR << (b - DEGREE)
            at[i] = v
        self.table = np.zeros((3, 256), np.int64)
        for part in range(3):
            for bit in range(min(8, LENGTH - 8 * part)):
                self.table[part, np.arange(256) >> bit & 1 == 1] ^= at[8 * part + bit]
        patterns, weights = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        last = [(0, -1)]
        for w in range(1, reach + 1):
            last = [(p | 1 << b, b) for p, top in last for b in range(top + 1, LENGTH)]
            patterns.append(np.array([p for p, _ in last], np.int64))
            weights.append(np.full(len(last), w))
        p, w = np.concatenate(patterns), np.concatenate(weights)
        s = self.syndrome(p)
        order = np.lexsort((w, s))
        self.patterns, self.excess = p[order], np.maximum(0, w[order] - RADIUS)
        starts = np.searchsorted(s[order], np.arange(1 << DEGREE))
        # up to[t][s]: patterns of syndrome s that leave an excess of at most t
        self.starts = starts
        self.up_to = [np.add.reduceat((self.excess <= t).astype(np.int64), starts) for t in range(reach - RADIUS + 1)]

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        return self.table[0, x & 255] ^ self.table[1, x >> 8 & 255] ^ self.table[2, x >> 16 & 127]

    def home(self, x: np.ndarray) -> np.ndarray:
        """The one code word within RADIUS."""
        return x ^ self.patterns[self.starts[self.syndrome(x)]]

    def near(self, x: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All code words within RADIUS + left of each x: index of x, word, and what is then left."""
        s = self.syndrome(x)
        n = np.stack(self.up_to)[left, s]
        of = np.repeat(np.arange(len(x)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.starts[s], n)
        return of, x[of] ^ self.patterns[at], left[of] - self.excess[at]


MASK = (1 << LENGTH) - 1


def anchored(prints: DataFrame, t: int, crowded: list[int]) -> DataFrame:
    """(anchor, fp, home) rows: fingerprints at home, and those sent to every anchor within RADIUS + t.

    crowded: first-level anchors (of 4,096 at most) whose rows are dealt to a second level.
    """

    def run(batches):
        cover = held(f"golay {t}", lambda: Cover(RADIUS + t))
        full = np.array(sorted(crowded), np.int64)
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for k in range(0, len(fps), 4096):
                fp = fps[k : k + 4096]
                one, two = fp & MASK, fp >> LENGTH & MASK
                home = cover.home(one)
                deep = np.isin(home, full)
                key = np.where(deep, (home << LENGTH | cover.home(two)) + (1 << 60), home)
                of, word, left = cover.near(one, np.full(len(fp), t))
                deep = np.isin(word, full)
                of2, word2, _ = cover.near(two[of[deep]], left[deep])
                keys = [key, word[~deep], (word[deep][of2] << LENGTH | word2) + (1 << 60)]
                rows = [fp, fp[of[~deep]], fp[of[deep][of2]]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(rows)), pa.array(np.repeat([0, 1], [len(fp), len(rows[1]) + len(rows[2])]).astype(np.int8))], ["anchor", "fp", "sent"])

    return prints.mapInArrow(run, "anchor long, fp long, sent byte")


def compared(home: np.ndarray, sent: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, least home of its part) at one anchor, at most one for each fingerprint sent or at home."""
    hits_h, hits_s = [], []
    step = max(1, 4_000_000 // max(1, len(home)))
    for k in range(0, len(sent), step):
        h, s = np.nonzero(np.bitwise_count(home[:, None] ^ sent[None, k : k + step]) <= t)
        hits_h.append(h)
        hits_s.append(s + k)
    h, s = np.concatenate(hits_h), np.concatenate(hits_s)
    if len(h) <= len(home):  # fingerprints at home meet but themselves
        h, s = h[home[h] != sent[s]], s[home[h] != sent[s]]
        if not len(h):
            return home[:0], home[:0]
    of_home = np.arange(len(home))
    while True:
        of_sent = np.full(len(sent), len(home))
        np.minimum.at(of_sent, s, of_home[h])
        new = of_home.copy()
        np.minimum.at(new, h, of_sent[s])
        if (new == of_home).all():
            break
        of_home = new
    met = of_sent < len(home)
    a, b = np.concatenate([home, sent[met]]), home[np.concatenate([of_home, of_sent[met]])]
    return a[a != b], b[a != b]


def compare_sorted(t: int):
    """A mapInArrow function over rows sorted by anchor, homes first: memory holds one anchor's homes and a batch."""

    def run(batches):
        anchor, homes, home = None, [], None
        for batch in batches:
            a, fp, sent = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "sent"))
            fp = fp.view(np.uint64) if fp.flags.c_contiguous else np.ascontiguousarray(fp).view(np.uint64)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(a)) + 1, [len(a)]])
            left, right = [], []
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                if a[i] != anchor:
                    anchor, homes, home = a[i], [], None
                middle = i + int(np.searchsorted(sent[i:j], 1))
                if middle > i:
                    homes.append(fp[i:middle].copy())
                if middle < j and homes:
                    if home is None:
                        home = np.unique(np.concatenate(homes))
                    x, y = compared(home, np.unique(fp[middle:j]), t)
                    left.append(x)
                    right.append(y)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left).view(np.int64)), pa.array(np.concatenate(right).view(np.int64))], ["a", "b"])

    return run


def linked(docs: DataFrame, t: int = 3, width: int = WIDTH, most_homes: int = 512) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document."""
    prints, rooted = _rooted(docs, t, width, most_homes)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least.withColumnRenamed("root", "r"), F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    return prints.join(named, F.col("fp") == F.col("f")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(docs: DataFrame, t: int, width: int, most_homes: int = 512, digests: bool = False) -> tuple[DataFrame, DataFrame]:
    """The fingerprints, and (fp, first, root): of each the least doc_id and the least fingerprint of its component."""
    prints = stored(fingerprints(docs, width, digests), "fingerprints")
    single = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(single.select("fp"), t, most_homes))
    return prints, single.join(roots.withColumnRenamed("key", "k"), F.col("fp") == F.col("k"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def links(single: DataFrame, t: int, most_homes: int = 512) -> DataFrame:
    """(a, b) of distinct fingerprints at t or fewer differing bits: enough of them to join all that are linked."""
    cover_home = single.select("fp").mapInArrow(_homes, "anchor long")
    # at most 4,096 rows: one for each first-level anchor
    crowded = [r.anchor for r in cover_home.groupBy("anchor").count().where(F.col("count") > most_homes).collect()]
    rows = anchored(single.select("fp"), t, crowded).repartition("anchor").sortWithinPartitions("anchor", "sent")
    return rows.mapInArrow(compare_sorted(t), "a long, b long")


def _homes(batches):
    cover = held("golay 0", lambda: Cover(RADIUS))
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(cover.home(batch.column("fp").to_numpy(zero_copy_only=False) & MASK))], ["anchor"])


def digest(text: str = "text"):
    """MD5 of a text, null counting as empty: with doc_id it tells the rows of a document from others'."""
    return F.md5(F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")))


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents with all columns, one row of each group: that with the least doc_id that isn't null, then the least digest.

    groups: doc_id, digest and root of every document, texts of one digest having one root.
    """
    name = uuid.uuid4().hex
    least = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("m"))
    keep = stored(least.select(F.col("m.doc_id").alias(f"id_{name}"), F.col("m.digest").alias(f"digest_{name}")), "kept")
    of = f"of_{name}"
    out = docs.withColumn(of, digest()).join(keep, (F.col(of) == F.col(f"digest_{name}")) & F.col("doc_id").cast("long").eqNullSafe(F.col(f"id_{name}")), "left_semi")
    # rows of one id and one text are copies of each other
    copies = groups.groupBy("doc_id", "digest").count().where("count > 1")
    return (out if copies.isEmpty() else out.dropDuplicates(["doc_id", of])).drop(of)


def representatives(docs: DataFrame, t: int = 3, width: int = WIDTH) -> DataFrame:
    """The documents with all columns, one row of each component, by its root: that with the least doc_id that isn't null."""
    prints, rooted = _rooted(docs, t, width, digests=True)
    return one_of_each(docs, stored(prints.join(rooted.withColumnRenamed("fp", "f"), F.col("fp") == F.col("f")).select("doc_id", "digest", "root"), "components"))
