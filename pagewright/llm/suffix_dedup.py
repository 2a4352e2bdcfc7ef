"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Only suffixes at sampled places are sorted: those whose next K bytes have the least hash of some window of
LENGTH - K + 1 places.  Equal strings of LENGTH bytes choose equal places, so each repeat is seen at a suffix
that both occurrences have in the sample (about one place in 35).

1. Each block of documents sends the hashes at its places; those found once in the corpus are settled.
2. The other suffixes of a block, with the bytes around the place that the strings it stands for cover, become a
   sorted, front-coded run for each range of first K bytes; of equal ones in a block only the first goes on.  Ranges
   are cut by splitters from a bounded sample, which decides on balance, never on results.
3. A range's runs are merged by a loser tree that keeps the length of the prefix each run's head shares with the
   last suffix put out, and never compares those bytes again.  The merged prefix lengths decide repeats: two suffixes
   share as many bytes as the least length between them.  A string that begins o bytes before its place has an earlier
   equal if they share LENGTH - o bytes, which these lengths say, and the o bytes before their places are equal, which
   is the only comparison left.
4. Marks go back to their blocks, which drop the bytes covered.

Results are exact: hashes only choose places and candidates, equality is decided on bytes.

A null text counts as empty.  A null doc_id sorts before all others and is null in the result.  Rows that
repeat an id are told apart by their places in the blocks, the first stored counting as earlier.  Texts under
LENGTH bytes lose nothing; texts of any length are treated whole.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.blocks import Block, blocks, dealt, id_array, packed, unpacked

LENGTH, K = 100, 32
LEFT = LENGTH - K
WINDOW = LENGTH - K + 1
CHUNK = 1 << 19
#: Blocks that splitters are chosen from, one in how many of their places, and the most ranges; beyond, ranges are dealt
#: on by hash.
SAMPLED_BLOCKS, SAMPLED_SHARE, MOST_RANGES = 16, 64, 4096
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = np.uint64(pow(int(base), done, 1 << 64))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out


def hashes(data: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """64-bit hashes of all K-byte strings of the data."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    h = (total[K:] - total[:-K]) * down[: len(data) - K + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_least(x: np.ndarray) -> np.ndarray:
    """The least of each WINDOW neighbouring values, by doubling."""
    span = 1
    while 2 * span <= WINDOW:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (WINDOW - span)], x[WINDOW - span :])


def places(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled places of a block (offsets into its data, ascending), their hashes, and for each the first and the last
    begin of a string of LENGTH bytes within a text whose window has its least hash, leftmost of equals, there.

    Every string has one place, at the same distance from its begin wherever it occurs.
    """
    data = np.frombuffer(block.data, np.uint8)
    n = len(data)
    nothing = np.zeros(0, np.int64)
    out: list[tuple] = [(nothing, np.zeros(0, np.uint64), nothing, nothing)]
    if n >= LENGTH:
        size = min(n, CHUNK + LENGTH)
        up, down = powers(BASE, size), powers(BACK, size)
        ends = np.cumsum(block.sizes)
        for start in range(0, n - LENGTH + 1, CHUNK):
            h = hashes(data[start : start + CHUNK + LENGTH], up, down)
            least = sliding_least((h & ~np.uint64(0xFFFFF)) | np.arange(len(h), dtype=np.uint64))[:CHUNK]
            begin = np.arange(start, start + len(least))
            inside = ends[np.searchsorted(ends, begin, "right").clip(max=len(ends) - 1)] - begin >= LENGTH
            begin, at = begin[inside], (least[inside] & np.uint64(0xFFFFF)).astype(np.int64)
            if len(at):
                new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                out.append((at[new] + start, h[at[new]], begin[new], begin[np.append(new[1:], len(at)) - 1]))
    at, h, first, last = (np.concatenate(x) for x in zip(*out))
    if len(at):  # a place may have strings on both sides of a chunk's end
        new = np.append(True, at[1:] != at[:-1])
        at, h, first, last = at[new], h[new], first[new], last[np.append(np.flatnonzero(new)[1:], len(new)) - 1]
    return at, h, first, last


def repeated_within(h: np.ndarray) -> np.ndarray:
    """For each hash, whether it occurs twice or more."""
    values, counts = np.unique(h, return_counts=True)
    return values[counts > 1]


def asked(buckets: int):
    """Per block, the distinct hashes at its places, by bucket."""

    def run(batches):
        for batch in batches:
            for number, blob in zip(batch.column("block").to_pylist(), batch.column("blob").to_pylist()):
                h = np.unique(places(Block.of(blob))[1])
                order, cuts = dealt(h, buckets)
                h = h[order]
                full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([number] * len(full), pa.int64()), pa.array([packed(np.diff(h[cuts[b] : cuts[b + 1]], prepend=np.uint64(0))) for b in full], pa.binary())], ["bucket", "block", "hashes"])

    return run


def answered(table: pa.Table) -> pa.Table:
    """For each block, those of its hashes that other blocks have too."""
    numbers = table.column("block").to_pylist()
    parts = [np.cumsum(unpacked(x, np.uint64)[0], dtype=np.uint64) for x in table.column("hashes").to_pylist()]
    shared = repeated_within(np.concatenate(parts))
    rows = [(n, found) for n, p in zip(numbers, parts) if len(found := p[np.isin(p, shared, assume_unique=True)])]
    return pa.table({"block": pa.array([n for n, _ in rows], pa.int64()), "shared": pa.array([packed(np.diff(f, prepend=np.uint64(0))) for _, f in rows], pa.binary())})


def contexts(data: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bytes around each place: `left` before it, at the end of LEFT bytes, `right` from it on; zero elsewhere."""
    offsets = np.arange(-LEFT, LENGTH)
    out = data[np.clip(at[:, None] + offsets, 0, len(data) - 1)]
    out[(offsets < -left[:, None]) | (offsets >= right[:, None])] = 0
    return out


def front_coded(right: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Shared prefix with the one before, for each of a sorted list, and what follows it."""
    shared, rest, last = [], [], b""
    for x in right:
        n = common(last, x, 0)
        shared.append(n)
        rest.append(x[n:])
        last = x
    return np.array(shared, np.uint8), b"".join(rest)


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, given that the first `known` bytes agree."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return n if not x else n - (x.bit_length() + 7) // 8


def splitters(source: DataFrame, buckets: int) -> list[bytes]:
    """First K bytes that cut the order of suffixes into min(buckets, MOST_RANGES) ranges of about equal size.

    The sample takes the same suffixes of every sampled block, by hash; what several blocks have counts once for each,
    as it is sent by each, and what only one has counts little, as it is settled before.
    """

    def prefixes(batches):
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                block = Block.of(blob)
                at, h, _, _ = places(block)
                at = at[h % np.uint64(SAMPLED_SHARE) == 0]
                yield pa.RecordBatch.from_arrays([pa.array(sorted({block.data[a : a + K] for a in at.tolist()}), pa.binary())], ["prefix"])

    chosen = [r.block for r in source.select("block").orderBy(F.xxhash64("block"), "block").limit(SAMPLED_BLOCKS).collect()]
    got = Counter(bytes(r.prefix) for r in source.where(F.col("block").isin(chosen)).select("blob").mapInArrow(prefixes, "prefix binary").collect())
    ranges, order = min(buckets, MOST_RANGES), sorted(got)
    if not order:
        return []
    load = np.cumsum([n if n > 1 else 0.1 for n in map(got.__getitem__, order)])
    return sorted({order[k] for k in np.searchsorted(load, load[-1] * np.arange(1, ranges) / ranges).tolist()})


def ranged(data: np.ndarray, at: np.ndarray, h: np.ndarray, cuts: list[bytes], buckets: int) -> np.ndarray:
    """The bucket of each suffix: the range of its first K bytes, and a hash of these where there are more buckets than ranges."""
    if not len(at):
        return at
    first = np.ascontiguousarray(data[at[:, None] + np.arange(K)]).view(f"S{K}").ravel()
    place = np.searchsorted(np.array(cuts, f"S{K}"), first, "right") if cuts else np.zeros(len(at), np.int64)
    each = max(1, buckets // (len(cuts) + 1))
    return place * each + ((h ^ (h >> np.uint64(32))) % np.uint64(each)).astype(np.int64)


def runs(buckets: int, splits: list[bytes]):
    """Per block, sorted front-coded runs of the suffixes that may repeat (kind 0), and what is settled at once (kind 1)."""

    def run(key, own: pa.Table, answers: pa.Table) -> pa.Table:
        kinds, keys, blobs = [], [], []
        for number, blob in zip(own.column("block").to_pylist(), own.column("blob").to_pylist()):
            block = Block.of(blob)
            data = np.frombuffer(block.data, np.uint8)
            at, h, begin, last = places(block)
            known = np.concatenate([repeated_within(h), *(np.cumsum(unpacked(x, np.uint64)[0], dtype=np.uint64) for x in answers.column("shared").to_pylist())])
            found = np.isin(h, known)
            at, h, left, right = at[found], h[found], (at - begin)[found], (last + LENGTH - at)[found]
            ends = np.cumsum(block.sizes)
            text = np.searchsorted(ends, at, "right")
            # the earlier by id, then by place in the block, comes first
            order = np.lexsort((at, text, block.ids[text]))
            at, h, text, left, right = at[order], h[order], text[order], left[order], right[order]
            firsts, a, b = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            seen: dict[bytes, int] = {}
            for k in range(0, len(at), 50_000):
                part, lo, hi = at[k : k + 50_000], left[k : k + 50_000], right[k : k + 50_000]
                c = contexts(data, part, lo, hi)
                rows = np.concatenate([c, lo[:, None].astype(np.uint8), hi[:, None].astype(np.uint8)], 1)
                again = np.array([seen.setdefault(x.tobytes(), k + j) != k + j for j, x in enumerate(rows)], bool) if len(rows) else np.zeros(0, bool)
                a.append((part - lo)[again])
                b.append((part + hi)[again])
                firsts.append(np.flatnonzero(~again) + k)
            kinds.append(1)
            keys.append(number)
            blobs.append(packed(np.concatenate(a), np.concatenate(b)))
            first = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
            members = list(seen)  # in the order of `first`
            bucket_of = ranged(data, at[first], h[first], splits, buckets)
            deal = np.argsort(bucket_of, kind="stable")
            ends_of = np.flatnonzero(np.diff(bucket_of[deal], append=-1))
            for start, end in zip([0, *(ends_of[:-1] + 1)], ends_of + 1):
                own_rows = deal[start:end]
                bucket = int(bucket_of[own_rows[0]])
                rows = sorted((members[j][LEFT : LEFT + members[j][-1]], int(first[j]), j) for j in own_rows.tolist())
                shared, rest = front_coded([r[0] for r in rows])
                where = np.array([r[1] for r in rows])
                lefts = b"".join([members[r[2]][:LEFT] for r in rows])
                kinds.append(0)
                keys.append(bucket)
                blobs.append(packed(np.array([number], np.int64), shared, np.array([len(r[0]) for r in rows], np.uint8), rest, lefts, np.array([members[r[2]][-2] for r in rows], np.uint8), block.ids[text[where]], at[where]))
        return pa.table({"kind": pa.array(kinds, pa.int32()), "key": pa.array(keys, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


class Run:
    """Reads a front-coded run one suffix at a time."""

    def __init__(self, index: int, blob: bytes):
        self.index = index
        number, self.shared, self.size, self.rest, self.lefts, self.left, self.ids, self.at = unpacked(blob, np.int64, np.uint8, np.uint8, None, None, np.uint8, np.int64, np.int64)
        self.block = int(number[0])
        self.shared, self.sizes = self.shared.tolist(), self.size.tolist()
        self.row, self.place, self.head = -1, 0, b""

    def advance(self) -> int:
        """Move on; the prefix length shared with the suffix before, or -1 at the end."""
        self.row += 1
        if self.row == len(self.shared):
            self.head = None
            return -1
        shared = self.shared[self.row]
        more = self.sizes[self.row] - shared
        self.head = self.head[:shared] + self.rest[self.place : self.place + more]
        self.place += more
        return shared


def merged(inputs: list[Run]):
    """(run, row, shared): all suffixes in order, with the prefix length each shares with the one before.

    A tree of losers: each node holds the run that lost there and the prefix its head shares with the suffix that
    won there.  Of two heads, that which shares more with the last suffix put out is the smaller; only if they
    share equally much are bytes compared, from there on.
    """
    n = 1
    while n < len(inputs):
        n *= 2
    heads: list = [*inputs, *[None] * (n - len(inputs))]
    for r in inputs:
        r.advance()

    def play(x, sx, y, sy):
        """Winner, its shared length with the last suffix, the loser, its shared length with the winner."""
        if x is None or x.head is None:
            return y, sy, x, -1
        if y is None or y.head is None:
            return x, sx, y, -1
        if sx > sy:
            return x, sx, y, sy
        if sy > sx:
            return y, sy, x, sx
        a, b = x.head, y.head
        both = common(a, b, sx)
        if both == len(a) or (both < len(b) and a[both] < b[both]):
            return x, sx, y, both
        return y, sy, x, both

    losers: list = [None] * n
    level = [(h, 0) for h in heads]
    width = n
    while width > 1:
        up = []
        for k in range(width // 2):
            w, sw, lo, sl = play(*level[2 * k], *level[2 * k + 1])
            losers[width // 2 + k] = (lo, sl)
            up.append((w, sw))
        level, width = up, width // 2
    best, shared = level[0]
    while best is not None and best.head is not None:
        yield best, best.row, shared
        shared = best.advance()
        node = (best.index + n) // 2
        while node:
            other, so = losers[node]
            best, shared, lo, sl = play(best, shared, other, so)
            losers[node] = (lo, sl)
            node //= 2


def marked(group: np.ndarray, shared: np.ndarray, before: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(member, first, last): the offsets before its place at which a string of each member has an earlier equal.

    Members are in the merge's order, groups together; shared: the prefix length that the merge found with the member
    before; before: the LEFT bytes before each place.  Small groups are taken by pairs, large ones offset by offset:
    members between which no shared length is under LENGTH - o are one run, in which equal bytes before the place tell.
    """
    sizes = np.bincount(group)
    out = []
    small = sizes[group] <= 8
    index = np.flatnonzero(small)
    low = shared[index]  # least shared length between each member and the k-th before it
    for k in range(1, 8):
        if len(index) <= k:
            break
        i, j = index[:-k], index[k:]
        low = np.minimum(low[:-1], shared[index[k:]]) if k > 1 else shared[j]
        same = group[i] == group[j]
        pairs_low = low[same]
        i, j = i[same], j[same]
        for part in range(0, len(i), 100_000):
            a, b = i[part : part + 100_000], j[part : part + 100_000]
            behind = (before[a] != before[b])[:, ::-1]
            back = np.where(behind.any(1), behind.argmax(1), LEFT)
            back, reach = np.minimum(back, np.minimum(left[a], left[b])), pairs_low[part : part + 100_000]
            hit = reach + back >= LENGTH
            later = np.where(rank[a] > rank[b], a, b)[hit]
            out.append((later, LENGTH - reach[hit], back[hit]))
    large = np.flatnonzero(~small)
    if len(large):
        down = powers(BACK, LEFT + 1)
        total = np.zeros((len(large), LEFT + 1), np.uint64)
        np.cumsum((before[large].astype(np.uint64) + np.uint64(1)) * powers(BASE, LEFT), axis=1, out=total[:, 1:])
        by_rank = np.argsort(rank[large], kind="stable")
        new_group = np.append(True, group[large][1:] != group[large][:-1])
        for o in range(LEFT + 1):
            run = np.cumsum(new_group | (shared[large] < LENGTH - o))
            rows = by_rank[((left[large] >= o) & (right[large] >= LENGTH - o))[by_rank]]
            if len(rows) < 2:
                continue
            key = (total[rows, LEFT] - total[rows, LEFT - o]) * down[LEFT - o]
            key = (key ^ (key >> np.uint64(33))) * BACK ^ run[rows].astype(np.uint64) * BASE
            _, first, back = np.unique(key, return_index=True, return_inverse=True)
            head = first[back]  # the earliest of each key
            x, y = rows, rows[head]
            equal = (run[x] == run[y]) & (before[large[x], LEFT - o :] == before[large[y], LEFT - o :]).all(1)
            if not equal.all():  # two strings of one key: its rows are told apart by their bytes
                seen: dict = {}
                for n in np.flatnonzero(np.isin(back, back[~equal])).tolist():
                    head[n] = seen.setdefault((run[rows[n]], before[large[rows[n]], LEFT - o :].tobytes()), n)
            again = large[rows[head != np.arange(len(rows))]]
            out.append((again, np.full(len(again), o), np.full(len(again), o)))
    return out


def settled(table: pa.Table) -> pa.Table:
    """Merge a bucket's runs and mark repeats; for each block the places to drop. What is settled already passes."""
    if table.column("kind")[0].as_py() == 1:
        return pa.table({"block": table.column("key"), "spans": table.column("blob")})
    inputs = [Run(k, x) for k, x in enumerate(table.column("blob").to_pylist())]
    n = sum(len(r.shared) for r in inputs)
    source, row, group, prefix = np.empty(n, np.int32), np.empty(n, np.int32), np.empty(n, np.int64), np.empty(n, np.int64)
    current = -1
    for k, (r, i, shared) in enumerate(merged(inputs)):
        if shared < K:
            current += 1
        source[k], row[k], group[k], prefix[k] = r.index, i, current, shared
    sizes = np.bincount(group, minlength=1)
    several = np.flatnonzero(sizes[group] > 1)
    source, row, prefix, group = source[several], row[several], prefix[several], np.unique(group[several], return_inverse=True)[1]

    def gather(name, dtype, width=0):
        out = np.empty((len(source), width) if width else len(source), dtype)
        for k, r in enumerate(inputs):
            own = source == k
            values = getattr(r, name)
            values = np.frombuffer(values, np.uint8).reshape(-1, width) if width else values
            out[own] = values[row[own]]
        return out

    left_bytes, left, right, ids, at = gather("lefts", np.uint8, LEFT), gather("left", np.int64), gather("size", np.int64), gather("ids", np.int64), gather("at", np.int64)
    numbers = np.array([r.block for r in inputs], np.int64)[source]
    rank = np.empty(len(source), np.int64)
    rank[np.lexsort((at, numbers, ids))] = np.arange(len(source))
    spans: dict[int, list] = {}
    if len(source):
        for member, first, last in marked(group, prefix, left_bytes, left, right, rank):
            # strings that begin first..last bytes before the place: from the farthest's begin to the nearest's end
            begin, end, to = at[member] - last, at[member] - first + LENGTH, numbers[member]
            for number in np.unique(to).tolist():
                spans.setdefault(number, []).append((begin[to == number], end[to == number]))
    # runs of neighbouring texts may touch in the block: they stay apart
    rows = [(number, packed(*joined(np.concatenate([x for x, _ in s]), np.concatenate([y for _, y in s]), False))) for number, s in spans.items()]
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "spans": pa.array([r[1] for r in rows], pa.binary())})


def joined(begin: np.ndarray, end: np.ndarray, touching: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open intervals; touching: also join those that only touch."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1] if touching else begin[1:] >= end[:-1])
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def removed(block: Block, blobs: list[bytes]) -> list[tuple[int, list[tuple[int, int]]]]:
    """Of each text of the block, its maximal removed runs (offsets in the text)."""
    parts = [unpacked(x, np.int64, np.int64) for x in blobs]
    empty = np.zeros(0, np.int64)
    begin, end = np.concatenate([empty, *(p[0] for p in parts)]), np.concatenate([empty, *(p[1] for p in parts)])
    ends, starts = np.cumsum(block.sizes), block.starts
    text = np.searchsorted(ends, begin, "right")
    out: list[tuple[int, list]] = [(k, []) for k in range(len(block.ids))]
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(len(block.ids) + 1))
    for k in np.unique(text).tolist():
        own = order[cuts[k] : cuts[k + 1]]
        a, b = joined(begin[own] - starts[k], end[own] - starts[k])
        out[k] = (k, list(zip(a.tolist(), b.tolist())))
    return out


def results(key, own: pa.Table, spans: pa.Table) -> pa.Table:
    """The rows of the documents of one block."""
    rows, ids = [], []
    for blob in own.column("blob").to_pylist():
        block = Block.of(blob)
        for (k, gone), data in zip(removed(block, spans.column("spans").to_pylist()), block.texts()):
            digest, last = sha256(), 0
            for a, b in gone:
                digest.update(data[last:a])
                last = b
            digest.update(data[last:])
            ids.append(block.ids[k])
            rows.append((len(data), sum(b - a for a, b in gone), len(gone), digest.hexdigest()))
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
    return pa.Table.from_arrays([id_array(np.array(ids, np.int64)), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def kept_texts(key, own: pa.Table, spans: pa.Table) -> pa.Table:
    """doc_id and the bytes that are left, for `deduplicated`."""
    ids, texts = [], []
    for blob in own.column("blob").to_pylist():
        block = Block.of(blob)
        for (k, gone), data in zip(removed(block, spans.column("spans").to_pylist()), block.texts()):
            ids.append(block.ids[k])
            texts.append(b"".join(data[a:b] for a, b in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(data)])))
    return pa.Table.from_arrays([id_array(np.array(ids, np.int64)), pa.array(texts, pa.binary())], ["doc_id", "text"])


def _apply(docs: DataFrame, function, schema: str, block_bytes: int, bucket_bytes: int) -> DataFrame:
    source = blocks(docs, block_bytes)
    total = source.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = max(64, -(-total // bucket_bytes))  # small inputs too have enough ranges for even shares
    answers = source.select("block", "blob").mapInArrow(asked(buckets), "bucket long, block long, hashes binary").groupBy("bucket").applyInArrow(answered, "block long, shared binary")
    found = source.select("block", "blob").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(runs(buckets, splitters(source, buckets)), "kind int, key long, blob binary")
    spans = found.groupBy("kind", "key").applyInArrow(settled, "block long, spans binary")
    return source.select("block", "blob").groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(function, schema)


def repeats(docs: DataFrame, block_bytes: int = 4_000_000, bucket_bytes: int = 8_000_000) -> DataFrame:
    """Counts and the digest of what is left of every document."""
    return _apply(docs, results, SCHEMA, block_bytes, bucket_bytes)


def deduplicated(docs: DataFrame, block_bytes: int = 4_000_000, bucket_bytes: int = 8_000_000) -> DataFrame:
    """doc_id and what is left of every document's text, as bytes: a cut may fall inside a character."""
    return _apply(docs, kept_texts, "doc_id long, text binary", block_bytes, bucket_bytes)
