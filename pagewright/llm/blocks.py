"""Documents in blocks of bounded size, kept as a table in the shared folder.

Operators that visit the corpus several times (once to ask, once to use the answers) name a block by its
number and are sent what concerns it; a block's documents are in memory together, other blocks' aren't.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import give_back, stored

#: What stands for a null doc_id inside blocks: it sorts first.
NO_ID = -(1 << 63)


def packed(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Arrays of numbers, or bytes, in one compressed string; numbers byte by byte of rank, so that small ones cost little."""
    raw = [a if isinstance(a, bytes) else np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=level).compress(b"".join([np.array([len(raw), *map(len, raw)], np.int64).tobytes(), *raw]))


def unpacked(blob: bytes, *types) -> list:
    """What packed() was given; type None gives bytes."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(data, np.int64, len(types), 8)
    out, at = [], 8 * (len(types) + 1)
    for size, kind in zip(sizes.tolist(), types):
        if kind is None:
            out.append(data[at : at + size])
        else:
            width = np.dtype(kind).itemsize
            planes = np.frombuffer(data, np.uint8, size, at).reshape(width, -1)
            out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += size
    return out


@dataclass
class Block:
    ids: np.ndarray
    sizes: np.ndarray
    data: bytes

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def texts(self) -> list[bytes]:
        return [self.data[a : a + n] for a, n in zip(self.starts.tolist(), self.sizes.tolist())]

    @classmethod
    def of(cls, blob: bytes) -> Block:
        return cls(*unpacked(blob, np.int64, np.int64, None))


def whole_texts(ids: np.ndarray, texts: list[bytes]) -> tuple[bytes]:
    return (packed(ids, np.array([len(t) for t in texts], np.int64), b"".join(texts), level=8),)


def blocks(docs: DataFrame, block_bytes: int = 4_000_000, pack=whole_texts, columns: tuple[str, ...] = ("blob",)) -> DataFrame:
    """(block, n_bytes, blob): every document's id and whole text, in blocks of about block_bytes or one longer text.

    pack: makes what is kept of a block's ids and texts, a value for each of the columns.
    """

    def run(batches):
        number, ids, texts, size = TaskContext.get().partitionId() << 24, [], [], 0

        def close():
            blobs = pack(np.array(ids, np.int64), texts)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), *(pa.array([x], pa.binary()) for x in blobs)], ["block", "n_bytes", *columns])

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or b""
                if size and size + len(text) > block_bytes:
                    yield close()
                    number, ids, texts, size = number + 1, [], [], 0
                    give_back()
                ids.append(NO_ID if i is None else i)
                texts.append(text)
                size += len(text)
        if ids:
            yield close()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return stored(source.mapInArrow(run, "block long, n_bytes long" + "".join(f", {c} binary" for c in columns)), "blocks")


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def dealt(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts keys into n buckets by their low bits after mixing (stable), and where each bucket begins."""
    bucket = ((keys ^ (keys >> np.uint64(32))) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))
