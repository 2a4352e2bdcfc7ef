"""What the operators share: word splitting, folds, the shared work folder, bounded caches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.sources.blocks import spread

#: The bytes that end a word are what bytes.split() splits on, 0x20 and 0x09-0x0D.
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, dealt to all cores where it is small and comes in few parts."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id is in no fold that is left out (-1)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(-1))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only where the session names none and runs on one machine, as in tests, a temporary folder is set, which goes with
    the process.  What is stored in the shared folder of a cluster stays as long as results are read from it, so it is
    the cluster's to clear.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="pagewright-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: it cuts lineage and outlives executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_labels(labels: DataFrame, name: str) -> DataFrame:
    """doc_id and one label of each labelled document; of repeated rows the largest label counts, nulls don't."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull()).groupBy("doc_id").agg(F.max(name).alias("label"))


def bounded_sample(keys: DataFrame, most: int) -> DataFrame:
    """At most `most` rows of (doc_id, ...), those whose ids hash lowest: the same for any partitioning.

    The result is at most `most` narrow rows, so joining with it by broadcast has a fixed bound.
    """
    return F.broadcast(keys.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))


def give_back() -> None:
    """Return freed memory of this Python worker to the system: workers are reused, and hold the most they ever took."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: it keeps what it has
        pass


class Memo(dict):
    """Values computed on first use; emptied between batches when it has grown beyond `most` keys."""

    def __init__(self, make, most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


#: Models and memos by key, one per Python worker: workers are reused from task to task.
_HELD: dict = {}


def held(key: str, make):
    """The object for this key, made once in this Python worker; only the last few are kept."""
    if key not in _HELD:
        while len(_HELD) >= 3:
            _HELD.pop(next(iter(_HELD)))
        _HELD[key] = make()
    return _HELD[key]


def portions(texts: list, most: int = 2_000_000):
    """(begin, end) slices of a batch with about that many characters each, or one longer text: memory follows these, not the batch."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
