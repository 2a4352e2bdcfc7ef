"""Files of blocks as a stream: clean blocks and formulas come out as files arrive.

Only operators that need one block or one page are here; books are put in context by the batch plan over what the
stream has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import formula as fx
from pagewright.functions.blocktext import is_furniture_phrase
from pagewright.functions.strings import strip
from pagewright.sources.blocks import BLOCKS


def block_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(BLOCKS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def formula_stream(blocks: DataFrame) -> DataFrame:
    """Blocks that look like formulas, with keys; stateless, so that rows come out as soon as they are read."""
    t = strip(F.col("text"))
    return blocks.where((F.col("block_type") == 0) & (t != "") & ~is_furniture_phrase(F.col("text")) & fx.is_formula_heuristic(t)).select("book_id", "page_num", "block_idx", t.alias("text"), fx.canonical_key(t).alias("canonical_key"))


def key_counts(formulas: DataFrame) -> DataFrame:
    """How often each formula has been seen so far."""
    return formulas.groupBy("canonical_key").count()


def start(df: DataFrame, path: str, checkpoint: str):
    """Append to Parquet; what is there already is taken up to now and the query ends."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
