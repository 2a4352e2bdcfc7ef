"""Blocks of text with their places on pages: adapters, file sources and the page-range scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS = (
    "book_id string, doc_uri string, page_num int, page_width double, page_height double, block_idx int, "
    "x0 double, y0 double, x1 double, y1 double, text string, block_type int"
)
#: The adapter's pages hold so many lines each.
LINES_PER_PAGE = 5


#: Tables under this many bytes are dealt to all cores where they come in fewer parts.
SMALL_TABLE = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """A small table that is read in fewer parts than there are cores, dealt to all of them; any other as it is.

    One file of one row group is one task however long its rows take.  What is moved is bounded by SMALL_TABLE.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < SMALL_TABLE and df.rdd.getNumPartitions() < cores else df


def from_documents(docs: DataFrame, lines_per_page: int = LINES_PER_PAGE) -> DataFrame:
    """Each document as a book of its own: its lines are blocks, a fixed number of lines a page.

    A narrow projection: no row leaves its partition, and later windows over a book are bounded by one document.
    """
    lines = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("block_idx", "text"))
    on_page = F.col("block_idx") % lines_per_page
    return lines.select(
        F.col("doc_id").cast("string").alias("book_id"),
        F.lit(None).cast("string").alias("doc_uri"),
        (F.floor(F.col("block_idx") / lines_per_page) + 1).cast("int").alias("page_num"),
        F.lit(595.0).alias("page_width"),
        F.lit(842.0).alias("page_height"),
        "block_idx",
        F.lit(72.0).alias("x0"),
        (F.lit(72.0) + 12 * on_page).alias("y0"),
        F.lit(523.0).alias("x1"),
        (F.lit(84.0) + 12 * on_page).alias("y1"),
        "text",
        F.lit(0).alias("block_type"),
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks from Parquet; files sorted by (book_id, page_num) let a page range prune row groups."""
    return spark.read.schema(BLOCKS).parquet(path)


def read_pdf(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of PDF files, read whole by a file reader on the executors; needs the PyMuPDF package there."""
    import importlib.util

    if importlib.util.find_spec("fitz") is None:
        raise RuntimeError("reading PDF files needs the PyMuPDF package, which is not installed here")

    def blocks_of(batches):
        import fitz
        import pandas as pd

        for batch in batches:
            for uri, content in zip(batch["path"], batch["content"]):
                rows = []
                with fitz.open(stream=content, filetype="pdf") as doc:
                    for number, page in enumerate(doc, 1):
                        for k, (x0, y0, x1, y1, text, _, kind) in enumerate(page.get_text("blocks")):
                            rows.append((uri.rsplit("/", 1)[-1].rsplit(".", 1)[0], uri, number, page.rect.width, page.rect.height, k, x0, y0, x1, y1, text, kind))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(blocks_of, BLOCKS)


CONTENTS = "book_id string, entry_idx int, level int, title string, page int"
SPANS = "book_id string, page_num int, text string, size double, y0 double"


def read_pdf_contents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entries of PDF files' tables of contents, and the spans of the pages that these name; needs PyMuPDF."""
    import importlib.util

    if importlib.util.find_spec("fitz") is None:
        raise RuntimeError("reading PDF files needs the PyMuPDF package, which is not installed here")
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows_of(of):
        def run(batches):
            import fitz
            import pandas as pd

            for batch in batches:
                for uri, content in zip(batch["path"], batch["content"]):
                    with fitz.open(stream=content, filetype="pdf") as doc:
                        yield pd.DataFrame(of(uri.rsplit("/", 1)[-1].rsplit(".", 1)[0], doc))

        return run

    def entries(book, doc):
        return {c: x for c, x in zip(("book_id", "entry_idx", "level", "title", "page"), zip(*[(book, k, level, str(title or "").strip(), page) for k, (level, title, page) in enumerate(doc.get_toc() or [])]))}

    def spans(book, doc):
        named = sorted({p for _, _, p in doc.get_toc() or [] if 1 <= p <= len(doc)})
        found = [(book, p, s.get("text") or "", s.get("size", 0.0), s["bbox"][1]) for p in named for b in doc[p - 1].get_text("dict").get("blocks", []) for line in b.get("lines", []) for s in line.get("spans", [])]
        return {c: x for c, x in zip(("book_id", "page_num", "text", "size", "y0"), zip(*found))}

    return files.mapInPandas(rows_of(entries), CONTENTS), files.mapInPandas(rows_of(spans), SPANS)


def pages(blocks: DataFrame, first: int, end: int) -> DataFrame:
    """The half-open range of pages counted from 0: pages first + 1 to end. Pushed down to the scan."""
    return blocks.where(F.col("page_num").between(first + 1, end))
