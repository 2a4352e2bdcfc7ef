"""The corpus pipeline: quality rules, near duplicates, benchmark passages, secrets, encoding.

Each stage takes the documents that the one before kept and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents.  All but the last return the columns of documents, whatever these are called.

Null and empty texts fail the base rules, so the first stage rejects them; given to a later stage they are one text
without words (one of them stays), hold no item and no secret, and encode to nothing.  Null ids sort last where the least
id stays; rows that share an id or have none are told apart by their texts.  Empty tables give empty results, and a
stage without labels or items leaves its decisions to the base rules, or removes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import bpe, decontamination, near_copies, quality, secret_scan
from pagewright.llm.common import stored, table
from pagewright.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the forest, fitted on labelled rows of these documents, reject go."""
    return quality.kept_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts with a Jaccard similarity of 0.8 or more the document with the least doc_id stays.

    The SimHash operator's anchors on five-word fingerprints give candidates, and MinHash bands those beyond its reach.
    """
    return near_copies.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked."""
    return secret_scan.redacted(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the text they decode to."""
    return bpe.encoded(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

#: Stages rest on fitted models, hashes of shingles and another library's encodings, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
