"""The registered queries of this folder: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import bpe, decontamination, katz, language, quality, secret_scan, simhash, suffix_dedup, toxicity, warc
from pagewright.llm.common import table


def tokenizer_path() -> str:
    """Where the tokenizer file of this machine lies; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.apply(docs, language.fit(docs))


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.apply(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), order=3)


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.apply(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_warc_round_trip, op3_toxicity, op4_benchmark_decontamination, op5_simhash_near_dedup, op6_secret_scan, op7_katz_scoring, op8_bpe_encoding, op9_suffix_array_dedup, op10_quality_rules)}

WORDS = "list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]', ' ', 'g'), ' '), lambda x: x <> '')"

#: DuckDB SQL where it can express the whole result.  The others rest on a fitted model, on XXH64 with a seed, on spans
#: found by overlapping rules, on another library's encodings or on byte strings at every offset; tests hold them
#: against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_warc_round_trip": """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(s, CAST(k // 4 * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - k % 4 * 5 AS INT)) & 31 AS INT) + 1, 1)), '') AS payload_digest,
CASE WHEN page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to FROM d""",
    "op4_benchmark_decontamination": f"""WITH q AS (SELECT item_id, {WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {WORDS} AS w FROM documents),
qs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) <= 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS g FROM q WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) <= 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS g FROM d WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM qs GROUP BY item_id), m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN qs USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM m JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_item - 1e-9""",
}
