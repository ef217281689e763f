"""The queries of this subpackage and the SQL that some of them can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, katz, language_id, near_dedup, sentencepieces, sharding, token_files, toxicity, warc
from .common import table


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op2_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.piece_digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(files)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_near_dedup, op2_sentencepieces, op3_sharding, op4_katz, op5_exact_dedup, op6_language_id, op7_decontaminate, op8_token_files, op9_warc, op10_toxicity)}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
        "op9_warc": r"""
            WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
            d AS (SELECT page_id, url, strlen(h) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS latest FROM p),
            b AS (SELECT *, array_to_string(list_transform(string_split(x, ''), lambda c: lpad(bin(('0x' || c)::INT), 4, '0')), '') AS bits,
                         regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(?:[?]([^#]*))?', ['host', 'port', 'path', 'query']) AS u FROM d),
            k AS (SELECT *, CASE WHEN url IS NULL THEN 'urn:null' WHEN u.host = '' THEN lower(trim(url)) ELSE
                       array_to_string(list_reverse(string_split(regexp_replace(lower(u.host), '^www[.]', ''), '.')), ',') || CASE WHEN u.port IN ('', '80', '443') THEN '' ELSE ':' || u.port END || ')'
                       || CASE WHEN u.path = '' THEN '/' ELSE lower(u.path) END || CASE WHEN u.query = '' THEN '' ELSE '?' || lower(u.query) END END AS url_key,
                       strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y%m%d%H%M%S') AS captured FROM b)
            SELECT page_id, payload_bytes,
                   array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(5), lambda k:
                       substr(bits, CAST(5 * i + k + 1 AS INT), 1)::INT * [16, 8, 4, 2, 1][CAST(k + 1 AS INT)])) AS INT), 1)), '') AS payload_digest,
                   CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> latest THEN latest END AS refers_to,
                   url_key, captured, row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS position
            FROM k""",
    }
