"""One query for each operator of this subpackage, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .language import identify
from .licenses import scan_licenses
from .mixing import mix
from .near_dedup import near_duplicates
from .pii import find_pii
from .substring_dedup import remove_repeats
from .toxicity import grade_documents
from .url_filter import filter_urls

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumns({"licenses": F.array_join("licenses", ","), "differences": F.array_join("differences", " ")}).drop("spans")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("_hash", "_root")


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_suffix_dedup, op2_url_filter, op3_pii, op4_licenses, op5_toxicity, op6_exact_dedup, op7_language, op8_decontaminate, op9_near_duplicates, op10_mix)
}

SQL: dict[str, str] = {
    "op6_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM t""",
    "op8_decontaminate": rf"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM benchmark),
        win AS (SELECT DISTINCT item, list_slice(ws, s, least(s + 9, len(ws))) AS win
                FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM b WHERE len(ws) > 0)),
        kinds AS (SELECT DISTINCT len(win) AS k FROM win),
        grams AS (SELECT doc_id, s, k, list_slice(ws, s, s + k - 1) AS win
                  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM w, kinds WHERE len(ws) >= k)),
        hits AS (SELECT doc_id, s, k, item FROM grams JOIN win USING (win)),
        pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, s, k FROM hits)) GROUP BY doc_id),
        own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN own USING (doc_id)""",
}
