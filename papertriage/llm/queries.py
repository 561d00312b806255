"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table. ``QUERIES`` maps a name to the
query, ``SQL`` to its DuckDB statement where SQL can express it; the others
are tested against brute force in ``tests/llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, exact_dedup, jaccard_join, lexical_search, suffix_dedup, url_filter, warc
from .bestfit_pack import pack_documents
from .common import read
from .decontaminate import find_leaks
from .language_id import identify_languages
from .license_scan import scan_licenses
from .secret_scan import scan_secrets
from .token_count import count_tokens


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_bestfit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages")).drop("distrust_share")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(read(spark, sf_dir, "conversations"))


_ALL = (
    op1_license_scan, op2_language_id, op3_jaccard_join, op4_decontaminate, op5_bestfit_pack,
    op6_token_count, op7_warc, op8_url_filter, op9_exact_dedup, op10_secret_scan, op11_lexical_search, op12_suffix_dedup, op13_conversation_repair,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
SQL: dict[str, str] = {
    "op3_jaccard_join": jaccard_join.SQL,
    "op7_warc": warc.SQL,
    "op8_url_filter": url_filter.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op12_suffix_dedup": suffix_dedup.SQL,
    "op13_conversation_repair": conversation_repair.SQL,
}
