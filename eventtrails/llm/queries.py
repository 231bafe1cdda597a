"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_join

    return ngram_join(_read(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .source_mix import mix_sources

    out = mix_sources(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_main_text

    return extract_main_text(_read(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_duplicates

    return exact_duplicates(_read(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import secret_report

    return secret_report(_read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality

    return score_quality(_read(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(_read(spark, sf_dir, "embeddings"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece_codec import encode_documents

    return encode_documents(_read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan_licenses

    return scan_licenses(_read(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pii_report

    return pii_report(_read(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_repair import repair_report

    return repair_report(_read(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(_read(spark, sf_dir, "documents"))


def op13_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import edited_report

    return edited_report(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_mix_sources": op2_mix_sources,
        "op3_html_extract": op3_html_extract,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_secret_scan": op5_secret_scan,
        "op6_quality": op6_quality,
        "op7_topk": op7_topk,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_license_scan": op9_license_scan,
        "op10_pii": op10_pii,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_collocations": op12_collocations,
        "op13_fingerprint": op13_fingerprint,
    }


def oracle_sql() -> dict[str, str]:
    from . import license_scan as L
    from .secret_scan import BASE_KINDS, RULES

    return {
        "op2_mix_sources": sql.MIX_SOURCES,
        "op4_exact_dedup": sql.EXACT_DEDUP,
        "op7_topk": sql.top_k(),
        "op11_conversation_repair": sql.conversation_repair(),
        "op12_collocations": sql.collocations(),
        "op9_license_scan": sql.license_scan(L.TEXTS + L.NOTICES, L.NOTICES, L.EQUIVALENTS, L.PUNCTUATION),
        "op5_secret_scan": sql.secret_scan(RULES, BASE_KINDS),
    }
