"""The queries of this subpackage over whole tables, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clinloom.llm import attention, byte_bpe, langid, leaks, lexical, merkle, minhash, pseudonyms, quality, secrets, token_files, toxicity, web_archive
from clinloom.session import read_table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


#: For the query alone; an application passes its own secret.
QUERY_KEY = b"pseudonym key of the registered query"


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.op1(read_table(spark, sf_dir, "documents"), QUERY_KEY)


def op2_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_archive.op2(read_table(spark, sf_dir, "pages"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op4(read_table(spark, sf_dir, "documents"))


def op5_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.op5(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op6(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op7(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op8(read_table(spark, sf_dir, "documents"), WORD_BPE)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.op9(read_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op10(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.op11(read_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.op12(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.op13(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pseudonyms": op1_pseudonyms,
        "op2_web_archive": op2_web_archive,
        "op3_minhash": op3_minhash,
        "op4_language": op4_language,
        "op5_leaks": op5_leaks,
        "op6_secrets": op6_secrets,
        "op7_toxicity": op7_toxicity,
        "op8_token_files": op8_token_files,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_quality": op10_quality,
        "op11_attention": op11_attention,
        "op12_lexical": op12_lexical,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {"op12_lexical": lexical.ORACLE}
