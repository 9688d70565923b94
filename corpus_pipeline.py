"""The corpus pipeline over documents: language, near duplicates, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; run() writes each
result as Parquet and reads it again as the next stage's documents. A document is a row's doc_id and text, known by a
64-bit hash of both, so that rows without doc_id, and different texts under one doc_id, are documents of their own.

Nulls and edge cases: a row without text has no language and goes in the first stage; where no document has a
language to learn from, that stage rejects nothing; repeated rows of one doc_id and text are one document to the
duplicate stage, which keeps one of them; very long texts are handled whole; columns besides those of
documents are not carried, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom.llm import byte_bpe, langid, leaks, minhash, secrets
from clinloom.session import read_table, store

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A language must be this likely at least, else the document goes.
LEAST_LANGUAGE_SCORE = 0.5


def _key():
    return F.xxhash64("doc_id", "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; those without text or letters, or with a language less
    likely than ``LEAST_LANGUAGE_SCORE``, go. Without any labelled language all stay."""
    rows = docs.select(*COLUMNS)
    model = langid.fit_on(rows)
    if not model.languages:
        return rows
    told = langid.identify(rows, model)
    return told.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays (of several the one with the
    smallest hash, those without doc_id last), in one row."""
    rows = docs.select(*COLUMNS).withColumn("key", _key())
    found = minhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id").distinct()
    named = rows.select("key", "doc_id").distinct().join(found, "key")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
    stays = store(first.select(F.col("first.key").alias("key")), "stays")
    kept = rows.join(stays, "key", "left_semi")
    one = kept.groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return one.select("row.*")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows = docs.select(*COLUMNS).withColumn("key", _key())
    held = leaks.find_leaks(rows.select(F.col("key").alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    held = store(held.select(F.col("doc_id").alias("key")).distinct(), "held")
    return rows.join(held, "key", "left_anti").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets replaced by a mark and n_chars counted anew."""
    clean = secrets.redact(docs.select(*COLUMNS))
    count = F.when(F.col("n_chars").isNotNull(), F.length("text").cast(T.LongType()))
    return clean.withColumn("n_chars", count).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document; decoding must give the text back, else it fails."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.round_trip(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    ids = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("decoding differs from the text")).cast("array<int>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secret_scans", secret_scans),
    ("token_ids", token_ids),
]

#: SQL can't express naive Bayes, the leak search or byte-level merges; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
