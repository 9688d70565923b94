"""Unmapped terms, the events behind them, and the searchable slice of the vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unmapped_terms(events: DataFrame) -> DataFrame:
    """Distinct (vocabulary_id, code) of events without a concept, with the term's matching key."""
    return events.where("concept_id = 0").select("vocabulary_id", "code", F.lower(F.trim("code")).alias("term_key")).distinct()


def affected_events(terms: DataFrame, events: DataFrame) -> DataFrame:
    """Unmapped events of each term, scoped by vocabulary where the term has one."""
    t = terms.select(F.col("vocabulary_id").alias("_v"), F.col("code").alias("_c"))
    same = (F.col("code") == F.col("_c")) & (F.col("_v").isNull() | F.col("_v").eqNullSafe(F.col("vocabulary_id")))
    return events.where("concept_id = 0").join(t, same, "left_semi").select("event_id", "vocabulary_id", "code")


def reconcile(proposals: DataFrame, events: DataFrame) -> DataFrame:
    """Open proposals (proposal_id, event_id, status) whose event has been mapped since are retired."""
    mapped = events.where("concept_id <> 0").select("event_id", F.lit(True).alias("_mapped")).distinct()
    retire = F.col("_mapped").isNotNull() & F.col("status").isin("PENDING", "LOW_CONFIDENCE")
    return proposals.join(mapped, "event_id", "left").withColumn("status", F.when(retire, "RETIRED").otherwise(F.col("status"))).drop("_mapped")


def concept_slice(concept: DataFrame, domain: str) -> DataFrame:
    """Current standard concepts of a domain."""
    return concept.where((F.col("standard_concept") == "S") & (F.coalesce(F.col("invalid_reason"), F.lit("")) == "") & (F.col("domain_id") == domain))


def slice_fingerprint(part: DataFrame) -> DataFrame:
    """One row that tells slices apart: count, least and greatest id, and the XOR of all rows' hashes."""
    return part.agg(
        F.count(F.lit(1)).alias("n"), F.min("concept_id").alias("low"), F.max("concept_id").alias("high"), F.bit_xor(F.xxhash64("concept_id", "concept_name", "concept_code")).alias("print")
    )
