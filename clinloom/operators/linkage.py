"""Linking events to visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.operators import intervals


def link_visits(events: DataFrame, visits: DataFrame) -> DataFrame:
    """``events`` (event_id, person_id, start_date, encounter_ref) with visit_id, link_method, status,
    reason and candidates. An explicit reference counts only if its visit has the same person and covers the
    date, and a bad one never falls back on time; without a reference a single covering visit links.
    Covering visits are counted by cells of person and month (``intervals``); no pair of event and visit is made."""
    e = events.select("event_id", "person_id", "start_date", "encounter_ref")
    v = visits.select("visit_id", F.col("person_id").alias("v_person"), F.col("start_date").alias("v_start"), F.col("end_date").alias("v_end"))
    covers = (F.col("start_date") >= F.col("v_start")) & (F.col("start_date") <= F.col("v_end"))
    named = e.where("encounter_ref is not null").join(v, F.col("encounter_ref") == F.col("visit_id"), "left")
    reason = (
        F.when(F.col("visit_id").isNull(), "REFERENCE_NOT_FOUND")
        .when(F.col("v_person") != F.col("person_id"), "REFERENCE_OTHER_PERSON")
        .when(~covers, "REFERENCE_OUTSIDE_DATE")
    )
    named = named.select(
        "event_id",
        F.when(reason.isNull(), F.col("visit_id")).alias("visit_id"),
        F.lit("REFERENCE").alias("link_method"),
        reason.alias("reason"),
        F.when(reason.isNull(), 1).otherwise(0).cast("long").alias("candidates"),
    )
    free = e.where("encounter_ref is null")
    timed = intervals.with_coverage(free, visits, ["person_id"], id="visit_id").select(
        "event_id",
        F.col("only").alias("visit_id"),
        F.lit("TEMPORAL").alias("link_method"),
        F.when(F.col("candidates") == 0, "NO_COVERING_VISIT").when(F.col("candidates") > 1, "AMBIGUOUS").alias("reason"),
        F.col("candidates").cast("long").alias("candidates"),
    )
    both = named.unionByName(timed)
    return both.withColumn("status", F.when(F.col("reason").isNull(), "LINKED").otherwise("QUARANTINED"))


def linkage_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("link_method", "status", "reason").agg(F.count(F.lit(1)).alias("n"))


def linkage_quarantine(decisions: DataFrame, current: DataFrame) -> DataFrame:
    """The next quarantine (event_id, reason, active): entries of events decided now are closed first, then
    each event that stays quarantined is open with its reason of now."""
    old = current.select("event_id", F.col("reason").alias("old_reason"))
    new = decisions.where("status = 'QUARANTINED'").select("event_id", F.col("reason").alias("new_reason"))
    return old.join(new, "event_id", "full").select("event_id", F.coalesce("new_reason", "old_reason").alias("reason"), F.col("new_reason").isNotNull().alias("active"))
