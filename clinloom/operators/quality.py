"""Data-quality checks. Each gives (check_name, table_name, n_violations)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.operators import intervals


def result(df: DataFrame, check: str, table: str, n: Column | None = None) -> DataFrame:
    """``n`` over ``df``, or its rows."""
    n = F.count(F.lit(1)) if n is None else n
    return df.agg(F.coalesce(n, F.lit(0)).cast("long").alias("n_violations")).select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "n_violations")


def primary_key(df: DataFrame, key: str, table: str) -> DataFrame:
    """Null keys plus rows beyond the first of a key."""
    return result(df, "primary_key", table, F.count_if(F.col(key).isNull()) + F.count(key) - F.count_distinct(key))


def foreign_key(df: DataFrame, parent: DataFrame, key: str, table: str) -> DataFrame:
    return result(df.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti"), "foreign_key", table)


def date_order(df: DataFrame, table: str) -> DataFrame:
    """Null starts and ends before their start."""
    return result(df.where("start_date is null or end_date < start_date"), "date_order", table)


def future_dates(df: DataFrame, as_of: str, table: str) -> DataFrame:
    return result(df.where(F.col("start_date") > F.lit(as_of).cast("date")), "future_date", table)


def outside_period(df: DataFrame, periods: DataFrame, table: str) -> DataFrame:
    """Events in no observation period of their person."""
    met = intervals.with_coverage(df.select("person_id", "start_date"), periods, ["person_id"])
    return result(met.where("candidates = 0"), "outside_period", table)


def concept_validity(df: DataFrame, concept: DataFrame, domain: str, table: str) -> DataFrame:
    """Concepts other than 0 that are unknown, not current and standard, or of another domain."""
    good = concept.where((F.col("standard_concept") == "S") & F.col("invalid_reason").isNull() & (F.col("domain_id") == domain)).select("concept_id")
    return result(df.where("concept_id <> 0").join(good, "concept_id", "left_anti"), "concept_validity", table)


def visit_links(linked: DataFrame, visits: DataFrame, table: str) -> DataFrame:
    """Links to a visit that is missing, another person's, or does not cover the date."""
    v = visits.select("visit_id", F.col("person_id").alias("_p"), F.col("start_date").alias("_s"), F.col("end_date").alias("_e"))
    both = linked.where("visit_id is not null").join(v, "visit_id", "left")
    fine = (F.col("person_id") == F.col("_p")) & F.col("start_date").between(F.col("_s"), F.col("_e"))
    return result(both.where(~F.coalesce(fine, F.lit(False))), "visit_link", table)


def linkage_decisions(events: DataFrame, decisions: DataFrame, table: str) -> DataFrame:
    """Events without a decision that agrees with their link."""
    d = decisions.select(F.col("event_id").alias("_e"), F.col("visit_id").alias("_v"), F.col("status").alias("_s"))
    agrees = (F.col("event_id") == F.col("_e")) & F.col("visit_id").eqNullSafe(F.col("_v")) & ((F.col("_s") == "LINKED") == F.col("visit_id").isNotNull())
    return result(events.join(d, agrees, "left_anti"), "linkage_decision", table)


def unrouted_targets(mapped: DataFrame, with_target: DataFrame, table: str) -> DataFrame:
    """Events left at concept 0 that have a standard target in some domain."""
    has = with_target.where("target_id is not null").select("event_id")
    return result(mapped.where("concept_id = 0").join(has, "event_id", "left_semi"), "unrouted_target", table)


def era_checks(eras: DataFrame, conditions: DataFrame, table: str) -> DataFrame:
    """Ranges turned round, eras without occurrences, and mapped events in no era of theirs."""
    keys = ["person_id", "concept_id"]
    met = intervals.with_coverage(conditions.where("concept_id <> 0").select(*keys, "start_date"), eras, keys)
    return (
        result(eras, "era_range", table, F.count_if(F.col("end_date") < F.col("start_date")))
        .unionByName(result(eras, "era_count", table, F.count_if(F.col("occurrences") < 1)))
        .unionByName(result(met.where("candidates = 0"), "era_coverage", table))
    )


def unit_outcomes(measurements: DataFrame, concept: DataFrame, table: str) -> DataFrame:
    """Units given without an outcome, outcomes without a unit, and unit concepts that are not current."""
    good = concept.where("domain_id = 'Unit' and standard_concept = 'S' and invalid_reason is null").select(F.col("concept_id").alias("unit_concept_id"))
    unclear = measurements.where(F.col("unit_code").isNull() != F.col("unit_concept_id").isNull())
    wrong = measurements.where("unit_concept_id <> 0").join(good, "unit_concept_id", "left_anti")
    return result(unclear, "unit_outcome", table).unionByName(result(wrong, "unit_concept", table))


def quarantined(quarantine: DataFrame, published: DataFrame, sources: DataFrame, table: str) -> DataFrame:
    """Quarantined events that are published all the same, and ones whose source is not on record."""
    return result(quarantine.join(published.select("event_id"), "event_id", "left_semi"), "quarantined_published", table).unionByName(
        result(quarantine.join(sources.select("event_id"), "event_id", "left_anti"), "quarantined_untraceable", table)
    )


def field_profile(df: DataFrame, fields: dict[str, float | None], table: str) -> DataFrame:
    """(table_name, field, completeness, n_high): the share of values present, and values above a plausible
    maximum, in one aggregation."""
    pairs = []
    for name, high in fields.items():
        n_high = F.count_if(F.col(name) > high) if high is not None else F.lit(0).cast("long")
        pairs.append(F.struct(F.lit(name).alias("field"), F.round(F.try_divide(F.count(name).cast("double"), F.count(F.lit(1))), 6).alias("completeness"), n_high.alias("n_high")))
    return df.agg(F.array(*pairs).alias("_all")).select(F.lit(table).alias("table_name"), F.explode("_all").alias("_one")).select("table_name", "_one.*")


def merge_shards(shards: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Check results of several runs (check_id, category, failed) as an overview by category, and the
    check_ids that more than one result has."""
    every = shards[0]
    for one in shards[1:]:
        every = every.unionByName(one)
    overview = every.groupBy("category").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("failed") == 1).alias("failed"))
    return overview, every.groupBy("check_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def policy_gate(checks: DataFrame, allowances: DataFrame) -> DataFrame:
    """Failed checks (check_id, failed, n_rows, pct) against reviewed allowances (check_id, reason, max_rows,
    max_pct): one row for each breach."""
    failed = checks.where("failed = 1").select("check_id", "n_rows", "pct", F.lit(True).alias("_failed"))
    allowed = allowances.select("check_id", "reason", "max_rows", "max_pct", F.lit(True).alias("_allowed"))
    breach = (
        F.when(F.col("_allowed").isNull(), "UNREVIEWED")
        .when(F.col("_failed").isNull(), "STALE_ALLOWANCE")
        .when(F.trim(F.coalesce("reason", F.lit(""))) == "", "NO_REASON")
        .when(F.col("max_rows").isNull() | F.col("max_pct").isNull(), "NO_CAPS")
        .when(F.col("n_rows").isNull() | F.col("pct").isNull(), "NO_METRICS")
        .when(F.col("n_rows") > F.col("max_rows"), "ROW_CAP")
        .when(F.col("pct") > F.col("max_pct"), "PERCENT_CAP")
    )
    return failed.join(allowed, "check_id", "full").withColumn("breach", breach).where("breach is not null").select("check_id", "breach")
