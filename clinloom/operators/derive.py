"""Eras, observation periods and cohort figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.functions.ids import hash_id
from clinloom.operators import intervals


def _eras(df: DataFrame, keys: list[str], gap_days: int) -> DataFrame:
    """(keys, start_date, end_date, n, gap_days) of eras of rows (start_date, end_date): a start more than ``gap_days`` after all
    ends before it, in its keys, begins another; gap_days counts the days of an era that no row covers.

    States that merge, so that a person with much of the rows is not one task: rows of one day are one, with the
    greatest end, before any shuffle; days become the unbroken stretches of their year; the stretches of a key, of which
    every one but the last is followed by a day that its year leaves open (183 a year at most), become eras."""
    days = df.groupBy(*keys, "start_date").agg(F.max("end_date").alias("end_date"), F.count(F.lit(1)).alias("n"))

    def merged(rows: DataFrame, part: list[str], apart: int, *more: Column) -> DataFrame:
        order = Window.partitionBy(*part).orderBy("start_date")
        rows = rows.withColumn("_reach", F.max("end_date").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        begins = F.when(F.col("start_date") > F.date_add("_reach", apart), 1).otherwise(0)
        between = F.when(begins == 0, F.greatest(F.datediff("start_date", "_reach") - 1, F.lit(0)))
        rows = rows.withColumns({"_era": F.sum(begins).over(order.rowsBetween(Window.unboundedPreceding, 0)), "_between": F.coalesce(between, F.lit(0))})
        return rows.groupBy(*part, "_era").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"), F.sum("n").alias("n"), *more)

    stretches = merged(days.withColumn("_year", F.year("start_date")), [*keys, "_year"], min(gap_days, 1))
    return merged(stretches.drop("_era"), keys, gap_days, F.sum("_between").alias("gap_days")).drop("_era")


def _lifted(end: Column) -> Column:
    """An end before the start is lifted to the start."""
    return F.greatest("start_date", F.coalesce(end, F.col("start_date")))


def condition_era(events: DataFrame, gap_days: int = 30) -> DataFrame:
    """Eras of mapped events by person and concept."""
    rows = events.where("concept_id <> 0").select("event_id", "person_id", "concept_id", "start_date", _lifted(F.col("end_date")).alias("end_date"))
    keys = ["person_id", "concept_id"]
    eras = _eras(rows, keys, gap_days).withColumnRenamed("n", "occurrences")
    return eras.select(hash_id(F.concat_ws("|", F.lit("condition"), *keys, "start_date")).alias("era_id"), *keys, "start_date", "end_date", "occurrences")


#: What a current standard ingredient is, by column.
_INGREDIENT = {"domain_id": "= 'Drug'", "concept_class_id": "= 'Ingredient'", "standard_concept": "= 'S'", "invalid_reason": "is null"}


def ingredient_exposures(exposures: DataFrame, ancestor: DataFrame, concept: DataFrame) -> DataFrame:
    """A row for each exposure and each of its current standard ingredients. A ``concept`` without the columns of domain,
    standard or validity is taken to hold current standard drugs alone."""
    ingredient = concept.where(" and ".join(f"{c} {rule}" for c, rule in _INGREDIENT.items() if c in concept.columns or c == "concept_class_id")).select(F.col("concept_id").alias("ancestor_id"))
    above = ancestor.join(ingredient, "ancestor_id", "left_semi").select("ancestor_id", F.col("descendant_id").alias("concept_id")).distinct()
    return exposures.where("concept_id <> 0").join(above, "concept_id")


def drug_era(exposures: DataFrame, ancestor: DataFrame, concept: DataFrame, gap_days: int = 30) -> DataFrame:
    """Eras by person and ingredient; gap_days counts the days strictly between exposures within an era."""
    rows = ingredient_exposures(exposures, ancestor, concept).select("event_id", "person_id", F.col("ancestor_id").alias("ingredient_id"), "start_date", _lifted(F.col("end_date")).alias("end_date"))
    keys = ["person_id", "ingredient_id"]
    out = _eras(rows, keys, gap_days).withColumnRenamed("n", "exposures")
    return out.select(hash_id(F.concat_ws("|", F.lit("drug"), *keys, "start_date")).alias("era_id"), *keys, "start_date", "end_date", "exposures", "gap_days")


def _gates(eras: DataFrame, bad_range: Column, *counted: tuple[str, DataFrame]) -> DataFrame:
    """(check_name, n): eras of a bad range, doubled ids, and the rows of each further check."""
    row = lambda df, name, n: df.agg(n.cast("long").alias("n")).select(F.lit(name).alias("check_name"), "n")
    out = row(eras, "invalid_range", F.count_if(bad_range)).unionByName(row(eras, "duplicate_id", F.count("era_id") - F.count_distinct("era_id")))
    for name, df in counted:
        out = out.unionByName(row(df, name, F.count(F.lit(1))))
    return out


def _uncovered(rows: DataFrame, eras: DataFrame, concept: str) -> DataFrame:
    """``rows`` that lie whole in no era of their person and concept."""
    return intervals.inside_none(rows, eras, ["person_id", concept])


_BAD_RANGE = "start_date is null or end_date is null or end_date < start_date"


def era_violations(conditions: DataFrame, eras: DataFrame) -> DataFrame:
    """(check_name, n): era ranges, doubled ids, and mapped events that no era covers."""
    rows = conditions.where("concept_id <> 0").withColumn("end_date", _lifted(F.col("end_date")))
    return _gates(eras, F.expr(_BAD_RANGE), ("uncovered_event", _uncovered(rows, eras, "concept_id")))


def drug_era_violations(exposures: DataFrame, eras: DataFrame, ancestor: DataFrame, concept: DataFrame) -> DataFrame:
    """(check_name, n): era ranges and gaps, doubled ids, mapped exposures without any ingredient, and pairs of
    exposure and ingredient that no era covers."""
    pairs = ingredient_exposures(exposures, ancestor, concept).withColumnRenamed("ancestor_id", "ingredient_id").withColumn("end_date", _lifted(F.col("end_date")))
    bare = hierarchy_violations(exposures, ancestor, concept)
    return _gates(eras, F.expr(f"{_BAD_RANGE} or gap_days < 0"), ("no_ingredient", bare), ("uncovered_pair", _uncovered(pairs, eras, "ingredient_id")))


def observation_period(visits: DataFrame, events: list[DataFrame]) -> DataFrame:
    """One period a person: the bounds of visits and events together, and which of them there were."""
    bounds = visits.groupBy("person_id").agg(F.min("start_date").alias("v_start"), F.max("end_date").alias("v_end"))
    every = None
    for one in events:
        rows = one.select("person_id", "start_date", F.coalesce("end_date", "start_date").alias("end_date"))
        every = rows if every is None else every.unionByName(rows)
    envelope = every.groupBy("person_id").agg(F.min("start_date").alias("e_start"), F.max("end_date").alias("e_end"))
    method = F.when(F.col("e_start").isNull(), "FHIR_ENCOUNTER_COVERAGE").when(F.col("v_start").isNull(), "CLINICAL_EVENT_ENVELOPE").otherwise("ENCOUNTER_PLUS_EVENT_ENVELOPE")
    return bounds.join(envelope, "person_id", "full").select(
        "person_id", F.least("v_start", "e_start").alias("start_date"), F.greatest("v_end", "e_end").alias("end_date"), method.alias("method")
    )


def average_observation_years(periods: DataFrame) -> DataFrame:
    days = periods.groupBy("person_id").agg(F.sum(F.datediff("end_date", "start_date") + 1).alias("days"))
    return days.agg(F.round(F.avg("days") / 365.25, 6).alias("mean_years"))


def top_concepts(events: DataFrame, concept: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent mapped concepts; ties by id."""
    n = events.where("concept_id <> 0").groupBy("concept_id").agg(F.count(F.lit(1)).alias("n"))
    return n.join(concept.select("concept_id", "concept_name"), "concept_id").orderBy(F.desc("n"), "concept_id").limit(k)


def expand(df: DataFrame, ancestor: DataFrame, of: int) -> DataFrame:
    """Rows of ``df`` whose concept lies at or below a concept."""
    return df.join(ancestor.where(F.col("ancestor_id") == of).select(F.col("descendant_id").alias("concept_id")), "concept_id", "left_semi")


def phenotype_counts(events: DataFrame, ancestor: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct persons with a concept below each of ``groups`` (group_id)."""
    below = ancestor.join(groups.select(F.col("group_id").alias("ancestor_id")), "ancestor_id").select(F.col("ancestor_id").alias("group_id"), F.col("descendant_id").alias("concept_id")).distinct()
    return events.join(below, "concept_id").groupBy("group_id").agg(F.count_distinct("person_id").alias("persons"))


def cascade(conditions: DataFrame, drugs: DataFrame, ancestor: DataFrame, condition: int, ingredients: list[int]) -> DataFrame:
    """Persons with a condition group, those of them with any of the ingredients, and the share."""
    having = expand(conditions, ancestor, condition).select("person_id").distinct()
    treated = drugs.join(ancestor.where(F.col("ancestor_id").isin(ingredients)).select(F.col("descendant_id").alias("concept_id")), "concept_id", "left_semi").select("person_id").distinct().withColumn("_treated", F.lit(True))
    both = having.join(treated, "person_id", "left")
    return both.agg(F.count(F.lit(1)).alias("persons"), F.count_if(F.col("_treated").isNotNull()).alias("treated")).withColumn("share", F.round(F.try_divide(F.col("treated").cast("double"), F.col("persons")), 6))


def hierarchy_violations(exposures: DataFrame, ancestor: DataFrame, concept: DataFrame) -> DataFrame:
    """Mapped exposures without any ingredient, which no drug era can hold."""
    held = ingredient_exposures(exposures, ancestor, concept).select("event_id")
    return exposures.where("concept_id <> 0").join(held, "event_id", "left_anti")
