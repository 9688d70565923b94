"""Source codes to standard concepts, and routing by domain. ``stg`` has event_id, vocabulary_id, code and
event columns; ``concept`` and ``relationship`` are the vocabulary. Spark picks the join strategy from the
sizes it sees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The tables that procedure routing can fill, by target domain.
ROUTES = {"Procedure": "procedure_occurrence", "Measurement": "measurement", "Observation": "observation", "Device": "device_exposure"}


def with_targets(stg: DataFrame, concept: DataFrame, relationship: DataFrame, source_must_be_valid: bool) -> DataFrame:
    """A row for each current standard target of an event's code, with nulls where there is none:
    source_concept_id, target_id, target_domain, target_class."""
    source = concept.where("invalid_reason is null") if source_must_be_valid else concept
    source = source.select(F.col("vocabulary_id").alias("_v"), F.col("concept_code").alias("_c"), F.col("concept_id").alias("source_concept_id"))
    maps = relationship.where("relationship_id = 'Maps to' and invalid_reason is null").select(F.col("concept_id_1").alias("_1"), F.col("concept_id_2").alias("_2"))
    standard = concept.where("standard_concept = 'S' and invalid_reason is null").select(
        F.col("concept_id").alias("target_id"), F.col("domain_id").alias("target_domain"), F.col("concept_class_id").alias("target_class")
    )
    return (
        stg.join(source, (F.col("vocabulary_id") == F.col("_v")) & (F.col("code") == F.col("_c")), "left")
        .join(maps, F.col("source_concept_id") == F.col("_1"), "left")
        .join(standard, F.col("_2") == F.col("target_id"), "left")
        .drop("_v", "_c", "_1", "_2")
    )


def _first(df: DataFrame, *order) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy("event_id").orderBy(*order))).where("_n = 1").drop("_n")


def _prefer(domain: str):
    return F.when(F.col("target_domain") == domain, 0).otherwise(1)


def map_conditions(stg: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Condition targets or unmapped events; one row per event, the domain first, then the lowest concept."""
    found = with_targets(stg, concept, relationship, True).where("target_domain = 'Condition' or target_id is null")
    return (
        _first(found, _prefer("Condition"), F.col("target_id").asc_nulls_last())
        .withColumn("concept_id", F.coalesce("target_id", F.lit(0)))
        .withColumn("source_concept_id", F.coalesce("source_concept_id", F.lit(0)))
    )


def map_drugs(stg: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Every event once, with its highest target; a target outside the drug domain counts as unmapped."""
    found = _first(with_targets(stg, concept, relationship, True), F.col("target_id").desc_nulls_last())
    return found.withColumn("concept_id", F.when(F.col("target_domain") == "Drug", F.col("target_id")).otherwise(0)).withColumn(
        "source_concept_id", F.coalesce("source_concept_id", F.lit(0))
    )


def map_measurements(stg: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Measurement targets or unmapped events, with unit and coded value: absent is null, present but
    unknown is 0."""
    found = with_targets(stg, concept, relationship, False).where("target_domain = 'Measurement' or target_id is null")
    one = _first(found, _prefer("Measurement"), F.col("target_id").asc_nulls_last())
    unit = concept.where("vocabulary_id = 'UCUM' and standard_concept = 'S' and invalid_reason is null").select(
        F.col("concept_code").alias("_unit"), F.col("concept_id").alias("_unit_id")
    )
    coded = concept.where("vocabulary_id = 'PART'").select(F.col("concept_code").alias("_code"), F.col("concept_id").alias("value_source_concept_id"))
    maps = relationship.where("relationship_id = 'Maps to' and invalid_reason is null").groupBy(F.col("concept_id_1").alias("_1")).agg(F.min("concept_id_2").alias("_value_id"))
    joined = (
        one.join(unit, F.col("unit_code") == F.col("_unit"), "left")
        .join(coded, F.col("value_code") == F.col("_code"), "left")
        .join(maps, F.col("value_source_concept_id") == F.col("_1"), "left")
    )
    return joined.select(
        *stg.columns,
        F.coalesce("target_id", F.lit(0)).alias("concept_id"),
        F.coalesce("source_concept_id", F.lit(0)).alias("source_concept_id"),
        F.when(F.col("unit_code").isNotNull(), F.coalesce("_unit_id", F.lit(0))).alias("unit_concept_id"),
        F.when(F.col("value_code").isNotNull(), F.coalesce("_value_id", F.lit(0))).alias("value_as_concept_id"),
    )


def map_observations(stg: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Observation targets, and unmapped Observation resources with neither number nor coded value."""
    found = with_targets(stg, concept, relationship, False)
    bare = (F.col("resource_type") == "Observation") & F.col("value").isNull() & F.col("value_code").isNull()
    found = found.where((F.col("target_domain") == "Observation") | (F.col("target_id").isNull() & bare))
    return _first(found, _prefer("Observation"), F.col("target_id").asc_nulls_last()).withColumn("concept_id", F.coalesce("target_id", F.lit(0)))


def route_procedures(stg: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """One mapping pass over procedures, each row with the table of its target's domain; unmapped events stay
    procedures, other domains are left to the quarantine."""
    found = with_targets(stg, concept, relationship, False)
    table = F.coalesce(*[F.when(F.col("target_domain") == d, t) for d, t in ROUTES.items()], F.when(F.col("target_id").isNull(), "procedure_occurrence"))
    return found.withColumn("target_table", table).where("target_table is not null").withColumn("concept_id", F.coalesce("target_id", F.lit(0)))


def ambiguous_targets(stg: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Events with more than one distinct standard target, and how many."""
    found = with_targets(stg, concept, relationship, False).where("target_id is not null")
    return found.groupBy("event_id").agg(F.count_distinct("target_id").alias("n_targets")).where("n_targets > 1")


def unsupported_routes(stg: DataFrame, concept: DataFrame, relationship: DataFrame, supported: tuple[str, ...]) -> DataFrame:
    """One row per resource type and event whose target lies in none of the supported domains: the lowest
    such target."""
    found = with_targets(stg, concept, relationship, False).where(F.col("target_id").isNotNull() & ~F.col("target_domain").isin(*supported))
    place = Window.partitionBy("resource_type", "event_id").orderBy("target_id")
    return found.withColumn("_n", F.row_number().over(place)).where("_n = 1").select("resource_type", "event_id", "target_id", "target_domain")


def unit_mismatch(stg: DataFrame, rules: DataFrame) -> DataFrame:
    """Events whose unit differs, nulls counting as a value, from the one that ``rules`` (code, unit, and vocabulary_id if
    they have it) asks of their code."""
    rule = rules.select(F.col("code").alias("_c"), F.col("unit").alias("expected_unit"), *[F.col(c).alias("_v") for c in rules.columns if c == "vocabulary_id"])
    same = F.col("code") == F.col("_c")
    if "_v" in rule.columns:
        same = same & (F.col("vocabulary_id") == F.col("_v"))
    return stg.join(rule, same).drop("_v").where(~F.col("unit_code").eqNullSafe(F.col("expected_unit"))).drop("_c")


def routing_collisions(target: DataFrame, routed: DataFrame, provenance: DataFrame) -> DataFrame:
    """Ids of ``routed`` that ``target`` already has from somewhere else than routing."""
    return routed.select("event_id").distinct().join(target.select("event_id"), "event_id", "left_semi").join(provenance.select("event_id"), "event_id", "left_anti")


def source_codings(stg: DataFrame, published: DataFrame) -> DataFrame:
    """The coding sidecar of published events."""
    return stg.select("event_id", "vocabulary_id", "code").join(published.select("event_id"), "event_id", "left_semi")


def provenance(events: DataFrame, codings: DataFrame, run_id: str) -> DataFrame:
    """A deterministic provenance row for each mapped event with a coding."""
    mapped = events.where("concept_id <> 0").select("event_id", "concept_id")
    return mapped.join(codings, "event_id").select("event_id", "concept_id", "vocabulary_id", "code", F.lit("VOCABULARY").alias("mapping_method"), F.lit(run_id).alias("run_id"))


def apply_approved(events: DataFrame, by_term: DataFrame, by_event: DataFrame, concept: DataFrame, domain: str) -> DataFrame:
    """``events`` with approved concepts where none was found: an approval of the event (event_id, approved)
    beats one of its term (vocabulary_id, code, approved), then the lowest id wins; only current standard
    concepts of the domain count. Two equi joins stand for the alternative conditions."""
    current = concept.where((F.col("standard_concept") == "S") & F.col("invalid_reason").isNull() & (F.col("domain_id") == domain)).select(F.col("concept_id").alias("approved"))
    one = lambda df, *keys: df.join(current, "approved", "left_semi").groupBy(*keys).agg(F.min("approved").alias("_approved"))
    event = one(by_event, "event_id").withColumnRenamed("_approved", "_by_event")
    term = one(by_term, "vocabulary_id", "code").withColumnRenamed("_approved", "_by_term")
    joined = events.join(event, "event_id", "left").join(term, ["vocabulary_id", "code"], "left")
    found = F.when(F.col("concept_id") == 0, F.coalesce("_by_event", "_by_term", F.lit(0))).otherwise(F.col("concept_id"))
    return joined.withColumn("concept_id", found).select(*events.columns)
