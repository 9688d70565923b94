"""The whole batch: files of bundles and a vocabulary release to one published set of tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.functions.ids import event_id, person_id
from clinloom.operators import derive, extract, linkage, standardise
from clinloom.session import discard, store
from clinloom.sources import bundles, files, tables

#: The tables that hold events.
EVENTS = ("condition_occurrence", "drug_exposure", "measurement", "observation", "procedure_occurrence", "device_exposure")

#: The types of resources that a table is made of, where these are few.
KINDS = {"person": ("Patient",), "condition_occurrence": ("Encounter", "Condition"), "condition_era": ("Condition",)}
DOMAINS = dict(zip(EVENTS, ("Condition", "Drug", "Measurement", "Observation", "Procedure", "Device"), strict=True))
# Codes whose results mean something else in another unit, (vocabulary, code, unit).
UNIT_RULES = (("LOINC", "788-0", "%"),)


@dataclass(frozen=True)
class Approved:
    """Approved mappings: ``by_term`` (vocabulary_id, code, approved) and ``by_event`` (event_id, approved)."""

    by_term: DataFrame
    by_event: DataFrame


def _one_each(df: DataFrame, key: str) -> DataFrame:
    """One row a key, the least by its other columns: copies of a resource in several bundles count once."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, "_r.*")


def _visit(ref: Column, key: bytes) -> Column:
    return F.when(ref.isNotNull(), event_id(ref, key))


def _staged(df: DataFrame, key: bytes) -> DataFrame:
    """Extracted events with ids: a component's is that of its resource and its path."""
    url = F.col("full_url")
    if "path" in df.columns:
        url = F.when(F.col("path") == "", url).otherwise(F.concat_ws("::", url, "path"))
    known = df.withColumns({"event_id": event_id(url, key), "person_id": person_id(F.col("person_ref"), key), "encounter_ref": _visit(F.col("encounter_ref"), key)})
    return _one_each(known.drop("full_url", "person_ref"), "event_id")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def cdm_tables(
    entries: DataFrame,
    concept: DataFrame,
    relationship: DataFrame,
    ancestor: DataFrame,
    key: bytes,
    keep: Callable[[str, DataFrame], DataFrame] = lambda _, df: df,
    approved: Approved | None = None,
    unit_rules: Sequence[tuple[str, str, str]] = UNIT_RULES,
    run_id: str = "flow",
    until: str | None = None,
) -> dict[str, DataFrame]:
    """Every table of ``tables.CDM`` from ``entries``, and beside them the visit links, the quarantines of routes and of units,
    the ambiguous events, the bundles' violations and the provenance of mapped events. ``keep`` gets
    each table as it is made and gives what later steps read, such as its written form. Persons without a year of birth are
    left out. Observations and procedures go where their targets' domains send them. Measurements whose unit breaks one of
    ``unit_rules`` are held back; events that the vocabulary leaves at 0 take an ``approved`` mapping of their domain. No more is
    made than ``until``, the name of a table, needs: for conditions and their eras no other events are read, and eras need no visits."""
    made = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        made[name] = keep(name, tables.conform(df, name) if name in tables.CDM else df)
        return made[name]

    e = extract.with_references(entries)
    if until in KINDS:
        e = e.where(F.col("resource_type").isin(*KINDS[until]))
    e = keep("staged_entries", e)
    persons = extract.extract_persons(e).where("year_of_birth > 0").withColumn("person_id", person_id(F.col("person_ref"), key))
    add("person", _one_each(persons.drop("person_ref"), "person_id"))
    if until == "person":
        return made
    stage = lambda name, df: keep(f"staged_{name}", _staged(df, key))
    conditions = stage("conditions", extract.extract_conditions(e))
    mapped_conditions = lambda: standardise.map_conditions(conditions, concept, relationship)

    def coded(name: str, parts: list[DataFrame]) -> DataFrame:
        rows = _union(parts).withColumn("_vocabulary_concept", F.col("concept_id"))
        if approved is not None:
            rows = standardise.apply_approved(rows, approved.by_term, approved.by_event, concept, DOMAINS[name])
        return keep(f"staged_{name}", rows)

    if until == "condition_era":
        add(until, derive.condition_era(coded("condition_occurrence", [mapped_conditions()])))
        return made
    visits = extract.extract_visits(e).withColumns({"visit_id": event_id(F.col("visit_ref"), key), "person_id": person_id(F.col("person_ref"), key)})
    visits = add("visit_occurrence", _one_each(visits.drop("visit_ref", "person_ref"), "visit_id"))

    linkable = ("event_id", "person_id", "start_date", "encounter_ref")
    if until == "condition_occurrence":
        rows, links = coded(until, [mapped_conditions()]), linkage.link_visits(conditions.select(*linkable), visits)
        add(until, rows.join(links.select("event_id", "visit_id"), "event_id", "left"))
        return made
    drugs = stage("drugs", extract.extract_drugs(e))
    measures, procedures = stage("measurements", extract.extract_measurements(e)), stage("procedures", extract.extract_procedures(e))
    rules = entries.sparkSession.createDataFrame(list(unit_rules), "vocabulary_id string, code string, unit string")
    bad_units = standardise.unit_mismatch(measures, rules)
    held = add("unit_quarantine", bad_units.select("event_id", "vocabulary_id", "code", "unit_code", "expected_unit"))
    publishable = measures.join(held.select("event_id"), "event_id", "left_anti")
    said = lambda kind: F.when(F.col("value_kind") == kind, F.col("value_text"))
    candidates = stage("candidates", extract.extract_observation_candidates(e)).withColumns({"value": said("quantity"), "value_code": said("coded")})

    routed = standardise.route_procedures(procedures, concept, relationship).groupBy("event_id", "target_table").agg(F.min("concept_id").alias("concept_id"))
    routed = routed.join(procedures, "event_id")
    columns = ("event_id", "person_id", "concept_id", "start_date", "vocabulary_id", "code")
    sent = lambda table: routed.where(F.col("target_table") == table).select(*columns)
    found = {
        "condition_occurrence": lambda: [mapped_conditions()],
        "drug_exposure": lambda: [standardise.map_drugs(drugs, concept, relationship)],
        "measurement": lambda: [standardise.map_measurements(publishable, concept, relationship), sent("measurement")],
        "observation": lambda: [standardise.map_observations(candidates, concept, relationship), sent("observation")],
        "procedure_occurrence": lambda: [sent("procedure_occurrence")],
        "device_exposure": lambda: [sent("device_exposure")],
    }
    staged = [df.select(*linkable) for df in (conditions, drugs, measures, procedures, candidates)]
    decisions = keep("event_visit_linkage", linkage.link_visits(_one_each(_union(staged), "event_id"), visits))
    made["event_visit_linkage"] = decisions
    links = decisions.select("event_id", "visit_id")
    events, provenance = {}, []
    for name, parts in found.items():
        rows = coded(name, parts())
        events[name] = add(name, rows.join(links, "event_id", "left"))
        if name == "condition_occurrence":
            add("condition_era", derive.condition_era(events[name]))
        if until in made:
            return made
        method = F.when(F.col("_vocabulary_concept") == 0, "APPROVED").otherwise("VOCABULARY")
        mapped = rows.where("concept_id <> 0").select("event_id", "concept_id", "vocabulary_id", "code", method.alias("mapping_method"))
        provenance.append(mapped.select(F.lit(name).alias("target_table"), "*", F.lit(run_id).alias("run_id")))
    add("mapping_provenance", _union(provenance))

    add("observation_period", derive.observation_period(visits, [_dated(df) for df in events.values()]))
    add("drug_era", derive.drug_era(events["drug_exposure"], ancestor, concept))

    kinds = candidates.select("event_id", "resource_type", "vocabulary_id", "code").unionByName(procedures.select("event_id", F.lit("Procedure").alias("resource_type"), "vocabulary_id", "code"))
    domains = {"Observation": ("Measurement", "Observation"), "Condition": ("Condition", "Observation"), "Procedure": tuple(standardise.ROUTES)}
    lost = [standardise.unsupported_routes(kinds.where(F.col("resource_type") == kind), concept, relationship, ok) for kind, ok in domains.items()]
    add("quarantine", _union(lost).select("resource_type", "event_id", "target_id", "target_domain"))
    # the tables whose events must not have several targets
    several = {"measurement": publishable, "observation": candidates.where("resource_type = 'Observation'"), "procedure_occurrence": procedures}
    many = [standardise.ambiguous_targets(df, concept, relationship).select(F.lit(name).alias("table_name"), "*") for name, df in several.items()]
    add("ambiguous_targets", _union(many))
    add("bundle_violations", extract.bundle_violations(entries))
    return made


def _dated(events: DataFrame) -> DataFrame:
    end = F.coalesce("end_date", "start_date") if "end_date" in events.columns else F.col("start_date")
    return events.select("person_id", "start_date", end.alias("end_date"))


def release_violations(made: dict[str, DataFrame], ancestor: DataFrame, concept: DataFrame, strict: bool = False) -> DataFrame:
    """(table_name, violation, n) of a set of tables: schemas and keys, persons that are not there, eras, events with several
    targets where they need a review first; and if ``strict``, the bundles' violations."""
    out = [tables.schema_violations(made[name], name).select("table_name", F.concat_ws(" ", "field", "violation").alias("violation"), "n") for name in tables.CDM]
    person = made["person"].select("person_id")
    for name in ("visit_occurrence", *EVENTS):
        lost = made[name].join(person, "person_id", "left_anti").agg(F.count(F.lit(1)).alias("n"))
        out.append(lost.select(F.lit(name).alias("table_name"), F.lit("NO_PERSON").alias("violation"), "n"))
    gates = {
        "condition_era": derive.era_violations(made["condition_occurrence"], made["condition_era"]),
        "drug_era": derive.drug_era_violations(made["drug_exposure"], made["drug_era"], ancestor, concept),
    }
    out += [df.select(F.lit(name).alias("table_name"), F.col("check_name").alias("violation"), "n") for name, df in gates.items()]
    out.append(made["ambiguous_targets"].groupBy("table_name").agg(F.count(F.lit(1)).alias("n")).select("table_name", F.lit("AMBIGUOUS_TARGETS").alias("violation"), "n"))
    if strict:
        out.append(made["bundle_violations"].groupBy("violation").agg(F.count(F.lit(1)).alias("n")).select(F.lit("bundles").alias("table_name"), "violation", "n"))
    return _union(out).where("n > 0")


def build_cdm(
    spark: SparkSession,
    bundle_path: str,
    vocabulary_path: str,
    out: str,
    key: bytes,
    approved: Approved | None = None,
    unit_rules: Sequence[tuple[str, str, str]] = UNIT_RULES,
    strict: bool = False,
) -> str:
    """Reads the bundles and the vocabulary release, writes every table as one new version below ``out``, checks what was
    written, and points readers to it; ``tables.read_published(spark, out, name)`` reads a table. A version that fails is
    deleted and the one before stays, and ``strict`` fails on the bundles' own violations too. Bundles are parsed once, and each table is computed from written ones."""
    vocabulary = files.read_vocabularies(spark, vocabulary_path)
    concept, relationship = vocabulary["concept"], vocabulary["concept_relationship"]
    ancestor = vocabulary["concept_ancestor"].withColumnsRenamed({"ancestor_concept_id": "ancestor_id", "descendant_concept_id": "descendant_id"})
    version, staged = tables.new_version(out), []

    def staged_as(name: str, df: DataFrame) -> DataFrame:
        staged.append(store(df, name))
        return staged[-1]

    def keep(name: str, df: DataFrame) -> DataFrame:
        if name.startswith("staged_"):
            return staged_as(name, df)
        df.write.parquet(f"{version}/{name}")
        return spark.read.parquet(f"{version}/{name}")

    try:
        entries = staged_as("entries", bundles.linked_entries(bundles.read_json(spark, bundle_path)))
        made = cdm_tables(entries, concept, relationship, ancestor, key, keep, approved, unit_rules, version.rsplit("-", 1)[1])
        tables.require_clean(spark, version, release_violations(made, ancestor, concept, strict))
        tables.point(spark, out, version)
    except BaseException:
        tables.drop(spark, version)
        raise
    finally:
        # what was staged holds patients' data; it goes whether the version stands or not
        for table in staged:
            discard(table)
    return version
