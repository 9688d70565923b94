"""What is read once and what is not read at all, for extraction in one pass and the flow's condition tables."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import functions as F

from clinloom import flow
from clinloom.functions.dates import fhir_datetime
from clinloom.operators import extract
from clinloom.plans import fhir, registry
from clinloom.plans.binding import Clinic
from clinloom.sources import bundles
from tests.test_round3 import DATA, plan


def test_candidates_parse_their_bundles_once(spark):
    text = plan(registry.queries()["b15"](spark, DATA), "optimizedPlan")
    assert text.count("Relation [bundle_id") == 1


def test_candidates_of_both_types(spark):
    """Components are an observation's alone, states are judged by type, and each type has its own dates and systems."""
    code = lambda *systems: {"coding": [{"system": s, "code": f"{s[-3:]}"} for s in systems]}
    loinc, snomed = "http://loinc.org", "http://snomed.info/sct"
    part = {"code": code(loinc), "valueString": "x"}
    made = {
        "o1": {"resourceType": "Observation", "status": "final", "code": code(snomed, loinc), "effectiveDateTime": "2024-01-02", "onsetDateTime": "2020-01-01", "valueBoolean": True, "component": [part, part]},
        "o2": {"resourceType": "Observation", "status": "entered-in-error", "code": code(loinc), "effectiveDateTime": "2024-01-02"},
        "c1": {"resourceType": "Condition", "status": "entered-in-error", "code": code(loinc, snomed), "onsetPeriod": {"start": "2024-03-01"}, "abatementDateTime": "2024-03-09", "valueString": "x", "component": [part]},
        "c2": {"resourceType": "Condition", "verificationStatus": {"coding": [{"code": " Refuted "}]}, "code": code(snomed), "onsetDateTime": "2024-03-01"},
        "c3": {"resourceType": "Condition", "code": code(snomed), "effectiveDateTime": "2024-03-01"},
    }
    rows = [(1, k, r["resourceType"], k, json.dumps(r | {"subject": {"reference": "Patient/" + k}})) for k, r in made.items()]
    entries = spark.createDataFrame(rows, "bundle_id int, full_url string, resource_type string, id string, resource string")
    got = extract.extract_observation_candidates(entries).select("full_url", "path", "resource_type", "person_ref", "vocabulary_id", F.col("start_date").cast("string"), F.col("end_date").cast("string"), "value_kind", "value_text")
    day = "2024-01-02"
    assert sorted(map(tuple, got.collect())) == [
        ("c1", "", "Condition", "Patient/c1", "SNOMED", "2024-03-01", "2024-03-09", None, None),
        ("o1", "", "Observation", "Patient/o1", "LOINC", day, day, "boolean", "true"),
        ("o1", "component[0]", "Observation", "Patient/o1", "LOINC", day, day, "string", "x"),
        ("o1", "component[1]", "Observation", "Patient/o1", "LOINC", day, day, "string", "x"),
    ]


def test_days_at_the_edge_of_the_pattern(spark):
    said = ["2024-02-29", " 2024-02-29 ", "2024-02-31", "0001-01-01", "2024-02", "2024-01-02T10:00:00+99:99", "2024-01-02T23:30:00-02:00", "2024-01-02T10:00", None]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(said)], "i int, x string").select("i", fhir_datetime(F.col("x")).alias("d")).orderBy("i").collect()
    day = datetime.date
    want = [day(2024, 2, 29), day(2024, 2, 29), None, day(1, 1, 1), None, None, day(2024, 1, 2), day(2024, 1, 2), None]
    assert [r.d and r.d.date for r in got] == want
    assert got[6].d.ts == datetime.datetime(2024, 1, 3, 1, 30) and got[0].d.ts == datetime.datetime(2024, 2, 29)


def test_entries_of_some_types_are_linked_as_all_are(spark):
    made = fhir.bundles(Clinic(spark, DATA)).limit(40)
    kinds = ("Encounter", "Condition")
    rows = lambda df: sorted((r.bundle_id, r.pos, r.full_url, r.id, r.subject_url, r.encounter_url, r.text) for r in df.withColumn("text", F.to_json("resource")).drop("resource", "medication_code").collect())
    some = rows(bundles.linked_entries(made, kinds))
    assert some == rows(bundles.linked_entries(made).where(F.col("resource_type").isin(*kinds))) and len(some) > 40


def test_conditions_read_no_other_events(spark):
    """No other event's fields are read; eras read the bundles once, without visits."""
    c = Clinic(spark, DATA)
    for name in ("condition_occurrence", "condition_era"):
        made = flow.cdm_tables(bundles.linked_entries(fhir._bundles(spark, DATA), flow.KINDS[name]), c.concept, c.relationship, c.ancestor, fhir.KEY, until=name)
        text = plan(made[name], "optimizedPlan")
        assert not any(field in text for field in ("valueQuantity", "performedPeriod", "authoredOn"))
    assert text.count("Relation [bundle_id") == 1
