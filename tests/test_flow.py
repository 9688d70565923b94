"""The whole batch from files: a small golden case, and a release that fails."""

from __future__ import annotations

import datetime
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from clinloom import flow
from clinloom.functions.coding import LOINC, RXNORM, SNOMED, UCUM
from clinloom.functions.ids import event_id, person_id
from clinloom.operators import extract
from clinloom.sources import files, tables

KEY = b"key of the tests"


def own_id(identity):
    return int(hmac.new(KEY, identity.encode(), hashlib.sha256).hexdigest()[:15], 16)


def own_person(identity):
    return int(hmac.new(KEY, identity.encode(), hashlib.sha256).hexdigest(), 16) % 2**62


def coded(system, code):
    return {"coding": [{"system": system, "code": code, "display": code}]}


def bundle(day="2020-02-01", birth="1950-03"):
    refs = {"subject": {"reference": "Patient/p"}, "encounter": {"reference": "Encounter/v"}}
    resources = [
        {"resourceType": "Patient", "id": "p", "gender": "female", "birthDate": birth},
        {"resourceType": "Encounter", "id": "v", "status": "finished", "class": {"code": "AMB"}, "subject": refs["subject"], "period": {"start": "2020-02-01", "end": "2020-02-03"}},
        {"resourceType": "Condition", "id": "c", "code": coded(SNOMED, "C"), "onsetDateTime": day, **refs},
        {"resourceType": "Observation", "id": "m", "status": "final", "code": coded(LOINC, "M"), "effectiveDateTime": day, "valueQuantity": {"value": 7.5, "unit": "mg/dL", "system": UCUM, "code": "mg/dL"},
         "component": [{"code": coded(LOINC, "M"), "valueQuantity": {"value": 1.5, "unit": "x"}}], **refs},
        {"resourceType": "Observation", "id": "o", "status": "final", "code": coded(LOINC, "O"), "effectiveDateTime": day, "valueString": "often", **refs},
        {"resourceType": "Observation", "id": "bad", "status": "entered-in-error", "code": coded(LOINC, "O"), "effectiveDateTime": day, "valueString": "never", **refs},
        {"resourceType": "Medication", "id": "d", "code": coded(RXNORM, "D")},
        {"resourceType": "MedicationRequest", "id": "r", "status": "active", "medicationReference": {"reference": "Medication/d"}, "authoredOn": day, **refs},
        {"resourceType": "Procedure", "id": "q", "status": "completed", "code": coded(SNOMED, "P"), "performedDateTime": day, **refs},
        {"resourceType": "Procedure", "id": "device", "status": "completed", "code": coded(SNOMED, "X"), "performedDateTime": day, **refs},
        {"resourceType": "Procedure", "id": "spec", "status": "completed", "code": coded(SNOMED, "S"), "performedDateTime": day, **refs},
    ]
    return {"resourceType": "Bundle", "entry": [{"fullUrl": f"urn:uuid:{r['id']}", "resource": r} for r in resources]}


SOURCES = {("SNOMED", "C"): "Condition", ("LOINC", "M"): "Measurement", ("LOINC", "O"): "Observation", ("RxNorm", "D"): "Drug", ("SNOMED", "P"): "Procedure", ("SNOMED", "X"): "Device", ("SNOMED", "S"): "Specimen"}


def vocabulary(folder):
    concepts, maps = [], []
    for n, ((voc, code), domain) in enumerate(SOURCES.items(), 1):
        concepts.append(f"{n}\t{code}\t{domain}\t{voc}\tSource\t\t{code}\t1970-01-01\t2099-12-31\t")
        concepts.append(f"{100 + n}\tStd {code}\t{domain}\tSTD\t{'Ingredient' if domain == 'Drug' else 'Clinical'}\tS\tS{code}\t1970-01-01\t2099-12-31\t")
        maps.append(f"{n}\t{100 + n}\tMaps to\t1970-01-01\t2099-12-31\t")
    concepts.append("8840\tmilligram per deciliter\tUnit\tUCUM\tUnit\tS\tmg/dL\t1970-01-01\t2099-12-31\t")
    lines = {"concept": concepts, "concept_relationship": maps, "concept_ancestor": ["104\t104\t0\t0"]}
    for table, columns in files.VOCABULARY.items():
        fields = [f.split() for f in columns.split(", ")]
        row = "\t".join({"long": "7", "int": "0", "date": "20200131"}.get(kind, "x") for _, kind in fields)
        (folder / f"{table.upper()}.csv").write_text("\n".join(["\t".join(n for n, _ in fields), *lines.get(table, [row])]) + "\n")


@pytest.fixture
def places(tmp_path):
    for name in ("bundles", "bundles/below", "vocabulary", "out"):
        (tmp_path / name).mkdir()
    vocabulary(tmp_path / "vocabulary")
    (tmp_path / "bundles/a.json").write_text(json.dumps(bundle(), indent=1))
    (tmp_path / "bundles/below/copy.json").write_text(json.dumps(bundle()))
    (tmp_path / "bundles/damaged.json").write_text('{"resourceType": "Bundle", "entry": [')
    (tmp_path / "bundles/list.json").write_text(json.dumps({"resourceType": "List", "entry": bundle()["entry"]}))
    (tmp_path / "bundles/notes.txt").write_text(json.dumps(bundle()))
    return {name: f"file://{tmp_path}/{name}" for name in ("bundles", "vocabulary", "out")} | {"folder": tmp_path}


def build(spark, places):
    flow.build_cdm(spark, places["bundles"], places["vocabulary"], places["out"], KEY)
    return lambda name: [tuple(r) for r in tables.read_published(spark, places["out"], name).collect()]


def test_golden_case_and_a_failing_release_that_keeps_the_old(spark, places):
    read = build(spark, places)
    person, visit = own_person("p"), own_id("v")
    day, end = datetime.date(2020, 2, 1), datetime.date(2020, 2, 3)
    assert read("person") == [(person, 8532, 1950, 3, None, None, None)]
    assert read("visit_occurrence") == [(visit, person, 9202, day, end)]
    assert read("condition_occurrence") == [(own_id("c"), person, 101, 1, day, day, visit)]
    assert read("drug_exposure") == [(own_id("r"), person, 104, 4, day, day, visit)]
    part = own_id("m::component[0]")
    assert set(read("measurement")) == {(own_id("m"), person, 102, 7.5, 8840, None, day, visit), (part, person, 102, 1.5, None, None, day, visit)}
    assert read("observation") == [(own_id("o"), person, 103, "often", day, visit)]
    assert read("procedure_occurrence") == [(own_id("q"), person, 105, day, visit)]
    assert read("device_exposure") == [(own_id("device"), person, 106, day, visit)]
    assert read("quarantine") == [("Procedure", own_id("spec"), 107, "Specimen")]
    assert read("observation_period") == [(person, day, end, "ENCOUNTER_PLUS_EVENT_ENVELOPE")]
    assert [r[1:] for r in read("condition_era")] == [(person, 101, day, day, 1)]
    assert [r[1:] for r in read("drug_era")] == [(person, 104, day, day, 1, 0)]
    linked = tables.read_published(spark, places["out"], "event_visit_linkage").groupBy("link_method", "status").count().collect()
    assert [tuple(r) for r in linked] == [("REFERENCE", "LINKED", 8)]

    # a patient without a year of birth is no person, so the events have none
    for name in ("a.json", "below/copy.json"):
        (places["folder"] / "bundles" / name).write_text(json.dumps(bundle(birth="unknown")))
    with pytest.raises(ValueError, match="NO_PERSON"):
        build(spark, places)
    assert [tuple(r) for r in tables.read_published(spark, places["out"], "person").collect()] == [(person, 8532, 1950, 3, None, None, None)]
    assert len(list((places["folder"] / "out").glob("version-*"))) == 1


def changed(places, change, vocabulary_change=None):
    b = bundle()
    change(b["entry"])
    for name in ("a.json", "below/copy.json"):
        (places["folder"] / "bundles" / name).write_text(json.dumps(b))
    if vocabulary_change:
        for table, (old, new) in vocabulary_change.items():
            path = places["folder"] / f"vocabulary/{table}.csv"
            assert old in path.read_text()
            path.write_text(path.read_text().replace(old, new))


def test_units_approvals_and_provenance(spark, places):
    def change(entries):
        wrong = {"resourceType": "Observation", "id": "rdw", "status": "final", "code": coded(LOINC, "788-0"), "effectiveDateTime": "2020-02-02",
                 "valueQuantity": {"value": 40, "unit": "fL", "system": UCUM, "code": "fL"}, "subject": {"reference": "Patient/p"}, "encounter": {"reference": "Encounter/v"}}
        right = wrong | {"id": "ok", "valueQuantity": {"value": 13, "unit": "%", "system": UCUM, "code": "%"}}
        unknown = {"resourceType": "Condition", "id": "u", "code": coded(SNOMED, "UNKNOWN"), "onsetDateTime": "2020-02-02", "subject": {"reference": "Patient/p"}}
        entries += [{"fullUrl": f"urn:uuid:{r['id']}", "resource": r} for r in (wrong, right, unknown)]

    changed(places, change)
    terms = spark.createDataFrame([("SNOMED", "UNKNOWN", 101), ("LOINC", "788-0", 101)], "vocabulary_id string, code string, approved long")
    events = spark.createDataFrame([], "event_id long, approved long")
    flow.build_cdm(spark, places["bundles"], places["vocabulary"], places["out"], KEY, flow.Approved(terms, events))
    read = lambda name: {r.event_id: r for r in tables.read_published(spark, places["out"], name).collect()}
    assert [(k, r.unit_code, r.expected_unit) for k, r in read("unit_quarantine").items()] == [(own_id("rdw"), "fL", "%")]
    measured = read("measurement")
    assert own_id("rdw") not in measured and measured[own_id("ok")].concept_id == 0  # 101 is no measurement
    assert read("condition_occurrence")[own_id("u")].concept_id == 101
    marks = read("mapping_provenance")
    assert (marks[own_id("u")].mapping_method, marks[own_id("c")].mapping_method, marks[own_id("u")].target_table) == ("APPROVED", "VOCABULARY", "condition_occurrence")
    assert own_id("ok") not in marks


def test_ambiguous_targets_and_strict_bundles_fail(spark, places):
    changed(places, lambda entries: entries[2]["resource"].update(encounter={"reference": "Encounter/nowhere"}))
    with pytest.raises(ValueError, match="UNRESOLVED_ENCOUNTER"):
        flow.build_cdm(spark, places["bundles"], places["vocabulary"], places["out"], KEY, strict=True)
    path = places["folder"] / "vocabulary/CONCEPT_RELATIONSHIP.csv"
    path.write_text(path.read_text() + "2\t103\tMaps to\t1970-01-01\t2099-12-31\t\n")  # M maps to the observation's concept too
    with pytest.raises(ValueError, match="AMBIGUOUS_TARGETS"):
        build(spark, places)


def test_an_exposure_without_ingredient_keeps_the_old_version(spark, places):
    from clinloom.session import shared_dir

    read = build(spark, places)
    before = read("drug_era")
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    names = lambda: {s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)}
    held = names()
    path = places["folder"] / "vocabulary/CONCEPT_ANCESTOR.csv"
    path.write_text(path.read_text().replace("104\t104", "105\t105"))
    with pytest.raises(ValueError, match="no_ingredient"):
        build(spark, places)
    assert [tuple(r) for r in tables.read_published(spark, places["out"], "drug_era").collect()] == before
    assert len(list((places["folder"] / "out").glob("version-*"))) == 1
    assert names() == held  # nothing staged is left


def test_resources_without_url_get_their_payloads_id(spark):
    payload = json.dumps(bundle()["entry"][2]["resource"])
    patient = json.dumps(bundle()["entry"][0]["resource"])
    rows = [(1, "urn:uuid:p", "Patient", "p", patient), (1, None, "Condition", "c", payload)]
    entries = spark.createDataFrame(rows, "bundle_id int, full_url string, resource_type string, id string, resource string")
    found = extract.extract_conditions(extract.with_references(entries)).select(event_id(F.col("full_url"), KEY), person_id(F.col("person_ref"), KEY))
    assert [tuple(r) for r in found.collect()] == [(own_id(payload), own_person("p"))]
