"""Operators on literal rows, where an oracle over the test tables would not reach the case."""

from __future__ import annotations

import hashlib
import hmac
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from clinloom.functions import ids, text
from clinloom.operators import derive, governance, linkage, retrieval
from clinloom.sources import files, tables

KEY = b"a key"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_identifiers_equal_the_standard_library(spark):
    refs = ["urn:uuid:abc", "HTTP://Host/Patient/7/_history/2?x#y", "Patient/7", " plain "]
    clean = ["abc", "http://host/Patient/7", "7", "plain"]
    df = spark.createDataFrame([(r,) for r in refs], "ref string")
    got = df.select("ref", ids.canonical_identity(F.col("ref")), ids.person_id(F.col("ref"), KEY), ids.event_id(F.col("ref"), KEY), ids.uuid5(uuid.NAMESPACE_URL, F.col("ref"))).collect()
    for row, ref, want in zip(got, refs, clean, strict=True):
        digest = hmac.new(KEY, want.encode(), hashlib.sha256).hexdigest()
        assert row[1] == want
        assert row[2] == int(digest, 16) % 2**62
        assert row[3] == int(digest[:15], 16)
        assert row[4] == str(uuid.uuid5(uuid.NAMESPACE_URL, ref))


def test_empty_identity_fails(spark):
    df = spark.createDataFrame([("",)], "ref string")
    with pytest.raises(Exception, match="must not be empty"):
        df.select(ids.person_id(F.col("ref"), KEY)).collect()


def test_eras(spark):
    d = date
    events = spark.createDataFrame(
        [(1, 7, 100, d(2020, 1, 1), d(2020, 1, 1)), (2, 7, 100, d(2020, 1, 20), None), (3, 7, 100, d(2020, 3, 1), d(2020, 2, 1)), (4, 7, 0, d(2020, 1, 1), None)],
        "event_id long, person_id long, concept_id long, start_date date, end_date date",
    )
    assert rows(derive.condition_era(events).select("start_date", "end_date", "occurrences"), "start_date") == [
        (d(2020, 1, 1), d(2020, 1, 20), 2),
        (d(2020, 3, 1), d(2020, 3, 1), 1),
    ]
    exposures = spark.createDataFrame(
        [(1, 7, 1000, d(2020, 1, 1), None), (2, 7, 1001, d(2020, 1, 20), None), (3, 7, 1001, d(2020, 4, 1), None)], events.schema
    )
    ancestor = spark.createDataFrame([(10, 1000), (20, 1000), (10, 1001)], "ancestor_id long, descendant_id long")
    concept = spark.createDataFrame([(10, "Ingredient"), (20, "Ingredient")], "concept_id long, concept_class_id string")
    got = rows(derive.drug_era(exposures, ancestor, concept).select("ingredient_id", "exposures", "gap_days"), "ingredient_id", "exposures")
    assert got == [(10, 1, 0), (10, 2, 18), (20, 1, 0)]
    assert derive.condition_era(events.limit(0)).count() == 0


def test_linkage_never_falls_back_from_a_reference(spark):
    d = date(2020, 1, 5)
    visits = spark.createDataFrame([(1, 1, date(2020, 1, 1), date(2020, 1, 9)), (2, 1, date(2020, 1, 4), date(2020, 1, 6)), (3, 2, d, d)], "visit_id long, person_id long, start_date date, end_date date")
    events = spark.createDataFrame([(1, 1, d, 2), (2, 2, d, None), (3, 1, d, None), (4, 1, d, 9), (5, 1, date(2020, 2, 1), 1), (6, 1, d, 3), (7, 3, d, None)], "event_id long, person_id long, start_date date, encounter_ref long")
    got = rows(linkage.link_visits(events, visits).select("event_id", "visit_id", "reason", "candidates"), "event_id")
    assert got == [
        (1, 2, None, 1), (2, 3, None, 1), (3, None, "AMBIGUOUS", 2), (4, None, "REFERENCE_NOT_FOUND", 0),
        (5, None, "REFERENCE_OUTSIDE_DATE", 0), (6, None, "REFERENCE_OTHER_PERSON", 0), (7, None, "NO_COVERING_VISIT", 0),
    ]


def test_review_admission_folds_in_order(spark):
    decisions = spark.createDataFrame([(1, "k", 9, "PENDING", True), (2, "k", 9, "PENDING", True), (3, "m", 9, "APPROVED", True)], "decision_id long, semantic_key string, proposer long, status string, eligible boolean")
    actions = spark.createDataFrame(
        [(1, 1, 5, "APPROVE", 1), (2, 1, 5, "REJECT", 2), (3, 2, 5, "REJECT", 3), (4, 1, 6, "REJECT", 4), (5, 1, 7, "REJECT", 5), (6, 2, 7, "REJECT", 6), (7, 3, 7, "REJECT", 7), (8, 1, 9, "REJECT", 8), (9, 99, 1, "REJECT", 9)],
        "review_id long, decision_id long, actor long, verdict string, submitted_at long",
    )
    accepted, rejected = governance.admit_reviews(decisions, actions)
    assert [r.review_id for r in accepted.orderBy("review_id").collect()] == [1, 4, 6]
    assert rows(rejected.select("review_id", "reason"), "review_id") == [
        (2, "SAME_PERSON"), (3, "SAME_PERSON"), (5, "TWO_REVIEWS_EXIST"), (7, "NOT_REVIEWABLE"), (8, "OWN_PROPOSAL"), (9, "UNKNOWN_DECISION"),
    ]


def test_registry_fold(spark):
    registry = spark.createDataFrame([("a", "s", "V1", True)], "adapter string, system string, vocabulary_id string, active boolean")
    actions = spark.createDataFrame(
        [(1, "a", "s", "V2", "REGISTER"), (2, "a", "s", "V1", "DEACTIVATE"), (3, "a", "s", "V2", "REGISTER"), (4, "a", "s", "V2", "REGISTER"), (5, "b", "s", "V1", "DEACTIVATE")],
        "action_id long, adapter string, system string, vocabulary_id string, kind string",
    )
    after, outcomes = governance.apply_registry(registry, actions)
    assert rows(outcomes, "action_id") == [(1, "CONFLICT"), (2, "DEACTIVATED"), (3, "REGISTERED"), (4, "UNCHANGED"), (5, "NOT_ACTIVE")]
    assert rows(after.select("vocabulary_id", "active"), "vocabulary_id") == [("V1", False), ("V2", True)]


def test_jaro_winkler_and_keys(spark):
    assert text.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    df = spark.createDataFrame([(" JOSÉ  Ångström ", "ﬁne  Café")], "a string, b string")
    assert tuple(df.select(text.actor_key("a"), text.alias_key("b")).first()) == ("jose angstrom", "fine café")


def test_redaction(spark):
    said = "mail a.b@x.org call +1 212 555 0199 from 10.0.0.1 MRN: 12345 Patient/p-1 059-12-3456"
    row = text.redact(spark.createDataFrame([(said,), (None,)], "t string"), "t").collect()
    assert not any(x in row[0].t for x in ("a.b@x.org", "0199", "10.0.0.1", "12345", "p-1", "3456"))
    assert set(row[0].categories) >= {"EMAIL", "PHONE", "IP_ADDRESS", "LOCAL_IDENTIFIER", "FHIR_PATIENT_REFERENCE"}
    assert row[1].t is None and row[1].categories == []


def test_suggest_actors(spark):
    names = spark.createDataFrame([("Ana Maria Silva",), ("Zed",)], "name string")
    aliases = spark.createDataFrame([(1, "ana silva"), (2, "Bob Stone")], "actor_id long, alias string")
    assert [tuple(r) for r in retrieval.suggest_actors(names, aliases).collect()] == [("Ana Maria Silva", 1, 0.96)]


def test_publish_keeps_the_old_version_on_failure(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    tables.publish(spark.range(3), path)
    with pytest.raises(ValueError):
        tables.publish(spark.range(9), path, spark.range(1))
    assert tables.read_published(spark, path).count() == 3


def test_upsert_twice_is_upsert_once(spark):
    now = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, v string, w string")
    new = spark.createDataFrame([(2, "c", "z"), (3, None, "q")], "id long, v string, w string")
    once = tables.upsert(now, new, ["id"], ["v"])
    assert rows(once, "id") == [(1, "a", "x"), (2, "c", "y"), (3, None, "q")]
    assert rows(tables.upsert(once, new, ["id"], ["v"]), "id") == rows(once, "id")


def test_hospital_header_is_checked(spark, tmp_path):
    (tmp_path / "h.csv").write_text("﻿schema_version\trecord_id\tdomain\tsource_value\nhospital-csv-v1\tr1\tlab\tglucose\n")
    valid, bad = files.read_hospital_csv(spark, str(tmp_path / "h.csv"))
    assert valid.count() == 1 and bad.count() == 0
    (tmp_path / "x.csv").write_text("record_id,domain\n")
    with pytest.raises(ValueError):
        files.read_hospital_csv(spark, str(tmp_path / "x.csv"))


def test_hospital_rows_by_the_first_broken_rule(spark, tmp_path):
    head = "schema_version,record_id,domain,source_value,unit,event_date\n"
    v = "hospital-csv-v1"
    lines = [
        f"{v},r1,Drug Exposure,aspirin,mg,2024-02-03",
        f"{v},r2,lab,glucose",  # a short line is read with blanks
        f"{v},r3,lab,glucose,mg,2024-02-03,more",
        f'{v},r4,lab,"a, quoted ""name""",mg,2024-02-03',
        f"{v},r5,lab,glucose,{'u' * 201},2024-02-30",
        f"{v},r6,lab,glucose,{'u' * 201},2024-02-03",
        f"{v},r1,lab,other,,",
        f"{v},,lab,blank id,,",
        f"{v},,lab,blank id,,",
        "v0,r7,lab,x,,",
    ]
    (tmp_path / "a.csv").write_text(head + "\n".join(lines[:5]) + "\n")
    (tmp_path / "b.csv").write_text(head + "\n".join(lines[5:]) + "\n")
    valid, bad = files.read_hospital_csv(spark, str(tmp_path))
    assert rows(valid.select("record_id", "target_table", "source_value", "event_date"), "record_id") == [
        ("r1", "drug_exposure", "aspirin", "2024-02-03"), ("r2", "measurement", "glucose", ""), ("r4", "measurement", 'a, quoted "name"', "2024-02-03"),
    ]
    assert rows(bad, "record_id", "violation") == [
        ("", "RECORD_ID"), ("", "RECORD_ID"), ("r1", "DUPLICATE_RECORD_ID"), ("r3", "EXTRA_FIELDS"), ("r5", "EVENT_DATE"), ("r6", "TOO_LONG"), ("r7", "SCHEMA_VERSION"),
    ]
    (tmp_path / "c.csv").write_text("record_id,schema_version,domain,source_value\n")
    with pytest.raises(ValueError, match="different headers"):
        files.read_hospital_csv(spark, str(tmp_path))


def test_receipt_files(spark, tmp_path):
    import json

    good = dict(schema_version="v", ingestion_run_id="RUN-1", input_manifest_sha256="0" * 64, source_adapter="csv", source_system="LAB", source_code="C", source_record_key="a" * 64, target_table="measurement", target_id=7)
    odd = [good, good | {"target_id": 0}, good | {"schema_version": "w"}, good | {"ingestion_run_id": "RUN-"}, good | {"target_table": "person"}, {k: v for k, v in good.items() if k != "target_id"}, good | {"more": 1}]
    (tmp_path / "one.json").write_text(json.dumps(odd, indent=1))
    (tmp_path / "two.json").write_text("{}")
    (tmp_path / "three.json").write_text(json.dumps([good] * 10_001))
    valid, bad = files.read_receipts(spark, str(tmp_path), "v")
    digest = hashlib.sha256(json.dumps(good, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert [(r.pos, r.receipt_id, r.target_id) for r in valid.collect()] == [(0, digest, 7)]
    assert rows(bad.select("pos", "violation"), F.col("pos").asc_nulls_first(), "violation") == [
        (None, "NOT_AN_ARRAY"), (None, "TOO_MANY"), (1, "TARGET_ID"), (2, "SCHEMA_VERSION"), (3, "RUN_ID"), (4, "TARGET_TABLE"), (5, "FIELDS"), (6, "FIELDS"),
    ]


def test_fuzzy_search_scores_what_brute_force_scores(spark):
    import random

    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randint(0, 9)))
    terms, names = [(i, word()) for i in range(40)] + [(90, None)], [(i, word()) for i in range(300)] + [(900, None), (901, "abc"), (902, "abc")]
    got = retrieval.jaro_winkler_topk(spark.createDataFrame(terms, "term_id long, term string"), spark.createDataFrame(names, "item_id long, name string").repartition(5), 4)
    want = []
    for t, term in terms[:-1]:
        scored = sorted((-round(text.jaro_winkler(term.strip(" ").lower(), n.strip(" ").lower()), 6), i) for i, n in names if n is not None)[:4]
        want += [(t, i, -s, k) for k, (s, i) in enumerate(scored, 1)]
    assert rows(got, "term_id", "rank") == want
    assert retrieval.jaro_winkler_topk(spark.createDataFrame(terms, "term_id long, term string").limit(0), spark.createDataFrame(names, "item_id long, name string"), 4).count() == 0


def test_slices_have_their_own_fingerprints(spark):
    from clinloom.operators import worklist

    frame = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "concept_id long, concept_name string, concept_code string")
    one = worklist.slice_fingerprint(frame).first()
    assert (one.n, one.low, one.high) == (2, 1, 2)
    assert worklist.slice_fingerprint(frame.orderBy(F.desc("concept_id")).repartition(3)).first() == one
    others = [frame.where("concept_id = 1"), frame.withColumn("concept_name", F.upper("concept_name")), frame.withColumn("concept_code", F.lit("x"))]
    assert all(worklist.slice_fingerprint(x).first() != one for x in others)


def test_registry_of_random_actions(spark):
    import random

    r = random.Random(4)
    actions = [(i, r.choice("ab"), "s", r.choice(["V1", "V2"]), r.choice(["REGISTER", "DEACTIVATE"])) for i in range(80)]
    registry = [("a", "s", "V2", True), ("a", "s", "V1", False)]
    held, want = {("a", "s"): "V2"}, []
    for i, adapter, system, vocabulary, kind in actions:
        now = held.get((adapter, system))
        if kind == "REGISTER":
            want.append((i, "REGISTERED" if now is None else "UNCHANGED" if now == vocabulary else "CONFLICT"))
            held[adapter, system] = now or vocabulary
        else:
            want.append((i, "DEACTIVATED" if now else "NOT_ACTIVE"))
            held[adapter, system] = None
    after, outcomes = governance.apply_registry(
        spark.createDataFrame(registry, "adapter string, system string, vocabulary_id string, active boolean"), spark.createDataFrame(actions, "action_id long, adapter string, system string, vocabulary_id string, kind string")
    )
    assert rows(outcomes, "action_id") == want
    assert {(x.adapter, x.system): x.vocabulary_id for x in after.where("active").collect()} == {k: v for k, v in held.items() if v}


def test_hospital_fields_over_several_lines(spark, tmp_path):
    v = "hospital-csv-v1"
    lines = [f'{v},r1,lab,"two\nlines",mg', f'{v},r2,lab,"a ""b"", c\r\n",mg', f'{v},r3,lab,x,"u\n",more,"even\nmore"', f'{v},r4,lab,nul\0,mg', f'{v},r5,lab,last\t,']
    (tmp_path / "h.csv").write_bytes(("schema_version,record_id,domain,source_value,unit\n" + "\n".join(lines) + "\n").encode())
    valid, bad = files.read_hospital_csv(spark, str(tmp_path / "h.csv"))
    assert rows(valid.select("record_id", "source_value", "unit"), "record_id") == [("r1", "two\nlines", "mg"), ("r2", 'a "b", c', "mg"), ("r5", "last", "")]
    assert rows(bad, "record_id") == [("r3", "EXTRA_FIELDS"), ("r4", "NUL_BYTE")]


def test_fuzzy_search_and_names_in_blocks(spark, monkeypatch):
    """Several blocks give what one gives, which is what all pairs give."""
    import random
    from difflib import SequenceMatcher

    r = random.Random(12)
    word = lambda: "".join(r.choices("abcde", k=r.randint(0, 7)))
    names, terms = [(i, r.choice([word(), word() + " " + word()])) for i in range(120)] + [(500, None)], [(i, word()) for i in range(50)] + [(77, None), (None, "x")]
    slice_ = spark.createDataFrame(names, "item_id long, name string").repartition(3)
    asked = spark.createDataFrame(terms, "term_id long, term string")
    monkeypatch.setattr(retrieval, "BLOCK_TERMS", 9)
    got = sorted((x.term_id, x["rank"], x.item_id, x.score) for x in retrieval.jaro_winkler_topk(asked, slice_, 4).collect())
    want = []
    for i, t in terms:
        if i is not None and t is not None:
            near = sorted((-round(text.jaro_winkler(t.strip(), n.strip()), 6), k) for k, n in names if n is not None)[:4]
            want += [(i, rank, k, -s) for rank, (s, k) in enumerate(near, 1)]
    assert [x[:3] for x in got] == [x[:3] for x in sorted(want)] and all(abs(x[3] - y[3]) < 1e-6 for x, y in zip(got, sorted(want), strict=True))

    people = [f"{r.choice(['Ann', 'anne', 'Bo', 'Jörg'])} {r.choice(['Li', 'Lee', 'Miller', 'Müller', 'Mueller'])}{r.choice(['', ' Jr'])}" for _ in range(40)]
    register = [(i, f"{r.choice(['ann', 'Anna', 'jorg', 'Bob'])} {r.choice(['lee', 'Muller', 'Miler'])}") for i in range(40)]
    monkeypatch.setattr(retrieval, "BLOCK_NAMES", 3)
    found = retrieval.suggest_actors(spark.createDataFrame([(p,) for p in people], "name string"), spark.createDataFrame(register, "actor_id long, alias string"))
    got = {(x.name, x.actor_id): x.similarity for x in found.collect()}
    import pandas as pd

    key = lambda s: text._actor_keys(pd.Series([s]))[0]
    want = {}
    for p in set(people):
        for i, alias in register:
            a, b = key(p), key(alias)
            x, y = a.split(), b.split()
            score = SequenceMatcher(None, a, b).ratio()
            if len(x) >= 2 and len(y) >= 2 and x[0] == y[0] and x[-1] == y[-1]:
                score = max(score, 0.96)
            if (len(x) >= 2 and set(x) <= set(y)) or (len(y) >= 2 and set(y) <= set(x)):
                score = max(score, 0.92)
            if score >= 0.84:
                want[p, i] = round(score, 6)
    assert got == want
