"""Rules that no query's tables break: files that must fail, runs that may not be compared, ids of batches."""

from __future__ import annotations

import uuid

import pytest

from clinloom.operators import derive, governance, retrieval, scoring
from clinloom.sources import files


def release(folder, **broken):
    """A vocabulary release of one row a table; ``broken`` gives a table's lines instead."""
    for table, columns in files.VOCABULARY.items():
        fields = [f.split() for f in columns.split(", ")]
        row = "\t".join({"long": "7", "int": "0", "date": "20200131"}.get(kind, "x") for _, kind in fields)
        lines = broken.get(table, [row])
        if lines is not None:
            (folder / f"{table.upper()}.csv").write_text("\n".join(["\t".join(n for n, _ in fields), *lines]) + "\n")
    return str(folder)


def test_release_reads_all_tables(spark, tmp_path):
    tables = files.read_vocabularies(spark, release(tmp_path))
    assert set(tables) == set(files.VOCABULARY)
    assert tables["domain"].collect() == [("x", "x", 7)]
    assert str(tables["concept"].first()["valid_start_date"]) == "2020-01-31"


def test_release_without_a_file_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="DOMAIN.csv"):
        files.read_vocabularies(spark, release(tmp_path, domain=None))


def test_empty_table_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="domain has no rows"):
        files.read_vocabularies(spark, release(tmp_path, domain=[]))


def test_bad_number_fails_and_empty_one_is_null(spark, tmp_path):
    assert files.read_vocabularies(spark, release(tmp_path, domain=["a\tb\t"]))["domain"].collect() == [("a", "b", None)]
    bad = files.read_vocabulary(spark, release(tmp_path, domain=["a\tb\tseven"]) + "/DOMAIN.csv", "domain")
    with pytest.raises(Exception, match="domain.domain_concept_id is no number: seven"):
        bad.collect()


RUN = "case_id long, domain string, split string, expected_decision string, expected_id long"


def test_runs_must_hold_the_same_cases(spark):
    one = spark.createDataFrame([(1, "Drug", "held_out", "MAP", 5), (2, "Drug", "held_out", "ABSTAIN", None)], RUN)
    scoring.require_comparable(one, one)
    for other in (one.where("case_id = 1"), one.unionByName(one.where("case_id = 2")), one.replace("Drug", "Device", "domain")):
        with pytest.raises(ValueError, match="the runs differ"):
            scoring.require_comparable(one, other)


def test_unlike_grids_fail(spark):
    rows = [(0.5, 4, 3, 1, 0.75, 0.5)]
    schema = "threshold double, admitted long, correct long, incorrect long, precision double, recall double"
    one = spark.createDataFrame(rows, schema)
    assert {r["metric"]: r["delta"] for r in scoring.threshold_deltas(one, one).collect()} == dict.fromkeys(("admitted", "correct", "incorrect", "precision", "recall"), 0.0)
    with pytest.raises(Exception, match="different threshold grids"):
        scoring.threshold_deltas(one, one.withColumn("threshold", one["threshold"] + 0.1)).collect()


def test_batch_ids_and_faults(spark):
    schema = "batch long, receipt_id string, run_id string, manifest string, record_key string, target_table string, target_id long"
    rows = [
        (1, "b", "r", "m", "k1", "t", 1), (1, "a", "r", "m", "k2", "t", 2),
        (2, "c", "r", "m", "k1", "t", 1), (2, "d", "r", "n", "k2", "t", 2),
        (3, "e", "r", "m", "k1", "t", 1), (3, "f", "r", "m", "k1", "t", 2),
        (4, "g", "r", "m", "k1", "t", 1), (4, "h", "r", "m", "k2", "t", 1),
        (5, "i", "r", "m", "k1", "t", 1), (5, "j", "r", "m", "k2", "t", 2), (5, "k", "r", "m", "k3", "t", 3),
    ]
    got = {r["batch"]: (r["violation"], r["batch_id"]) for r in governance.handoff_batches(spark.createDataFrame(rows, schema), 2, uuid.NAMESPACE_URL, "handoff:").collect()}
    want = {2: "MANY_RUNS", 3: "DUPLICATE_RECORD", 4: "DUPLICATE_EVENT", 5: "TOO_MANY"}
    assert got == {1: (None, str(uuid.uuid5(uuid.NAMESPACE_URL, "handoff:a|b")))} | {k: (v, None) for k, v in want.items()}


def test_policies_follow_decisions(spark):
    pairs, approved = "semantic_key string, concept_id long, active boolean", "semantic_key string, concept_id long, decision_id long, active boolean"
    accepted = spark.createDataFrame([(1, "a", 10, "APPROVED"), (2, "b", 20, "REJECTED")], "decision_id long, semantic_key string, concept_id long, status string")
    old = spark.createDataFrame([("a", 11, 8, True), ("b", 20, 9, True), ("c", 30, 7, True)], approved)
    policies = spark.createDataFrame([("a", 10, True), ("a", 11, True), ("b", 20, False)], pairs)
    nxt, rules = governance.publish_policies(accepted, old, policies)
    assert sorted(map(tuple, nxt.collect())) == [("a", 10, 1, True), ("b", 20, 9, False), ("c", 30, 7, True)]
    assert sorted(map(tuple, rules.collect())) == [("a", 10, False), ("a", 11, True), ("b", 20, True)]


def test_vectors_of_other_lengths_are_at_distance_one(spark):
    index = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 2.0])], "item_id long, vector array<double>")
    queries = spark.createDataFrame([(9, [2.0, 0.0])], "query_id long, vector array<double>")
    found = [(r["item_id"], round(r["distance"], 6)) for r in retrieval.cosine_topk(queries, index, 4).orderBy("rank").collect()]
    assert found == [(1, 0.0), (2, 1.0), (3, 1.0), (4, 1.0)]


def test_only_current_standard_ingredients_count(spark):
    concept = spark.createDataFrame(
        [(1, "Drug", "Ingredient", "S", None), (2, "Drug", "Ingredient", "S", "D"), (3, "Drug", "Ingredient", None, None)],
        "concept_id long, domain_id string, concept_class_id string, standard_concept string, invalid_reason string",
    )
    ancestor = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "ancestor_id long, descendant_id long")
    exposures = spark.createDataFrame([(100, 10), (101, 11), (102, 12), (103, 0)], "event_id long, concept_id long")
    assert {r["event_id"] for r in derive.ingredient_exposures(exposures, ancestor, concept).collect()} == {100}
    assert {r["event_id"] for r in derive.hierarchy_violations(exposures, ancestor, concept).collect()} == {101, 102}
