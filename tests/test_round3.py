"""What a step sends, how often it does its work, and results on keys that the small tables don't hold."""

from __future__ import annotations

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clinloom import flow
from clinloom.operators import extract, retrieval
from clinloom.plans import fhir, registry
from clinloom.plans.binding import Clinic
from clinloom.sources import bundles

DATA = "/root/testdata/sf0.001"


def plan(df, of="executedPlan") -> str:
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    try:
        return getattr(df._jdf.queryExecution(), of)().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.debug.maxToStringFields")


def test_bundles_send_columns_not_texts(spark):
    """Texts are made above the last exchange."""
    text = plan(fhir.bundles(Clinic(spark, DATA)))
    assert "resourceType" in text
    assert "resourceType" not in text[text.index("Exchange") :]


def test_c21_where_source_concepts_take_standard_ids(spark, tmp_path):
    """Part keys beyond a million give source concepts the ids of standard ones."""
    for t in os.listdir(DATA):
        os.symlink(f"{DATA}/{t}", tmp_path / t)
    os.unlink(tmp_path / "part.parquet")
    con = duckdb.connect()
    con.sql(f"copy (select p.* replace (cast(p_partkey + i as bigint) as p_partkey) from '{DATA}/part.parquet' p, (select unnest([0, 1000000, 1000300]) as i)) to '{tmp_path}/part.parquet' (format parquet)")
    for t in os.listdir(tmp_path):
        con.sql(f"create view {t.removesuffix('.parquet')} as select * from '{tmp_path}/{t}'")
    want = sorted(con.sql(registry.oracle_sql()["c21"]).fetchall(), key=repr)
    got = registry.queries()["c21"](spark, str(tmp_path)).select("case_id", "expected_id", "reason")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_names_in_many_copies_are_scored_once(spark, monkeypatch):
    met = []
    score = retrieval._nearest_names
    monkeypatch.setattr(retrieval, "_nearest_names", lambda shared, named, k: met.append((len(shared.value), named.count())) or score(shared, named, k))
    names = ["red bolt", "Red Bolt ", "blue ring", "green nut", "red bold"]
    items = [(100 - i, names[i % 5]) for i in range(60)] + [(7, None)]
    terms = [(i, ("red bolt", "blue rng", " RED BOLT")[i % 3]) for i in range(30)]
    got = retrieval.jaro_winkler_topk(spark.createDataFrame(terms, "term_id long, term string"), spark.createDataFrame(items, "item_id long, name string"), 4)
    got = sorted((r.term_id, r["rank"], r.item_id, r.score) for r in got.collect())
    want = []
    for i, term in terms:
        scored = [(-round(retrieval.jaro_winkler(term.strip().lower(), n.strip().lower()), 6), item) for item, n in items if n is not None]
        want += [(i, k + 1, item, -s) for k, (s, item) in enumerate(sorted(scored)[:4])]
    assert got == sorted(want)
    assert met == [(2, 4)]


def test_axes_run_once_a_distinct_text(spark, monkeypatch):
    counts = {}
    stored = retrieval.store

    def counted(df, name):
        table = stored(df, name)
        counts[name] = table.count()
        return table

    monkeypatch.setattr(retrieval, "store", counted)
    rows = [(t, ("Glucose in Serum", None)[t == 9], t + r, ("x in Urine", "y in Serum", None)[r % 3], r / 10, r) for t in range(10) for r in range(6)]
    df = spark.createDataFrame(rows, "term_id long, term string, item_id long, name string, similarity double, rank int")
    best = retrieval.rerank(df, 2).collect()
    assert counts == {"axes": 3}
    assert len(best) == 20
    # a term without a text keeps the order of its similarities
    assert [r["rank"] for r in sorted(best, key=lambda r: r.new_rank) if r.term_id == 9] == [5, 4]


@pytest.mark.parametrize("rows", [3, 512])
def test_search_meets_few_rows_at_once(spark, monkeypatch, rows):
    monkeypatch.setattr(retrieval, "ROWS_AT_ONCE", rows)
    r = np.random.default_rng(5)
    v = [(i, r.standard_normal(4).tolist()) for i in range(80)] + [(90 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(9)]
    df = spark.createDataFrame(v, "item_id long, vector array<double>")
    got = retrieval.cosine_topk(df.where("item_id < 5").withColumnRenamed("item_id", "query_id"), df, 6)
    got = {(x.query_id, x["rank"]): x.item_id for x in got.collect()}
    unit = {i: np.array(x) / np.linalg.norm(x) for i, x in v}
    for q in range(5):
        best = sorted(unit, key=lambda i: (round(1 - float(unit[q] @ unit[i]), 12), i))[:6]
        assert [got[q, k + 1] for k in range(6)] == best


def _violations(rows):
    """By loops over (bundle_id, full_url, resource_type, id, subject)."""
    out = []
    for b in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == b]
        names = {n for r in own if r[1] and r[2] and r[3] for n in (r[1], f"{r[2]}/{r[3]}")}
        if not any(r[2] == "Patient" for r in own):
            out.append((b, None, "NO_PATIENT"))
        for r in own:
            if not (r[1] or "").startswith("urn:uuid:") or r[1] == "urn:uuid:":
                out.append((b, r[1], "BAD_FULL_URL"))
            if sum(x[1] == r[1] for x in own) > 1:
                out.append((b, r[1], "DUPLICATE_FULL_URL"))
            if r[3] and sum((x[2], x[3]) == (r[2], r[3]) for x in own) > 1:
                out.append((b, r[1], "DUPLICATE_IDENTITY"))
            if r[2] == "MedicationRequest" and r[4] and r[4] not in names:
                out.append((b, r[1], "UNRESOLVED_SUBJECT"))
    return sorted(out, key=repr)


def test_bundle_violations_by_loops_and_one_exchange(spark):
    r = np.random.default_rng(8)
    urls = [None, "", "urn:uuid:a", "urn:uuid:b", "urn:uuid:c", "Patient/1", "urn:uuid:"]
    kinds, ids, refs = ["Patient", "MedicationRequest", "Encounter", None, ""], [None, "", "1", "2"], [None, "", "urn:uuid:a", "Patient/1", "Encounter/2", "x"]
    pick = lambda xs: xs[r.integers(len(xs))]
    rows = [(int(b), pick(urls), pick(kinds), pick(ids), pick(refs)) for b in range(40) for _ in range(r.integers(1, 7))]
    df = spark.createDataFrame(rows, "bundle_id long, full_url string, resource_type string, id string, ref string")
    entries = df.selectExpr("bundle_id", "0 as pos", "full_url", "resource_type", "id", """concat('{"subject":{"reference":', coalesce(concat('"', ref, '"'), 'null'), '}}') as resource""")
    found = extract.bundle_violations(entries)
    got = sorted((tuple(x) for x in found.collect()), key=repr)
    assert got == _violations(rows)
    assert plan(extract.bundle_violations(entries)).count("Exchange") == 1


def test_flow_writes_its_entries_once(spark, monkeypatch):
    names = []
    stored = fhir.store
    monkeypatch.setattr(fhir, "store", lambda df, name: names.append(name) or stored(df, name))
    registry.queries()["flow_condition_occurrence"](spark, DATA)
    assert names.count("staged_entries") == 1


def test_ids_read_their_identity_once(spark):
    """One chain of digests for a person's and an event's id."""
    assert plan(registry.queries()["b3_ids"](spark, DATA), "optimizedPlan").count("sha2(") == 2


@pytest.mark.parametrize("name", ["person", "condition_occurrence", "condition_era"])
def test_flow_makes_no_more_than_is_asked(spark, name):
    c = Clinic(spark, DATA)
    made = flow.cdm_tables(bundles.linked_entries(fhir.bundles(c)), c.concept, c.relationship, c.ancestor, fhir.KEY, until=name)
    assert name in made and not {"drug_exposure", "mapping_provenance", "bundle_violations"} & set(made)


def test_bundles_are_made_by_tasks_that_follow_the_lines(spark, monkeypatch):
    """The bytes shuffled are few, so that by them one task would make all texts."""
    monkeypatch.setattr(fhir, "TASK_LINES", 500, raising=False)
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    assert fhir.bundles(Clinic(spark, DATA)).rdd.getNumPartitions() == -(-lines // 500) > 4


def test_bundles_are_written_small(spark):
    """What is written of the bundles is a small part of their texts, which repeat themselves."""
    made = fhir._bundles(spark, DATA)
    written = sum(os.path.getsize(f.removeprefix("file://")) for f in made.inputFiles())
    assert written < made.agg(F.sum(F.octet_length("json"))).first()[0] / 9


@pytest.mark.parametrize("name", ["b5", "b7", "b8", "b12", "b13"])
def test_bundles_are_read_without_an_exchange(spark, name):
    """Beyond the making of the bundles these send and sort nothing, so that they can't spill either."""
    text = plan(registry.queries()[name](spark, DATA))
    assert "Scan parquet" in text
    assert not any(step in text for step in ("Exchange", "Sort", "Aggregate", "Window", "Join"))
