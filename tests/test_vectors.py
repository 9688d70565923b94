"""The inverted file: recall against the exhaustive search, and exactness where all cells are probed."""

from __future__ import annotations

import numpy as np
import pytest

from clinloom.operators import retrieval, vectors
from clinloom.plans import lookup
from clinloom.session import read_table


def both(spark, rows, k=5, **probe):
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    asked, items = df.where("vec_id % 5 = 0").withColumnRenamed("vec_id", "query_id"), df.withColumnRenamed("vec_id", "item_id")
    table = lambda d: {(r.query_id, r["rank"]): (r.item_id, round(r.distance, 9)) for r in d.collect()}
    return table(vectors.probe_topk(asked, vectors.build_index(items, 12), k, **probe)), table(retrieval.cosine_topk(asked, items, k))


@pytest.mark.parametrize("part", [20_000, 7])
def test_all_cells_give_the_exhaustive_result(spark, monkeypatch, part):
    """Copies and ties, zero and null vectors, a hot cell in parts."""
    monkeypatch.setattr(vectors, "PART_ROWS", part)
    monkeypatch.setattr(vectors, "QUERIES_AT_ONCE", 8)
    r = np.random.default_rng(2)
    rows = [(i, r.standard_normal(6).tolist()) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(40)] + [(300, [0.0] * 6), (301, None), (305, [0.0] * 6)]
    got, want = both(spark, rows, probes=12)
    assert got == want


@pytest.mark.parametrize("cell", [32_768, 40])
def test_every_row_asks(spark, monkeypatch, cell):
    """All pairs, in one cell and in several: copies and ties, zero and null vectors, a query's own id left out."""
    monkeypatch.setattr(retrieval, "CELL_ROWS", cell)
    monkeypatch.setattr(retrieval, "ROWS_AT_ONCE", 1)
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(6).tolist()) for i in range(90)]
    rows += [(200 + i, rows[7][1]) for i in range(12)] + [(300, [0.0] * 6), (301, None)]
    got = retrieval.nearest_others(spark.createDataFrame(rows, "item_id long, vector array<double>"), 5)
    got = {(x.query_id, x["rank"]): x.item_id for x in got.collect()}
    unit = {i: np.array(v or [0.0] * 6) / (np.linalg.norm(v or [0.0]) or 1) for i, v in rows}
    want = {}
    for q, v in rows:
        best = sorted((i for i in unit if i != q), key=lambda i: (round(1 - float(unit[q] @ unit[i]), 12), i))[:5]
        want |= {(q, n + 1): i for n, i in enumerate(best) if v is not None}
    assert got == want


def test_all_embeddings_ask(spark):
    rows = read_table(spark, "/root/testdata/sf0.001", "embeddings")
    found = lookup.e2_all(spark, "/root/testdata/sf0.001").select("query_id").distinct()
    assert found.count() == rows.where("embedding is not null").count() > 50


def test_few_cells_where_vectors_lie_in_clusters():
    r = np.random.default_rng(4)
    heads = r.standard_normal((40, 16))
    rows = heads[r.integers(0, 40, 3000)] + 0.1 * r.standard_normal((3000, 16))
    assert vectors.probes_needed(rows, vectors.fit_centres(rows, 40)) <= 4
    loose = r.standard_normal((3000, 16))
    assert vectors.probes_needed(loose, vectors.fit_centres(loose, 40)) > 8


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_on_embeddings(spark, folder):
    rows = read_table(spark, f"/root/testdata/{folder}", "embeddings").selectExpr("vec_id", "embedding as vector")
    asked, items = rows.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), rows.withColumnRenamed("vec_id", "item_id")
    pairs = lambda d: {(r.query_id, r.item_id) for r in d.collect()}
    got, want = pairs(vectors.probe_topk(asked, vectors.build_index(items), 5)), pairs(retrieval.cosine_topk(asked, items, 5))
    assert len(got & want) >= 0.9 * len(want)


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, vector array<double>")
    assert vectors.build_index(none) is None
    some = vectors.build_index(spark.createDataFrame([(1, [1.0, 0.0])], "item_id long, vector array<double>"))
    assert vectors.probe_topk(none.withColumnRenamed("item_id", "query_id"), some, 3).collect() == []
