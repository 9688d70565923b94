"""An inverted file of vectors: cells around centres, probed by an equi join."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.operators.retrieval import as_matrix
from clinloom.session import ship_package, store

#: Vectors that the centres are fitted on, the least by a hash of their id, and centres at most.
SAMPLE_VECTORS, MOST_CELLS = 20_000, 1_024
#: Cells are probed until so large a share of the nearest TUNED_K of TUNED_QUERIES sample vectors, in the sample, lies in them.
TARGET_RECALL, TUNED_QUERIES, TUNED_K = 0.95, 512, 5
#: Rows of a cell that one task searches, about, and queries that it holds scores for at once.
PART_ROWS, QUERIES_AT_ONCE = 20_000, 512
_FOUND = "query_id long, item_id long, distance double"


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm == 0, 1, norm)


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Spherical k-means; a centre that loses its vectors stays where it was."""
    r = np.random.default_rng(seed)
    sample = _unit(sample)
    centres = sample[r.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(1)
        order = np.argsort(near, kind="stable")
        cell, first = np.unique(near[order], return_index=True)
        centres = centres.copy()
        centres[cell] = _unit(np.add.reduceat(sample[order], first))
    return centres


def probes_needed(sample: np.ndarray, centres: np.ndarray) -> int:
    """Cells that a query has to probe: few where vectors lie in clusters, many where they have no structure."""
    sample = _unit(sample)
    asked = sample[:: max(1, len(sample) // TUNED_QUERIES)]
    s = asked @ sample.T
    np.put_along_axis(s, (np.arange(len(asked)) * max(1, len(sample) // TUNED_QUERIES))[:, None], -2, 1)  # not itself
    nearest = np.argpartition(-s, min(TUNED_K, len(sample) - 1) - 1, axis=1)[:, :TUNED_K] if len(sample) > 1 else np.zeros((len(asked), 1), int)
    cell = (sample @ centres.T).argmax(1)
    place = np.argsort(np.argsort(-(asked @ centres.T), axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(place, cell[nearest], 1).ravel())
    return int(needed[min(len(needed) - 1, math.ceil(TARGET_RECALL * len(needed)))]) + 1


@dataclass(frozen=True)
class VectorIndex:
    """``rows`` (cell, part, item_id, vector): every vector in the cell of its nearest centre, a cell dealt into parts;
    ``parts`` (cell, parts) says into how many; ``probes`` cells give the recall aimed at."""

    centres: np.ndarray
    probes: int
    rows: DataFrame
    parts: DataFrame


def _with_cells(df: DataFrame, centres: np.ndarray, many: int) -> DataFrame:
    """A row of ``df`` (id, vector) for each of the ``many`` cells nearest to it."""
    ship_package(df.sparkSession)
    schema = "cell int, id long, vector array<double>"

    def run(batches):
        for b in batches:
            v = as_matrix(b.column(1), centres.shape[1])
            near = np.argsort(-np.round(v @ centres.T, 12), axis=1, kind="stable")[:, :many]
            n = near.shape[1]
            flat = pa.array(np.repeat(v, n, axis=0).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) * n + 1) * v.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int32)), b.column(0).take(pa.array(np.repeat(np.arange(len(v)), n))), lists], names=["cell", "id", "vector"])

    return df.mapInArrow(run, schema)


def build_index(items: DataFrame, cells: int | None = None) -> VectorIndex | None:
    """Indexes every row of ``items`` (item_id, vector); centres come from ``SAMPLE_VECTORS`` of them, twice the square root of the
    rows of them up to ``MOST_CELLS``. Null vectors, and those of another length, count as zero. None for an empty table."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("vector").cast("array<double>").alias("vector"))
    sample = rows.where("vector is not null").orderBy(F.xxhash64("item_id"), "item_id").limit(SAMPLE_VECTORS).toArrow()
    n = rows.count()
    if not sample.num_rows:
        return None
    vectors = sample.column(1).combine_chunks()
    width = len(vectors[0])
    cells = cells or max(1, min(MOST_CELLS, int(2 * math.sqrt(n)), sample.num_rows // 8))
    known = as_matrix(vectors, width)
    centres = fit_centres(known, cells)
    dealt = store(_with_cells(rows, centres, 1).withColumnRenamed("id", "item_id"), "cells")
    parts = dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts"))
    parts = store(parts, "cell-parts")
    return VectorIndex(centres, probes_needed(known, centres), dealt.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("item_id"), F.col("parts")).cast("int")).drop("parts"), parts)


def probe_topk(queries: DataFrame, index: VectorIndex, k: int, probes: int | None = None) -> DataFrame:
    """(query_id, item_id, distance, rank): the k nearest by cosine of ``queries`` (query_id, vector) among the rows of the
    ``probes`` cells nearest to each (the index's own number if none is given), ties by id. A query goes to each part of its cells, where exact cosines are taken."""
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("vector").cast("array<double>").alias("vector")).where("vector is not null")
    asked = _with_cells(asked, index.centres, probes or index.probes).withColumnRenamed("id", "query_id").join(index.parts, "cell")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    width = index.centres.shape[1]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if left.num_rows and right.num_rows:
            ids, v = right.column("item_id").to_numpy(), _unit(as_matrix(right.column("vector").combine_chunks(), width)).T
            asked_ids, q = left.column("query_id").to_numpy(), _unit(as_matrix(left.column("vector").combine_chunks(), width))
            n, found = min(k, len(ids)), []
            for at in range(0, len(q), QUERIES_AT_ONCE):
                s = np.round(q[at : at + QUERIES_AT_ONCE] @ v, 12)
                best = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, :n] if len(ids) < 4 * n else None
                if best is None:
                    # all that reach the n-th score, so that ties are settled by id
                    least = np.partition(s, len(ids) - n, axis=1)[:, len(ids) - n]
                    rows, cols = np.nonzero(s >= least[:, None])
                    order = np.lexsort((ids[cols], -s[rows, cols], rows))
                    rows, cols = rows[order], cols[order]
                    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < n
                    rows, cols = rows[keep], cols[keep]
                else:
                    rows, cols = np.repeat(np.arange(len(s)), n), best.ravel()
                found.append((asked_ids[at + rows], ids[cols], 1 - s[rows, cols]))
            out = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table(out, names=["query_id", "item_id", "distance"])

    near = asked.groupBy("cell", "part").cogroup(index.rows.groupBy("cell", "part")).applyInArrow(search, _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.round("distance", 12), "item_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
