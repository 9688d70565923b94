"""Connected components of a large edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.session import store


def _least(df: DataFrame, key: str, value: str) -> DataFrame:
    # stored, so that the join below reads both sides through exchanges that skew handling may split
    return store(df.groupBy(F.col(key).alias("node")).agg(F.min(value).alias("low")), "star")


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long), component being the smallest node
    reachable. Large-star and small-star rounds alternate until nothing changes; each is a grouped
    minimum and a join, so no group is gathered in a task. Loops and repeated edges do no harm, edges
    with a null end are left out, no edges give no rows."""
    pairs = (
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    now = store(pairs, "edges")
    print_of = F.struct(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)))
    seen = now.agg(print_of).first()[0]
    for _ in range(max_rounds):
        if not seen[0]:
            break
        # large star: each larger neighbour of a node moves to the node's least neighbour
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _least(both, "u", "v")
        large = (
            now.select(F.col("v").alias("node"), F.col("u").alias("big"))
            .join(low, "node")
            .select(F.col("big").alias("u"), F.least("node", "low").alias("v"))
            .distinct()
        )
        large = store(large, "edges")
        # small star: a node and its smaller neighbours move to the least of them
        low = _least(large, "u", "v")
        moved = large.join(low, large["u"] == low["node"]).select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = moved.unionByName(low.select(F.col("node").alias("u"), F.col("low").alias("v")))
        now = store(small.where("u <> v").distinct(), "edges")
        after = now.agg(print_of).first()[0]
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("components did not settle")
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return ends.unionByName(roots)
