"""Slices on disk: what is rewritten, what is carried, and what a failure leaves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clinloom.sources import slices

NAME = ["run"]
KIND = "run string, k long, v string"


def folders(spark, path):
    return {r.slice: r.folder for r in slices.manifest(spark, path).collect()}


def content(spark, path):
    return sorted(map(tuple, slices.read(spark, path).collect()), key=repr)


def test_replace_touches_only_its_slices(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = [("a", 1, "x"), ("a", 2, None), ("b", 3, "y"), (None, 4, "z"), ("", 5, "e")]
    first = slices.replace_slices(path, spark.createDataFrame(rows, KIND), slices.slice_name(NAME))
    assert content(spark, path) == sorted(rows, key=repr)
    before = folders(spark, path)
    assert len(before) == 4
    new = [("b", 7, "n"), ("c", 8, "m")]
    second = slices.replace_slices(path, spark.createDataFrame(new, KIND), slices.slice_name(NAME))
    after, want = folders(spark, path), sorted([r for r in rows if r[0] != "b"] + new, key=repr)
    assert content(spark, path) == want
    assert sum(f.startswith(second) for f in after.values()) == 2 and sum(f.startswith(first) for f in after.values()) == 3
    # nothing but the touched slices was written
    assert len(list((tmp_path / "t" / second.rsplit("/", 1)[1] / "data").glob("_slice=*"))) == 2
    # again: the same table
    slices.replace_slices(path, spark.createDataFrame(new, KIND), slices.slice_name(NAME))
    assert content(spark, path) == want
    gone = slices.vacuum(spark, path)
    assert len(gone) == 3 and content(spark, path) == want


def test_upsert_reads_and_writes_touched_buckets(spark, tmp_path):
    path, name = f"file://{tmp_path}/u", slices.bucket_name(["k"], 8)
    slices.replace_slices(path, spark.range(100).selectExpr("'a' run", "id k", "'old' v"), name)
    before = folders(spark, path)
    new = spark.createDataFrame([("b", 5, "new"), ("b", 500, "new")], KIND)
    for _ in range(2):
        slices.upsert_slices(path, new, ["k"], ["v"], name)
        got = {r.k: (r.run, r.v) for r in slices.read(spark, path).collect()}
        assert got == {k: ("a", "old") for k in range(100)} | {5: ("a", "new"), 500: ("b", "new")}
    after = folders(spark, path)
    assert sum(before[s] != after[s] for s in before) <= 2


def test_a_failed_run_keeps_the_old_table(spark, tmp_path):
    path = f"file://{tmp_path}/f"
    slices.replace_slices(path, spark.createDataFrame([("a", 1, "x")], KIND), slices.slice_name(NAME))
    bad = spark.createDataFrame([("a", 2, "y")], KIND).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        slices.replace_slices(path, bad, slices.slice_name(NAME))
    assert content(spark, path) == [("a", 1, "x")]
    assert len(list((tmp_path / "f").glob("version-*"))) == 1
    none = spark.createDataFrame([], KIND)
    slices.replace_slices(path, none, slices.slice_name(NAME))
    assert content(spark, path) == [("a", 1, "x")]
