"""Tables on disk in slices, of which a change rewrites only those that it touches.

A version is a folder with the slices that its run wrote and a manifest (slice, folder) of all slices of the table, written
by this run or carried from earlier ones. The pointer of ``tables.point`` names the newest version, so readers see the old
table or the new one whole, and a run that fails leaves the old one. Slices are named by the digest of their values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.sources import tables

_DATA, _MANIFEST, _SLICE = "data", "manifest", "_slice"


def slice_name(columns: list[str]) -> Column:
    """Names a row's slice; null is a value of its own."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.substring(F.sha2(F.to_json(F.array(*parts)), 256), 1, 24)


def bucket_name(keys: list[str], buckets: int) -> Column:
    """A slice by the keys' hash, for tables without a column to slice by."""
    return F.concat(F.lit("b"), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"))


def _newest(spark: SparkSession, path: str) -> str | None:
    folder, fs = tables._files(spark, path)
    if not fs.exists(folder) or not any(s.getPath().getName().startswith("pointer-") for s in fs.listStatus(folder)):
        return None
    pointers = spark.read.text(f"{path}/pointer-*").select(F.col("_metadata.file_name").alias("name"), "value")
    return pointers.agg(F.max_by("value", "name")).first()[0]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(slice, folder) of the newest version."""
    return spark.read.parquet(f"{_newest(spark, path)}/{_MANIFEST}")


def read(spark: SparkSession, path: str, only: DataFrame | None = None) -> DataFrame:
    """The table, or its slices that ``only`` (slice) names. The folders' names, one a slice, pass through the driver."""
    listed = manifest(spark, path)
    wanted = listed if only is None else listed.join(only, "slice", "left_semi")
    folders = sorted(r.folder for r in wanted.select("folder").distinct().collect())
    if not folders:  # the schema of any slice
        any_of = [r.folder for r in listed.limit(1).collect()]
        return spark.read.parquet(*any_of).limit(0)
    return spark.read.parquet(*folders)


def _publish(spark: SparkSession, path: str, version: str, rows: DataFrame, carried: DataFrame | None) -> str:
    """Writes ``rows`` (with ``_slice``) and the manifest of them and of ``carried``, and points to the version."""
    try:
        rows.write.partitionBy(_SLICE).parquet(f"{version}/{_DATA}")
        folder, fs = tables._files(spark, f"{version}/{_DATA}")
        names = [s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(folder) if s.getPath().getName().startswith(f"{_SLICE}=")]
        own = spark.createDataFrame([(n, f"{version}/{_DATA}/{_SLICE}={n}") for n in names], "slice string, folder string")
        whole = own if carried is None else own.unionByName(carried.select("slice", "folder"))
        whole.coalesce(1).write.parquet(f"{version}/{_MANIFEST}")
        tables.point(spark, path, version)
    except BaseException:
        tables.drop(spark, version)
        raise
    return version


def replace_slices(path: str, incoming: DataFrame, name: Column) -> str:
    """The table at ``path`` with each slice that ``incoming`` has rows of replaced by them; others are carried as they are.
    ``name`` is what ``slice_name`` or ``bucket_name`` gives. Without a table there it is made."""
    spark = incoming.sparkSession
    rows = incoming.withColumn(_SLICE, name)
    carried = None
    if _newest(spark, path) is not None:
        carried = manifest(spark, path).join(rows.select(F.col(_SLICE).alias("slice")).distinct(), "slice", "left_anti")
    return _publish(spark, path, tables.new_version(path), rows, carried)


def upsert_slices(path: str, incoming: DataFrame, keys: list[str], update_cols: list[str], name: Column) -> str:
    """As ``tables.upsert`` for the table at ``path``: the slices that incoming rows fall into are read, merged and written
    anew. ``name`` depends on ``keys`` alone, so that a row's old and new form lie in one slice."""
    spark = incoming.sparkSession
    touched = incoming.select(name.alias("slice")).distinct()
    merged = tables.upsert(read(spark, path, touched), incoming, keys, update_cols)
    carried = manifest(spark, path).join(touched, "slice", "left_anti")
    return _publish(spark, path, tables.new_version(path), merged.withColumn(_SLICE, name), carried)


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Deletes the slices that the newest version does not use, and gives their folders; readers of older versions must be done."""
    used = {r.folder.rstrip("/").split("://")[-1] for r in manifest(spark, path).collect()}
    newest = _newest(spark, path).split("/")[-1]
    folder, fs = tables._files(spark, path)
    gone = []
    for version in [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("version-")]:
        data = tables._files(spark, f"{path}/{version.getName()}/{_DATA}")[0]
        slices = [s.getPath() for s in fs.listStatus(data) if s.isDirectory()] if fs.exists(data) else []
        dead = [s for s in slices if f"{path}/{version.getName()}/{_DATA}/{s.getName()}".split("://")[-1] not in used]
        for s in dead:
            fs.delete(s, True)
            gone.append(s.toString())
        if len(dead) == len(slices) and version.getName() != newest:
            fs.delete(version, True)
    return gone
