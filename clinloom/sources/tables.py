"""Typed tables: schemas and their check, slices, upserts, and publication by version."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The tables that this library fills: columns with types, key first, ! marks required ones.
CDM = {
    "person": "person_id long!, gender_concept_id long!, year_of_birth int!, month_of_birth int, day_of_birth int, race string, ethnicity string",
    "visit_occurrence": "visit_id long!, person_id long!, visit_concept_id long!, start_date date!, end_date date!",
    "condition_occurrence": "event_id long!, person_id long!, concept_id long!, source_concept_id long, start_date date!, end_date date, visit_id long",
    "drug_exposure": "event_id long!, person_id long!, concept_id long!, source_concept_id long, start_date date!, end_date date!, visit_id long",
    "measurement": "event_id long!, person_id long!, concept_id long!, value double, unit_concept_id long, value_as_concept_id long, start_date date!, visit_id long",
    "observation": "event_id long!, person_id long!, concept_id long!, value_text string, start_date date!, visit_id long",
    "procedure_occurrence": "event_id long!, person_id long!, concept_id long!, start_date date!, visit_id long",
    "device_exposure": "event_id long!, person_id long!, concept_id long!, start_date date!, visit_id long",
    "observation_period": "person_id long!, start_date date!, end_date date!, method string!",
    "condition_era": "era_id long!, person_id long!, concept_id long!, start_date date!, end_date date!, occurrences long!",
    "drug_era": "era_id long!, person_id long!, ingredient_id long!, start_date date!, end_date date!, exposures long!, gap_days long!",
}


def cdm_schema(table: str) -> T.StructType:
    fields = [f.split() for f in CDM[table].split(", ")]
    return T.StructType([T.StructField(n, T._parse_datatype_string(t.rstrip("!")), not t.endswith("!")) for n, t in fields])


def schema_violations(df: DataFrame, table: str) -> DataFrame:
    """(table_name, field, violation, n): columns missing, of another type or out of order, nulls in
    required ones, and doubled keys; all counts in one pass."""
    schema, found = cdm_schema(table), []
    have = dict(df.dtypes)
    order = [c for c in df.columns if c in schema.fieldNames()]
    counts = []
    for f in schema.fields:
        if f.name not in have:
            found.append((table, f.name, "MISSING", 1))
        elif have[f.name] != f.dataType.simpleString():
            found.append((table, f.name, "TYPE", 1))
        elif not f.nullable:
            counts.append(F.struct(F.lit(f.name).alias("field"), F.lit("NULL").alias("violation"), F.count_if(F.col(f.name).isNull()).alias("n")))
    if order != [n for n in schema.fieldNames() if n in have]:
        found.append((table, "*", "ORDER", 1))
    key = schema.fieldNames()[0]
    if key in have:
        counts.append(F.struct(F.lit(key).alias("field"), F.lit("DUPLICATE_KEY").alias("violation"), (F.count(key) - F.count_distinct(key)).alias("n")))
    spark = df.sparkSession
    fixed = spark.createDataFrame(found, "table_name string, field string, violation string, n long")
    if not counts:
        return fixed
    counted = df.agg(F.array(*counts).alias("a")).select(F.explode("a").alias("x")).select(F.lit(table).alias("table_name"), "x.*").where("n > 0")
    return fixed.unionByName(counted)


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns of a table of ``CDM``, in order and typed."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in cdm_schema(table).fields])


def _files(spark: SparkSession, path: str):
    """A folder and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def new_version(path: str) -> str:
    return f"{path}/version-{uuid.uuid4().hex}"


def point(spark: SparkSession, path: str, version: str) -> None:
    """Makes ``version`` the one that readers of ``path`` see. Pointers are numbered files that are made once, so a
    reader sees the old version or the new one whole."""
    folder, fs = _files(spark, path)
    numbers = [int(s.getPath().getName().split("-")[1]) for s in fs.listStatus(folder) if s.getPath().getName().startswith("pointer-")]
    draft = _files(spark, f"{path}/draft-{uuid.uuid4().hex}")[0]
    out = fs.create(draft)
    out.write(bytearray(version.encode("utf-8")))
    out.close()
    if not fs.rename(draft, _files(spark, f"{path}/pointer-{max(numbers, default=0) + 1:08d}")[0]):
        raise RuntimeError("another writer published at the same time")


def drop(spark: SparkSession, version: str) -> None:
    """Deletes a version, if it is there."""
    folder, fs = _files(spark, version)
    fs.delete(folder, True)


def require_clean(spark: SparkSession, version: str, violations: DataFrame) -> None:
    """Deletes ``version`` and fails if ``violations`` has rows."""
    found = violations.limit(5).collect()
    if found:
        drop(spark, version)
        raise ValueError(f"the new version fails its checks: {[r.asDict() for r in found]}")


def publish(df: DataFrame, path: str, violations: DataFrame | Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Writes a new version below ``path`` and, if ``violations`` has no rows, points the table to it; a version that
    fails is deleted. A function gets the version as it was written."""
    spark, version = df.sparkSession, new_version(path)
    df.write.parquet(version)
    if violations is not None:
        require_clean(spark, version, violations(spark.read.parquet(version)) if callable(violations) else violations)
    point(spark, path, version)
    return version


def read_published(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """The version that the newest pointer names, or a table of it where it is a folder of tables."""
    pointers = spark.read.text(f"{path}/pointer-*").select(F.col("_metadata.file_name").alias("name"), "value")
    newest = pointers.agg(F.max_by("value", "name")).first()[0]
    return spark.read.parquet(f"{newest}/{table}" if table else newest)


def replace_slice(current: DataFrame, incoming: DataFrame, slice_cols: list[str]) -> DataFrame:
    """``current`` without the slices that ``incoming`` has, and ``incoming``."""
    slices = incoming.select(*[F.col(c).alias(f"_{c}") for c in slice_cols]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in slice_cols]
    return current.join(slices, same, "left_anti").unionByName(incoming)


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """``current`` with ``update_cols`` of rows with the same keys taken from ``incoming``, and its new rows
    whole. Other columns of known rows stay. ``incoming`` has one row a key."""
    rest = [c for c in current.columns if c not in keys]
    old = current.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in rest], F.lit(True).alias("_old"))
    new = incoming.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in rest], F.lit(True).alias("_new"))
    both = old.join(new, keys, "full")

    def pick(c: str):
        take_new = F.col("_new").isNotNull() if c in update_cols else F.col("_old").isNull()
        return F.when(take_new, F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c)

    picked = {c: pick(c) for c in rest}
    return both.select(*[picked.get(c, F.col(c)) for c in current.columns])


def append_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """``current``, and the rows of ``incoming`` whose key, nulls equal, it does not have."""
    known = current.select(*[F.col(c).alias(f"_{c}") for c in keys]).distinct()
    return current.unionByName(incoming.join(known, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys], "left_anti"))


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` that it lacks, as nulls; its own stay as they are."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns})
