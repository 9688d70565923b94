"""Vocabulary, hospital, receipt and labelled-case files. Readers give valid rows and violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The columns of the vocabulary files; dates are ISO or yyyyMMdd.
VOCABULARY = {
    "concept": "concept_id long, concept_name string, domain_id string, vocabulary_id string, concept_class_id string, standard_concept string, concept_code string, valid_start_date date, valid_end_date date, invalid_reason string",
    "concept_relationship": "concept_id_1 long, concept_id_2 long, relationship_id string, valid_start_date date, valid_end_date date, invalid_reason string",
    "concept_ancestor": "ancestor_concept_id long, descendant_concept_id long, min_levels_of_separation int, max_levels_of_separation int",
    "vocabulary": "vocabulary_id string, vocabulary_name string, vocabulary_reference string, vocabulary_version string, vocabulary_concept_id long",
    "domain": "domain_id string, domain_name string, domain_concept_id long",
    "concept_class": "concept_class_id string, concept_class_name string, concept_class_concept_id long",
}


def read_vocabulary(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A tab-delimited vocabulary file or folder without quotes, empty fields null. A missing file, an empty
    table or a number that is none fails; a date that is none is null."""
    fields = [f.split() for f in VOCABULARY[table].split(", ")]
    text = spark.read.csv(path, schema=", ".join(f"{n} string" for n, _ in fields), sep="\t", header=True, quote="", escape="", nullValue="", enforceSchema=False)

    def typed(name: str, kind: str) -> Column:
        if kind == "date":
            value = F.coalesce(F.try_to_timestamp(name, F.lit("yyyy-MM-dd")), F.try_to_timestamp(name, F.lit("yyyyMMdd")))
            return value.cast("date").alias(name)
        if kind == "string":
            return F.col(name)
        value = F.expr(f"try_cast({name} as {kind})")
        bad = F.raise_error(F.concat(F.lit(f"{table}.{name} is no number: "), name)).cast(kind)
        return F.when(value.isNull() & F.col(name).isNotNull(), bad).otherwise(value).alias(name)

    if text.isEmpty():
        raise ValueError(f"{table} has no rows")
    return text.select(*[typed(*f) for f in fields])


def read_vocabularies(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every table of ``VOCABULARY`` from ``folder``, whose files are named after the tables in capitals; all must be
    there before any is read. Publish them as one version, so that a reader never sees tables of two releases."""
    paths = {table: f"{folder.rstrip('/')}/{table.upper()}.csv" for table in VOCABULARY}
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    missing = [p for p in paths.values() if not jvm(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm(p))]
    if missing:
        raise FileNotFoundError("vocabulary files are missing: " + ", ".join(missing))
    return {table: read_vocabulary(spark, path, table) for table, path in paths.items()}


# The hospital file's contract.
HOSPITAL_VERSION = "hospital-csv-v1"
HOSPITAL_REQUIRED = ("schema_version", "record_id", "domain", "source_value")
HOSPITAL_CONTEXT = ("source_system", "source_code", "unit", "specimen", "route", "dose", "event_date")
HOSPITAL_DOMAINS = {
    "condition": "condition_occurrence",
    "condition_occurrence": "condition_occurrence",
    "drug": "drug_exposure",
    "drug_exposure": "drug_exposure",
    "medication": "drug_exposure",
    "measurement": "measurement",
    "lab": "measurement",
    "laboratory": "measurement",
    "observation": "observation",
    "procedure": "procedure_occurrence",
    "procedure_occurrence": "procedure_occurrence",
    "device": "device_exposure",
    "device_exposure": "device_exposure",
}
RECORD_ID = "^[A-Za-z0-9][A-Za-z0-9._:-]{0,99}$"
LONGEST_SOURCE, LONGEST_CONTEXT = 500, 200
_HOSPITAL = (*HOSPITAL_REQUIRED, *HOSPITAL_CONTEXT)
#: What stands around a value and is no part of it.
_BLANKS = "".join(filter(str.isspace, map(chr, range(0x3001))))


def read_hospital_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a hospital file (comma, semicolon or tab, told by the header; a byte-order mark is
    dropped) under its contract: valid rows with target_table, and (record_id, violation) for the others,
    by the first rule that a row breaks. A header that breaks the contract fails. A quoted field may hold line breaks and
    doubled quotes, so a record is no line and a file is one task: many files are read side by side, one is not split."""
    # the first line of every file; all files of a folder have the same header
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header")).select(F.ltrim("header", F.lit("\ufeff")).alias("header")).distinct().limit(2).collect()
    if len(first) > 1:
        raise ValueError("files with different headers")
    header = first[0][0] if first else ""
    sep = max((",", ";", "\t"), key=header.count)
    names = [n.strip().strip('"') for n in header.split(sep)]
    if len(names) != len(set(names)):
        raise ValueError("doubled column names")
    if set(HOSPITAL_REQUIRED) - set(names) or set(names) - set(_HOSPITAL):
        raise ValueError("columns missing or unknown")
    schema = ", ".join(f"`{n}` string" for n in names) + ", _corrupt string"
    rows = spark.read.csv(path, schema=schema, sep=sep, header=True, escape='"', multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", enforceSchema=True)
    # a short line counts as damaged for Spark too, but is read with blanks here
    fields = F.size(F.split(F.regexp_replace("_corrupt", '"[^"]*"', ""), sep, -1))
    return check_hospital_rows(rows.withColumn("_corrupt", F.when(fields > len(names), F.col("_corrupt"))))


def check_hospital_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As above, for rows that are parsed already; ``_corrupt`` holds a line with extra fields."""
    present = [c for c in _HOSPITAL if c in rows.columns]
    clean = rows.select(*[F.trim(F.coalesce(F.col(c), F.lit("")), F.lit(_BLANKS)).alias(c) for c in present], F.col("_corrupt"))
    key = F.replace(F.lower("domain"), F.lit(" "), F.lit("_"))
    domain = F.coalesce(*[F.when(key == d, t) for d, t in HOSPITAL_DOMAINS.items()])
    early = (
        F.when(F.col("_corrupt").isNotNull(), "EXTRA_FIELDS")
        .when(F.contains(F.concat(*present), F.lit("\0")), "NUL_BYTE")
        .when(F.col("schema_version") != HOSPITAL_VERSION, "SCHEMA_VERSION")
        .when(~F.col("record_id").rlike(RECORD_ID), "RECORD_ID")
    )
    clean = clean.withColumn("target_table", domain).withColumn("_early", early)
    # stable where ids repeat: the row with the least content stays; rows without a valid id aren't ranked
    order = Window.partitionBy("record_id").orderBy(*present)
    ranked = clean.where("_early is null").withColumn("_n", F.row_number().over(order))
    clean = ranked.unionByName(clean.where("_early is not null").withColumn("_n", F.lit(1)))
    long_ = F.lit(False)
    for c in HOSPITAL_CONTEXT:
        if c in present:
            long_ = long_ | (F.length(c) > LONGEST_CONTEXT)
    rule = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(F.col("_n") > 1, "DUPLICATE_RECORD_ID")
        .when(F.col("target_table").isNull(), "DOMAIN")
        .when(F.col("source_value") == "", "EMPTY_SOURCE_VALUE")
        .when(F.length("source_value") > LONGEST_SOURCE, "TOO_LONG")
    )
    if "event_date" in present:
        good = F.col("event_date").rlike(r"^\d{4}-\d\d-\d\d$") & F.try_to_timestamp("event_date", F.lit("yyyy-MM-dd")).isNotNull()
        rule = rule.when((F.col("event_date") != "") & ~good, "EVENT_DATE")
    rule = rule.when(long_, "TOO_LONG")
    judged = clean.withColumn("violation", rule)
    valid = judged.where("violation is null").select(*present, "target_table")
    return valid, judged.where("violation is not null").select("record_id", "violation")


def hospital_summary(valid: DataFrame) -> DataFrame:
    """(target_table, n, fields): rows and context fields present."""
    context = [c for c in HOSPITAL_CONTEXT if c in valid.columns]
    present = F.array_compact(F.array(*[F.when(F.max(F.col(c) != ""), F.lit(c)) for c in context]))
    return valid.groupBy("target_table").agg(F.count(F.lit(1)).alias("n"), F.array_join(present, ",").alias("fields"))


# The receipts' contract.
RECEIPT = ("schema_version", "ingestion_run_id", "input_manifest_sha256", "source_adapter", "source_system", "source_code", "source_record_key", "target_table", "target_id")
RUN_ID, ADAPTER, DIGEST = "^RUN-[A-Za-z0-9][A-Za-z0-9._-]{0,95}$", "^[a-z0-9][a-z0-9._-]{0,49}$", "^[0-9a-f]{64}$"
SYSTEM, LONGEST_CODE = "^[A-Z0-9][A-Z0-9._:-]{0,99}$", 50
MOST_RECEIPTS = 10_000


def read_receipts(spark: SparkSession, path: str, version: str) -> tuple[DataFrame, DataFrame]:
    """Receipt files, a batch (a JSON array) each, named by their place; as ``check_receipts`` judges them."""
    files = spark.read.text(path, wholetext=True)
    return check_receipts(files.select(F.col("_metadata.file_path").alias("batch_id"), F.col("value").alias("json")), version)


def check_receipts(batches: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """Receipts of the schema ``version`` in ``batches`` (batch_id, json: an array of objects): valid rows with receipt_id, the digest of
    their canonical JSON, and (batch_id, pos, violation) by the first rule that a receipt breaks. A receipt has
    exactly the fields of ``RECEIPT``; a batch holds 10,000 at most."""
    items = batches.select("batch_id", F.from_json("json", "array<string>").alias("items"))
    whole = items.where(F.col("items").isNull() | (F.size("items") > MOST_RECEIPTS)).select("batch_id", F.lit(None).cast("int").alias("pos"), F.when(F.col("items").isNull(), "NOT_AN_ARRAY").otherwise("TOO_MANY").alias("violation"))
    each = items.where(F.size("items") <= MOST_RECEIPTS).select("batch_id", F.posexplode("items").alias("pos", "item"))
    schema = ", ".join(f"{f} {'long' if f == 'target_id' else 'string'}" for f in RECEIPT)
    parsed = each.withColumn("r", F.from_json("item", schema)).withColumn("keys", F.array_sort(F.json_object_keys("item")))
    fits = lambda field, pattern: F.coalesce(F.col(f"r.{field}").rlike(pattern), F.lit(False))
    violation = (
        F.when(~F.col("keys").eqNullSafe(F.array(*[F.lit(k) for k in sorted(RECEIPT)])), "FIELDS")
        .when(~F.col("r.schema_version").eqNullSafe(F.lit(version)), "SCHEMA_VERSION")
        .when(~fits("ingestion_run_id", RUN_ID), "RUN_ID")
        .when(~fits("input_manifest_sha256", DIGEST), "MANIFEST_DIGEST")
        .when(~F.coalesce(F.col("r.target_id") > 0, F.lit(False)), "TARGET_ID")
        .when(~fits("source_adapter", ADAPTER), "SOURCE_ADAPTER")
        .when(~fits("source_system", SYSTEM), "SOURCE_SYSTEM")
        .when(~F.coalesce(F.length(F.trim("r.source_code")).between(1, LONGEST_CODE), F.lit(False)), "SOURCE_CODE")
        .when(~F.coalesce(F.col("r.target_table").isin(*sorted(set(HOSPITAL_DOMAINS.values()))), F.lit(False)), "TARGET_TABLE")
        .when(~fits("source_record_key", DIGEST), "RECORD_KEY")
    )
    judged = parsed.withColumn("violation", violation)
    canonical = F.to_json(F.struct(*[F.col(f"r.{k}").alias(k) for k in sorted(RECEIPT)]))
    valid = judged.where("violation is null").select("batch_id", "pos", F.sha2(canonical.cast("binary"), 256).alias("receipt_id"), "r.*")
    return valid, whole.unionByName(judged.where("violation is not null").select("batch_id", "pos", "violation"))


CASE = "case_id long, family_id string, split string, domain string, decision string, concept_id long"


def read_cases(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Labelled cases of a JSON-lines file, and (subject, violation): shapes, doubled ids, families and
    concepts that lie in more than one split."""
    return check_cases(spark.read.schema(CASE).json(path))


def check_cases(cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    shape = F.col("case_id").isNull() | F.col("split").isNull() | ((F.col("decision") == "MAP") != F.col("concept_id").isNotNull())
    one = lambda df, key, what: df.select(F.col(key).cast("string").alias("subject"), F.lit(what).alias("violation"))
    bad = one(cases.where(shape), "case_id", "SHAPE")
    bad = bad.unionByName(one(cases.groupBy("case_id").count().where("count > 1"), "case_id", "DUPLICATE_ID"))
    for key, what in (("family_id", "FAMILY_LEAK"), ("concept_id", "CONCEPT_LEAK")):
        leaks = cases.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct("split").alias("n")).where("n > 1")
        bad = bad.unionByName(one(leaks, key, what))
    return cases.where(~shape), bad
