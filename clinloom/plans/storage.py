"""Registered queries: files and tables. The files are written by Spark from the test tables first."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clinloom.plans.binding import Clinic, oracle
from clinloom.plans.registry import query
from clinloom.session import shared_dir
from clinloom.sources import files, slices, tables


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("a2", oracle("select concept_id, concept_name, domain_id, concept_code, date '1970-01-01' as valid_start_date, date '2099-12-31' as valid_end_date, invalid_reason from concept", "concept"))
def a2(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    day = F.when(F.col("concept_id") % 2 == 0, "19700101").otherwise("1970-01-01")
    rows = c.concept.withColumns({"valid_start_date": day, "valid_end_date": F.lit("20991231")})
    names = [f.split()[0] for f in files.VOCABULARY["concept"].split(", ")]
    path = _folder(spark, "vocabulary")
    rows.select(*[F.col(n).cast("string") for n in names]).write.csv(path, sep="\t", header=True, quote="", nullValue="")
    return files.read_vocabulary(spark, path, "concept").select("concept_id", "concept_name", "domain_id", "concept_code", "valid_start_date", "valid_end_date", "invalid_reason")


A2_TABLES = oracle("""select 'concept' as table_name, concept_id as id, concept_name as name from concept union all select 'concept_relationship', concept_id_1, relationship_id || concept_id_2 from relationship
union all select 'concept_ancestor', ancestor_id, cast(descendant_id as varchar) from ancestor union all select 'vocabulary', s_suppkey, s_name from supplier union all select 'domain', c_custkey, c_name from customer
union all select 'concept_class', p_partkey, p_name || p_partkey from part""", "concept", "relationship", "ancestor")


@query("a2_tables", A2_TABLES)
def a2_tables(spark, sf_dir):
    """All six files of a vocabulary release, written first and read together."""
    c, folder = Clinic(spark, sf_dir), _folder(spark, "release")
    day, none = F.lit("20200101"), F.lit(None).cast("string")
    days = {"valid_start_date": day, "valid_end_date": F.lit("20991231")}
    of = lambda name, **columns: c.raw(name).select(*[F.expr(e).alias(k) for k, e in columns.items()])
    made = {
        "concept": c.concept.withColumns(days),
        "concept_relationship": c.relationship.withColumns(days),
        "concept_ancestor": c.ancestor.select(F.col("ancestor_id").alias("ancestor_concept_id"), F.col("descendant_id").alias("descendant_concept_id"), F.lit(0).alias("min_levels_of_separation"), F.lit(1).alias("max_levels_of_separation")),
        "vocabulary": of("supplier", vocabulary_id="concat('V', s_suppkey)", vocabulary_name="s_name", vocabulary_concept_id="s_suppkey").withColumns({"vocabulary_reference": none, "vocabulary_version": day}),
        "domain": of("customer", domain_id="concat('D', c_custkey)", domain_name="c_name", domain_concept_id="c_custkey"),
        "concept_class": of("part", concept_class_id="concat('C', p_partkey)", concept_class_name="concat(p_name, p_partkey)", concept_class_concept_id="p_partkey"),
    }
    for table, rows in made.items():
        names = [f.split()[0] for f in files.VOCABULARY[table].split(", ")]
        rows.select(*[F.col(n).cast("string") for n in names]).write.csv(f"{folder}/{table.upper()}.csv", sep="\t", header=True, quote="", nullValue="")
    keys = {
        "concept": ("concept_id", "concept_name"), "concept_relationship": ("concept_id_1", "concat(relationship_id, concept_id_2)"), "concept_ancestor": ("ancestor_concept_id", "cast(descendant_concept_id as string)"),
        "vocabulary": ("vocabulary_concept_id", "vocabulary_name"), "domain": ("domain_concept_id", "domain_name"), "concept_class": ("concept_class_concept_id", "concept_class_name"),
    }
    out = None
    for table, rows in files.read_vocabularies(spark, folder).items():
        key, name = keys[table]
        one = rows.select(F.lit(table).alias("table_name"), F.expr(key).alias("id"), F.expr(name).alias("name"))
        out = one if out is None else out.unionByName(one)
    return out


def _hospital(spark, sf_dir):
    key = F.col("p_partkey")
    rows = Clinic(spark, sf_dir).raw("part").select(
        F.when(key % 23 == 0, "v0").otherwise(files.HOSPITAL_VERSION).alias("schema_version"),
        F.when(key % 19 == 0, "?bad").when(key % 41 == 0, F.concat(F.lit("r"), (key - 41).cast("string"))).otherwise(F.concat(F.lit("r"), key.cast("string"))).alias("record_id"),
        F.when(key % 17 == 0, "billing").when(key % 2 == 0, "LAB").otherwise("medication").alias("domain"),
        F.when(key % 13 == 0, " ").when(key % 31 == 0, F.concat("p_name", F.lit('\nsecond "line"; 1'))).otherwise(F.col("p_name")).alias("source_value"),
        F.when(key % 11 == 0, F.repeat(F.lit("u"), 201)).otherwise("mg").alias("unit"),
        F.when(key % 7 == 0, "2024-02-30").when(key % 5 == 0, "2024-2-3").when(key % 3 == 0, "2024-02-03").alias("event_date"),
    )
    path = _folder(spark, "hospital")
    rows.write.csv(path, sep=";", header=True, escape='"')
    return files.read_hospital_csv(spark, path)


_HOSPITAL = """(select *, row_number() over (partition by record_id order by schema_version, record_id, domain, source_value, unit, event_date) as n from (select case when p_partkey % 23 = 0 then 'v0' else 'hospital-csv-v1' end as schema_version,
 case when p_partkey % 19 = 0 then '?bad' when p_partkey % 41 = 0 then 'r' || (p_partkey - 41) else 'r' || p_partkey end as record_id, case when p_partkey % 17 = 0 then 'billing' when p_partkey % 2 = 0 then 'LAB' else 'medication' end as domain,
 case when p_partkey % 13 = 0 then '' when p_partkey % 31 = 0 then p_name || chr(10) || 'second "line"; 1' else p_name end as source_value, case when p_partkey % 11 = 0 then repeat('u', 201) else 'mg' end as unit,
 case when p_partkey % 7 = 0 then '2024-02-30' when p_partkey % 5 = 0 then '2024-2-3' when p_partkey % 3 = 0 then '2024-02-03' else '' end as event_date from part))"""
_VIOLATION = """case when schema_version <> 'hospital-csv-v1' then 'SCHEMA_VERSION' when record_id = '?bad' then 'RECORD_ID' when n > 1 then 'DUPLICATE_RECORD_ID' when domain = 'billing' then 'DOMAIN' when source_value = '' then 'EMPTY_SOURCE_VALUE'
 when event_date not in ('', '2024-02-03') then 'EVENT_DATE' when length(unit) > 200 then 'TOO_LONG' end"""


@query("a3", f"select record_id, {_VIOLATION} as violation from {_HOSPITAL} where violation is not null")
def a3(spark, sf_dir):
    return _hospital(spark, sf_dir)[1]


@query("a3_valid", f"select record_id, domain, source_value, unit, case domain when 'LAB' then 'measurement' else 'drug_exposure' end as target_table from {_HOSPITAL} where {_VIOLATION} is null")
def a3_valid(spark, sf_dir):
    """Rows that keep the contract, some with line breaks, quotes and separators inside their fields."""
    return _hospital(spark, sf_dir)[0].select("record_id", "domain", "source_value", "unit", "target_table")


@query("d22", f"select target_table, count(*) as n, 'unit' || case when max(event_date) <> '' then ',event_date' else '' end as fields from (select *, case domain when 'LAB' then 'measurement' else 'drug_exposure' end as target_table from {_HOSPITAL} where {_VIOLATION} is null) group by 1")
def d22(spark, sf_dir):
    return files.hospital_summary(_hospital(spark, sf_dir)[0])


A4 = """with r as (select o_orderkey as k, o_orderkey // 1000 as batch_id, row_number() over (partition by o_orderkey // 1000 order by o_orderkey) - 1 as pos from orders)
select batch_id, cast(pos as int) as pos, case when k % 7 = 0 then 'FIELDS' when k % 31 = 0 then 'SCHEMA_VERSION' when k % 13 = 0 then 'RUN_ID' when k % 5 = 0 then 'MANIFEST_DIGEST' when k % 17 = 0 then 'TARGET_ID' when k % 19 = 0 then 'SOURCE_ADAPTER' when k % 23 = 0 then 'SOURCE_SYSTEM'
 when k % 29 = 0 then 'SOURCE_CODE' when k % 11 = 0 then 'TARGET_TABLE' when k % 37 = 0 then 'RECORD_KEY' end as violation from r where violation is not null"""


@query("a4", A4)
def a4(spark, sf_dir):
    key = F.col("o_orderkey")
    digest = F.sha2(key.cast("string").cast("binary"), 256)
    odd = lambda n, bad, good: F.when(key % n == 0, bad).otherwise(good)
    fields = {
        "schema_version": odd(31, "v0", F.lit("receipt-v1")),
        "ingestion_run_id": odd(13, "run 1", F.concat(F.lit("RUN-"), (key % 7).cast("string"))),
        "input_manifest_sha256": odd(5, "short", digest),
        "source_adapter": odd(19, "Bad Adapter", F.lit("csv")),
        "source_system": odd(23, "lab", F.lit("LAB")),
        "source_code": odd(29, " ", F.concat(F.lit("C"), key.cast("string"))),
        "source_record_key": odd(37, F.upper(digest), digest),
        "target_table": odd(11, "person", F.lit("measurement")),
        "target_id": odd(17, -key, key),
    }
    full = F.to_json(F.struct(*[fields[n].alias(n) for n in files.RECEIPT]))
    cut = F.to_json(F.struct(key.alias("target_id"), F.lit("x").alias("target_table")))
    rows = Clinic(spark, sf_dir).raw("orders").select(F.floor(key / 1000).alias("batch_id"), F.struct(key, F.when(key % 7 == 0, cut).otherwise(full).alias("item")).alias("row"))
    items = F.transform(F.array_sort(F.collect_list("row")), lambda r: r["item"])
    batches = rows.groupBy("batch_id").agg(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")).alias("json"))
    return files.check_receipts(batches, "receipt-v1")[1]


A5 = """with k as (select * replace (case when case_id % 20 = 1 then null else expected_id end as expected_id) from cases)
select cast(case_id as varchar) as subject, 'SHAPE' as violation from k where (expected_decision = 'MAP') <> (expected_id is not null)
union all select family_id, 'FAMILY_LEAK' from k group by 1 having count(distinct split) > 1 union all select cast(expected_id as varchar), 'CONCEPT_LEAK' from k where expected_id is not null group by 1 having count(distinct split) > 1"""


@query("a5", oracle(A5, "cases"))
def a5(spark, sf_dir):
    rows = Clinic(spark, sf_dir).cases.select("case_id", "family_id", "split", "domain", F.col("expected_decision").alias("decision"), F.when(F.col("case_id") % 20 != 1, F.col("expected_id")).alias("concept_id"))
    path = _folder(spark, "cases")
    rows.write.json(path)
    return files.read_cases(spark, path)[1]


A6 = """select 'visit_occurrence' as table_name, field, violation, n from (select 'start_date' as field, 'NULL' as violation, count(*) filter (where visit_id % 9 = 0) + count(*) filter (where visit_id % 900 = 0) as n from visit
 union all select 'visit_id', 'DUPLICATE_KEY', count(*) filter (where visit_id % 100 = 0) from visit union all select 'visit_concept_id', 'TYPE', 1)"""


@query("a6", oracle(A6, "visit"))
def a6(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    visits = c.visit.select("visit_id", "person_id", F.lit(0).alias("visit_concept_id"), F.when(F.col("visit_id") % 9 != 0, F.col("start_date")).alias("start_date"), "end_date")
    return tables.schema_violations(visits.unionByName(visits.where("visit_id % 100 = 0")), "visit_occurrence")


@query("a7", oracle("select visit_id, person_id, start_date, end_date from visit", "visit"))
def a7(spark, sf_dir):
    path, visits = _folder(spark, "published"), Clinic(spark, sf_dir).visit.select("visit_id", "person_id", "start_date", "end_date")
    tables.publish(visits.where("visit_id % 2 = 0"), path)
    tables.publish(visits, path, lambda written: written.where("end_date < start_date"))
    return tables.read_published(spark, path)


_LEFT, _RIGHT = "(select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders where o_orderkey % 3 <> 0)", "(select o_orderkey, o_custkey + 1 as o_custkey, 'X' as o_orderstatus, 'new' as o_orderpriority from orders where o_orderkey % 4 = 0)"


def _sides(spark, sf_dir):
    orders = Clinic(spark, sf_dir).raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    new = orders.where("o_orderkey % 4 = 0").withColumns({"o_custkey": F.col("o_custkey") + 1, "o_orderstatus": F.lit("X"), "o_orderpriority": F.lit("new")})
    return orders.where("o_orderkey % 3 <> 0"), new


@query("a8", "select o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderstatus <> 'F' union all select o_orderkey, o_orderstatus, 'again' from orders where o_orderstatus = 'F' and o_orderkey % 4 = 0")
def a8(spark, sf_dir):
    orders = Clinic(spark, sf_dir).raw("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return tables.replace_slice(orders, orders.where("o_orderstatus = 'F' and o_orderkey % 4 = 0").withColumn("o_orderpriority", F.lit("again")), ["o_orderstatus"])


A8_DISK = "select o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderstatus <> 'F' or o_orderpriority <> '1-URGENT' union all select o_orderkey, o_orderstatus, 'again' from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT' and o_orderkey % 4 = 0"


@query("a8_disk", A8_DISK)
def a8_disk(spark, sf_dir):
    """Slices by status and priority on disk; one is replaced, the others' files are carried."""
    orders = Clinic(spark, sf_dir).raw("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path, name = _folder(spark, "slices"), slices.slice_name(["o_orderstatus", "o_orderkind"])
    slices.replace_slices(path, orders.withColumn("o_orderkind", F.col("o_orderpriority")), name)
    new = orders.where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT' and o_orderkey % 4 = 0")
    slices.replace_slices(path, new.withColumns({"o_orderkind": F.col("o_orderpriority"), "o_orderpriority": F.lit("again")}), name)
    return slices.read(spark, path).drop("o_orderkind")


@query("a9", f"select coalesce(l.o_orderkey, r.o_orderkey) as o_orderkey, case when l.o_orderkey is null then r.o_custkey else l.o_custkey end as o_custkey, coalesce(r.o_orderstatus, l.o_orderstatus) as o_orderstatus, coalesce(r.o_orderpriority, l.o_orderpriority) as o_orderpriority from {_LEFT} l full join {_RIGHT} r on l.o_orderkey = r.o_orderkey")
def a9(spark, sf_dir):
    return tables.upsert(*_sides(spark, sf_dir), ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@query("a9_disk", f"select coalesce(l.o_orderkey, r.o_orderkey) as o_orderkey, case when l.o_orderkey is null then r.o_custkey else l.o_custkey end as o_custkey, coalesce(r.o_orderstatus, l.o_orderstatus) as o_orderstatus, coalesce(r.o_orderpriority, l.o_orderpriority) as o_orderpriority from {_LEFT} l full join {_RIGHT} r on l.o_orderkey = r.o_orderkey")
def a9_disk(spark, sf_dir):
    """The upsert of a9 on a table on disk, in sixteen slices by key."""
    old, new = _sides(spark, sf_dir)
    path, name = _folder(spark, "upserts"), slices.bucket_name(["o_orderkey"], 16)
    slices.replace_slices(path, old, name)
    slices.upsert_slices(path, new, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"], name)
    return slices.read(spark, path)


@query("a10", f"select * from {_LEFT} union all select * from {_RIGHT} where o_orderkey not in (select o_orderkey from {_LEFT})")
def a10(spark, sf_dir):
    return tables.append_absent(*_sides(spark, sf_dir), ["o_orderkey"])


@query("a11", oracle("select person_id, gender_concept_id, year_of_birth, cast(null as int) as month_of_birth, cast(null as int) as day_of_birth, cast(null as varchar) as race, cast(null as varchar) as ethnicity from person", "person"))
def a11(spark, sf_dir):
    return tables.add_missing_columns(Clinic(spark, sf_dir).person, tables.cdm_schema("person"))
