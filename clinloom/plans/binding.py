"""Clinical views of the star-schema test tables: as DataFrames, and as DuckDB SQL for the oracles."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.functions.ids import hash_id
from clinloom.session import read_table, ship_package

TYPES = ("ECONOMY", "STANDARD", "PROMO", "SMALL", "MEDIUM", "LARGE")
DOMAINS = ("Condition", "Drug", "Measurement", "Observation", "Procedure", "Device")
AS_OF = "2010-01-01"

_TYPE_NO = "case p_type " + " ".join(f"when '{t}' then {i}" for i, t in enumerate(TYPES)) + " end"
_DOMAIN = "case p_type " + " ".join(f"when '{t}' then '{d}'" for t, d in zip(TYPES, DOMAINS, strict=True)) + " end"
_BRAND = "cast(substr(p_brand, 7) as bigint)"
_CLASS = "case substr(o_orderpriority, 1, 1) when '1' then 'EMER' when '2' then 'IMP' when '3' then 'AMB' when '4' then 'HH' else 'OTHER' end"

#: name: (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "person": (
        (),
        "select c_custkey as person_id, case c_custkey % 3 when 0 then 8507 when 1 then 8532 else 0 end as gender_concept_id,"
        " 1930 + c_custkey % 80 as year_of_birth from customer",
    ),
    "visit": (
        (),
        "select o_orderkey as visit_id, o_custkey as person_id, cast(o_orderdate as date) as start_date,"
        f" cast(o_orderdate as date) + cast(o_orderkey % 60 as int) as end_date, {_CLASS} as class_code from orders",
    ),
    "event": (
        (),
        "select cast('0x' || substr(sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 15) as bigint) as event_id,"
        " o_custkey as person_id, l_orderkey as order_key, l_linenumber as line_number, l_suppkey as supplier_id,"
        " 'PART' as vocabulary_id, cast(l_partkey as varchar) as code, cast(l_shipdate as date) as start_date,"
        " cast(l_shipdate as date) + cast(cast(l_quantity as int) % 15 as int) as end_date, l_quantity as value,"
        " case when l_linenumber = 5 then null when l_linestatus = 'O' then 'mg/dL' else 'zz' end as unit_code,"
        " case when l_linenumber = 6 then cast(l_suppkey as varchar) end as value_code,"
        " case when l_linenumber % 2 = 0 then case when l_linenumber = 4 then l_orderkey + 1 else l_orderkey end"
        " when l_linenumber = 7 then -l_orderkey - 1 end as encounter_ref,"
        " case l_returnflag when 'N' then 'final' when 'A' then 'amended' else 'entered-in-error' end as status,"
        " case when l_linenumber % 3 = 0 then 'Condition' else 'Observation' end as resource_type"
        " from lineitem join orders on l_orderkey = o_orderkey",
    ),
    "concept": (
        (),
        f"select 1000000 + p_partkey as concept_id, p_name as concept_name, {_DOMAIN} as domain_id, 'PART' as vocabulary_id, 'Source' as concept_class_id,"
        " cast(null as varchar) as standard_concept, cast(p_partkey as varchar) as concept_code, case when p_partkey % 17 = 0 then 'D' end as invalid_reason from part"
        f" union all select distinct 2000000 + {_BRAND} * 10 + {_TYPE_NO}, p_brand || ' ' || p_type, {_DOMAIN}, 'STD', 'Clinical', 'S', 'S' || cast({_BRAND} * 10 + {_TYPE_NO} as varchar), cast(null as varchar) from part"
        f" union all select distinct 3000000 + {_BRAND}, p_brand, 'Drug', 'STD', 'Ingredient', 'S', 'I' || cast({_BRAND} as varchar), cast(null as varchar) from part"
        " union all select 8840, 'milligram per deciliter', 'Unit', 'UCUM', 'Unit', 'S', 'mg/dL', cast(null as varchar)",
    ),
    "relationship": (
        (),
        f"select 1000000 + p_partkey as concept_id_1, 2000000 + {_BRAND} * 10 + {_TYPE_NO} as concept_id_2, 'Maps to' as relationship_id, case when p_partkey % 13 = 0 then 'D' end as invalid_reason from part"
        f" union all select 1000000 + p_partkey, 2000000 + {_BRAND} * 10 + ({_TYPE_NO} + 1) % 6, 'Maps to', cast(null as varchar) from part where p_partkey % 29 = 0",
    ),
    "ancestor": (
        (),
        f"select distinct 3000000 + {_BRAND} as ancestor_id, 2000000 + {_BRAND} * 10 + {_TYPE_NO} as descendant_id from part"
        f" union all select distinct 2000000 + {_BRAND} * 10 + {_TYPE_NO}, 2000000 + {_BRAND} * 10 + {_TYPE_NO} from part"
        f" union all select distinct 3000000 + {_BRAND}, 3000000 + {_BRAND} from part",
    ),
    # events with every current standard target of their code; a row with a null target when there is none
    "mapped": (
        ("event", "concept", "relationship"),
        "select e.*, s.concept_id as source_concept_id, t.concept_id as target_id, t.domain_id as target_domain, t.concept_class_id as target_class from event e"
        " left join concept s on s.vocabulary_id = e.vocabulary_id and s.concept_code = e.code and s.invalid_reason is null"
        " left join relationship r on r.concept_id_1 = s.concept_id and r.relationship_id = 'Maps to' and r.invalid_reason is null"
        " left join concept t on t.concept_id = r.concept_id_2 and t.standard_concept = 'S' and t.invalid_reason is null",
    ),
    # as above with source concepts that may be invalid
    "mapped_any": (
        ("event", "concept", "relationship"),
        "select e.*, s.concept_id as source_concept_id, t.concept_id as target_id, t.domain_id as target_domain, t.concept_class_id as target_class from event e"
        " left join concept s on s.vocabulary_id = e.vocabulary_id and s.concept_code = e.code"
        " left join relationship r on r.concept_id_1 = s.concept_id and r.relationship_id = 'Maps to' and r.invalid_reason is null"
        " left join concept t on t.concept_id = r.concept_id_2 and t.standard_concept = 'S' and t.invalid_reason is null",
    ),
    "condition": (
        ("mapped",),
        "select event_id, person_id, start_date, end_date, coalesce(target_id, 0) as concept_id, coalesce(source_concept_id, 0) as source_concept_id, code from mapped"
        " where target_domain = 'Condition' or target_id is null"
        " qualify row_number() over (partition by event_id order by case when target_domain = 'Condition' then 0 else 1 end, target_id nulls last) = 1",
    ),
    "drug": (
        ("mapped",),
        "select event_id, person_id, start_date, end_date, case when target_domain = 'Drug' then target_id else 0 end as concept_id, coalesce(source_concept_id, 0) as source_concept_id, code from mapped"
        " qualify row_number() over (partition by event_id order by target_id desc nulls last) = 1",
    ),
    # labelled cases with predictions
    "cases": (
        (),
        f"select p_partkey as case_id, {_DOMAIN} as domain, case when p_partkey % 5 < 3 then 'development' else 'held_out' end as split, p_brand as family_id,"
        f" case when p_partkey % 4 = 0 then 'ABSTAIN' else 'MAP' end as expected_decision, case when p_partkey % 4 <> 0 then 2000000 + {_BRAND} * 10 + {_TYPE_NO} end as expected_id,"
        " case when p_partkey % 7 = 0 then 'ABSTAIN' else 'MAP' end as raw_decision,"
        f" case when p_partkey % 7 = 0 then null when p_partkey % 3 = 0 then 2000000 + {_BRAND} * 10 + ({_TYPE_NO} + 1) % 6 else 2000000 + {_BRAND} * 10 + {_TYPE_NO} end as raw_id,"
        " (p_partkey * 37 % 101) / 100.0 as score, case when p_partkey % 7 <> 0 and (p_partkey * 37 % 101) / 100.0 >= 0.5 then 'MAP' else 'ABSTAIN' end as decision,"
        f" case when p_partkey % 6 = 0 then [2000000 + {_BRAND} * 10] else [2000000 + {_BRAND} * 10 + {_TYPE_NO}, 2000000 + {_BRAND} * 10] end as candidates from part",
    ),
}


def oracle(body: str, *views: str) -> str:
    """``body`` below the definitions of the views it names, and of those they read."""
    order: list[str] = []

    def add(name: str) -> None:
        for below in VIEWS[name][0]:
            add(below)
        if name not in order:
            order.append(name)

    for name in views:
        add(name)
    own = body.strip()
    parts = [f"{name} as ({VIEWS[name][1]})" for name in order]
    if own.lower().startswith("with "):
        return "with " + ", ".join([*parts, own[5:]])
    return ("with " + ", ".join(parts) + " " if parts else "") + own


class Clinic:
    """The views as DataFrames over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship_package(spark)
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.dir, name)

    @cached_property
    def person(self) -> DataFrame:
        key = F.col("c_custkey")
        gender = F.when(key % 3 == 0, 8507).when(key % 3 == 1, 8532).otherwise(0)
        return self.raw("customer").select(key.alias("person_id"), gender.alias("gender_concept_id"), (1930 + key % 80).alias("year_of_birth"))

    @cached_property
    def visit(self) -> DataFrame:
        start = F.to_date("o_orderdate")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("visit_id"),
            F.col("o_custkey").alias("person_id"),
            start.alias("start_date"),
            F.date_add(start, (F.col("o_orderkey") % 60).cast("int")).alias("end_date"),
            F.expr(_CLASS).alias("class_code"),
        )

    @cached_property
    def event(self) -> DataFrame:
        lines = self.raw("lineitem").join(self.raw("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        line, start = F.col("l_linenumber"), F.to_date("l_shipdate")
        return lines.select(
            hash_id(F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")).alias("event_id"),
            F.col("o_custkey").alias("person_id"),
            F.col("l_orderkey").alias("order_key"),
            line.alias("line_number"),
            F.col("l_suppkey").alias("supplier_id"),
            F.lit("PART").alias("vocabulary_id"),
            F.col("l_partkey").cast("string").alias("code"),
            start.alias("start_date"),
            F.date_add(start, (F.col("l_quantity").cast("int") % 15)).alias("end_date"),
            F.col("l_quantity").alias("value"),
            F.when(line == 5, None).when(F.col("l_linestatus") == "O", "mg/dL").otherwise("zz").alias("unit_code"),
            F.when(line == 6, F.col("l_suppkey").cast("string")).alias("value_code"),
            F.when(line == 4, F.col("l_orderkey") + 1).when(line % 2 == 0, F.col("l_orderkey")).when(line == 7, -F.col("l_orderkey") - 1).alias("encounter_ref"),
            F.when(F.col("l_returnflag") == "N", "final").when(F.col("l_returnflag") == "A", "amended").otherwise("entered-in-error").alias("status"),
            F.when(line % 3 == 0, "Condition").otherwise("Observation").alias("resource_type"),
        )

    @cached_property
    def concept(self) -> DataFrame:
        part, key = self.raw("part"), F.col("p_partkey")
        brand, kind, domain = F.expr(_BRAND), F.expr(_TYPE_NO), F.expr(_DOMAIN)
        none = F.lit(None).cast("string")

        def rows(df, concept_id, name, domain, vocabulary, klass, standard, code, invalid):
            return df.select(
                concept_id.cast("long").alias("concept_id"), name.alias("concept_name"), domain.alias("domain_id"), F.lit(vocabulary).alias("vocabulary_id"),
                F.lit(klass).alias("concept_class_id"), standard.alias("standard_concept"), code.alias("concept_code"), invalid.alias("invalid_reason"),
            )

        source = rows(part, 1000000 + key, F.col("p_name"), domain, "PART", "Source", none, key.cast("string"), F.when(key % 17 == 0, "D"))
        standard = rows(part, 2000000 + brand * 10 + kind, F.concat_ws(" ", "p_brand", "p_type"), domain, "STD", "Clinical", F.lit("S"), F.concat(F.lit("S"), (brand * 10 + kind).cast("string")), none)
        ingredient = rows(part, 3000000 + brand, F.col("p_brand"), F.lit("Drug"), "STD", "Ingredient", F.lit("S"), F.concat(F.lit("I"), brand.cast("string")), none)
        unit = rows(self.spark.range(1), F.lit(8840), F.lit("milligram per deciliter"), F.lit("Unit"), "UCUM", "Unit", F.lit("S"), F.lit("mg/dL"), none)
        return source.unionByName(standard.distinct()).unionByName(ingredient.distinct()).unionByName(unit)

    @cached_property
    def relationship(self) -> DataFrame:
        part, key = self.raw("part"), F.col("p_partkey")
        brand, kind = F.expr(_BRAND), F.expr(_TYPE_NO)
        first = part.select((1000000 + key).alias("concept_id_1"), (2000000 + brand * 10 + kind).alias("concept_id_2"), F.lit("Maps to").alias("relationship_id"), F.when(key % 13 == 0, "D").alias("invalid_reason"))
        second = part.where(key % 29 == 0).select((1000000 + key).alias("concept_id_1"), (2000000 + brand * 10 + (kind + 1) % 6).alias("concept_id_2"), F.lit("Maps to").alias("relationship_id"), F.lit(None).cast("string").alias("invalid_reason"))
        return first.unionByName(second)

    @cached_property
    def ancestor(self) -> DataFrame:
        part = self.raw("part")
        ingredient, standard = 3000000 + F.expr(_BRAND), 2000000 + F.expr(_BRAND) * 10 + F.expr(_TYPE_NO)
        pair = lambda a, d: part.select(a.alias("ancestor_id"), d.alias("descendant_id")).distinct()
        return pair(ingredient, standard).unionByName(pair(standard, standard)).unionByName(pair(ingredient, ingredient))

    @cached_property
    def cases(self) -> DataFrame:
        key = F.col("p_partkey")
        own = 2000000 + F.expr(_BRAND) * 10 + F.expr(_TYPE_NO)
        other = 2000000 + F.expr(_BRAND) * 10 + (F.expr(_TYPE_NO) + 1) % 6
        first = 2000000 + F.expr(_BRAND) * 10
        score = (key * 37 % 101) / 100.0
        return self.raw("part").select(
            key.alias("case_id"),
            F.expr(_DOMAIN).alias("domain"),
            F.when(key % 5 < 3, "development").otherwise("held_out").alias("split"),
            F.col("p_brand").alias("family_id"),
            F.when(key % 4 == 0, "ABSTAIN").otherwise("MAP").alias("expected_decision"),
            F.when(key % 4 != 0, own).alias("expected_id"),
            F.when(key % 7 == 0, "ABSTAIN").otherwise("MAP").alias("raw_decision"),
            F.when(key % 7 == 0, None).when(key % 3 == 0, other).otherwise(own).alias("raw_id"),
            score.alias("score"),
            F.when((key % 7 != 0) & (score >= 0.5), "MAP").otherwise("ABSTAIN").alias("decision"),
            F.when(key % 6 == 0, F.array(first)).otherwise(F.array(own, first)).alias("candidates"),
        )
