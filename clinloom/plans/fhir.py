"""Registered queries over FHIR bundles that are built from the star-schema tables: one bundle an order,
with its patient, its encounter and a resource for each line; some documents are no bundles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom import flow
from clinloom.functions import coding, dates, ids, units
from clinloom.operators import derive, extract, standardise
from clinloom.plans.binding import VIEWS, Clinic, oracle
from clinloom.plans.clinical import CONDITION_ERAS
from clinloom.plans.registry import query
from clinloom.session import store
from clinloom.sources import bundles as source

KEY = b"key of the registered queries"
LOCAL = "http://hospital.example/parts"
#: Lines whose bundles one task makes.
TASK_LINES = 50_000

#: The resources as SQL: what the bundles hold, by line.
RES = f"""res as (select *, case when line in (1, 5, 7) then 'Observation' when line in (2, 6) then 'Condition' when line = 3 then 'MedicationRequest' else 'Procedure' end as resource_type,
 case when line in (1, 5, 7) then case flag when 'N' then 'final' when 'A' then 'amended' else 'entered-in-error' end when line = 4 then case flag when 'N' then 'completed' when 'A' then 'in-progress' else 'entered-in-error' end
  when line = 3 then case flag when 'N' then 'active' when 'A' then 'stopped' else 'cancelled' end else case flag when 'N' then 'confirmed' when 'A' then 'refuted' else 'entered-in-error' end end as status,
 case line when 1 then '{coding.LOINC}' when 2 then '{coding.SNOMED}' when 3 then '{coding.RXNORM}' when 4 then '{LOCAL}' when 5 then '{coding.UNCODED_TEXT}' when 6 then '{coding.MISSING_SYSTEM}' else '{LOCAL}' end as system,
 case line when 1 then 'L' || part when 5 then 'text-' || substr(sha256('term ' || part), 1, 24) else part end as code,
 case line when 1 then 'L' || part when 3 then 'Part ' || part when 5 then 'Term ' || part when 6 then part else 'Part ' || part end as source_value,
 case when line in (1, 5, 7) then flag in ('N', 'A') when line = 4 then flag = 'N' when line = 3 then flag in ('N', 'A') else flag = 'N' end as published
 from (select l_orderkey as order_key, 'Patient/' || o_custkey as person_ref, 'Encounter/' || l_orderkey as encounter_ref, l_linenumber as line, cast(l_partkey as varchar) as part, l_partkey, l_suppkey, l_quantity, l_returnflag as flag,
   cast(l_shipdate as date) as day, 'urn:uuid:' || concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as full_url from lineitem join orders on l_orderkey = o_orderkey where l_orderkey % 97 <> 0))"""
_VOC = f"case system when '{coding.LOINC}' then 'LOINC' when '{coding.SNOMED}' then 'SNOMED' when '{coding.RXNORM}' then 'RxNorm' else 'FHIR_' || substr(sha256(system), 1, 12) end"


def _sql(body: str) -> str:
    return f"with {RES} {body}"


def _struct(**fields):
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def _coding(system=None, code=None, display=None):
    parts = {"system": system, "code": code, "display": display}
    return _struct(**{k: v for k, v in parts.items() if v is not None})


def _resource_json(l: Callable[[str], Column]) -> tuple[Column, Column, Column]:
    """A line's key, its resource and that of the Medication of its third line, from the line's columns."""
    line, part, flag = l("l_linenumber"), l("l_partkey").cast("string"), l("l_returnflag")
    key, date = l("key"), l("l_shipdate")
    day = F.date_format(date, "yyyy-MM-dd")
    label = F.concat(F.lit("Part "), part)
    shared = dict(
        id=key,
        subject=_struct(reference=F.concat(F.lit("Patient/"), l("o_custkey").cast("string"))),
        encounter=_struct(reference=F.concat(F.lit("Encounter/"), l("l_orderkey").cast("string"))),
    )
    state = lambda n, a, r: F.when(flag == "N", n).when(flag == "A", a).otherwise(r)
    observed = state("final", "amended", "entered-in-error")
    local = _coding(F.lit(LOCAL + "/"), part, label)
    quantity = dict(value=l("l_quantity"), unit=F.lit("ng per dl"), system=F.lit(coding.UCUM), code=F.lit("ng/dl"))
    quantity["comparator"] = F.when(l("l_partkey") % 4 == 0, "<")
    component = _struct(code=_struct(coding=F.array(_coding(F.lit(coding.LOINC), F.lit("C1"), F.lit("Component")))), valueQuantity=_struct(value=l("l_quantity") * 2))
    verification = _struct(coding=F.array(_coding(None, state("confirmed", "refuted", "entered-in-error"))))
    json = {
        1: _struct(resourceType=F.lit("Observation"), status=observed, code=_struct(coding=F.array(_coding(F.lit(LOCAL + "/"), part, label), _coding(F.lit(coding.LOINC), F.concat(F.lit("L"), part), F.lit(None).cast("string")))),
                   effectiveDateTime=F.concat(day, F.lit("T10:30:00+02:00")), valueQuantity=_struct(**quantity), component=F.array(component), **shared),
        2: _struct(resourceType=F.lit("Condition"), verificationStatus=verification, code=_struct(coding=F.array(_coding(F.lit(coding.SNOMED), part, label))), onsetDateTime=day,
                   abatementDateTime=F.date_format(F.date_add(date, 5), "yyyy-MM-dd"), **shared),
        3: _struct(resourceType=F.lit("MedicationRequest"), status=state("active", "stopped", "cancelled"), medicationReference=_struct(reference=F.concat(F.lit("Medication/m-"), key)), authoredOn=day,
                   dispenseRequest=_struct(validityPeriod=_struct(end=F.date_format(F.date_add(date, 30), "yyyy-MM-dd"))), **shared),
        4: _struct(resourceType=F.lit("Procedure"), status=state("completed", "in-progress", "entered-in-error"), code=_struct(coding=F.array(local)), performedPeriod=_struct(start=day), **shared),
        5: _struct(resourceType=F.lit("Observation"), status=observed, code=_struct(text=F.concat(F.lit("Term "), part)), effectiveDateTime=F.date_format(date, "yyyy-MM"), valueString=F.lit("positive"), **shared),
        6: _struct(resourceType=F.lit("Condition"), verificationStatus=verification, code=_struct(coding=F.array(_coding(None, part))), onsetPeriod=_struct(start=day), **shared),
        7: _struct(resourceType=F.lit("Observation"), status=observed, code=_struct(coding=F.array(local)), effectivePeriod=_struct(start=day),
                   valueCodeableConcept=_struct(coding=F.array(_coding(F.lit(LOCAL), l("l_suppkey").cast("string")))), **shared),
    }
    resource = F.coalesce(*[F.when(line == n, F.to_json(j)) for n, j in json.items()])
    medicine = F.to_json(_struct(resourceType=F.lit("Medication"), id=F.concat(F.lit("m-"), key), code=_struct(coding=F.array(_coding(F.lit(coding.RXNORM), part, label)))))
    return key, resource, F.when(line == 3, medicine)


def bundles(c: Clinic) -> DataFrame:
    """(bundle_id, json). What is shuffled are the lines' few columns; texts are made when an order's lines are together. These
    are far larger than those columns, so the number of tasks follows the lines, not the bytes shuffled, and a task stays small."""
    used = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    # dealt out before they are collected, so that no half-made lists are sorted and sent
    lines = c.raw("lineitem").select("l_orderkey", *used)
    tasks = max(1, -(-lines.count() // TASK_LINES))
    lines = lines.repartition(tasks, "l_orderkey")
    per_order = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct(*used)).alias("lines"))
    orders = c.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").repartition(tasks, "o_orderkey")
    orders = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    entry = lambda url, body: F.concat(F.lit('{"fullUrl":"urn:uuid:'), url, F.lit('","resource":'), body, F.lit("}"))

    def members(x: Column) -> Column:
        key, resource, medicine = _resource_json(lambda name: F.col(name) if name in ("o_custkey", "l_orderkey") else x[name])
        own, med = F.struct(key.alias("u"), entry(key, resource).alias("j")), F.concat(F.lit("m-"), key)
        return F.when(medicine.isNotNull(), F.array(own, F.struct(med.alias("u"), entry(med, medicine).alias("j")))).otherwise(F.array(own))

    keyed = F.transform("lines", lambda x: F.struct(F.concat_ws("-", "l_orderkey", x["l_partkey"], x["l_suppkey"], x["l_linenumber"]).alias("key"), *[x[c].alias(c) for c in used]))
    xs = F.array_sort(F.flatten(F.transform(keyed, members)))
    customer, order = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    birth = F.when(F.col("o_custkey") % 3 == 0, F.concat((1930 + F.col("o_custkey") % 80).cast("string"), F.lit("-05-17"))).otherwise((1930 + F.col("o_custkey") % 80).cast("string"))
    race = _struct(url=F.lit("http://example.org/us-core-race"), extension=F.array(_struct(url=F.lit("text"), valueString=F.concat(F.lit("R"), (F.col("o_custkey") % 5).cast("string")))))
    patient = F.to_json(_struct(resourceType=F.lit("Patient"), id=customer, gender=F.when(F.col("o_custkey") % 2 == 0, "male").otherwise("female"), birthDate=birth, extension=F.array(race)))
    start = F.date_format("o_orderdate", "yyyy-MM-dd")
    stay = _struct(start=start, end=F.when(F.col("o_orderkey") % 2 == 0, F.date_format(F.date_add("o_orderdate", 2), "yyyy-MM-dd")))
    klass = _struct(code=F.when(F.col("o_orderpriority").startswith("1"), "EMER").when(F.col("o_orderpriority").startswith("2"), "IMP").otherwise("AMB"))
    visit = F.to_json(_struct(**{"resourceType": F.lit("Encounter"), "id": order, "status": F.lit("finished"), "subject": _struct(reference=F.concat(F.lit("Patient/"), customer)), "class": klass, "period": stay}))
    head = F.array(entry(F.concat(F.lit("p-"), customer), patient), entry(F.concat(F.lit("v-"), order), visit))
    every = F.concat(head, F.coalesce(F.transform(xs, lambda x: x["j"]), F.array().cast("array<string>")))
    kind = F.when(F.col("o_orderkey") % 97 == 0, "Library").otherwise("Bundle")
    text = F.concat(F.lit('{"resourceType":"'), kind, F.lit('","entry":['), F.array_join(every, ","), F.lit("]}"))
    return orders.select(F.col("o_orderkey").alias("bundle_id"), text.alias("json"))


_written: dict[tuple[str, str], str] = {}


def _bundles(spark, sf_dir):
    """The bundles of a folder as a table that is written once for the application: making them is no part of a query.
    Their texts repeat themselves, so that zstd leaves far fewer bytes than the usual codec."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _written:
        _written[at] = store(bundles(Clinic(spark, sf_dir)), "bundles", compression="zstd")._stored_at
    return spark.read.parquet(_written[at])


def _entries(spark, sf_dir):
    return source.entries(_bundles(spark, sf_dir))


def _linked(spark, sf_dir):
    return source.linked_entries(_bundles(spark, sf_dir))


A1 = """, e as (select order_key as bundle_id, full_url, resource_type from res union all select order_key, 'urn:uuid:m-' || substr(full_url, 10), 'Medication' from res where line = 3)
select bundle_id, row_number() over (partition by bundle_id order by full_url) + 1 as pos, full_url, resource_type from e
union all select o_orderkey, 0, 'urn:uuid:p-' || o_custkey, 'Patient' from orders where o_orderkey % 97 <> 0 union all select o_orderkey, 1, 'urn:uuid:v-' || o_orderkey, 'Encounter' from orders where o_orderkey % 97 <> 0"""


@query("a1", _sql(A1))
def a1(spark, sf_dir):
    return _entries(spark, sf_dir).select("bundle_id", F.col("pos").cast("long").alias("pos"), "full_url", "resource_type")


@query("b1", _sql("select full_url, 'urn:uuid:p-' || substr(person_ref, 9) as subject_url, case when line = 4 then 'Group/9' else 'urn:uuid:v-' || substr(encounter_ref, 11) end as context_url from res where line in (2, 4)"))
def b1(spark, sf_dir):
    e = _entries(spark, sf_dir)
    index = extract.reference_index(e)
    rows = e.where("resource_type in ('Condition', 'Procedure') and full_url rlike '-[24]$'").withColumn("subject", source.path(F.col("resource"), "$.subject.reference", "string"))
    rows = rows.withColumn("context", F.when(F.col("resource_type") == "Procedure", " Group/9 ").otherwise(source.path(F.col("resource"), "$.encounter.reference", "string")))
    return extract.resolve_refs(extract.resolve_refs(rows, index, "subject", "subject_url"), index, "context", "context_url").select("full_url", "subject_url", "context_url")


B1_LINKED = """select full_url, 'urn:uuid:p-' || substr(person_ref, 9) as subject_url, 'urn:uuid:v-' || substr(encounter_ref, 11) as encounter_url, case when line = 3 then part end as medication from res
union all select 'urn:uuid:m-' || substr(full_url, 10), null, null, null from res where line = 3 union all select 'urn:uuid:p-' || o_custkey, null, null, null from orders where o_orderkey % 97 <> 0
union all select 'urn:uuid:v-' || o_orderkey, 'urn:uuid:p-' || o_custkey, null, null from orders where o_orderkey % 97 <> 0"""


@query("b1_linked", _sql(B1_LINKED))
def b1_linked(spark, sf_dir):
    """All references of all entries, resolved inside their bundles' rows."""
    code = source.path(F.col("medication_code"), "$.coding[0].code", "string")
    return _linked(spark, sf_dir).select("full_url", "subject_url", "encounter_url", code.alias("medication"))


_REFS = """case p_partkey % 6 when 0 then 'urn:uuid:' || p_partkey when 1 then 'HTTP://Host.Example/fhir/Part/' || p_partkey || '/_history/3' when 2 then 'Part/' || p_partkey || '?x=1' when 3 then 'Part/' || p_partkey || '/_history/2' when 4 then 'https://a.example/Part/' || p_partkey || '/?q=1#f' else ' ' || p_partkey || ' ' end"""


@query(
    "b2",
    "select p_partkey, case when p_partkey % 6 = 1 then 'http://host.example/fhir/Part/' || p_partkey when p_partkey % 6 = 4 then 'https://a.example/Part/' || p_partkey else cast(p_partkey as varchar) end as identity from part",
)
def b2(spark, sf_dir):
    rows = Clinic(spark, sf_dir).raw("part").selectExpr("p_partkey", f"{_REFS} as ref")
    return rows.select("p_partkey", ids.canonical_identity(F.col("ref")).alias("identity"))


@query("b3")
def b3(spark, sf_dir):
    e = _entries(spark, sf_dir)
    # a resource's text and the digest of its identity are made once
    e = e.select("full_url", extract.payload(e).alias("text"), ids.identity_digest(F.col("full_url"), KEY).alias("digest"))
    return e.select("full_url", ids.person_of(F.col("digest")).alias("person_id"), ids.event_of(F.col("digest")).alias("event_id"), ids.payload_event_id(F.col("text"), KEY, F.lit("component[0]")).alias("payload_id"), ids.fingerprint(F.col("text"), KEY).alias("fingerprint"))


def _hmac_sql(text: str) -> str:
    """HMAC-SHA256 of a text under KEY, in hex."""
    pad = lambda mask: "from_hex('" + bytes(k ^ mask for k in KEY.ljust(64, b"\0")).hex() + "')"
    return f"sha256({pad(0x5C)} || from_hex(sha256({pad(0x36)} || encode({text}))))"


def _event_sql(digest: str) -> str:
    return f"cast('0x' || substr({digest}, 1, 15) as bigint)"


def _person_sql(digest: str) -> str:
    return f"((cast('0x' || substr({digest}, 49, 1) as bigint) % 4) * 1152921504606846976 + cast('0x' || substr({digest}, 50, 15) as bigint))"


# the identity of urn:uuid: URLs is what follows
_IDS = f"""select full_url, {_person_sql('h')} as person_id, {_event_sql('h')} as event_id from (select full_url, {_hmac_sql("substr(full_url, 10)")} as h
 from (select full_url from res union all select 'urn:uuid:m-' || substr(full_url, 10) from res where line = 3
  union all select 'urn:uuid:p-' || o_custkey from orders where o_orderkey % 97 <> 0 union all select 'urn:uuid:v-' || o_orderkey from orders where o_orderkey % 97 <> 0))"""


@query("b3_ids", _sql(_IDS))
def b3_ids(spark, sf_dir):
    e = _entries(spark, sf_dir).select("full_url", ids.identity_digest(F.col("full_url"), KEY).alias("digest"))
    return e.select("full_url", ids.person_of(F.col("digest")).alias("person_id"), ids.event_of(F.col("digest")).alias("event_id"))


def _flow(spark, sf_dir, table):
    """A table of the whole flow; the parts' codes are SNOMED's there, so that conditions are mapped."""
    c = Clinic(spark, sf_dir)
    concept = c.concept.withColumn("vocabulary_id", F.when(F.col("vocabulary_id") == "PART", "SNOMED").otherwise(F.col("vocabulary_id")))
    # conditions and visits both read the entries, and links and targets both read these, so they are written once, as
    # build_cdm does; persons and eras read the entries once
    kept = ("staged_entries", "staged_conditions", "visit_occurrence") if table == "condition_occurrence" else ()
    return flow.cdm_tables(source.linked_entries(_bundles(spark, sf_dir), flow.KINDS[table]), concept, c.relationship, c.ancestor, KEY, lambda name, df: store(df, name) if name in kept else df, until=table)[table]


_SEEN = "orders where o_orderkey % 97 <> 0"
FLOW_PERSON = f"""select {_person_sql('h')} as person_id, case when k % 2 = 0 then 8507 else 8532 end as gender_concept_id, cast(1930 + k % 80 as int) as year_of_birth,
 cast(case when k % 3 = 0 then 5 end as int) as month_of_birth, cast(case when k % 3 = 0 then 17 end as int) as day_of_birth, 'R' || (k % 5) as race, cast(null as varchar) as ethnicity
 from (select o_custkey as k, {_hmac_sql("'p-' || o_custkey")} as h from (select distinct o_custkey from {_SEEN}))"""


@query("flow_person", FLOW_PERSON)
def flow_person(spark, sf_dir):
    """Persons of the whole flow, with keyed ids."""
    return _flow(spark, sf_dir, "person")


# conditions with the day of their visit; copies of a resource count once, by the earliest day
_COND = """cond as (select full_url, substr(any_value(person_ref), 9) as person, substr(any_value(encounter_ref), 11) as visit, any_value(system) as system, any_value(code) as code, min(day) as day, any_value(line) as line
 from res where published and resource_type = 'Condition' group by 1),
linked as (select c.*, case when day between cast(o_orderdate as date) and cast(o_orderdate as date) + case when o_orderkey % 2 = 0 then 2 else 0 end then visit end as held from cond c join orders on o_orderkey = cast(visit as bigint))"""
_FLOW_CONDITION = f"""with {{views}}, {_COND},
found as (select l.*, s.concept_id as source_id, t.concept_id as target_id, t.domain_id as target_domain from linked l
 left join concept s on s.vocabulary_id = 'PART' and l.system = '{coding.SNOMED}' and s.concept_code = l.code and s.invalid_reason is null
 left join relationship r on r.concept_id_1 = s.concept_id and r.relationship_id = 'Maps to' and r.invalid_reason is null
 left join concept t on t.concept_id = r.concept_id_2 and t.standard_concept = 'S' and t.invalid_reason is null),
one as (select * from found where target_domain = 'Condition' or target_id is null qualify row_number() over (partition by full_url order by case when target_domain = 'Condition' then 0 else 1 end, target_id nulls last) = 1),
made as (select {_event_sql(_hmac_sql("substr(full_url, 10)"))} as event_id, {_person_sql(_hmac_sql("'p-' || person"))} as person_id, coalesce(target_id, 0) as concept_id, coalesce(source_id, 0) as source_concept_id,
 day as start_date, case when line = 2 then day + 5 else day end as end_date, case when held is not null then {_event_sql(_hmac_sql("'v-' || held"))} end as visit_id from one)"""


def _flow_sql(body):
    views = oracle("select 1", "concept", "relationship").removeprefix("with ").removesuffix(" select 1")
    return _FLOW_CONDITION.format(views=f"{RES}, {views}") + " " + body


@query("flow_condition_occurrence", _flow_sql("select * from made"))
def flow_condition_occurrence(spark, sf_dir):
    """Conditions of the whole flow: extracted, identified, mapped and linked."""
    return _flow(spark, sf_dir, "condition_occurrence")


@query("flow_condition_era", _flow_sql("select e.person_id, e.concept_id, e.start_date, e.end_date, e.occurrences from (" + CONDITION_ERAS.replace("from condition where", "from made where") + ") e"))
def flow_condition_era(spark, sf_dir):
    """Eras of the conditions of the whole flow."""
    return _flow(spark, sf_dir, "condition_era").select("person_id", "concept_id", "start_date", "end_date", "occurrences")


@query("b4", _sql("select full_url, system, code, source_value as display from (select * replace (case when line = 1 then null else source_value end as source_value) from res where line <> 3 and line <> 1 and line <> 6) union all select full_url, system, code, code from res where line = 6 union all select full_url, system, code, '' from res where line = 1"))
def b4(spark, sf_dir):
    found = None
    for kind in ("Observation", "Condition", "Procedure"):
        one = extract.parsed(_entries(spark, sf_dir), kind).select("full_url", coding.select_coding(F.col("r.code"), extract.PREFERRED[kind]).alias("c"))
        found = one if found is None else found.unionByName(one)
    return found.select("full_url", "c.system", "c.code", "c.display")


@query("b5", _sql(f"select full_url, {_VOC} as vocabulary_id, source_value from res where line in (2, 4, 6)"))
def b5(spark, sf_dir):
    e = _entries(spark, sf_dir).where("full_url rlike '-[246]$'")
    code = source.path(F.col("resource"), "$.code", coding.CODEABLE)
    rows = e.where("resource_type in ('Condition', 'Procedure')").withColumn("c", coding.select_coding(code, (coding.SNOMED,)))
    return rows.select("full_url", coding.vocabulary_id(F.col("c.system")).alias("vocabulary_id"), coding.source_value(F.col("c")).alias("source_value"))


B6 = """select event_id, case when k in (0, 1, 2) then cast(ts as date) end as day, case k when 0 then cast(cast(ts as date) as timestamp) when 1 then date_trunc('second', ts) when 2 then date_trunc('second', ts) - interval 2 hour end as moment
from (select event_id, ts, event_id % 5 as k from events)"""


@query("b6", B6)
def b6(spark, sf_dir):
    k, day = F.col("event_id") % 5, F.date_format("ts", "yyyy-MM-dd")
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k == 0, day).when(k == 1, F.concat(second, F.lit("Z"))).when(k == 2, F.concat(second, F.lit("+02:00"))).when(k == 3, F.substring(day, 1, 7)).otherwise("2024-02-31")
    rows = Clinic(spark, sf_dir).raw("events").select("event_id", dates.fhir_datetime(text).alias("d"))
    return rows.select("event_id", F.col("d.date").alias("day"), F.col("d.ts").alias("moment"))


@query("b7", _sql("select full_url, resource_type from res where published"))
def b7(spark, sf_dir):
    return extract.publishable(_entries(spark, sf_dir)).where(F.col("resource_type").isin(*extract.TARGETS)).select("full_url", "resource_type")


@query("b8", _sql("select resource_type, full_url as event_key, status, case when resource_type = 'Condition' then 'FHIR_CONDITION_VERIFICATION_' else 'FHIR_' || upper(resource_type) || '_STATUS_' end || upper(replace(status, '-', '_')) as reason from res where not published"))
def b8(spark, sf_dir):
    return extract.exclusions(_entries(spark, sf_dir))


B9 = """select distinct 'urn:uuid:p-' || o_custkey as person_ref, cast(1930 + o_custkey % 80 as int) as year_of_birth, case when o_custkey % 3 = 0 then 5 end as month_of_birth, case when o_custkey % 3 = 0 then 17 end as day_of_birth,
 case when o_custkey % 2 = 0 then 8507 else 8532 end as gender_concept_id, 'R' || (o_custkey % 5) as race, cast(null as varchar) as ethnicity from orders where o_orderkey % 97 <> 0"""


@query("b9", B9)
def b9(spark, sf_dir):
    return extract.extract_persons(_entries(spark, sf_dir))


B10 = """select 'urn:uuid:v-' || o_orderkey as visit_ref, 'Patient/' || o_custkey as person_ref, case substr(o_orderpriority, 1, 1) when '1' then 9203 when '2' then 9201 else 9202 end as visit_concept_id,
 cast(o_orderdate as date) as start_date, cast(o_orderdate as date) + case when o_orderkey % 2 = 0 then 2 else 0 end as end_date from orders where o_orderkey % 97 <> 0"""


@query("b10", B10)
def b10(spark, sf_dir):
    return extract.extract_visits(_entries(spark, sf_dir))


_E = f"full_url, person_ref, encounter_ref, {_VOC} as vocabulary_id, code, source_value, day as start_date"


@query("b11", _sql(f"select {_E}, case when line = 2 then day + 5 else day end as end_date from res where published and resource_type = 'Condition'"))
def b11(spark, sf_dir):
    return extract.extract_conditions(_entries(spark, sf_dir))


@query("b12", _sql(f"select {_E}, day + 30 as end_date from res where published and line = 3"))
def b12(spark, sf_dir):
    return extract.extract_drugs(_linked(spark, sf_dir).drop("subject_url", "encounter_url"))


@query("b13", _sql("select full_url, '' as path from res where published and resource_type = 'Observation' union all select full_url, 'component[0]' from res where published and line = 1"))
def b13(spark, sf_dir):
    return extract.explode_components(_entries(spark, sf_dir)).select("full_url", "path")


B14 = f"""select {_E}, day as end_date, '' as path, case when line = 1 then l_quantity end as value, case when line = 1 and l_partkey % 4 = 0 then 4171756 end as operator_concept_id, case when line = 1 then 'ng per dl' end as unit,
 case when line = 1 then 'ng/dL' end as unit_code, case when line = 7 then cast(l_suppkey as varchar) end as value_code from res where published and line in (1, 7)
union all select full_url, person_ref, encounter_ref, 'LOINC', 'C1', 'Component', day, day, 'component[0]', l_quantity * 2, null, null, null, null from res where published and line = 1"""


@query("b14", _sql(B14))
def b14(spark, sf_dir):
    return extract.extract_measurements(_entries(spark, sf_dir))


B15 = """select full_url, '' as path, 'Observation' as resource_type, case line when 1 then 'quantity' else 'coded' end as value_kind from res where published and line in (1, 7)
union all select full_url, 'component[0]', 'Observation', 'quantity' from res where published and line = 1 union all select full_url, '', 'Condition', null from res where published and resource_type = 'Condition'"""


@query("b15", _sql(B15))
def b15(spark, sf_dir):
    return extract.extract_observation_candidates(_entries(spark, sf_dir)).select("full_url", "path", "resource_type", "value_kind")


@query("b16", _sql(f"select {_E}, day as end_date from res where published and line = 4"))
def b16(spark, sf_dir):
    return extract.extract_procedures(_entries(spark, sf_dir))


B17 = f"""select p_partkey, case when p_partkey % 3 = 0 then null when p_partkey % 7 = 0 then null when p_partkey % 2 = 0 then '[U]/L' else 'mmol/L' end as unit from part"""


@query("b17", B17)
def b17(spark, sf_dir):
    key = F.col("p_partkey")
    rows = Clinic(spark, sf_dir).raw("part").select(key, F.when(key % 3 != 0, coding.UCUM).otherwise("local").alias("system"), F.when(key % 7 == 0, " ").when(key % 2 == 0, " U/L").otherwise("mmol/L").alias("code"))
    return rows.select("p_partkey", units.canonical_unit(F.col("system"), F.col("code")).alias("unit"))


B18 = """select distinct t as target_table, full_url, encounter_ref from res, unnest(case resource_type when 'Condition' then ['condition_occurrence', 'observation'] when 'Observation' then ['measurement', 'observation']
 when 'Procedure' then ['procedure_occurrence', 'measurement', 'observation', 'device_exposure'] else ['drug_exposure'] end) u(t)"""


@query("b18", _sql(B18))
def b18(spark, sf_dir):
    return extract.event_contexts(_entries(spark, sf_dir))[0]


# equal lines of an order give equal resources, in some tables
_DOUBLED = """ union all select order_key, full_url, v from (select order_key, full_url from res union all select order_key, 'urn:uuid:m-' || substr(full_url, 10) from res where line = 3) e
 join (select full_url from res group by 1 having count(*) > 1 union all select 'urn:uuid:m-' || substr(full_url, 10) from res where line = 3 group by 1 having count(*) > 1) using (full_url), (select unnest(['DUPLICATE_FULL_URL', 'DUPLICATE_IDENTITY']) as v)"""


@query("b19", _sql("select order_key as bundle_id, full_url, 'UNRESOLVED_SUBJECT' as violation from res where order_key % 10 = 3 union all select order_key, null, 'NO_PATIENT' from (select distinct o_orderkey as order_key from orders where o_orderkey % 97 <> 0 and o_orderkey % 10 = 3)" + _DOUBLED))
def b19(spark, sf_dir):
    e = _entries(spark, sf_dir)
    return extract.bundle_violations(e.where("not (resource_type = 'Patient' and bundle_id % 10 = 3)"))


@query("b19_quantity", _sql("select order_key as bundle_id, full_url, 'NO_UNIT' as violation from res where line = 1 and order_key % 7 = 0 union all select order_key, full_url, 'NO_NUMBER' from res where line = 1 and order_key % 11 = 0" + _DOUBLED))
def b19_quantity(spark, sf_dir):
    """Bundles whose quantities lack a unit or a number, by order."""
    body, gone = F.col("json"), lambda text, old, new: F.replace(text, F.lit(old), F.lit(new))
    bare = gone(gone(body, '"unit":"ng per dl"', '"unit":""'), '"code":"ng/dl"', '"code":""')
    body = F.when(F.col("bundle_id") % 7 == 0, bare).otherwise(body)
    body = F.when(F.col("bundle_id") % 11 == 0, gone(body, '"valueQuantity":{"value":', '"valueQuantity":{"was":')).otherwise(body)
    return extract.bundle_violations(source.entries(_bundles(spark, sf_dir).withColumn("json", body)))


@query("b19_counts", _sql("select resource_type, count(*) as n from res group by 1 union all select 'Medication', count(*) from res where line = 3 union all select k, count(*) from orders, (select unnest(['Patient', 'Encounter']) as k) where o_orderkey % 97 <> 0 group by 1"))
def b19_counts(spark, sf_dir):
    return extract.resource_counts(_entries(spark, sf_dir))



_SLICE = ", ".join(
    [
        "",
        f"concept as ({VIEWS['concept'][1]})",
        f"relationship as ({VIEWS['relationship'][1]})",
        """ev as (select cast('0x' || substr(sha256(full_url), 1, 15) as bigint) as event_id, cast(substr(person_ref, 9) as bigint) as person_id, 'PART' as vocabulary_id, code, day as start_date,
 case when line = 2 then day + 5 else day end as end_date from (select distinct * from res) where published and resource_type = 'Condition')""",
        f"mapped as ({VIEWS['mapped'][1].replace('from event e', 'from ev e')})",
        f"condition as ({VIEWS['condition'][1]})",
    ]
)


@query("d1_bundles", _sql(f"{_SLICE} {CONDITION_ERAS}"))
def d1_bundles(spark, sf_dir):
    """Condition eras from bundles: parse, keep what may be published, extract, standardise, collapse."""
    c = Clinic(spark, sf_dir)
    found = extract.extract_conditions(source.entries(bundles(c))).distinct().select(
        ids.hash_id(F.col("full_url")).alias("event_id"),
        F.regexp_extract("person_ref", "^Patient/(.*)$", 1).cast("long").alias("person_id"),
        F.lit("PART").alias("vocabulary_id"),
        "code",
        "start_date",
        "end_date",
    )
    return derive.condition_era(standardise.map_conditions(found, c.concept, c.relationship))
