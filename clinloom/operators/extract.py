"""Typed rows from the resources of bundles. ``entries`` is what clinloom.sources.bundles gives; ``resource`` may be JSON
text as well, which is then parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.functions.coding import CODEABLE, LOINC, RXNORM, SNOMED, select_coding, source_value, vocabulary_id
from clinloom.functions.dates import fhir_datetime
from clinloom.functions.units import canonical_unit
from clinloom.sources.bundles import path

_REF = "struct<reference:string>"
_PERIOD = "struct<start:string,end:string>"
_VALUE = f"valueQuantity:struct<value:double,comparator:string,unit:string,system:string,code:string>,valueString:string,valueBoolean:boolean,valueCodeableConcept:{CODEABLE}"
#: One narrow schema for each resource type; a field of another shape is null and the row survives.
SCHEMAS = {
    "Patient": "gender:string,birthDate:string,extension:array<struct<url:string,extension:array<struct<url:string,valueString:string,valueCoding:struct<display:string>>>>>",
    "Encounter": f"status:string,subject:{_REF},class:struct<code:string>,period:{_PERIOD}",
    "Condition": f"verificationStatus:{CODEABLE},subject:{_REF},encounter:{_REF},code:{CODEABLE},onsetDateTime:string,onsetPeriod:{_PERIOD},abatementDateTime:string,abatementPeriod:{_PERIOD}",
    "Medication": f"code:{CODEABLE}",
    "MedicationRequest": f"status:string,subject:{_REF},encounter:{_REF},medicationCodeableConcept:{CODEABLE},medicationReference:{_REF},authoredOn:string,dispenseRequest:struct<validityPeriod:{_PERIOD}>",
    "Observation": f"status:string,subject:{_REF},encounter:{_REF},code:{CODEABLE},effectiveDateTime:string,effectivePeriod:{_PERIOD},{_VALUE},component:array<struct<code:{CODEABLE},{_VALUE}>>",
    "Procedure": f"status:string,subject:{_REF},encounter:{_REF},code:{CODEABLE},performedDateTime:string,performedPeriod:{_PERIOD}",
}
PREFERRED = {"Condition": (SNOMED,), "Observation": (LOINC, SNOMED), "Procedure": (SNOMED,), "MedicationRequest": (RXNORM,)}

# Publication policy by resource type, visit classes, comparators, genders.
ALLOWED = {
    "Observation": ("final", "amended", "corrected"),
    "Procedure": ("completed",),
    "MedicationRequest": ("active", "on-hold", "completed", "stopped"),
}
DENIED = {"Encounter": ("entered-in-error",)}
DENIED_VERIFICATION = ("entered-in-error", "refuted")
VISIT_CONCEPTS = {"AMB": 9202, "WELL": 9202, "IMP": 9201, "EMER": 9203, "URGENT": 9203, "HH": 581476, "VR": 722455}
COMPARATORS = {"<": 4171756, "<=": 4171754, ">": 4172704, ">=": 4171755}
GENDERS = {"male": 8507, "female": 8532}
#: Domain tables whose events a resource may become.
TARGETS = {
    "Condition": ("condition_occurrence", "observation"),
    "Observation": ("measurement", "observation"),
    "Procedure": ("procedure_occurrence", "measurement", "observation", "device_exposure"),
    "MedicationRequest": ("drug_exposure",),
}


def _is_text(entries: DataFrame) -> bool:
    return dict(entries.dtypes)["resource"] == "string"


def _resource(entries: DataFrame) -> Column:
    return F.try_parse_json("resource") if _is_text(entries) else F.col("resource")


def payload(entries: DataFrame) -> Column:
    """A resource's text: as it was given, or of a VARIANT the one with sorted keys and without blanks."""
    return F.col("resource") if _is_text(entries) else F.to_json("resource")


def parsed(entries: DataFrame, kind: str) -> DataFrame:
    """Entries of one resource type with ``r``, the resource as a struct."""
    return entries.where(F.col("resource_type") == kind).withColumn("r", path(_resource(entries), "$", f"struct<{SCHEMAS[kind]}>"))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, which are computed once a row: a filter on them stays above the generator, where one above a plain
    column would take its expression along and compute it again."""
    made = F.explode_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", made.alias("_once")).select("*", "_once.*").drop("_once")


def published(entries: DataFrame, kind: str) -> DataFrame:
    """``parsed`` entries of one type that may be published; the resource is read once, and its state with it."""
    read = _once(entries.where(F.col("resource_type") == kind), r=path(_resource(entries), "$", f"struct<{SCHEMAS[kind]}>"))
    return read.where(_reason(F.lit(kind), *(F.col("r") if f in SCHEMAS[kind] else None for f in ("status", "verificationStatus"))).isNull())


def _reason(kind: Column, state: Column | None, verification: Column | None) -> Column:
    """``exclusion_reason`` from resources that have been read, those with a status and those with a verificationStatus."""
    none = F.array().cast("array<string>")
    codes = none if verification is None else F.coalesce(verification_codes(verification["verificationStatus"]), none)
    return exclusion_reason(kind, F.lit("") if state is None else state["status"], codes)


def _lookup(values: dict, key: Column, other=None) -> Column:
    return F.coalesce(*[F.when(key == k, v) for k, v in values.items()], F.lit(other))


def reference_index(entries: DataFrame) -> DataFrame:
    """(bundle_id, ref, full_url): each resource by its full URL and by Type/id."""
    good = entries.where("resource_type <> '' and id <> '' and full_url <> ''")
    refs = F.explode(F.array("full_url", F.concat_ws("/", "resource_type", "id")))
    return good.select("bundle_id", refs.alias("ref"), "full_url").groupBy("bundle_id", "ref").agg(F.max_by("full_url", "full_url").alias("resolved"))


def resolve_refs(df: DataFrame, index: DataFrame, ref: str, out: str) -> DataFrame:
    """``out``: the full URL a reference stands for in its bundle; an unknown one stays as it is."""
    value = F.trim(F.coalesce(F.col(ref), F.lit("")))
    return df.withColumn("_ref", value).join(index.withColumnRenamed("ref", "_ref"), ["bundle_id", "_ref"], "left").withColumn(out, F.coalesce("resolved", "_ref")).drop("_ref", "resolved")


def with_references(entries: DataFrame) -> DataFrame:
    """``entries`` with subject_url and encounter_url, resolved once for every extractor, which then read these: entries that
    are ``linked_entries`` have them, others are joined with their bundles' index. An entry without a full URL gets its
    resource's text for one, so that ids made from it are those of the payload."""
    index = None
    for field in ("subject", "encounter"):
        if f"{field}_url" in entries.columns:
            continue
        index = index if index is not None else reference_index(entries)
        refs = entries.withColumn("_said", path(_resource(entries), f"$.{field}.reference", "string"))
        entries = resolve_refs(refs, index, "_said", f"{field}_url").drop("_said").withColumn(f"{field}_url", F.nullif(f"{field}_url", F.lit("")))
    return entries.withColumn("full_url", F.coalesce(F.nullif("full_url", F.lit("")), F.concat(F.lit("urn:uuid:"), payload(entries))))


def _reference(df: DataFrame, field: str) -> Column:
    return F.col(f"{field}_url" if f"{field}_url" in df.columns else f"r.{field}.reference")


def verification_codes(codeable: Column) -> Column:
    codes = F.transform(F.coalesce(codeable["coding"], F.array()), lambda c: F.lower(F.trim(F.coalesce(c["code"], F.lit("")))))
    return F.filter(codes, lambda c: c != "")


def exclusion_reason(kind: Column, status: Column, verification: Column) -> Column:
    """Why an event is not published; null if it is. ``verification`` holds codes in lower case."""
    state = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    name = lambda s: F.upper(F.replace(s, F.lit("-"), F.lit("_")))
    denied = F.array_sort(F.array_intersect(verification, F.array(*map(F.lit, DENIED_VERIFICATION))))
    reason = F.when(kind == "Condition", F.when(F.size(denied) > 0, F.concat(F.lit("FHIR_CONDITION_VERIFICATION_"), name(F.get(denied, F.lit(0))))))
    by_status = F.concat(F.lit("FHIR_"), F.upper(kind), F.lit("_STATUS_"), F.when(state == "", "MISSING").otherwise(name(state)))
    for type_, states in DENIED.items():
        reason = reason.when((kind == type_) & state.isin(*states), by_status)
    for type_, states in ALLOWED.items():
        reason = reason.when((kind == type_) & ~state.isin(*states), by_status)
    return reason


def with_reason(entries: DataFrame) -> DataFrame:
    """``entries`` with status and reason."""
    resource = _resource(entries)
    codes = path(resource, "$.verificationStatus", CODEABLE)
    verification = F.coalesce(verification_codes(codes), F.array().cast("array<string>"))
    own = F.trim(F.coalesce(path(resource, "$.status", "string"), F.lit("")))
    status = F.when(F.col("resource_type") == "Condition", F.array_join(F.array_sort(F.array_distinct(verification)), ",")).otherwise(own)
    return entries.withColumn("status", status).withColumn("reason", exclusion_reason(F.col("resource_type"), own, verification))


def publishable(entries: DataFrame) -> DataFrame:
    return with_reason(entries).where("reason is null").drop("status", "reason")


def exclusions(entries: DataFrame) -> DataFrame:
    """(resource_type, event_key, status, reason) of events kept back; without a URL the key is a digest."""
    key = F.coalesce(F.nullif("full_url", F.lit("")), F.concat(F.lit("sha256:"), F.sha2(payload(entries).cast("binary"), 256)))
    return with_reason(entries).where("reason is not null").select("resource_type", key.alias("event_key"), "status", "reason")


def extract_persons(entries: DataFrame) -> DataFrame:
    """Distinct persons: birth date of any precision in parts, gender concept, race and ethnicity as text."""
    p = parsed(entries, "Patient")
    birth = F.trim("r.birthDate")
    good = birth.rlike(r"^\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?)?$")
    number = lambda group: F.when(good, F.nullif(F.regexp_extract(birth, r"^(\d{4})(?:-(\d\d))?(?:-(\d\d))?$", group), F.lit("")).cast("int"))

    def from_extension(word: str) -> Column:
        one = F.get(F.filter("r.extension", lambda e: F.contains(F.lower(e["url"]), F.lit(word))), F.lit(0))
        said = F.transform(one["extension"], lambda x: F.coalesce(x["valueString"], x["valueCoding"]["display"]))
        return F.get(F.filter(said, lambda s: s.isNotNull() & (F.trim(s) != "")), F.lit(0))

    return p.select(
        F.col("full_url").alias("person_ref"),
        number(1).alias("year_of_birth"),
        number(2).alias("month_of_birth"),
        number(3).alias("day_of_birth"),
        _lookup(GENDERS, F.lower(F.trim("r.gender")), 0).alias("gender_concept_id"),
        from_extension("race").alias("race"),
        from_extension("ethnicity").alias("ethnicity"),
    ).distinct()


def extract_visits(entries: DataFrame) -> DataFrame:
    v = parsed(entries, "Encounter")
    start, end = fhir_datetime(F.col("r.period.start")), fhir_datetime(F.col("r.period.end"))
    return v.select(
        F.col("full_url").alias("visit_ref"),
        _reference(v, "subject").alias("person_ref"),
        _lookup(VISIT_CONCEPTS, F.upper(F.trim("r.class.code")), 0).alias("visit_concept_id"),
        start["date"].alias("start_date"),
        F.coalesce(end["date"], start["date"]).alias("end_date"),
    ).where("start_date is not null")


def _coded(df: DataFrame, codeable: str, preferred: tuple[str, ...]) -> DataFrame:
    return _with_code(_once(df, coding=select_coding(F.col(codeable), preferred)))


def _with_code(df: DataFrame) -> DataFrame:
    return df.where("coding is not null").withColumns({"vocabulary_id": vocabulary_id(F.col("coding.system")), "code": F.col("coding.code"), "source_value": source_value(F.col("coding"))})


_EVENT = ("full_url", "person_ref", "encounter_ref", "vocabulary_id", "code", "source_value", "start_date", "end_date")


def _events(df: DataFrame, start: Column, end: Column | None, *more: str) -> DataFrame:
    dated = _once(df, _start=fhir_datetime(start)["date"]).where("_start is not null")
    last = F.col("_start") if end is None else F.coalesce(fhir_datetime(end)["date"], F.col("_start"))
    return dated.withColumns(
        {"person_ref": _reference(df, "subject"), "encounter_ref": _reference(df, "encounter"), "start_date": F.col("_start"), "end_date": last}
    ).select(*_EVENT, *more)


def extract_conditions(entries: DataFrame) -> DataFrame:
    c = _coded(published(entries, "Condition"), "r.code", PREFERRED["Condition"])
    return _events(c, F.coalesce("r.onsetDateTime", "r.onsetPeriod.start"), F.coalesce("r.abatementDateTime", "r.abatementPeriod.end"))


def extract_drugs(entries: DataFrame) -> DataFrame:
    """Requests with their own concept, or that of the Medication they refer to in the bundle."""
    m = published(entries, "MedicationRequest")
    if "medication_code" in m.columns:
        both = m.withColumn("_med_code", path(F.col("medication_code"), "$", CODEABLE))
    else:
        medication = resolve_refs(m.withColumn("_med", F.col("r.medicationReference.reference")), reference_index(entries), "_med", "_med_url")
        known = parsed(entries, "Medication").select("bundle_id", F.col("full_url").alias("_med_url"), F.col("r.code").alias("_med_code")).dropDuplicates(["bundle_id", "_med_url"])
        both = medication.join(known, ["bundle_id", "_med_url"], "left")
    both = both.withColumn("_code", F.coalesce("r.medicationCodeableConcept", "_med_code"))
    period = "r.dispenseRequest.validityPeriod"
    return _events(_coded(both, "_code", PREFERRED["MedicationRequest"]), F.coalesce(f"{period}.start", "r.authoredOn"), F.col(f"{period}.end"))


def extract_procedures(entries: DataFrame) -> DataFrame:
    p = _coded(published(entries, "Procedure"), "r.code", PREFERRED["Procedure"])
    return _events(p, F.coalesce("r.performedDateTime", "r.performedPeriod.start"), None)


_RESULT = ("code", "valueQuantity", "valueString", "valueBoolean", "valueCodeableConcept")


def _parts(r: Column) -> tuple[Column, Column]:
    """An Observation itself, with an empty path, and the array of its components."""
    whole = F.struct(F.lit("").alias("path"), *[r[f].alias(f) for f in _RESULT])
    parts = F.transform(
        F.coalesce(r["component"], F.array()), lambda c, i: F.struct(F.concat(F.lit("component["), i.cast("string"), F.lit("]")).alias("path"), *[c[f].alias(f) for f in _RESULT])
    )
    return whole, parts


def explode_components(entries: DataFrame) -> DataFrame:
    """Observations with ``path`` and ``e``: the resource itself (empty path) and each of its components."""
    whole, parts = _parts(F.col("r"))
    # the outer form, as the plain one would have its array computed once more in a filter
    return published(entries, "Observation").withColumn("e", F.explode_outer(F.concat(F.array(whole), parts))).withColumn("path", F.col("e.path"))


def _effective() -> Column:
    return F.coalesce("r.effectiveDateTime", "r.effectivePeriod.start")


def extract_measurements(entries: DataFrame) -> DataFrame:
    """Numeric and coded results; a comparator that is not known fails."""
    found = _coded(explode_components(entries), "e.code", PREFERRED["Observation"])
    sign = F.trim("e.valueQuantity.comparator")
    bad = F.raise_error(F.concat(F.lit("unknown comparator "), sign)).cast("int")
    operator = F.when(F.coalesce(sign, F.lit("")) != "", F.coalesce(_lookup(COMPARATORS, sign), bad))
    found = found.where(F.col("e.valueQuantity.value").isNotNull() | F.col("e.valueCodeableConcept").isNotNull()).withColumns(
        {
            "value": F.col("e.valueQuantity.value"),
            "operator_concept_id": operator,
            "unit": F.coalesce("e.valueQuantity.unit", "e.valueQuantity.code"),
            "unit_code": canonical_unit(F.col("e.valueQuantity.system"), F.col("e.valueQuantity.code")),
            "value_code": select_coding(F.col("e.valueCodeableConcept"))["code"],
        }
    )
    return _events(found, _effective(), None, "path", "value", "operator_concept_id", "unit", "unit_code", "value_code")


def extract_observation_candidates(entries: DataFrame) -> DataFrame:
    """Conditions and observations that may become observations, with the value that counts: quantity, then
    text, then truth value, then coded. Entries are read in one pass, as conditions (``c``) or observations (``r``)."""
    kind = F.col("resource_type")
    observed, stated = kind == "Observation", kind == "Condition"
    shape = lambda of: path(_resource(entries), "$", f"struct<{SCHEMAS[of]}>")
    read = _once(entries.where(observed | stated), r=F.when(observed, shape("Observation")), c=F.when(stated, shape("Condition")))
    read = read.where(_reason(kind, F.col("r"), F.col("c")).isNull())
    whole, parts = _parts(F.col("r"))
    own = F.struct(F.lit("").alias("path"), F.col("c.code").alias("code"), *[whole[f].alias(f) for f in _RESULT[1:]])
    each = read.withColumn("e", F.explode_outer(F.when(stated, F.array(own)).otherwise(F.concat(F.array(whole), parts))))
    coding = F.when(stated, select_coding(F.col("e.code"), PREFERRED["Condition"])).otherwise(select_coding(F.col("e.code"), PREFERRED["Observation"]))
    value_kind = (
        F.when(F.col("e.valueQuantity.value").isNotNull(), "quantity")
        .when(F.col("e.valueString").isNotNull(), "string")
        .when(F.col("e.valueBoolean").isNotNull(), "boolean")
        .when(F.col("e.valueCodeableConcept").isNotNull(), "coded")
    )
    value = F.coalesce(
        F.col("e.valueQuantity.value").cast("string"), F.col("e.valueString"), F.col("e.valueBoolean").cast("string"), select_coding(F.col("e.valueCodeableConcept"))["code"]
    )
    found = _with_code(_once(each, coding=coding)).withColumns({"path": F.col("e.path"), "value_kind": value_kind, "value_text": value})
    start = F.when(stated, F.coalesce("c.onsetDateTime", "c.onsetPeriod.start")).otherwise(_effective())
    end = F.when(stated, F.coalesce("c.abatementDateTime", "c.abatementPeriod.end"))
    for field in ("subject", "encounter"):
        if f"{field}_url" not in found.columns:
            found = found.withColumn(f"{field}_url", F.coalesce(f"r.{field}.reference", f"c.{field}.reference"))
    return _events(found, start, end, "path", "value_kind", "value_text", "resource_type")


def event_contexts(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(target_table, full_url, encounter_ref) for each table an event may go to, and the keys that have
    several references."""
    kind = F.coalesce(*[F.when(F.col("resource_type") == k, F.array(*map(F.lit, t))) for k, t in TARGETS.items()])
    rows = entries.where(F.col("resource_type").isin(*TARGETS)).select(
        F.explode(kind).alias("target_table"), "full_url", F.trim(path(_resource(entries), "$.encounter.reference", "string")).alias("encounter_ref")
    )
    rows = rows.where("encounter_ref <> ''").distinct()
    clash = rows.groupBy("target_table", "full_url").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows, clash


def bundle_violations(entries: DataFrame) -> DataFrame:
    """(bundle_id, full_url, violation) for structural faults: full URLs missing, relative or doubled, doubled
    identities, no patient, subjects and encounters that resolve to nothing, no usable concept, quantities
    without a number or a unit. Resources are read once; what is shuffled, once, are names, references and an entry's own faults."""
    kind, resource = F.col("resource_type"), _resource(entries)
    body = path(resource, "$", f"struct<code:{CODEABLE},valueQuantity:struct<value:double,unit:string,code:string>>")
    said = lambda field: F.when(kind.isin(*TARGETS), F.nullif(F.trim(path(resource, f"$.{field}.reference", "string")), F.lit("")))
    read = entries.select("bundle_id", "full_url", "resource_type", "id", said("subject").alias("subject"), said("encounter").alias("encounter"), F.when(kind.isin("Condition", "Observation", "Procedure"), body).alias("_r"))
    quantity = F.when(kind == "Observation", F.col("_r.valueQuantity"))
    empty = lambda part: F.coalesce(quantity[part], F.lit("")) == ""
    faults = {
        "BAD_FULL_URL": ~F.coalesce(F.col("full_url").rlike(r"^(urn:uuid:|https?://)."), F.lit(False)),
        "NO_CONCEPT": kind.isin("Condition", "Observation", "Procedure") & select_coding(F.col("_r.code")).isNull(),
        "NO_NUMBER": quantity.isNotNull() & quantity["value"].isNull(),
        "NO_UNIT": quantity.isNotNull() & empty("unit") & empty("code"),
    }
    own = F.array_compact(F.array(*[F.when(fault, name) for name, fault in faults.items()]))
    facts = read.select("bundle_id", F.struct("full_url", "resource_type", "id", "subject", "encounter", own.alias("own")).alias("_e"))
    bundle = facts.repartition("bundle_id").groupBy("bundle_id").agg(F.collect_list("_e").alias("_es"))

    url, identity = lambda e: F.struct(e["full_url"]), lambda e: F.struct(e["resource_type"], e["id"])

    sorted_ = bundle.withColumns({"_urls": F.array_sort(F.transform("_es", url)), "_ids": F.array_sort(F.transform("_es", identity))})
    again = lambda name: F.array_distinct(F.filter(name, lambda x, i: F.get(name, i + 1).eqNullSafe(x)))
    good = F.filter("_es", lambda e: (e["resource_type"] != "") & (e["id"] != "") & (e["full_url"] != ""))
    names = F.flatten(F.transform(good, lambda e: F.array(e["full_url"], F.concat_ws("/", e["resource_type"], e["id"]))))
    asked = F.array_compact(F.flatten(F.transform("_es", lambda e: F.array(e["subject"], e["encounter"]))))
    lone = F.when(~F.exists("_es", lambda e: F.coalesce(e["resource_type"] == "Patient", F.lit(False))), True)
    judged = sorted_.select("bundle_id", "_es", again("_urls").alias("_url_twice"), again("_ids").alias("_id_twice"), F.array_except(asked, names).alias("_lost"), lone.alias("_lone"))
    e = F.col("_e")
    each = judged.select("bundle_id", F.posexplode_outer("_es").alias("_n", "_e"), "_url_twice", "_id_twice", "_lost", "_lone")
    more = F.array(
        F.when(F.array_contains("_url_twice", url(e)), "DUPLICATE_FULL_URL"),
        F.when((e["id"] != "") & F.array_contains("_id_twice", identity(e)), "DUPLICATE_IDENTITY"),
        F.when(F.array_contains("_lost", e["subject"]), "UNRESOLVED_SUBJECT"),
        F.when(F.array_contains("_lost", e["encounter"]), "UNRESOLVED_ENCOUNTER"),
    )
    # the bundle's own fault goes with its first entry
    told = F.transform(F.concat(e["own"], F.array_compact(more)), lambda v: F.struct(e["full_url"].alias("full_url"), v.alias("violation")))
    whole = F.when((F.col("_n") == 0) & F.col("_lone"), F.array(F.struct(F.lit(None).cast("string").alias("full_url"), F.lit("NO_PATIENT").alias("violation"))))
    found = each.select("bundle_id", F.explode_outer(F.concat(told, F.coalesce(whole, F.array().cast("array<struct<full_url:string,violation:string>>")))).alias("_v"))
    return found.where("_v is not null").select("bundle_id", "_v.full_url", "_v.violation")


def resource_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("resource_type").agg(F.count(F.lit(1)).alias("n"))
