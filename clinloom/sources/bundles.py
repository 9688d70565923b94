"""FHIR bundles. A document is parsed once, into a VARIANT; everything else reads paths of that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def path(value: Column, at: str, kind: str) -> Column:
    """What stands at a path of a VARIANT; null where it is missing or of another shape."""
    return F.try_variant_get(value, at, kind)


def _members(bundles: DataFrame) -> DataFrame:
    """(bundle_id, members): the entries of each Bundle as VARIANTs; null for documents that are none, or no JSON."""
    parsed = bundles.select("bundle_id", F.try_parse_json("json").alias("_doc"))
    doc = F.col("_doc")
    return parsed.select("bundle_id", F.when(path(doc, "$.resourceType", "string") == "Bundle", path(doc, "$.entry", "array<variant>")).alias("members"))


def _fields(e: Column) -> dict[str, Column]:
    return {
        "full_url": F.trim(path(e, "$.fullUrl", "string")),
        "resource_type": F.trim(path(e, "$.resource.resourceType", "string")),
        "id": F.trim(path(e, "$.resource.id", "string")),
        "resource": path(e, "$.resource", "variant"),
    }


def entries(bundles: DataFrame) -> DataFrame:
    """A row for each entry of ``bundles`` (bundle_id, json): bundle_id, pos, full_url, resource_type, id and the resource as a
    VARIANT. Documents that are no Bundle, or no JSON, give none."""
    # the outer form, as the plain one would have its array, and with it the parse, computed once more in a filter
    each = _members(bundles).select("bundle_id", F.posexplode_outer("members").alias("pos", "_e")).where("pos is not null")
    return each.select("bundle_id", "pos", *[c.alias(name) for name, c in _fields(F.col("_e")).items()])


def linked_entries(bundles: DataFrame, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """``entries`` with subject_url, encounter_url and medication_code, the CodeableConcept (a VARIANT) of the Medication that
    is referred to; of the ``kinds`` of resources alone, if they are given. References are looked up in the bundle's own map
    while it is still one row, so nothing is joined or shuffled, and the map is not carried by its entries. A reference is a
    Type/id or a full URL of the bundle; another stays as it is. Of resources with one name, that with the greatest full URL counts."""
    said = lambda e, field: F.trim(path(e, f"$.resource.{field}.reference", "string"))
    # names are those of all entries, the rest is read of those that are asked for
    named = F.transform("members", lambda e: F.struct(*[c.alias(n) for n, c in _fields(e).items() if n != "resource"]))
    good = F.filter(named, lambda e: (e["resource_type"] != "") & (e["id"] != "") & (e["full_url"] != ""))
    pair = lambda ref, url: F.struct(ref.alias("ref"), url.alias("url"))
    names = F.flatten(F.transform(good, lambda e: F.array(pair(e["full_url"], e["full_url"]), pair(F.concat_ws("/", e["resource_type"], e["id"]), e["full_url"]))))
    asked = lambda e: {"_subject": said(e, "subject"), "_encounter": said(e, "encounter"), "_medication": said(e, "medicationReference")}
    drugs = F.array().cast("array<struct<url:string,code:variant>>")
    if kinds is None or "MedicationRequest" in kinds:
        drug = lambda e: {"url": _fields(e)["full_url"], "code": path(e, "$.resource.code", "variant")}
        drugs = F.filter("members", lambda e: (_fields(e)["resource_type"] == "Medication") & (_fields(e)["full_url"] != ""))
        drugs = F.transform(drugs, lambda e: F.struct(*[c.alias(n) for n, c in drug(e).items()]))
    numbered = F.transform("members", lambda e, i: F.struct(i.alias("pos"), e.alias("e")))
    if kinds is not None:
        numbered = F.filter(numbered, lambda x: _fields(x["e"])["resource_type"].isin(*kinds))
    read = F.transform(numbered, lambda x: F.struct(x["pos"].alias("pos"), *[c.alias(n) for n, c in (_fields(x["e"]) | asked(x["e"])).items()]))
    found = _members(bundles).select("bundle_id", read.alias("_es"), F.array_sort(F.array_distinct(names)).alias("_names"), drugs.alias("_drugs"))
    # sorted by name and URL, the last of each name; what stands for itself need not be looked up
    last = F.filter("_names", lambda x, i: ~F.coalesce(F.get("_names", i + 1)["ref"] == x["ref"], F.lit(False)))
    found = found.select("bundle_id", "_es", F.map_from_entries(F.filter(last, lambda x: x["ref"] != x["url"])).alias("_map"), "_drugs")

    def resolved(ref: Column) -> Column:
        return F.nullif(F.when(ref.startswith("urn:"), ref).otherwise(F.coalesce(F.try_element_at("_map", ref), ref)), F.lit(""))

    # references are read once, resolved once, and then met with the medications
    more = lambda e: {"subject_url": resolved(e["_subject"]), "encounter_url": resolved(e["_encounter"]), "_url": resolved(e["_medication"])}
    own = ("pos", "full_url", "resource_type", "id", "resource")
    full = F.transform("_es", lambda e: F.struct(*[e[n].alias(n) for n in own], *[c.alias(n) for n, c in more(e).items()]))

    def medication(e: Column) -> Column:
        code = F.get(F.filter("_drugs", lambda d: d["url"] == e["_url"]), F.lit(0))["code"]
        return F.when(e["resource_type"] == "MedicationRequest", code)

    full = F.transform(full, lambda e: F.struct(*[e[n].alias(n) for n in (*own, "subject_url", "encounter_url")], medication(e).alias("medication_code")))
    return found.select("bundle_id", F.explode_outer(full).alias("_e")).where("_e is not null").select("bundle_id", "_e.*")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(bundle_id, json) of every JSON file below ``path``; a file's name is its bundle_id."""
    files = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").text(path, wholetext=True)
    return files.select(F.input_file_name().alias("bundle_id"), F.col("value").alias("json"))


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Entries of every JSON file below ``path``."""
    return entries(read_json(spark, path))
