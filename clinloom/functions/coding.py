"""Choosing a coding of a FHIR CodeableConcept, and its vocabulary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CODING = "struct<system:string,code:string,display:string,version:string>"
CODEABLE = f"struct<coding:array<{CODING}>,text:string>"

# Code systems, their vocabularies, and the two name spaces for incomplete codings.
SNOMED = "http://snomed.info/sct"
LOINC = "http://loinc.org"
RXNORM = "http://www.nlm.nih.gov/research/umls/rxnorm"
UCUM = "http://unitsofmeasure.org"
VOCABULARIES = {SNOMED: "SNOMED", LOINC: "LOINC", RXNORM: "RxNorm", UCUM: "UCUM"}
MISSING_SYSTEM = "urn:fhir:missing-system"
UNCODED_TEXT = "urn:fhir:uncoded-text"


def clean_system(system: Column) -> Column:
    """Trimmed, without closing slashes; null is empty."""
    return F.regexp_replace(F.trim(F.coalesce(system, F.lit(""))), "/+$", "")


def _text(value: Column) -> Column:
    return F.trim(F.coalesce(value, F.lit("")))


def _clean(c: Column) -> Column:
    return F.struct(
        clean_system(c["system"]).alias("system"), _text(c["code"]).alias("code"), _text(c["display"]).alias("display"), F.nullif(_text(c["version"]), F.lit("")).alias("version")
    )


def select_coding(codeable: Column, preferred: tuple[str, ...] = ()) -> Column:
    """struct<system, code, display, version>: the first complete coding of the preferred systems in their
    order, else the first complete one, else the first code under the missing-system name space, else the
    text (or first display) with a digest for a code. Null where nothing is usable."""
    codings = F.transform(F.coalesce(codeable["coding"], F.array().cast(f"array<{CODING}>")), _clean)
    complete = F.filter(codings, lambda c: (c["system"] != "") & (c["code"] != ""))
    of = lambda system: F.get(F.filter(complete, lambda c: c["system"] == system.rstrip("/")), F.lit(0))
    wanted = [of(system) for system in preferred]
    code = F.get(F.filter(codings, lambda c: c["code"] != ""), F.lit(0))
    shown = F.get(F.filter(codings, lambda c: c["display"] != ""), F.lit(0))["display"]
    text = F.coalesce(F.nullif(_text(codeable["text"]), F.lit("")), shown)
    bare = F.struct(
        F.lit(MISSING_SYSTEM).alias("system"), code["code"].alias("code"), F.coalesce(F.nullif(code["display"], F.lit("")), code["code"]).alias("display"), code["version"].alias("version")
    )
    digest = F.concat(F.lit("text-"), F.substring(F.sha2(F.lower(text).cast("binary"), 256), 1, 24))
    worded = F.struct(F.lit(UNCODED_TEXT).alias("system"), digest.alias("code"), text.alias("display"), F.lit(None).cast("string").alias("version"))
    return F.coalesce(*wanted, F.get(complete, F.lit(0)), F.when(code.isNotNull(), bare), F.when(text.isNotNull(), worded))


def vocabulary_id(system: Column) -> Column:
    """The vocabulary of a known system, else FHIR_ and twelve digits of the system's digest."""
    known = F.coalesce(*[F.when(clean_system(system) == s, v) for s, v in VOCABULARIES.items()])
    return F.coalesce(known, F.concat(F.lit("FHIR_"), F.substring(F.sha2(clean_system(system).cast("binary"), 256), 1, 12)))


def source_value(coding: Column) -> Column:
    return F.coalesce(F.nullif(coding["display"], F.lit("")), coding["code"])
