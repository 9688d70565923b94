"""Units of measure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinloom.functions.coding import UCUM

# Reviewed equivalents; everything else stays as written, in its case.
ALIASES = {
    "U/L": "[U]/L",
    "kU/L": "10*3.[U]/L",
    "m[IU]/L": "10*-3.[iU]/L",
    "mL/min/{1.73_m2}": "mL/min/(173.10*-2.m2)",
    "ng/dl": "ng/dL",
    "{score}": "[score]",
}


def canonical_unit(system: Column, code: Column) -> Column:
    """The code of a unit of the UCUM system, by its reviewed alias if it has one; null for others."""
    plain = F.nullif(F.trim(code), F.lit(""))
    alias = F.coalesce(*[F.when(plain == a, to) for a, to in ALIASES.items()], plain)
    return F.when(system == UCUM, alias)
