"""Value-type classifier for the polymorphic observation value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: precedence of the tagged union ---------------------------
FAMILIES = ("coded", "numeric", "text", "datetime", "drug")
OTHER = "other"
# ---------------------------------------------------------------------------


def value_type(coded="value_coded", numeric="value_numeric", text="value_text",
               datetime="value_datetime", drug="value_drug") -> Column:
    """First non-null of coded > numeric > text > datetime > drug, else 'other'."""
    cols = [coded, numeric, text, datetime, drug]
    expr = None
    for fam, c in zip(FAMILIES, cols):
        cond = (F.col(c) if isinstance(c, str) else c).isNotNull()
        expr = F.when(cond, F.lit(fam)) if expr is None else expr.when(cond, F.lit(fam))
    return expr.otherwise(F.lit(OTHER))
