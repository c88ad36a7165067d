"""Column expressions with the source SQL's semantics where Spark differs.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_skipping_concat(*parts) -> Column:
    """CONCAT that treats NULL arguments as '' (a missing name gives ' ')."""
    return F.concat(*[F.coalesce(_c(p), F.lit("")) for p in parts])


def full_name(given, family) -> Column:
    """``CONCAT(given, ' ', family)`` with NULL-skipping semantics."""
    return F.concat(F.coalesce(_c(given), F.lit("")), F.lit(" "), F.coalesce(_c(family), F.lit("")))


def year_boundaries(start, end) -> Column:
    """``date_diff('year', start, end)``: calendar-year boundaries crossed, bigint."""
    return (F.year(_c(end)) - F.year(_c(start))).cast("long")


def minute_boundaries(start, end) -> Column:
    """``date_diff('minute', s, e)``: minute boundaries crossed (10:00:59 -> 10:01:00 is 1)."""
    s = F.date_trunc("minute", _c(start))
    e = F.date_trunc("minute", _c(end))
    return F.timestamp_diff("MINUTE", s, e).cast("long")


def day_boundaries(start, end) -> Column:
    """``date_diff('day', d1, d2)`` on dates, bigint."""
    return F.datediff(_c(end), _c(start)).cast("long")


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` as int."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
