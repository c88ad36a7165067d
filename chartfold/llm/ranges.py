"""Documents dealt to partitions by ascending doc_id, without an order over all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width


def deal_by_id(docs: DataFrame, key: str = "doc_id", weight=None, most: int | None = None) -> tuple[DataFrame, int]:
    """``docs`` with a column ``part``: consecutive ranges of the key, numbered upwards, and their number.

    Bounds are approximate quantiles of the key, so ranges hold about equal row counts; equal keys share a range.
    With ``weight`` and ``most`` there are as many ranges as keep about ``most`` of the weight in each.  The driver
    reads the bounds only: as many as there are ranges.
    """
    spark = docs.sparkSession
    parts = max(1, shuffle_width(spark))
    if weight is not None:
        parts = max(parts, int((docs.agg(F.sum(weight)).first()[0] or 0) // most) + 1)
    bounds = docs.where(F.col(key).isNotNull()).agg(
        F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], max(1000, 20 * parts))).first()[0] or []
    bounds = sorted(set(bounds))
    part = F.when(F.col(key).isNull(), 0).otherwise(F.expr(_rank_of(key, bounds)))  # null keys first
    return docs.withColumn("part", part.cast("int")), len(bounds) + 1


def _rank_of(key: str, bounds: list) -> str:
    """SQL for the number of bounds up to the key, by halving: depth grows with the logarithm of the bounds."""
    if not bounds:
        return "0"

    def go(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"if({key} < {bounds[mid]}L, {go(lo, mid)}, {go(mid + 1, hi)})"
    return go(0, len(bounds))
