"""Top-1 row per parent (J20 / O3): ``LEFT JOIN LATERAL (... ORDER BY ... DESC LIMIT 1)``.

Expressed as ``groupBy(parent).agg(max(struct(order..., tie, payload...)))``:
a partial aggregate, so a parent with a huge number of children is reduced
map-side, and no sort of a whole group is needed.  NULL sorts lowest in a
struct comparison, so ``max`` equals ``ORDER BY ... DESC NULLS LAST``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_parent(children: DataFrame, parent: str, order_desc, tie: str | None = None,
                      payload=None) -> DataFrame:
    order_desc = list(order_desc)
    lead = order_desc + ([tie] if tie and tie not in order_desc else [])
    payload = [c for c in (payload or children.columns) if c != parent and c not in lead]
    fields = lead + payload
    st = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    agg = children.groupBy(parent).agg(F.max(st).alias("__top"))
    return agg.select(parent, *[F.col(f"__top.f{i}").alias(c) for i, c in enumerate(fields)])
