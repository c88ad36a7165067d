"""Key-merge and delete+insert.

``upsert_by_key(target, batch, keys, order_by)``:
  1. one row per key in the batch: greatest ``order_by``, ties by the
     remaining columns (a ``max(struct)`` aggregate: partial, so a hot key is
     combined map-side instead of landing whole in one task);
  2. target rows whose key matches (null-safe) are dropped (left anti join behind a key filter, so the target is not shuffled);
  3. union by name, missing columns NULL (or a per-column fill);
  4. idempotent: merging the same batch twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import rows_without_keys


#: Written at extraction where the source gives an order of arrival; it decides before any date.
INGEST_SEQ = "_ingest_seq"
AUDIT_DATES = ("date_created", "date_changed", "date_voided")


def change_order(batch: DataFrame) -> list[Column]:
    """Order of the versions of a row: arrival, where known (an un-void clears its date), then the change cursor."""
    order = [F.col(INGEST_SEQ)] if INGEST_SEQ in batch.columns else []
    return order + ([change_cursor(batch)] if AUDIT_DATES[0] in batch.columns else [])


def latest_per_key(batch: DataFrame, keys, order_by=()) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (names or columns), ties by the other columns in order."""
    keys = list(keys)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by if not (isinstance(c, str) and c in keys)]
    payload = [c for c in batch.columns if c not in keys]
    if not payload:
        return batch.select(*keys).distinct()
    # Field names are positional to avoid clashes with user column names.
    st = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"f{i}") for i, c in enumerate(payload)])
    agg = batch.groupBy(*keys).agg(F.max(st).alias("__w"))
    return agg.select(*keys, *[F.col(f"__w.f{i}").alias(c) for i, c in enumerate(payload)]) \
              .select(*batch.columns)


def upsert_by_key(target: DataFrame, batch: DataFrame, keys, order_by=(),
                  fill: dict | None = None, dedupe: bool = True, null_safe: bool = True) -> DataFrame:
    """``null_safe=False`` for primary keys that are never NULL: a plain equi-join on the keys.
    Target rows are not shuffled unless the key filter of the batch lets them through."""
    keys = list(keys)
    b = latest_per_key(batch, keys, order_by) if dedupe else batch
    if INGEST_SEQ not in target.columns:
        b = b.drop(INGEST_SEQ)
    # the keys of the batch before its versions are sorted out: the same set, and a narrow plan
    kept = rows_without_keys(target, batch.select(*keys), keys, null_safe)
    out = kept.unionByName(b, allowMissingColumns=True)
    if fill:
        out = out.fillna({k: v for k, v in fill.items() if k in out.columns})
    return out


def delete_insert(target: DataFrame, fresh: DataFrame, deleted_keys: DataFrame, key: str) -> DataFrame:
    """``DELETE FROM target WHERE key IN (deleted_keys); INSERT fresh`` as one new version.

    ``deleted_keys`` is a one-column DataFrame (the ids whose source rows are in
    the refresh window); the IN-subquery becomes a left anti join behind a key filter.
    """
    dead = deleted_keys.select(F.col(deleted_keys.columns[0]).alias(key))
    kept = rows_without_keys(target, dead, [key])
    return kept.unionByName(fresh, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def change_cursor(df: DataFrame, base: str = "date_created",
                  extra=("date_changed", "date_voided")) -> Column:
    """Greatest of the audit timestamps present (H1): catches edits and voids."""
    cols = [base] + [c for c in extra if c in df.columns]
    return F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(base)


def changed_between(df: DataFrame, since, until=None, cols=AUDIT_DATES) -> Column:
    """A row is changed if any of its dates lies in [since, until].

    Plain comparisons joined by OR reach the parquet scan or the JDBC query; a
    comparison of their greatest does not.
    """
    out = None
    for c in cols:
        if c in df.columns:
            one = F.col(c) >= F.lit(since)
            one = one if until is None else one & (F.col(c) <= F.lit(until))
            out = one if out is None else out | one
    if out is None:
        raise ValueError(f"none of {list(cols)} in the table")
    return out
