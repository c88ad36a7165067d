"""Incremental refresh.

* ``ingest``: key-merge the changed rows of each raw table (change cursor
  >= mark) into the stored raw table.
* ``refresh_flat_window``: the source's DELETE+INSERT of one date window of
  obs; with no bounds and no mark it is a full rebuild with the void filter
  always on (H3 fixed).
* ``refresh_wide_window``: the source's increment - re-pivot only the rows in
  the window and merge by (person_id, encounter_id); older values of a
  touched encounter are lost (H5, kept for parity).
* ``refresh_wide_touched``: our default.  Touched encounters (changed obs,
  obs of changed encounters/visits/concept names, old and new flat rows) are
  re-pivoted from *all* their current rows; encounters hit by a newly
  discovered value family are touched too, and old columns are renamed by
  (concept, family, answer) identity.  The result equals a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import spec as table_spec
from ..operators.joins import bounded_broadcasts, rows_with_keys, rows_without_keys
from ..operators.upsert import change_cursor, change_order, changed_between, delete_insert, latest_per_key, upsert_by_key
from ..session import STORED_CODEC, scratch_path
from ..sources.derived import with_tables
from .flatten import flatten_appointments, flatten_observations
from .pivot import CatalogEntry, PivotSpec, build_catalog, catalog_frame, widen

WIDE_MERGE_KEYS = ("person_id", "encounter_id")


# -- marks and cursors -----------------------------------------------------------

def high_water_mark(df: DataFrame, col: str | Column):
    """``SELECT MAX(col)`` (S10/A11): one scalar to the driver."""
    c = F.col(col) if isinstance(col, str) else col
    return df.agg(F.max(c).alias("m")).first()["m"]


def changed_rows(current: DataFrame, since, until=None, cursor: Column | None = None) -> DataFrame:
    """Cursor scan (S2): rows with an audit date, or the given cursor, in [since, until]."""
    if cursor is None:
        return current.where(changed_between(current, since, until))
    cur = cursor
    out = current.where(cur >= F.lit(since))
    if until is not None:
        out = out.where(cur <= F.lit(until))
    return out


def ingest(stored: dict[str, DataFrame], current: dict[str, DataFrame], since,
           names=("obs", "encounter", "visit")) -> dict[str, DataFrame]:
    """Key-merge each table's changed rows into its stored copy (S3)."""
    out = with_tables(current)
    for n in names:
        keys = table_spec(n).keys
        batch = changed_rows(current[n], since)
        out[n] = upsert_by_key(stored[n], batch, keys, order_by=change_order(batch), null_safe=False)
    return out


# -- flat table: DELETE + INSERT ----------------------------------------------

def window_filter(col: str, start=None, end=None) -> Column | None:
    c = F.col(col)
    if start is not None and end is not None:
        return c.between(F.lit(start), F.lit(end))          # F6
    if start is not None:
        return c >= F.lit(start)                             # F7
    return None                                              # F9: no bounds


def refresh_flat_window(flat_old: DataFrame | None, raw: dict[str, DataFrame],
                        start=None, end=None) -> DataFrame:
    """Delete obs of the window from the flat table, insert them re-flattened."""
    if start is None and end is None and flat_old is not None:
        start = high_water_mark(flat_old, "date_created")
    cond = window_filter("date_created", start, end)
    if cond is None or flat_old is None:
        return flatten_observations(raw)                     # full rebuild, void filter on
    deleted = raw["obs"].where(cond).select("obs_id")        # J25: IN (SELECT obs_id ...)
    fresh = flatten_observations(raw, obs_filter=cond)
    return delete_insert(flat_old, fresh, deleted, "obs_id")


def refresh_appointments(flat_old: DataFrame, raw, start=None, end=None, as_of=None) -> DataFrame:
    """DELETE + INSERT of appointments with any audit date in the closed range [start, end].

    Without an end the range is open; without both it starts at the flat table's mark (H4).  An appointment made inside
    the range and changed after it is in the range by its date of creation.
    """
    if start is None and end is None:
        start = high_water_mark(flat_old, F.greatest("date_changed", "date_created"))
    changed = changed_rows(raw["patient_appointment"], start, end)
    fresh = flatten_appointments(with_tables(raw, patient_appointment=changed), as_of=as_of)
    return delete_insert(flat_old, fresh, changed.select("patient_appointment_id"), "patient_appointment_id")


def changed_obs_ids(raw: dict[str, DataFrame], since) -> DataFrame:
    """Obs whose flat rows may differ since ``since``: own changes or a changed parent.

    Changed parents are encounters, encounters of changed visits and concepts with a
    changed name.  Obs without a change of their own are looked up in the key filter of the
    changed encounters, so they are not shuffled.
    """
    obs = raw["obs"]
    visits = changed_rows(raw["visit"], since).select("visit_id")
    enc = changed_rows(raw["encounter"], since).select("encounter_id").unionByName(
        rows_with_keys(raw["encounter"].select("encounter_id", "visit_id"), visits, ["visit_id"]).select("encounter_id"))
    names = changed_rows(raw["concept_name"], since).select("concept_id").distinct()
    q_names = names.withColumn("__q_changed", F.lit(True))
    a_names = names.select(F.col("concept_id").alias("__a_id"), F.lit(True).alias("__a_changed"))
    q_names, a_names = bounded_broadcasts([q_names, a_names])
    flagged = (obs.select("obs_id", "encounter_id", "concept_id", "value_coded",
                          change_cursor(obs).alias("__cursor"))
               .join(q_names, "concept_id", "left")
               .join(a_names, F.col("value_coded") == F.col("__a_id"), "left"))
    own = F.coalesce(F.col("__cursor") >= F.lit(since), F.lit(False)) | F.col("__q_changed").isNotNull() | F.col("__a_changed").isNotNull()
    by_parent = rows_with_keys(flagged.where(~own), enc, ["encounter_id"])
    return flagged.where(own).select("obs_id").unionByName(by_parent.select("obs_id")).distinct()


def restrict_to_obs(raw: dict[str, DataFrame], ids: DataFrame):
    """Raw tables cut down to the given obs and their encounters and visits.

    Re-flattening a few changed obs then joins against a few encounters; all tables are
    cut behind key filters instead of being shuffled whole.
    """
    return restrict_to_encounters(with_tables(raw, obs=rows_with_keys(raw["obs"], ids, ["obs_id"])))


def restrict_to_encounters(raw, staged=None, n_obs: int | None = None):
    """Encounters and visits cut down to those of the obs in ``raw``, ``n_obs`` of them where known.

    ``staged``, a function of a table and a name that writes it and reads it back, is applied to each: no plan then holds more than one
    key filter, and none is made again by what reads the encounters twice.
    """
    def cut(name, keys):
        rows = rows_with_keys(raw[name], keys, keys.columns, n_keys=n_obs)
        return rows if staged is None else staged(rows, name)
    enc = cut("encounter", raw["obs"].select("encounter_id"))
    return with_tables(raw, encounter=enc, visit=cut("visit", enc.select("visit_id")))


# -- wide table ---------------------------------------------------------------

def _ident(e: CatalogEntry):
    return (e.concept, e.family, e.answer)


def align_columns(wide: DataFrame, old_cat: list[CatalogEntry], new_cat: list[CatalogEntry],
                  spec: PivotSpec = PivotSpec()) -> DataFrame:
    """Rename old columns to the new catalog by identity; new one-hot = 0, others NULL."""
    old_by_id = {_ident(e): e.name for e in old_cat}
    cols = [F.col(k) for k in spec.keys] + ([F.col("date_created")] if spec.created else [])
    for e in new_cat:
        src = old_by_id.get(_ident(e))
        if src is not None:
            cols.append(F.col(src).alias(e.name))
        elif e.family == "coded":
            cols.append(F.lit(0).alias(e.name))
        else:
            cols.append(F.lit(None).cast(_value_type(wide, spec, e.family)).alias(e.name))
    return wide.select(*cols)


def _value_type(df: DataFrame, spec: PivotSpec, family: str) -> str:
    return {"numeric": "double", "text": "string", "datetime": "timestamp_ntz", "drug": "bigint"}[family]


def _merge(old: DataFrame, batch: DataFrame, keys, catalog, spec) -> DataFrame:
    out = upsert_by_key(old, batch, keys, order_by=["date_created"])
    names = [*spec.keys] + (["date_created"] if spec.created else []) + [e.name for e in catalog]
    return out.select(*names)


def refresh_wide_window(wide_old: DataFrame, old_cat: list[CatalogEntry], flat_new: DataFrame,
                        start=None, end=None, spec: PivotSpec = PivotSpec(),
                        keys=WIDE_MERGE_KEYS, stored: bool = False) -> tuple[DataFrame, list[CatalogEntry]]:
    """The source's incremental pivot: window rows only, columns from all data (A10, H5).  ``stored``: ``flat_new`` is read from files."""
    new_cat = build_catalog(flat_new, spec)
    cond = window_filter("date_created", start, end)
    rows = flat_new if cond is None else flat_new.where(cond)
    batch = widen(rows, spec, catalog=new_cat, stored=stored)
    old = align_columns(wide_old, old_cat, new_cat, spec)
    return _merge(old, batch, keys, new_cat, spec), new_cat


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "staging", name)
    df.write.option("compression", STORED_CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)


def refresh_wide_touched(wide_old: DataFrame, old_cat: list[CatalogEntry], flat_old: DataFrame,
                         raw: dict[str, DataFrame], since, spec: PivotSpec = PivotSpec(),
                         materialize=None) -> tuple[DataFrame, DataFrame, list[CatalogEntry]]:
    """Re-pivot touched encounters from all their rows; returns (wide, flat, catalog)."""
    if materialize is None:                         # plans that are read by several joins and their filters are written first
        materialize = _staged
        raw = with_tables(raw, **{t: _staged(raw[t], "raw_" + t) for t in ("obs", "encounter", "visit")})
        flat_old, wide_old = _staged(flat_old, "flat_old"), _staged(wide_old, "wide_old")
    ids = materialize(changed_obs_ids(raw, since), "changed_obs_ids")
    fresh = flatten_observations(restrict_to_obs(raw, ids))
    flat_new = materialize(delete_insert(flat_old, fresh, ids, "obs_id"), "flattened_observations")
    new_cat = build_catalog(flat_new, spec)
    touched = (rows_with_keys(flat_old.select("obs_id", "encounter_id"), ids, ["obs_id"])
               .unionByName(rows_with_keys(flat_new.select("obs_id", "encounter_id"), ids, ["obs_id"]))).select("encounter_id")
    # A value family new to a concept takes values from rows of any type (rule a):
    # every encounter with such a value is touched as well.
    old_ids = {_ident(e) for e in old_cat}
    grown = [e for e in new_cat if e.family != "coded" and _ident(e) not in old_ids]
    if grown:
        g = F.broadcast(catalog_frame(flat_new.sparkSession, grown))
        hit = None
        for fam in {e.family for e in grown}:
            c = (F.col("family") == fam) & F.col(spec.value_col(fam)).isNotNull()
            hit = c if hit is None else hit | c
        extra = flat_new.join(g, (F.col(spec.concept) == F.col("concept")) & hit, "left_semi")
        touched = touched.unionByName(extra.select("encounter_id"))
    touched = materialize(touched.distinct(), "touched_encounters")
    batch = widen(rows_with_keys(flat_new, touched, ["encounter_id"]), spec, catalog=new_cat)
    old = rows_without_keys(align_columns(wide_old, old_cat, new_cat, spec), touched, ["encounter_id"])
    wide = old.unionByName(batch)
    names = [*spec.keys] + (["date_created"] if spec.created else []) + [e.name for e in new_cat]
    return wide.select(*names), flat_new, new_cat


__all__ = ["high_water_mark", "changed_rows", "ingest", "refresh_flat_window", "changed_obs_ids",
           "align_columns", "refresh_wide_window", "refresh_wide_touched", "latest_per_key"]
