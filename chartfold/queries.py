"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables through the clinical views, so its work
grows with them.  Intermediate tables that several jobs reuse are written
to the shared storage folder (``materialize``) instead of being recomputed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.classify import value_type
from .plans.flatten import flatten_appointments, flatten_observations, flatten_patient_program, latest_states
from .operators.skew import heavy_key_counts
from .operators.upsert import change_order, upsert_by_key
from .plans import incremental as incr
from .plans.pivot import ENCOUNTER_KEYS, PivotSpec, build_catalog, catalog_frame, coded_answers, concept_types, widen
from .plans import analytics as an
from .session import STORED_CODEC, scratch_path
from .sources.changes import ChangeTable, LatestRow
from .sources.derived import ClinicalSource, with_tables
from .sources.raw import load_raw
from .sources.storage import VersionedTable

AS_OF = _dt.date(2024, 1, 1)


def source(spark: SparkSession, sf_dir: str, **kw) -> ClinicalSource:
    return ClinicalSource(spark, sf_dir, **kw)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared storage root and read it back.

    Cuts lineage (a lost executor recomputes from the written files, not from
    the whole upstream plan) and lets several jobs reuse one result.
    """
    path = scratch_path(df.sparkSession, "materialized", name)
    df.write.mode("errorifexists").option("compression", STORED_CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)


def landed(spark: SparkSession, sf_dir: str, names=("obs", "visit")) -> ClinicalSource:
    """The source with these raw tables written once, as an extraction leaves them: snapshots and increments that read them
    several times do not join or group the driver tables each time."""
    return source(spark, sf_dir).land(names, materialize)


# -- flat tables ---------------------------------------------------------------

def q_flatten_observations(spark, sf_dir):
    return flatten_observations(source(spark, sf_dir).tables())


def q_flatten_appointments(spark, sf_dir):
    # O1: newest first as a storage order - sorted within partitions, no global shuffle
    return flatten_appointments(source(spark, sf_dir).tables(), as_of=AS_OF) \
        .sortWithinPartitions(F.desc_nulls_last("start_date_time"))


def q_flatten_patient_program(spark, sf_dir):
    # O2: newest enrolment first, same storage-order treatment
    return flatten_patient_program(source(spark, sf_dir).tables(), as_of=AS_OF) \
        .sortWithinPartitions(F.desc_nulls_last("date_enrolled"))


def q_latest_state_lateral(spark, sf_dir):
    return latest_states(source(spark, sf_dir).table("patient_state"))


# -- pivot building blocks -----------------------------------------------------

def flat_obs_table(spark, sf_dir, **kw) -> DataFrame:
    return materialize(flatten_observations(source(spark, sf_dir, **kw).tables()), "flattened_observations")


def q_value_type_classify(spark, sf_dir):
    flat = flatten_observations(source(spark, sf_dir).tables())
    return flat.select("obs_id", "concept_id", "concept_name", "value_coded_name",
                       value_type().alias("value_type"))


def q_concept_catalog(spark, sf_dir):
    return concept_types(flatten_observations(source(spark, sf_dir).tables()))


def q_coded_answers(spark, sf_dir):
    flat = flatten_observations(source(spark, sf_dir).tables())
    coded = concept_types(flat).where(F.col("value_type") == "coded").select("concept_name")
    return coded_answers(flat).join(coded, "concept_name", "left_semi")


def q_pivot_column_catalog(spark, sf_dir):
    flat = flatten_observations(source(spark, sf_dir).tables())
    return catalog_frame(spark, build_catalog(flat))


def _widen_families(families):
    def q(spark, sf_dir):
        flat = flat_obs_table(spark, sf_dir)
        return widen(flat, PivotSpec(families=families))
    return q


def q_widen_observations(spark, sf_dir, strategy="auto", n_concepts=25):
    flat = flat_obs_table(spark, sf_dir, n_concepts=n_concepts)
    return widen(flat, PivotSpec(), strategy=strategy)


def q_widen_long_plan(spark, sf_dir):
    return q_widen_observations(spark, sf_dir, strategy="long")


SUBSET_PATTERN = "Weight%"


def q_widen_concept_subset(spark, sf_dir):
    flat = flat_obs_table(spark, sf_dir)
    return widen(flat, PivotSpec(concept_filter=F.col("concept_name").like(SUBSET_PATTERN)))


# -- events: the same pivot over another long table ----------------------------

EVENT_SPEC = PivotSpec(keys=("user_id", "day"), created="date_created")


def events_long(events: DataFrame) -> DataFrame:
    """Each event as two observations: a coded 'Event type' and a numeric 'Event value'."""
    base = events.select("user_id", F.to_date("ts").alias("day"), F.col("ts").alias("date_created"),
                         "event_type", "value")
    null = {c: F.lit(None).cast(t) for c, t in
            (("value_text", "string"), ("value_datetime", "timestamp_ntz"), ("value_drug", "long"))}
    coded = base.select("user_id", "day", "date_created", F.lit("Event type").alias("concept_name"),
                        F.col("event_type").alias("value_coded_name"), F.lit(1).cast("long").alias("value_coded"),
                        F.lit(None).cast("double").alias("value_numeric"), *[v.alias(k) for k, v in null.items()])
    num = base.select("user_id", "day", "date_created", F.lit("Event value").alias("concept_name"),
                      F.lit(None).cast("string").alias("value_coded_name"), F.lit(None).cast("long").alias("value_coded"),
                      F.col("value").alias("value_numeric"), *[v.alias(k) for k, v in null.items()])
    return coded.unionByName(num)


def q_events_one_hot(spark, sf_dir):
    ev = source(spark, sf_dir).table("events")
    return widen(events_long(ev), EVENT_SPEC)


# -- incremental family ------------------------------------------------------------

# Cut points read off the data: ~1% of obs are created after INCR_T1, ~10% after UPSERT_T.
INCR_T1 = _dt.datetime(2001, 7, 10)
UPSERT_T = _dt.datetime(2000, 12, 1)
RANGE_START = _dt.datetime(2001, 6, 1)
RANGE_END = _dt.datetime(2001, 7, 31)
FACTS = ("obs", "encounter", "visit", "patient_appointment", "patient_program", "patient_state")


def _old_and_now(spark, sf_dir, t1, land=()):
    now = landed(spark, sf_dir, land)
    return now.at(t1).tables(), now.tables()


def raw_after_ingest(spark, sf_dir, t1, land=("obs", "visit")):
    """Stored raw tables as of ``t1`` with the changed rows since merged in (S2 + S3)."""
    old, now = _old_and_now(spark, sf_dir, t1, land)
    return old, incr.ingest(old, now, t1, names=FACTS)


def q_cursor_scan(spark, sf_dir):
    return incr.changed_rows(source(spark, sf_dir).table("obs"), INCR_T1)


def q_cursor_scan_business_time(spark, sf_dir):
    """The loader's own cursors, obs and encounters by the time they happened."""
    raw = load_raw(source(spark, sf_dir).table, ("obs", "encounter"), since=INCR_T1, business_time=True)
    parts = [raw[t].select(F.lit(t).alias("table_name"), F.col(key).cast("string").alias("id"), F.col(at).alias("happened"))
             for t, key, at in (("obs", "obs_id", "obs_datetime"), ("encounter", "encounter_id", "encounter_datetime"))]
    return parts[0].unionByName(parts[1])


def q_high_water_marks(spark, sf_dir):
    """The marks an increment starts from, one row per mark."""
    old = source(spark, sf_dir).at(INCR_T1).tables()
    fo = flatten_observations(old).agg(F.max("date_created").alias("value"))
    fa = flatten_appointments(old, as_of=AS_OF)
    marks = [fo.select(F.lit("obs_date_created").alias("mark"), "value"),
             fa.agg(F.max("date_changed").alias("value")).select(
                 F.lit("appointment_date_changed").alias("mark"), "value"),
             fa.agg(F.max(F.greatest("date_changed", "date_created")).alias("value")).select(
                 F.lit("appointment_changed_or_created").alias("mark"), "value")]
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out


def q_upsert_raw(spark, sf_dir):
    old, now = _old_and_now(spark, sf_dir, UPSERT_T, land=("obs",))
    batch = incr.changed_rows(now["obs"], UPSERT_T)
    return upsert_by_key(old["obs"], batch, ["obs_id"], order_by=change_order(batch), null_safe=False)


def q_upsert_no_cursor(spark, sf_dir):
    src = source(spark, sf_dir)
    stored = src.table("drug_order").where(F.col("date_activated") < F.lit(UPSERT_T))
    stored = stored.withColumn("dose", F.col("dose") - 1)   # stale values in the stored copy
    return upsert_by_key(stored, src.table("drug_order"), spec_keys("drug_order"))


def q_upsert_composite(spark, sf_dir):
    src = source(spark, sf_dir)
    ur = src.table("user_role")
    stored = ur.where(F.col("user_id") % 2 == 0).unionByName(
        ur.where(F.col("user_id") % 5 == 0).select("user_id", F.lit("Retired").alias("role")))
    return upsert_by_key(stored, ur, spec_keys("user_role"))


def q_upsert_partial_key(spark, sf_dir):
    """S5 as the source loader has it: user_role merged by a part of its key keeps one role a user."""
    from .catalog import spec
    ur = source(spark, sf_dir).table("user_role")
    stored = ur.select("user_id", F.lit("Retired").alias("role")).distinct()
    return upsert_by_key(stored, ur, spec("user_role").legacy_key)


def spec_keys(name):
    from .catalog import spec
    return list(spec(name).keys)


def q_upsert_evolving_columns(spark, sf_dir):
    """Merge a batch with columns the stored wide table does not have yet."""
    old, now = _old_and_now(spark, sf_dir, INCR_T1, land=("obs", "visit"))
    flat_old = materialize(flatten_observations(old), "flat_old")
    narrow = PivotSpec(families=("coded", "numeric"))
    target = widen(flat_old, narrow, catalog=build_catalog(flat_old, narrow))
    flat_now = materialize(flatten_observations(now), "flat_now")
    cat = build_catalog(flat_now)
    batch = widen(flat_now.where(F.col("date_created") >= F.lit(INCR_T1)), catalog=cat)
    new_onehot = [e.name for e in cat if e.family == "coded" and e.name not in target.columns]
    return upsert_by_key(target, batch, list(ENCOUNTER_KEYS), order_by=["date_created"],
                         fill={c: 0 for c in new_onehot})


def _flat_pair(spark, sf_dir, t1):
    old, raw = raw_after_ingest(spark, sf_dir, t1)
    flat_old = materialize(flatten_observations(old), "flat_old")
    return old, raw, flat_old


def q_delete_insert_observations(spark, sf_dir):
    _, raw, flat_old = _flat_pair(spark, sf_dir, INCR_T1)
    return incr.refresh_flat_window(flat_old, raw)


def q_delete_insert_no_bounds(spark, sf_dir):
    _, raw = raw_after_ingest(spark, sf_dir, INCR_T1)
    return incr.refresh_flat_window(None, raw)


def q_delete_insert_appointments(spark, sf_dir):
    old, raw = raw_after_ingest(spark, sf_dir, INCR_T1, land=())
    return incr.refresh_appointments(materialize(flatten_appointments(old, as_of=AS_OF), "flat_appointments_old"), raw, as_of=AS_OF)


def q_delete_insert_appointments_range(spark, sf_dir):
    """Reprocess a closed date range; rows of other dates keep their state."""
    old, raw = raw_after_ingest(spark, sf_dir, INCR_T1, land=())
    flat_old = materialize(flatten_appointments(old, as_of=AS_OF), "flat_appointments_old")
    return incr.refresh_appointments(flat_old, raw, RANGE_START, RANGE_END, as_of=AS_OF)


def _wide_old(flat_old):
    cat = build_catalog(flat_old)
    return materialize(widen(flat_old, catalog=cat, stored=True), "wide_old"), cat


def q_widen_window_mode(spark, sf_dir):
    _, raw, flat_old = _flat_pair(spark, sf_dir, INCR_T1)
    wide_old, cat_old = _wide_old(flat_old)
    start = incr.high_water_mark(flat_old, "date_created")
    flat_new = materialize(incr.refresh_flat_window(flat_old, raw, start=start), "flat_new")
    wide, _ = incr.refresh_wide_window(wide_old, cat_old, flat_new, start=start, stored=True)
    return wide


def q_widen_range_mode(spark, sf_dir):
    _, raw, flat_old = _flat_pair(spark, sf_dir, INCR_T1)
    wide_old, cat_old = _wide_old(flat_old)
    flat_new = materialize(incr.refresh_flat_window(flat_old, raw, RANGE_START, RANGE_END), "flat_new")
    wide, _ = incr.refresh_wide_window(wide_old, cat_old, flat_new, RANGE_START, RANGE_END, stored=True)
    return wide


def q_widen_touched_mode(spark, sf_dir):
    _, raw, flat_old = _flat_pair(spark, sf_dir, INCR_T1)
    wide_old, cat_old = _wide_old(flat_old)
    wide, _, _ = incr.refresh_wide_touched(wide_old, cat_old, flat_old, raw, INCR_T1, materialize=materialize)
    return wide


def q_widen_delta(spark, sf_dir):
    """A10, H5: the wide table from counted cells after inserts, edits and voids; only touched groups are folded again."""
    from .plans.cells import CellStore, refresh_wide_cells
    _, raw, flat_old = _flat_pair(spark, sf_dir, INCR_T1)
    store = CellStore(spark, scratch_path(spark, "tables"))
    store.build(flat_old)
    wide_old, cat_old = materialize(store.wide(), "wide_old"), store.catalog()
    ids = materialize(incr.changed_obs_ids(raw, INCR_T1), "changed_obs_ids")
    after = materialize(flatten_observations(incr.restrict_to_obs(raw, ids)), "flat_changed")
    delta = store.apply(flat_old.join(ids, "obs_id", "left_semi"), after)
    wide, _ = refresh_wide_cells(wide_old, cat_old, store, delta)
    return wide


# -- reporting ---------------------------------------------------------------------

def _flat(spark, sf_dir):
    """Flat rows as a plan: a report that needs a few columns of it reads only these."""
    return flatten_observations(source(spark, sf_dir).tables())


def _groups(spark, sf_dir):
    """The rows of the wide table without its pivoted columns."""
    return _flat(spark, sf_dir).select(*ENCOUNTER_KEYS).distinct()


def q_obs_count_by_concept(spark, sf_dir):
    t = source(spark, sf_dir).tables(["obs", "concept_name"])
    return an.obs_count_by_concept(t["obs"], t["concept_name"])


def q_avg_vitals_by_visit(spark, sf_dir):
    return an.avg_vitals_by_visit(flat_obs_table(spark, sf_dir))


def q_encounter_type_distribution(spark, sf_dir):
    return an.encounter_type_distribution(_groups(spark, sf_dir))


def q_lab_results_by_location(spark, sf_dir):
    return an.lab_results_by_location(_groups(spark, sf_dir))


def q_clinical_totals(spark, sf_dir):
    return an.clinical_totals(_flat(spark, sf_dir))


def q_top_locations(spark, sf_dir):
    return an.top_locations(_flat(spark, sf_dir))


def q_visit_frequency(spark, sf_dir):
    return an.visit_frequency(_flat(spark, sf_dir))


def q_daily_encounter_volume(spark, sf_dir):
    return an.daily_encounter_volume(source(spark, sf_dir).table("encounter"))


def q_encounter_types_by_location(spark, sf_dir):
    return an.encounter_types_by_location(_groups(spark, sf_dir))


def q_provider_productivity(spark, sf_dir):
    return an.provider_productivity(flatten_appointments(source(spark, sf_dir).tables(), as_of=AS_OF))


def q_missing_value_rates(spark, sf_dir):
    return an.missing_value_rates(widen(flat_obs_table(spark, sf_dir)))


def q_patient_vital_series(spark, sf_dir):
    return an.patient_vital_series(_flat(spark, sf_dir))


def q_duplicate_keys(spark, sf_dir):
    return an.duplicate_keys(source(spark, sf_dir).table("drug_order"), spec_keys("drug_order"))


def q_patients_with_identifiers(spark, sf_dir):
    t = source(spark, sf_dir).tables(["person", "patient_identifier"])
    return an.patients_with_identifiers(t["person"], t["patient_identifier"])


def q_recent_encounters(spark, sf_dir):
    t = source(spark, sf_dir).tables(["encounter", "person", "encounter_type", "location"])
    return an.recent_encounters(t["encounter"], t["person"], t["encounter_type"], t["location"])


def q_recent_observations(spark, sf_dir):
    t = source(spark, sf_dir).tables(["obs", "concept_name"])
    return an.recent_observations(t["obs"], t["concept_name"])


# -- sources and sinks --------------------------------------------------------------

def q_scan_catalog(spark, sf_dir):
    """Scan every derived raw table of the catalog; one row count per table."""
    raw = load_raw(source(spark, sf_dir).table, SCANNED_TABLES)
    parts = [raw[n].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n in SCANNED_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SCANNED_TABLES = ("person", "person_name", "patient_identifier", "encounter", "encounter_type", "obs",
                  "visit", "visit_type", "location", "provider", "concept_name", "program",
                  "program_workflow", "program_workflow_state", "patient_program", "patient_state",
                  "drug_order", "user_role", "patient_appointment", "appointment_service",
                  "appointment_service_type")


# The landed tables hold what a text export of the source may hold: everything as text, and some values that are none.
TEXT_KEYS = {"obs": {"obs_id": "string"}, "patient_state": {"patient_state_id": "string"}}


def landed_as_text(src: ClinicalSource, name: str) -> DataFrame:
    """A raw table as a text export: decimal commas, zero dates, odd flags, an unreadable reference and missing keys here and there."""
    df = src.table(name).select(*[F.col(c).cast("string").alias(c) for c in src.table(name).columns])
    faults = {
        "obs": [("value_numeric", F.col("value_numeric").cast("double") == 50, "50,0")],
        "encounter": [("encounter_datetime", F.col("encounter_id").cast("long") % 97 == 0, "0000-00-00 00:00:00"),
                      ("location_id", F.col("encounter_id").cast("long") % 194 == 0, "ward 3")],
        "person": [("dead", F.col("person_id").cast("long") % 89 == 0, "2")],
        "patient_identifier": [("patient_identifier_id", F.col("patient_id").cast("long") % 101 == 0, None)],
    }
    return df.select(*[_broken(c, faults.get(name, ())) for c in df.columns])


def _broken(column: str, faults):
    for name, where, value in faults:
        if name == column:
            return F.when(where, F.lit(value)).otherwise(F.col(column)).alias(column)
    return F.col(column)


def q_quarantine_counts(spark, sf_dir):
    """Every derived raw table, landed as text, under the schema contract: accepted rows and rows per reason."""
    from .catalog import spec
    from .sources.contract import REASONS, checked
    src = source(spark, sf_dir)
    out = None
    for name in SCANNED_TABLES:
        rows = checked(landed_as_text(src, name), spec(name), TEXT_KEYS.get(name))
        why = F.when(F.size(REASONS) == 0, F.array(F.lit("accepted"))).otherwise(F.col(REASONS))
        one = (rows.select(F.lit(name).alias("table_name"), F.explode(why).alias("reason"))
               .groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_rows")))
        out = one if out is None else out.unionByName(one)
    return out


def q_load_typed(spark, sf_dir):
    """Landed text files read back under the contract, the changed rows of obs typed; what does not fit is in the quarantine."""
    from .sources.contract import load_typed, quarantine_into
    from .sources.raw import parquet_reader
    src, root = source(spark, sf_dir), scratch_path(spark, "landed")
    for name in ("obs", "encounter"):
        landed_as_text(src, name).write.parquet(f"{root}/{name}")
    held = ChangeTable(spark, "quarantine", LatestRow(("table_name", "row_digest")), root=scratch_path(spark, "tables"))
    read = dict(reader=parquet_reader(spark, root), names=("obs", "encounter"), types=TEXT_KEYS, on_reject=quarantine_into(held))
    load_typed(**read)
    raw = load_typed(**read, since=UPSERT_T)              # a second run finds the same broken rows and keeps each once
    good = raw["obs"].select(F.lit("accepted").alias("state"), F.lit("obs").alias("table_name"), F.col("obs_id").alias("id"), "value_numeric", "date_created", "voided")
    bad = held.read().select(F.lit("quarantined").alias("state"), "table_name",
                             F.coalesce(F.get_json_object("row_key", "$.obs_id"), F.get_json_object("row_key", "$.encounter_id")).alias("id"))
    return good.unionByName(bad, allowMissingColumns=True)


def q_replace_and_read(spark, sf_dir):
    """Full replace twice (new version each time), read the current version back."""
    table = VersionedTable(spark, "widened_observations", root=scratch_path(spark, "tables"))
    flat = flat_obs_table(spark, sf_dir)
    table.write(widen(flat, PivotSpec(families=("coded",))))
    table.write(widen(flat))
    cur = table.read()
    return cur.agg(F.lit(table.versions()[-1]).alias("version"), F.count(F.lit(1)).alias("n_rows"),
                   F.countDistinct("encounter_id").alias("n_encounters"))


READ_ROWS = 100


def q_limit_read(spark, sf_dir):
    """The first rows of the stored wide table, as a report reads them; the limit is the feature."""
    table = VersionedTable(spark, "widened_observations", root=scratch_path(spark, "tables"))
    table.write(widen(flat_obs_table(spark, sf_dir)))
    return table.read().orderBy(*ENCOUNTER_KEYS).limit(READ_ROWS)


class DriverLost(RuntimeError):
    pass


def q_increment_after_crash(spark, sf_dir):
    """A run that dies before its commit leaves nothing behind; the next one passes its own, later
    mark and still takes the dead run's rows from the stored one."""
    from .plans.refresh import WideStore
    root = scratch_path(spark, "tables")
    src = landed(spark, sf_dir)
    WideStore(spark, root=root).build_full(src.at(UPSERT_T).tables())
    dying = WideStore(spark, root=root)

    def lost(commit, after):
        raise DriverLost
    dying._publish = lost
    try:
        dying.increment(src.at(INCR_T1).tables())
    except DriverLost:
        pass
    store = WideStore(spark, root=root)
    store.increment(src.tables(), since=INCR_T1)
    return store.wide()


EDITED_LOCATION, EDITED_TYPE, EDITED_CONCEPT = 3, 2, 1012


def q_increment_dictionary_edit(spark, sf_dir):
    """Renamed dictionary rows, without any audit date, reach the stored rows that show them."""
    from .plans.refresh import WideStore
    store = WideStore(spark, root=scratch_path(spark, "tables"))
    src = landed(spark, sf_dir)
    store.build_full(src.at(INCR_T1).tables())
    now = src.tables()

    def renamed(table, hit, name):
        return now[table].withColumn("name", F.when(hit, F.lit(name)).otherwise(F.col("name")))
    store.increment(with_tables(
        now, location=renamed("location", F.col("location_id") == EDITED_LOCATION, "Moved clinic"),
        encounter_type=renamed("encounter_type", F.col("encounter_type_id") == EDITED_TYPE, "Laboratory"),
        concept_name=renamed("concept_name", (F.col("concept_id") == EDITED_CONCEPT) & (F.col("locale") == "en"), "Body mass (kg)")))
    return store.wide()


def q_widen_custom_aggregates(spark, sf_dir):
    """Another aggregate for one family of columns."""
    return widen(flat_obs_table(spark, sf_dir), PivotSpec(families=("numeric",), aggregates={"numeric": F.min}))


def q_bootstrap_or_increment(spark, sf_dir):
    """The first run finds nothing stored and builds in full; the next run increments
    (partition-local rewrite of the stored flat and wide tables)."""
    from .plans.refresh import WideStore
    store = WideStore(spark, root=scratch_path(spark, "tables"))
    src = landed(spark, sf_dir)
    assert store.refresh(src.at(INCR_T1).tables(), since=INCR_T1) == "full"
    assert store.refresh(src.tables(), since=INCR_T1) == "increment"
    return store.wide()


def q_reports_after_increment(spark, sf_dir):
    """Every report from the month states that an increment kept up, as (report, name, type, person, value)."""
    from .plans.refresh import WideStore
    from .plans.reports import REPORTS
    store = WideStore(spark, root=scratch_path(spark, "tables"), reports=True)
    src = landed(spark, sf_dir)
    store.build_full(src.at(INCR_T1).tables())
    store.increment(src.tables())
    states, out = store.report_states(), None
    for name, report in REPORTS.items():
        df = report(states).withColumnsRenamed({"metric": "location_name", "n_visits": "value", "n_rows": "value"})
        have = set(df.columns)
        df = df.select(F.lit(name).alias("report"), *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in (
            ("location_name", "string"), ("encounter_type_name", "string"), ("person_id", "long"), ("value", "long"))])
        out = df if out is None else out.unionByName(df)
    return out


#: A key is reported when it holds this part of a table's rows.
HEAVY_SHARE = 0.001


def q_heavy_join_keys(spark, sf_dir):
    """The keys of the two skewed joins that hold a thousandth of the rows or more, with exact counts."""
    t = source(spark, sf_dir).tables(["encounter", "patient_appointment"])

    def keys(table, key):
        counts = heavy_key_counts(t[table], key, HEAVY_SHARE)
        return counts.select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("join_key"), "n_rows")
    return keys("encounter", "visit_id").unionByName(keys("patient_appointment", "provider_id"))


def q_stream_change_files(spark, sf_dir):
    """The raw obs table after a stream that wrote its micro-batches as change files, merged as it is read."""
    from .streaming.ingest import ingest_available
    old, now = _old_and_now(spark, sf_dir, UPSERT_T, land=("obs",))
    root = scratch_path(spark, "stream")
    obs = ChangeTable(spark, "obs", LatestRow(("obs_id",)), root=root + "/tables")
    obs.write(old["obs"])
    changed = incr.changed_rows(now["obs"], UPSERT_T)
    # files as an extraction leaves them, several in a micro-batch
    changed.repartition(8, "obs_id").write.parquet(root + "/landing/obs")
    ingest_available(spark, "obs", root + "/landing/obs", obs, schema=changed.schema, checkpoint=root + "/checkpoint", files_per_batch=3)
    return obs.read()


def q_stream_available_now(spark, sf_dir):
    """Changed obs land as files; an availableNow stream key-merges each micro-batch
    into the raw obs table, then re-pivots the touched months of the stored wide table."""
    from .plans.refresh import WideStore
    from .streaming.ingest import ingest_available
    src = landed(spark, sf_dir)
    root = scratch_path(spark, "stream")
    old = src.at(INCR_T1).tables()
    raw_obs = ChangeTable(spark, "obs", LatestRow(("obs_id",)), root=root + "/tables")
    raw_obs.write(old["obs"])
    store = WideStore(spark, root=root + "/tables")
    store.build_full(old)
    changed = incr.changed_rows(src.table("obs"), INCR_T1)
    landing = root + "/landing/obs"
    # two landings, as two scheduled extractions would leave them
    cut = F.col("date_created") < F.lit(_dt.datetime(2001, 7, 20))
    changed.where(cut).write.mode("append").parquet(landing)
    changed.where(~cut).write.mode("append").parquet(landing)

    def repivot(batch, epoch_id):
        # the other raw tables are current; the mark is the previous run's
        store.increment(with_tables(src.tables(), obs=raw_obs.read()), INCR_T1)

    ingest_available(spark, "obs", landing, raw_obs, schema=changed.schema,
                     checkpoint=root + "/checkpoint", after=repivot)
    return store.wide()


def registry() -> dict:
    return {
        "flatten_observations": q_flatten_observations,
        "flatten_appointments": q_flatten_appointments,
        "flatten_patient_program": q_flatten_patient_program,
        "latest_state_lateral": q_latest_state_lateral,
        "value_type_classify": q_value_type_classify,
        "concept_catalog": q_concept_catalog,
        "coded_answers": q_coded_answers,
        "pivot_column_catalog": q_pivot_column_catalog,
        "pivot_coded_onehot": _widen_families(("coded",)),
        "pivot_numeric": _widen_families(("numeric",)),
        "pivot_text": _widen_families(("text",)),
        "pivot_datetime": _widen_families(("datetime",)),
        "pivot_drug": _widen_families(("drug",)),
        "widen_observations": q_widen_observations,
        "widen_long_plan": q_widen_long_plan,
        "widen_concept_subset": q_widen_concept_subset,
        "events_one_hot": q_events_one_hot,
        "cursor_scan": q_cursor_scan,
        "high_water_marks": q_high_water_marks,
        "upsert_raw": q_upsert_raw,
        "upsert_no_cursor": q_upsert_no_cursor,
        "upsert_composite": q_upsert_composite,
        "upsert_evolving_columns": q_upsert_evolving_columns,
        "delete_insert_observations": q_delete_insert_observations,
        "delete_insert_no_bounds": q_delete_insert_no_bounds,
        "delete_insert_appointments": q_delete_insert_appointments,
        "delete_insert_appointments_range": q_delete_insert_appointments_range,
        "upsert_partial_key": q_upsert_partial_key,
        "cursor_scan_business_time": q_cursor_scan_business_time,
        "limit_read": q_limit_read,
        "increment_after_crash": q_increment_after_crash,
        "increment_dictionary_edit": q_increment_dictionary_edit,
        "widen_custom_aggregates": q_widen_custom_aggregates,
        "widen_window_mode": q_widen_window_mode,
        "widen_range_mode": q_widen_range_mode,
        "widen_touched_mode": q_widen_touched_mode,
        "widen_delta": q_widen_delta,
        "obs_count_by_concept": q_obs_count_by_concept,
        "avg_vitals_by_visit": q_avg_vitals_by_visit,
        "encounter_type_distribution": q_encounter_type_distribution,
        "lab_results_by_location": q_lab_results_by_location,
        "clinical_totals": q_clinical_totals,
        "top_locations": q_top_locations,
        "visit_frequency": q_visit_frequency,
        "daily_encounter_volume": q_daily_encounter_volume,
        "encounter_types_by_location": q_encounter_types_by_location,
        "provider_productivity": q_provider_productivity,
        "missing_value_rates": q_missing_value_rates,
        "patient_vital_series": q_patient_vital_series,
        "duplicate_keys": q_duplicate_keys,
        "patients_with_identifiers": q_patients_with_identifiers,
        "recent_encounters": q_recent_encounters,
        "recent_observations": q_recent_observations,
        "scan_catalog": q_scan_catalog,
        "quarantine_counts": q_quarantine_counts,
        "load_typed": q_load_typed,
        "replace_and_read": q_replace_and_read,
        "bootstrap_or_increment": q_bootstrap_or_increment,
        "stream_available_now": q_stream_available_now,
        "stream_change_files": q_stream_change_files,
        "reports_after_increment": q_reports_after_increment,
        "heavy_join_keys": q_heavy_join_keys,
    }
