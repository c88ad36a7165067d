"""Increments: hazards H3/H5/H8 on literal fixtures, and touched == full rebuild on driver data."""
import datetime as dt

import pytest

from chartfold.plans import incremental as incr
from chartfold.plans.flatten import flatten_observations
from chartfold.plans.pivot import build_catalog, widen
from chartfold.sources.derived import ClinicalSource
from helpers import D0, base_tables, table

T = dt.datetime(2024, 6, 1)
D1 = dt.datetime(2024, 7, 1)


def _world(spark, obs_rows):
    t = base_tables(spark)
    t["concept_name"] = t["concept_name"].unionByName(table(spark, "concept_name", [
        {"concept_name_id": 5, "concept_id": 400, "name": "Smoker", "locale": "en", "locale_preferred": True},
        {"concept_name_id": 6, "concept_id": 201, "name": "No", "locale": "en", "locale_preferred": True}]))
    t["obs"] = table(spark, "obs", obs_rows)
    return t


OLD = [
    {"obs_id": 1, "person_id": 1, "concept_id": 100, "encounter_id": 10, "location_id": 1, "value_numeric": 65.5,
     "date_created": D0, "voided": False},
    {"obs_id": 2, "person_id": 1, "concept_id": 400, "encounter_id": 10, "location_id": 1, "value_coded": 200,
     "date_created": D0, "voided": False},
]
NEW = [
    {"obs_id": 3, "person_id": 1, "concept_id": 300, "encounter_id": 10, "location_id": 1, "value_numeric": 37.0,
     "date_created": D1, "voided": False},
    {"obs_id": 4, "person_id": 2, "concept_id": 400, "encounter_id": 12, "location_id": 1, "value_coded": 201,
     "date_created": D1, "voided": False},
]


@pytest.fixture
def states(spark):
    old = _world(spark, OLD)
    now = _world(spark, OLD + NEW)
    now["encounter"] = now["encounter"].unionByName(table(spark, "encounter", [
        {"encounter_id": 12, "patient_id": 2, "visit_id": 5, "encounter_type": 1, "location_id": 1,
         "date_created": D1, "voided": False}]))
    flat_old = flatten_observations(old)
    cat_old = build_catalog(flat_old)
    return old, now, flat_old, cat_old, widen(flat_old, catalog=cat_old)


def _by_enc(df):
    return {r.encounter_id: r.asDict() for r in df.collect()}


def test_touched_keeps_old_values_and_fills_new_answer(states):
    old, now, flat_old, cat_old, wide_old = states
    wide, flat, cat = incr.refresh_wide_touched(wide_old, cat_old, flat_old, now, T)
    rows = _by_enc(wide)
    assert rows[10]["weight_kg_value"] == 65.5 and rows[10]["temperature_value"] == 37.0   # H5 fixed
    assert rows[10]["smoker_no"] == 0 and rows[12]["smoker_no"] == 1                     # new answer, 0 for old
    full = widen(flatten_observations(now))
    assert sorted(map(tuple, wide.select(*full.columns).collect()), key=repr) == \
        sorted(map(tuple, full.collect()), key=repr)


def test_window_mode_loses_older_values(states):
    old, now, flat_old, cat_old, wide_old = states
    flat_new = incr.refresh_flat_window(flat_old, now, start=T)
    wide, _ = incr.refresh_wide_window(wide_old, cat_old, flat_new, start=T)
    rows = _by_enc(wide)
    assert rows[10]["weight_kg_value"] is None and rows[10]["temperature_value"] == 37.0   # H5, as the source


def test_empty_target_reload_never_inserts_voided(spark):
    t = _world(spark, OLD + [dict(NEW[0], voided=True)])
    flat = incr.refresh_flat_window(None, t)                                              # H3
    assert sorted(r.obs_id for r in flat.collect()) == [1, 2]


def test_split_location_is_reported(spark):
    t = _world(spark, OLD + [dict(NEW[0], date_created=D0)])
    t["location"] = t["location"].unionByName(table(spark, "location", [{"location_id": 3, "name": "Annex",
                                                                          "retired": False}]))
    t["obs"] = t["obs"].unionByName(table(spark, "obs", [
        {"obs_id": 9, "person_id": 1, "concept_id": 100, "encounter_id": 10, "location_id": 3,
         "value_numeric": 1.0, "date_created": D0, "voided": False}]))
    wide = widen(flatten_observations(t))
    from chartfold.plans.analytics import duplicate_keys
    assert [tuple(r) for r in duplicate_keys(wide, ["person_id", "encounter_id"]).collect()] == [(1, 10, 2)]  # H8


@pytest.mark.parametrize("cut", [dt.datetime(2000, 12, 1), dt.datetime(2001, 7, 10)])
def test_touched_equals_full_rebuild_on_driver_data(spark, small_dir, cut):
    src = ClinicalSource(spark, small_dir)
    old = src.at(cut).tables()
    raw = incr.ingest(old, src.tables(), cut)
    flat_old = flatten_observations(old)
    cat_old = build_catalog(flat_old)
    wide, _, cat = incr.refresh_wide_touched(widen(flat_old, catalog=cat_old), cat_old, flat_old, raw, cut)
    full = widen(flatten_observations(src.tables()))
    assert wide.columns == full.columns
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)


def test_ingest_reproduces_current_source(spark, small_dir):
    src = ClinicalSource(spark, small_dir)
    cut = dt.datetime(2000, 1, 1)
    merged = incr.ingest(src.at(cut).tables(), src.tables(), cut)
    for name in ("obs", "encounter", "visit"):
        a = sorted(map(tuple, merged[name].collect()), key=repr)
        b = sorted(map(tuple, src.table(name).select(*merged[name].columns).collect()), key=repr)
        assert a == b, name
