"""Flatten joins: semantics of the source SQL on literal fixtures."""
import datetime as dt

from pyspark.sql import functions as F

from chartfold.plans.flatten import FLAT_OBS_COLUMNS, flatten_appointments, flatten_observations, latest_states
from helpers import D0, base_tables, table


def _obs(**kw):
    row = {"obs_id": 1, "person_id": 1, "concept_id": 100, "encounter_id": 10, "location_id": 1,
           "value_numeric": 65.5, "date_created": D0, "voided": False}
    row.update(kw)
    return row


def test_flat_columns_and_names(spark):
    t = base_tables(spark)
    t["obs"] = table(spark, "obs", [_obs()])
    flat = flatten_observations(t)
    assert flat.columns == FLAT_OBS_COLUMNS and len(FLAT_OBS_COLUMNS) == 46
    r = flat.collect()[0]
    assert r.concept_name == "Weight (kg)"            # en only; fr name does not match (two_locales)
    assert r.location_name == "Clinic A" and r.encounter_type_name == "Adult Visit"


def test_no_encounter_and_voided_rows_dropped(spark):
    t = base_tables(spark)
    t["obs"] = table(spark, "obs", [
        _obs(obs_id=1), _obs(obs_id=2, encounter_id=None), _obs(obs_id=3, voided=True),
        _obs(obs_id=4, encounter_id=11)])                 # voided encounter
    assert [r.obs_id for r in flatten_observations(t).collect()] == [1]


def test_two_preferred_names_fan_out(spark):
    t = base_tables(spark)
    t["concept_name"] = t["concept_name"].unionByName(table(spark, "concept_name", [
        {"concept_name_id": 9, "concept_id": 100, "name": "Body weight", "locale": "en", "locale_preferred": True}]))
    t["obs"] = table(spark, "obs", [_obs()])
    assert sorted(r.concept_name for r in flatten_observations(t).collect()) == ["Body weight", "Weight (kg)"]


def test_location_name_from_obs_location_id_from_visit(spark):
    t = base_tables(spark)
    t["obs"] = table(spark, "obs", [_obs(location_id=2)])
    r = flatten_observations(t).collect()[0]
    assert r.location_name == "Old Clinic" and r.location_id == 1   # J6


def _appt_tables(spark):
    t = base_tables(spark)
    t["person"] = table(spark, "person", [{"person_id": 1, "gender": "F", "birthdate": dt.date(2000, 12, 31)}])
    t["person_name"] = table(spark, "person_name", [
        {"person_name_id": 1, "person_id": 1, "given_name": "Ann", "family_name": None, "preferred": True,
         "voided": False}])
    t["provider"] = table(spark, "provider", [{"provider_id": 7, "person_id": 99, "retired": False}])
    t["appointment_service"] = table(spark, "appointment_service", [
        {"appointment_service_id": 1, "name": "Gone", "voided": True}])
    t["appointment_service_type"] = table(spark, "appointment_service_type", [])
    t["patient_appointment"] = table(spark, "patient_appointment", [{
        "patient_appointment_id": 1, "patient_id": 1, "start_date_time": dt.datetime(2024, 1, 1, 10, 0, 59),
        "end_date_time": dt.datetime(2024, 1, 1, 10, 1, 0), "appointment_service_id": 1, "location_id": 2,
        "provider_id": 7, "voided": False, "tele_health_video_link": None}])
    return t


def test_appointment_semantics(spark):
    r = flatten_appointments(_appt_tables(spark), as_of=dt.date(2001, 1, 1)).collect()[0]
    assert r.duration_minutes == 1                        # minute boundaries (X3)
    assert r.patient_age == 1                             # year boundaries (X2)
    assert r.patient_name == "Ann "                       # NULL family name skipped (X1)
    assert r.provider_name == " "                         # no preferred name at all
    assert r.service_name is None and r.location_name is None   # voided / retired dimension (F3)
    assert r.is_telehealth == 0


def test_latest_state_order(spark):
    d = dt.date
    st = table(spark, "patient_state", [
        {"patient_state_id": 1, "patient_program_id": 1, "state": 1, "start_date": d(2024, 1, 1),
         "date_created": D0, "voided": False},
        {"patient_state_id": 2, "patient_program_id": 1, "state": 2, "start_date": d(2024, 1, 1),
         "date_created": dt.datetime(2024, 2, 1), "voided": False},       # tie on start -> later created
        {"patient_state_id": 3, "patient_program_id": 1, "state": 3, "start_date": None,
         "date_created": dt.datetime(2025, 1, 1), "voided": False},       # NULL start sorts last
        {"patient_state_id": 4, "patient_program_id": 1, "state": 4, "start_date": d(2025, 1, 1),
         "date_created": D0, "voided": True},                              # voided ignored
        {"patient_state_id": 5, "patient_program_id": 2, "state": 5, "start_date": d(2024, 1, 1),
         "date_created": D0, "voided": False},
        {"patient_state_id": 6, "patient_program_id": 2, "state": 6, "start_date": d(2024, 1, 1),
         "date_created": D0, "voided": False},                             # full tie -> higher id
    ])
    got = {r.patient_program_id: r.patient_state_id for r in latest_states(st).collect()}
    assert got == {1: 2, 2: 6}
