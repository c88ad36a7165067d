import datetime as dt

from pyspark.sql import types as T

FLAT_SCHEMA = T.StructType([
    T.StructField("person_id", T.LongType()), T.StructField("encounter_id", T.LongType()),
    T.StructField("encounter_type_name", T.StringType()), T.StructField("visit_date_started", T.TimestampNTZType()),
    T.StructField("location_name", T.StringType()), T.StructField("concept_name", T.StringType()),
    T.StructField("value_coded", T.LongType()), T.StructField("value_coded_name", T.StringType()),
    T.StructField("value_numeric", T.DoubleType()), T.StructField("value_text", T.StringType()),
    T.StructField("value_datetime", T.TimestampNTZType()), T.StructField("value_drug", T.LongType()),
    T.StructField("value_complex", T.StringType()), T.StructField("date_created", T.TimestampNTZType()),
    T.StructField("obs_id", T.LongType()),
])
D0 = dt.datetime(2024, 1, 1)


def obs(person, enc, concept, coded=None, answer=None, num=None, text=None, when=None, drug=None,
        complex_=None, created=D0, obs_id=None, location="Clinic A", etype="Adult Visit", visit=D0):
    return (person, enc, etype, visit, location, concept, coded, answer, num, text, when, drug, complex_,
            created, obs_id)


def flat_df(spark, rows):
    rows = [r if r[-1] is not None else r[:-1] + (i + 1,) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, FLAT_SCHEMA)


def rows_by(df, key="person_id"):
    return {r[key]: r.asDict() for r in df.collect()}

# raw clinical table schemas (FIXTURES.md part A), for literal fixtures
RAW_DDL = {
    "obs": "obs_id long, person_id long, concept_id long, encounter_id long, location_id long, obs_group_id long, "
           "accession_number string, form_namespace_and_path string, value_coded long, value_coded_name_id long, "
           "value_drug long, value_datetime timestamp_ntz, value_numeric double, value_modifier string, "
           "value_text string, value_complex string, comments string, creator long, date_created timestamp_ntz, "
           "obs_datetime timestamp_ntz, voided boolean, void_reason string, date_voided timestamp_ntz, "
           "previous_version long",
    "concept_name": "concept_name_id long, concept_id long, name string, uuid string, locale string, "
                    "locale_preferred boolean, date_created timestamp_ntz",
    "encounter": "encounter_id long, patient_id long, visit_id long, encounter_type long, location_id long, "
                 "encounter_datetime timestamp_ntz, date_created timestamp_ntz, voided boolean, date_voided timestamp_ntz",
    "encounter_type": "encounter_type_id long, name string, description string, uuid string, retired boolean",
    "visit": "visit_id long, patient_id long, visit_type_id long, location_id long, date_started timestamp_ntz, "
             "date_stopped timestamp_ntz, date_created timestamp_ntz, voided boolean",
    "visit_type": "visit_type_id long, name string, uuid string, retired boolean",
    "location": "location_id long, name string, description string, address1 string, address2 string, "
                "city_village string, state_province string, postal_code string, country string, retired boolean, "
                "uuid string",
    "person": "person_id long, gender string, birthdate date, dead boolean, death_date timestamp_ntz",
    "person_name": "person_name_id long, person_id long, given_name string, middle_name string, "
                   "family_name string, preferred boolean, voided boolean",
    "provider": "provider_id long, person_id long, retired boolean",
    "appointment_service": "appointment_service_id long, name string, description string, duration_mins long, "
                           "start_time string, end_time string, voided boolean",
    "appointment_service_type": "appointment_service_type_id long, name string, duration_mins long, voided boolean",
    "patient_appointment": "patient_appointment_id long, appointment_number string, uuid string, patient_id long, "
                           "start_date_time timestamp_ntz, end_date_time timestamp_ntz, "
                           "date_appointment_scheduled timestamp_ntz, status string, appointment_kind string, "
                           "priority string, comments string, appointment_service_id long, "
                           "appointment_service_type_id long, location_id long, provider_id long, "
                           "related_appointment_id long, tele_health_video_link string, date_created timestamp_ntz, "
                           "date_changed timestamp_ntz, voided boolean, void_reason string",
    "patient_state": "patient_state_id long, patient_program_id long, state long, start_date date, end_date date, "
                     "uuid string, date_created timestamp_ntz, voided boolean",
}


def table(spark, name, rows):
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(RAW_DDL[name])
    cols = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


def base_tables(spark):
    """A tiny consistent clinical world; tests override single tables."""
    return {
        "concept_name": table(spark, "concept_name", [
            {"concept_name_id": 1, "concept_id": 100, "name": "Weight (kg)", "locale": "en", "locale_preferred": True},
            {"concept_name_id": 2, "concept_id": 100, "name": "Poids", "locale": "fr", "locale_preferred": True},
            {"concept_name_id": 3, "concept_id": 200, "name": "Yes", "locale": "en", "locale_preferred": True},
            {"concept_name_id": 4, "concept_id": 300, "name": "Temperature", "locale": "en", "locale_preferred": True},
        ]),
        "encounter": table(spark, "encounter", [
            {"encounter_id": 10, "patient_id": 1, "visit_id": 5, "encounter_type": 1, "location_id": 1,
             "date_created": D0, "voided": False},
            {"encounter_id": 11, "patient_id": 1, "visit_id": 5, "encounter_type": 1, "location_id": 1,
             "date_created": D0, "voided": True},
        ]),
        "encounter_type": table(spark, "encounter_type", [{"encounter_type_id": 1, "name": "Adult Visit",
                                                           "retired": False}]),
        "visit": table(spark, "visit", [{"visit_id": 5, "visit_type_id": 1, "location_id": 1, "date_started": D0,
                                         "voided": False}]),
        "visit_type": table(spark, "visit_type", [{"visit_type_id": 1, "name": "Outpatient", "retired": False}]),
        "location": table(spark, "location", [
            {"location_id": 1, "name": "Clinic A", "retired": False},
            {"location_id": 2, "name": "Old Clinic", "retired": True}]),
    }
