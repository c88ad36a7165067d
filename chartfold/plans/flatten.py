"""Denormalised flat tables.

Join order is chosen for scale: the encounter side (encounter -> visit ->
types) is assembled first, so the largest table (obs) is shuffled once, on
``encounter_id``.  That hash partitioning also satisfies the wide group-by
(its keys include ``encounter_id``), so flatten + widen need no further
exchange.  Dictionary tables go through ``bounded_broadcast``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sqlcompat import day_boundaries, flag, full_name, minute_boundaries, year_boundaries
from ..operators.joins import bounded_broadcasts
from ..operators.skew import split_join
from ..operators.topone import latest_per_parent

FLAT_OBS_COLUMNS = [
    "obs_id", "person_id", "concept_id", "concept_name", "concept_uuid", "obs_group_id",
    "accession_number", "form_namespace_and_path", "value_coded", "value_coded_name",
    "value_coded_uuid", "value_coded_name_id", "value_drug", "value_datetime", "value_numeric",
    "value_modifier", "value_text", "value_complex", "comments", "creator", "date_created",
    "obs_voided", "obs_void_reason", "previous_version", "encounter_id", "encounter_voided",
    "encounter_type_name", "encounter_type_description", "encounter_type_uuid",
    "encounter_type_retired", "visit_id", "visit_date_started", "visit_date_stopped",
    "visit_type_name", "visit_type_uuid", "visit_type_retired", "location_id", "location_name",
    "location_address1", "location_address2", "location_city_village", "location_state_province",
    "location_postal_code", "location_country", "location_retired", "location_uuid",
]

#: Ids and dates behind a flat row that the flat table itself does not show; a store keeps them (``source_ids``).
SOURCE_IDS = ("x_location_id", "x_encounter_type", "x_visit_type", "x_encounter_date")


def _live(df: DataFrame, flag_col: str) -> DataFrame:
    """Soft-delete filter: ``flag = 0`` (NULL is not live either)."""
    return df.where(~F.col(flag_col))


def preferred_names(concept_name: DataFrame, prefix: str, locale: str = "en") -> DataFrame:
    """Preferred names in one locale, renamed for one role of the dictionary."""
    cn = concept_name.where(F.col("locale_preferred") & (F.col("locale") == locale))
    return cn.select(F.col("concept_id").alias(prefix + "concept_id"),
                     F.col("name").alias(prefix + "name"), F.col("uuid").alias(prefix + "uuid"))


def flatten_observations(t: dict[str, DataFrame], obs_filter: Column | None = None,
                         void_filter: bool = True, source_ids: bool = False, split_visits: bool = True,
                         by: tuple[str, Column] | None = None) -> DataFrame:
    """``flattened_observations``: one row per live obs of a live encounter (x name fan-out).

    ``source_ids`` adds the ids the dictionary joins went by and the encounter's date (``SOURCE_IDS``).
    ``split_visits`` deals the encounters of heavy visits, and those without a visit, over many tasks (J3);
    a caller that knows its encounters to be few saves the look at their keys.
    ``by``, a name and an expression over the visit's and the encounter's (``e_date``) dates, adds a column that the rows are dealt
    and sorted by: before the dictionaries are joined where these are broadcast, so that none of their texts is shuffled or sorted.
    """
    obs = t["obs"]
    if obs_filter is not None:
        obs = obs.where(obs_filter)
    if void_filter:
        obs = _live(obs, "voided")
    enc = _live(t["encounter"], "voided").select(
        F.col("encounter_id").alias("e_encounter_id"), F.col("visit_id").alias("e_visit_id"),
        F.col("encounter_type").alias("e_type"), F.col("voided").alias("encounter_voided"),
        *([F.coalesce("encounter_datetime", "date_created").alias("e_date")] if source_ids or by is not None else []))
    visit = t["visit"].select(
        F.col("visit_id"), F.col("visit_type_id").alias("v_visit_type_id"),
        F.col("date_started").alias("visit_date_started"),
        F.col("date_stopped").alias("visit_date_stopped"),
        F.col("location_id").alias("v_location_id"))
    et = (t["encounter_type"].select(
        F.col("encounter_type_id").alias("et_id"), F.col("name").alias("encounter_type_name"),
        F.col("description").alias("encounter_type_description"),
        F.col("uuid").alias("encounter_type_uuid"), F.col("retired").alias("encounter_type_retired")))
    vt = (t["visit_type"].select(
        F.col("visit_type_id").alias("vt_id"), F.col("name").alias("visit_type_name"),
        F.col("uuid").alias("visit_type_uuid"), F.col("retired").alias("visit_type_retired")))
    loc = (t["location"].select(
        F.col("location_id").alias("l_id"), F.col("name").alias("location_name"),
        *[F.col(c).alias("location_" + c) for c in
          ("address1", "address2", "city_village", "state_province", "postal_code",
           "country", "retired", "uuid")]))
    names = t["concept_name"]
    vn = preferred_names(names, "vn_")
    qn = preferred_names(names, "qn_")
    large = [et, vt, loc, vn, qn]
    et, vt, loc, vn, qn = small = bounded_broadcasts(large)
    early = by is not None and all(a is not b for a, b in zip(small, large))

    def typed(df):
        return df.join(et, F.col("e_type") == et.et_id, "left").join(vt, F.col("v_visit_type_id") == vt.vt_id, "left")

    def dealt(df):
        return df.hint("rebalance", by[0]).sortWithinPartitions(by[0])

    # encounter side first: encounter -> visit -> encounter_type, visit_type
    if split_visits:
        ev = split_join(enc, visit, "e_visit_id", "visit_id", spread="e_encounter_id")
    else:
        ev = enc.join(visit, enc.e_visit_id == visit.visit_id, "left")
    if not early:
        ev = typed(ev)
    # obs LEFT JOIN encounter ... WHERE encounter.voided = 0  ==  inner join with live encounters
    flat = obs.join(ev, obs.encounter_id == ev.e_encounter_id, "inner")
    if by is not None:
        flat = flat.withColumn(*by)
    if early:
        flat = typed(dealt(flat))
    flat = flat.join(loc, flat.location_id == loc.l_id, "left")  # obs-level location (J6)
    flat = flat.join(vn, flat.value_coded == vn.vn_concept_id, "left")
    flat = flat.join(qn, flat.concept_id == qn.qn_concept_id, "left")
    behind = [obs.location_id, F.col("e_type"), F.col("v_visit_type_id"), F.col("e_date")] if source_ids else []
    flat = flat.select(
        "obs_id", "person_id", "concept_id",
        F.col("qn_name").alias("concept_name"), F.col("qn_uuid").alias("concept_uuid"),
        "obs_group_id", "accession_number", "form_namespace_and_path", "value_coded",
        F.col("vn_name").alias("value_coded_name"), F.col("vn_uuid").alias("value_coded_uuid"),
        "value_coded_name_id", "value_drug", "value_datetime", "value_numeric", "value_modifier",
        "value_text", "value_complex", "comments", "creator", "date_created",
        F.col("voided").alias("obs_voided"), F.col("void_reason").alias("obs_void_reason"),
        "previous_version", F.col("e_encounter_id").alias("encounter_id"), "encounter_voided",
        "encounter_type_name", "encounter_type_description", "encounter_type_uuid",
        "encounter_type_retired", "visit_id", "visit_date_started", "visit_date_stopped",
        "visit_type_name", "visit_type_uuid", "visit_type_retired",
        F.col("v_location_id").alias("location_id"),  # visit's location, as in the source SQL
        "location_name", "location_address1", "location_address2", "location_city_village",
        "location_state_province", "location_postal_code", "location_country",
        "location_retired", "location_uuid", *[c.alias(n) for c, n in zip(behind, SOURCE_IDS)],
        *([by[0]] if by is not None else []))
    return flat if by is None or early else dealt(flat)


def _as_of_date(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of)


def _person_names(t, prefix: str) -> DataFrame:
    pn = t["person_name"].where(F.col("preferred") & ~F.col("voided"))
    return pn.select(F.col("person_id").alias(prefix + "person_id"),
                     *[F.col(c).alias(prefix + c) for c in ("given_name", "middle_name", "family_name")])


def flatten_appointments(t: dict[str, DataFrame], as_of=None, appt_filter: Column | None = None,
                         void_filter: bool = True) -> DataFrame:
    """``flattened_appointments``."""
    today = _as_of_date(as_of)
    pa = t["patient_appointment"]
    if appt_filter is not None:
        pa = pa.where(appt_filter)
    if void_filter:
        pa = _live(pa, "voided")
    person = t["person"].select(F.col("person_id").alias("p_id"), "gender", "birthdate")
    pn = _person_names(t, "pn_")
    svc = (_live(t["appointment_service"], "voided").select(
        F.col("appointment_service_id").alias("s_id"), F.col("name").alias("service_name"),
        F.col("description").alias("service_description"),
        F.col("duration_mins").alias("service_default_duration"),
        F.col("start_time").alias("service_start_time"), F.col("end_time").alias("service_end_time")))
    stype = (_live(t["appointment_service_type"], "voided").select(
        F.col("appointment_service_type_id").alias("st_id"), F.col("name").alias("service_type_name"),
        F.col("duration_mins").alias("service_type_duration")))
    loc = (_live(t["location"], "retired").select(
        F.col("location_id").alias("l_id"), F.col("name").alias("location_name"),
        F.col("description").alias("location_description")))
    prov = _live(t["provider"], "retired").select(
        F.col("provider_id").alias("pr_id"), F.col("person_id").alias("pr_person_id"))
    persons = prov.select(F.col("pr_person_id").alias("x_person_id")).distinct()
    svc, stype, loc, persons = bounded_broadcasts([svc, stype, loc, persons])
    # the names of provider persons only (J14): the table of all persons' names is read, not shuffled
    ppn = _person_names(t, "ppn_")
    ppn = ppn.join(persons, ppn.ppn_person_id == F.col("x_person_id"), "left_semi")
    named = prov.join(ppn, prov.pr_person_id == ppn.ppn_person_id, "left")
    prov, = bounded_broadcasts([named])

    j = pa.join(person, pa.patient_id == person.p_id, "left")
    j = j.join(pn, j.patient_id == pn.pn_person_id, "left")
    j = j.join(svc, j.appointment_service_id == svc.s_id, "left")
    j = j.join(stype, j.appointment_service_type_id == stype.st_id, "left")
    j = j.join(loc, j.location_id == loc.l_id, "left")
    if prov is named:                                        # too many to broadcast: few providers may hold most rows (J13)
        j = split_join(j, prov, "provider_id", "pr_id", spread="patient_appointment_id")
    else:
        j = j.join(prov, j.provider_id == prov.pr_id, "left")
    return j.select(
        "patient_appointment_id", "appointment_number", F.col("uuid").alias("appointment_uuid"),
        "patient_id", full_name("pn_given_name", "pn_family_name").alias("patient_name"),
        F.col("gender").alias("patient_gender"),
        year_boundaries(F.col("birthdate"), today).alias("patient_age"),
        "start_date_time", "end_date_time",
        minute_boundaries("start_date_time", "end_date_time").alias("duration_minutes"),
        "date_appointment_scheduled", "status", "appointment_kind", "priority", "comments",
        "appointment_service_id", "service_name", "service_description", "service_default_duration",
        "service_start_time", "service_end_time", "appointment_service_type_id", "service_type_name",
        "service_type_duration", "location_id", "location_name", "location_description",
        "provider_id", full_name("ppn_given_name", "ppn_family_name").alias("provider_name"),
        "related_appointment_id", "tele_health_video_link",
        flag(F.col("tele_health_video_link").isNotNull()).alias("is_telehealth"),
        "date_created", "date_changed", "voided", "void_reason")


STATE_PAYLOAD = ("patient_state_id", "state", "start_date", "end_date", "uuid", "date_created")


def latest_states(patient_state: DataFrame) -> DataFrame:
    """Latest live state per enrolment: start_date DESC, date_created DESC, id DESC."""
    live = _live(patient_state, "voided")
    return latest_per_parent(live, "patient_program_id", ["start_date", "date_created"],
                             tie="patient_state_id", payload=list(STATE_PAYLOAD))


def flatten_patient_program(t: dict[str, DataFrame], as_of=None) -> DataFrame:
    """``flattened_patient_program``."""
    today = _as_of_date(as_of)
    pp = _live(t["patient_program"], "voided")
    person = t["person"].select(F.col("person_id").alias("p_id"), "gender", "birthdate", "dead",
                                "death_date")
    pn = _person_names(t, "pn_")
    prog = (_live(t["program"], "retired").select(
        F.col("program_id").alias("pg_id"), F.col("name").alias("program_name"),
        F.col("description").alias("program_description"), F.col("uuid").alias("program_uuid")))
    names = t["concept_name"]
    on = preferred_names(names, "on_")
    sn = preferred_names(names, "sn_")
    wn = preferred_names(names, "wn_")
    loc = (_live(t["location"], "retired").select(
        F.col("location_id").alias("l_id"), F.col("name").alias("enrollment_location_name"),
        F.col("city_village").alias("enrollment_location_city"),
        F.col("state_province").alias("enrollment_location_state"),
        F.col("uuid").alias("enrollment_location_uuid")))
    ps = latest_states(t["patient_state"]).select(
        F.col("patient_program_id").alias("ps_pp_id"),
        F.col("patient_state_id").alias("current_state_id"), F.col("state").alias("ps_state"),
        F.col("start_date").alias("current_state_start_date"),
        F.col("end_date").alias("current_state_end_date"), F.col("uuid").alias("current_state_uuid"))
    pws = (_live(t["program_workflow_state"], "retired").select(
        F.col("program_workflow_state_id").alias("current_workflow_state_id"),
        F.col("program_workflow_id").alias("pws_workflow_id"),
        F.col("concept_id").alias("pws_concept_id"),
        F.col("initial").alias("is_initial_state"), F.col("terminal").alias("is_terminal_state")))
    pw = (_live(t["program_workflow"], "retired").select(
        F.col("program_workflow_id"), F.col("concept_id").alias("pw_concept_id")))
    prog, on, sn, wn, loc, pws, pw = bounded_broadcasts([prog, on, sn, wn, loc, pws, pw])

    j = pp.join(person, pp.patient_id == person.p_id, "left")
    j = j.join(pn, j.patient_id == pn.pn_person_id, "left")
    j = j.join(prog, j.program_id == prog.pg_id, "left")
    j = j.join(on, j.outcome_concept_id == on.on_concept_id, "left")
    j = j.join(loc, j.location_id == loc.l_id, "left")
    j = j.join(ps, j.patient_program_id == ps.ps_pp_id, "left")
    j = j.join(pws, j.ps_state == pws.current_workflow_state_id, "left")
    j = j.join(sn, j.pws_concept_id == sn.sn_concept_id, "left")
    j = j.join(pw, j.pws_workflow_id == pw.program_workflow_id, "left")
    j = j.join(wn, j.pw_concept_id == wn.wn_concept_id, "left")
    enrolled = F.col("date_enrolled").cast("date")
    completed = F.col("date_completed").cast("date")
    return j.select(
        "patient_program_id", F.col("uuid").alias("patient_program_uuid"), "patient_id",
        full_name("pn_given_name", "pn_family_name").alias("patient_name"),
        F.col("pn_given_name").alias("patient_given_name"),
        F.col("pn_middle_name").alias("patient_middle_name"),
        F.col("pn_family_name").alias("patient_family_name"),
        F.col("gender").alias("patient_gender"), F.col("birthdate").alias("patient_birthdate"),
        year_boundaries(F.col("birthdate").cast("date"), today).alias("patient_age"),
        F.col("dead").alias("patient_dead"), F.col("death_date").alias("patient_death_date"),
        F.col("pg_id").alias("program_id"), "program_name", "program_description", "program_uuid",
        "date_enrolled", "date_completed",
        flag(F.col("date_completed").isNull()).alias("is_active"),
        F.when(F.col("date_completed").isNotNull(), day_boundaries(enrolled, completed))
         .otherwise(day_boundaries(enrolled, today)).alias("days_in_program"),
        "outcome_concept_id", F.col("on_name").alias("outcome_name"),
        F.col("on_uuid").alias("outcome_uuid"),
        F.col("location_id").alias("enrollment_location_id"), "enrollment_location_name",
        "enrollment_location_city", "enrollment_location_state", "enrollment_location_uuid",
        "current_state_id", "current_state_start_date", "current_state_end_date",
        "current_state_uuid", "current_workflow_state_id",
        F.col("sn_name").alias("current_state_name"),
        F.col("sn_uuid").alias("current_state_concept_uuid"),
        "is_initial_state", "is_terminal_state", "program_workflow_id",
        F.col("wn_name").alias("workflow_name"), F.col("wn_uuid").alias("workflow_concept_uuid"),
        "date_created", "date_changed", "voided", "void_reason")
