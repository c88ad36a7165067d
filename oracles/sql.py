"""DuckDB oracle SQL for every registered query.

Independent of the Spark code: flat tables are written as SQL joins in the
source dialect (DuckDB's own concat and date_diff) over live dimensions, and pivot oracles
discover their columns with DuckDB over the same parquet files, then emit a
filtered aggregate per column.
"""

from __future__ import annotations

import datetime as _dt
import os
import re

from .views import with_views

AS_OF = "DATE '2024-01-01'"
ORACLE_SF_DIR = os.environ.get("CHARTFOLD_ORACLE_SF_DIR", "/root/testdata/sf0.01")
DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()

# --- flat tables ------------------------------------------------------------

# Output names (columns and their prefixes) are fixed values of the source schema.  Every dimension is a subquery
# that keeps its live rows, names its columns as the flat table does, and calls its key as the side that points to it.

def _dim(table: str, key: str, columns: dict[str, str], live: str = "true", keep_key: bool = False) -> str:
    """``key``: "column AS name to join by"; ``columns``: output name -> column."""
    picked = [key] + ([key.split(" AS ")[0]] if keep_key else []) + [f"{c} AS {n}" for n, c in columns.items()]
    return f"(SELECT {', '.join(picked)} FROM {table} WHERE {live})"


def _prefixed(prefix: str, *columns: str) -> dict[str, str]:
    return {f"{prefix}_{c}": c for c in columns}


def _star(core: str, dims, drop, replace: str = "") -> str:
    """``core`` with each (join key, subquery) attached, rows of the core kept; ``drop``: join keys that are no output."""
    joins = "\n  ".join(f"LEFT JOIN {sub} USING ({key})" for key, sub in dims)
    without = f"EXCLUDE ({', '.join(drop)})" if drop else ""
    return f"\n  SELECT * {without} {replace}\n  FROM {core}\n  {joins}"


ENGLISH = "locale = 'en' AND locale_preferred"
FULL_NAME = "concat(given_name, ' ', family_name)"
LIVE_NAME = "preferred AND NOT voided"


def flat_obs(prefix: str = "", extra: str = "") -> str:
    core = f"""(SELECT * EXCLUDE (voided, void_reason, location_id),
      voided AS obs_voided, void_reason AS obs_void_reason, location_id AS place_ref
    FROM (SELECT {OBS_COLUMNS} FROM {prefix}obs o WHERE NOT voided {extra})
    JOIN (SELECT encounter_id, visit_id AS visit_ref, encounter_type AS type_ref, voided AS encounter_voided
          FROM {prefix}encounter WHERE NOT voided) USING (encounter_id))"""
    return _star(core, [
        ("concept_id", _dim("concept_name", "concept_id", _prefixed("concept", "name", "uuid"), ENGLISH)),
        ("value_coded", _dim("concept_name", "concept_id AS value_coded", _prefixed("value_coded", "name", "uuid"), ENGLISH)),
        ("type_ref", _dim("encounter_type", "encounter_type_id AS type_ref",
                          _prefixed("encounter_type", "name", "description", "uuid", "retired"))),
        ("visit_ref", _dim(f"{prefix}visit", "visit_id AS visit_ref",
                           {"location_id": "location_id", "visit_type_ref": "visit_type_id", **_prefixed("visit", "date_started", "date_stopped")},
                           keep_key=True)),
        ("visit_type_ref", _dim("visit_type", "visit_type_id AS visit_type_ref", _prefixed("visit_type", "name", "uuid", "retired"))),
        ("place_ref", _dim("location", "location_id AS place_ref",
                           _prefixed("location", "name", "address1", "address2", "city_village", "state_province", "postal_code",
                                     "country", "retired", "uuid"))),
    ], drop=("type_ref", "visit_ref", "visit_type_ref", "place_ref"))


OBS_COLUMNS = ("obs_id, person_id, concept_id, encounter_id, location_id, obs_group_id, accession_number, form_namespace_and_path, "
               "value_coded, value_coded_name_id, value_drug, value_datetime, value_numeric, value_modifier, value_text, "
               "value_complex, comments, creator, date_created, voided, void_reason, previous_version")


def flat_appointments(prefix: str = "", extra: str = "") -> str:
    core = f"""(SELECT patient_appointment_id, appointment_number, uuid AS appointment_uuid, patient_id, provider_id, location_id,
      appointment_service_id, appointment_service_type_id, related_appointment_id, status, appointment_kind, priority, comments,
      start_date_time, end_date_time, date_diff('minute', start_date_time, end_date_time) AS duration_minutes,
      date_appointment_scheduled, tele_health_video_link, CAST(tele_health_video_link IS NOT NULL AS INTEGER) AS is_telehealth,
      date_created, date_changed, voided, void_reason
    FROM {prefix}patient_appointment pa WHERE NOT voided {extra})"""
    names = _dim("person_name", "person_id", {"provider_name": FULL_NAME}, LIVE_NAME)
    return _star(core, [
        ("patient_id", _dim("person", "person_id AS patient_id",
                            {"patient_gender": "gender", "patient_age": f"date_diff('year', birthdate, {AS_OF})"})),
        ("patient_id", _dim("person_name", "person_id AS patient_id", {"patient_name": FULL_NAME}, LIVE_NAME)),
        ("provider_id", f"(SELECT provider_id, provider_name FROM {_dim('provider', 'provider_id', {'person_id': 'person_id'}, 'NOT retired')} "
                        f"LEFT JOIN {names} USING (person_id))"),
        ("location_id", _dim("location", "location_id", _prefixed("location", "name", "description"), "NOT retired")),
        ("appointment_service_id", _dim("appointment_service", "appointment_service_id",
                                        {"service_default_duration": "duration_mins",
                                         **_prefixed("service", "name", "description", "start_time", "end_time")}, "NOT voided")),
        ("appointment_service_type_id", _dim("appointment_service_type", "appointment_service_type_id",
                                             {"service_type_name": "name", "service_type_duration": "duration_mins"}, "NOT voided")),
    ], drop=(), replace="REPLACE (coalesce(patient_name, ' ') AS patient_name, coalesce(provider_name, ' ') AS provider_name)")


def flat_programs() -> str:
    core = f"""(SELECT patient_program_id, uuid AS patient_program_uuid, patient_id, program_id AS program_ref, outcome_concept_id,
      location_id AS enrollment_location_id, date_enrolled, date_completed, CAST(date_completed IS NULL AS INTEGER) AS is_active,
      date_diff('day', CAST(date_enrolled AS DATE), coalesce(CAST(date_completed AS DATE), {AS_OF})) AS days_in_program,
      date_created, date_changed, voided, void_reason
    FROM patient_program WHERE NOT voided)"""
    return _star(core, [
        ("patient_id", _dim("person", "person_id AS patient_id",
                            {"patient_age": f"date_diff('year', CAST(birthdate AS DATE), {AS_OF})",
                             **_prefixed("patient", "gender", "birthdate", "dead", "death_date")})),
        ("patient_id", _dim("person_name", "person_id AS patient_id",
                            {"patient_name": FULL_NAME, **_prefixed("patient", "given_name", "middle_name", "family_name")}, LIVE_NAME)),
        ("program_ref", _dim("program", "program_id AS program_ref", _prefixed("program", "name", "description", "uuid"), "NOT retired", True)),
        ("outcome_concept_id", _dim("concept_name", "concept_id AS outcome_concept_id", _prefixed("outcome", "name", "uuid"), ENGLISH)),
        ("enrollment_location_id", _dim("location", "location_id AS enrollment_location_id",
                                        {"enrollment_location_city": "city_village", "enrollment_location_state": "state_province",
                                         **_prefixed("enrollment_location", "name", "uuid")}, "NOT retired")),
        ("patient_program_id", _dim(f"({LATEST_STATE})", "patient_program_id",
                                    {"current_state_id": "patient_state_id", "state_ref": "state",
                                     **_prefixed("current_state", "start_date", "end_date", "uuid")})),
        ("state_ref", _dim("program_workflow_state", "program_workflow_state_id AS state_ref",
                           {"current_workflow_state_id": "program_workflow_state_id", "state_concept": "concept_id",
                            "workflow_ref": "program_workflow_id", "is_initial_state": "initial", "is_terminal_state": "terminal"}, "NOT retired")),
        ("state_concept", _dim("concept_name", "concept_id AS state_concept",
                               {"current_state_name": "name", "current_state_concept_uuid": "uuid"}, ENGLISH)),
        ("workflow_ref", _dim("program_workflow", "program_workflow_id AS workflow_ref", {"workflow_concept": "concept_id"}, "NOT retired", True)),
        ("workflow_concept", _dim("concept_name", "concept_id AS workflow_concept",
                                  {"workflow_name": "name", "workflow_concept_uuid": "uuid"}, ENGLISH)),
    ], drop=("program_ref", "state_ref", "state_concept", "workflow_ref", "workflow_concept"),
        replace="REPLACE (coalesce(patient_name, ' ') AS patient_name)")


LATEST_STATE = """
  SELECT patient_program_id, patient_state_id, state, start_date, end_date, uuid, date_created FROM patient_state WHERE NOT voided
  QUALIFY row_number() OVER (PARTITION BY patient_program_id
    ORDER BY start_date DESC NULLS LAST, date_created DESC NULLS LAST, patient_state_id DESC) = 1"""

# --- pivot oracle -----------------------------------------------------------

_SPECIAL = "+/\\?=<>()&|!@#$%^*,.:;`\"'[]{}"
_RE2_CLASS = "[" + "".join("\\" + c for c in _SPECIAL) + "]"
KEYS = ("person_id", "encounter_id", "encounter_type_name", "visit_date_started", "location_name")
SUFFIX = {"numeric": "value", "text": "text", "datetime": "datetime", "drug": "drug_id"}
VALUE_COL = {"numeric": "value_numeric", "text": "value_text", "datetime": "value_datetime",
             "drug": "value_drug"}
RANK = {"coded": 0, "numeric": 1, "text": 2, "datetime": 3, "drug": 4}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def duck_safe(expr: str) -> str:
    cls = _q(_RE2_CLASS)
    s = f"regexp_replace({expr}, {cls}, '_', 'g')"
    s = f"regexp_replace({s}, ' ', '_', 'g')"
    s = f"regexp_replace({s}, '_+', '_', 'g')"
    return f"substring(lower(trim({s}, '_')), 1, 40)"


# first family of the order of precedence that has a value
TYPE_CASE = "coalesce(" + ", ".join(
    f"if({c} IS NULL, NULL, '{f}')" for f, c in {"coded": "value_coded", **VALUE_COL}.items()) + ", 'other')"


def _connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _unique(names, taken):
    seen = {t.lower() for t in taken}
    out = []
    for n in names:
        cand, i = n, 1
        while cand.lower() in seen:
            i += 1
            cand = f"{n}_{i}"
        seen.add(cand.lower())
        out.append(cand)
    return out


def pivot_catalog(flat_sql_with_views: str, where: str = "", families=tuple(RANK),
                  sf_dir: str | None = None, con=None, source: str = "flat"):
    """Discover (name, concept, family, answer) with DuckDB over the CTE ``source``."""
    own = con is None
    con = con or _connect(sf_dir or ORACLE_SF_DIR)
    sql = f"""{flat_sql_with_views}
      , d AS (SELECT DISTINCT concept_name AS c, {TYPE_CASE} AS f,
                CASE WHEN {TYPE_CASE} = 'coded' THEN value_coded_name END AS a
              FROM {source} WHERE concept_name IS NOT NULL {where})
      SELECT c, f, a, {duck_safe('c')} AS cs, {duck_safe('a')} AS ans FROM d"""
    rows = con.execute(sql).fetchall()
    if own:
        con.close()
    coded = {r[0] for r in rows if r[1] == "coded"}
    ent = []
    for c, f, a, cs, ans in rows:
        if f not in families or f == "other":
            continue
        if f == "coded":
            if a is None or c not in coded:
                continue
            raw = f"{cs}_{ans}"
        else:
            raw = f"{cs}_{SUFFIX[f]}"
        ent.append((c, RANK[f], a or "", f, a, raw))
    ent = sorted(set(ent))
    names = _unique([e[5] for e in ent], set(KEYS) | {"date_created"})
    return [(n, e[0], e[3], e[4]) for n, e in zip(names, ent)]


NULL_TYPE = {"numeric": "DOUBLE", "text": "VARCHAR", "datetime": "TIMESTAMP", "drug": "BIGINT"}


def pivot_select(catalog, source: str = "flat", where: str = "", keys=KEYS, present=None) -> str:
    """``present``: identities the table had; others become 0 (one-hot) or NULL."""
    cols = []
    for name, c, f, a in catalog:
        if present is not None and (c, f, a) not in present:
            cols.append(f"0 AS \"{name}\"" if f == "coded" else f"CAST(NULL AS {NULL_TYPE[f]}) AS \"{name}\"")
        elif f == "coded":
            cols.append(f"CAST(count(*) FILTER (concept_name = {_q(c)} AND value_coded_name = {_q(a)}) > 0 AS INTEGER) AS \"{name}\"")
        else:
            cols.append(f"max({VALUE_COL[f]}) FILTER (concept_name = {_q(c)}) AS \"{name}\"")
    k = ", ".join(keys)
    extra = (",\n  " + ",\n  ".join(cols)) if cols else ""
    return (f"SELECT {k}, MAX(date_created) AS date_created{extra}\n"
            f"FROM {source} {('WHERE ' + where) if where else ''} GROUP BY {k}")
