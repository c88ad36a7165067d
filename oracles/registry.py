"""Oracle SQL per registered query (DuckDB dialect, driver tables pre-registered)."""

from __future__ import annotations

import datetime as _dt
from functools import lru_cache

from . import sql as S
from .views import base_views, with_views

SUBSET_PATTERN = "Weight%"

EVENTS_LONG = """
  SELECT user_id, CAST(ts AS DATE) AS day, ts AS date_created, 'Event type' AS concept_name,
         event_type AS value_coded_name, CAST(1 AS BIGINT) AS value_coded,
         CAST(NULL AS DOUBLE) AS value_numeric, CAST(NULL AS VARCHAR) AS value_text,
         CAST(NULL AS TIMESTAMP) AS value_datetime, CAST(NULL AS BIGINT) AS value_drug FROM events
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), ts, 'Event value', CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
         value, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT) FROM events"""


def _flat_ctes(flat_sql: str | None = None, **kw) -> str:
    return with_views("", extra={"flat": flat_sql or S.flat_obs()}, **kw)


def pivot_query(families=tuple(S.RANK), where: str = "", flat_sql: str | None = None,
                keys=S.KEYS, **kw) -> str:
    ctes = _flat_ctes(flat_sql, **kw)
    cat = S.pivot_catalog(ctes, ("AND " + where) if where else "", families)
    # the concept filter chooses columns; every encounter still gets its row
    return ctes + S.pivot_select(cat, "flat", "", keys)


CATALOG_SQL = f"""
  , d AS (SELECT DISTINCT concept_name AS c, {S.TYPE_CASE} AS f,
            CASE WHEN {S.TYPE_CASE} = 'coded' THEN value_coded_name END AS a
          FROM flat WHERE concept_name IS NOT NULL),
  coded AS (SELECT DISTINCT c FROM d WHERE f = 'coded'),
  e AS (
    SELECT c, f, a, CASE f WHEN 'coded' THEN 0 WHEN 'numeric' THEN 1 WHEN 'text' THEN 2
                           WHEN 'datetime' THEN 3 ELSE 4 END AS r,
      concat({S.duck_safe('c')}, '_',
             CASE f WHEN 'coded' THEN {S.duck_safe('a')} WHEN 'numeric' THEN 'value' WHEN 'text' THEN 'text'
                    WHEN 'datetime' THEN 'datetime' ELSE 'drug_id' END) AS raw
    FROM d WHERE f <> 'other' AND (f <> 'coded' OR (a IS NOT NULL AND c IN (SELECT c FROM coded)))),
  n AS (SELECT *, row_number() OVER (PARTITION BY lower(raw) ORDER BY c, r, coalesce(a, '')) AS rn FROM e)
  SELECT CAST(row_number() OVER (ORDER BY c, r, coalesce(a, '')) - 1 AS INTEGER) AS col_id,
         CASE WHEN rn = 1 THEN raw ELSE concat(raw, '_', CAST(rn AS VARCHAR)) END AS name,
         c AS concept, f AS family, a AS answer
  FROM n"""


INCR_T1 = "TIMESTAMP '2001-07-10 00:00:00'"
UPSERT_T = "TIMESTAMP '2000-12-01 00:00:00'"
RANGE = ("TIMESTAMP '2001-06-01 00:00:00'", "TIMESTAMP '2001-07-31 00:00:00'")
_T1 = _dt.datetime(2001, 7, 10)
_UT = _dt.datetime(2000, 12, 1)


def _nullsafe(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


def _incremental_ctes(extra: dict[str, str]) -> str:
    return with_views("", extra=extra, snapshots={"old_": _T1})


def _flat_refresh(cond_obs: str) -> str:
    """flat_old minus obs in the window, plus the window re-flattened."""
    return (f"SELECT * FROM flat_old WHERE obs_id NOT IN (SELECT obs_id FROM obs o WHERE {cond_obs})\n"
            f"UNION ALL\n{S.flat_obs(extra='AND ' + cond_obs)}")


def window_query(start: str | None = None, end: str | None = None) -> str:
    if start is None:
        cond = "o.date_created >= (SELECT s FROM m)"
        rows = "date_created >= (SELECT s FROM m)"
    else:
        cond = f"o.date_created BETWEEN {start} AND {end}"
        rows = f"date_created BETWEEN {start} AND {end}"
    ctes = _incremental_ctes({
        "flat_old": S.flat_obs("old_"),
        "m": "SELECT max(date_created) AS s FROM flat_old",
        "flat_new": _flat_refresh(cond)})
    con = S._connect(S.ORACLE_SF_DIR)
    old_cat = S.pivot_catalog(ctes, source="flat_old", con=con)
    new_cat = S.pivot_catalog(ctes, source="flat_new", con=con)
    con.close()
    present = {(c, f, a) for _, c, f, a in old_cat}
    wide_old = S.pivot_select(new_cat, "flat_old", present=present)
    batch = S.pivot_select(new_cat, "flat_new", rows)
    k2 = ("person_id", "encounter_id")
    return (f"{ctes}, wide_old AS ({wide_old}), b AS ({batch})\n"
            f"SELECT * FROM wide_old w WHERE NOT EXISTS (SELECT 1 FROM b WHERE {_nullsafe('b', 'w', k2)})\n"
            f"UNION ALL BY NAME SELECT * FROM b")


def evolving_query() -> str:
    ctes = _incremental_ctes({"flat_old": S.flat_obs("old_"), "flat": S.flat_obs()})
    con = S._connect(S.ORACLE_SF_DIR)
    narrow = S.pivot_catalog(ctes, source="flat_old", families=("coded", "numeric"), con=con)
    full = S.pivot_catalog(ctes, source="flat", con=con)
    con.close()
    tgt = S.pivot_select(narrow, "flat_old")
    b = S.pivot_select(full, "flat", f"date_created >= {INCR_T1}")
    tnames = {n for n, *_ in narrow}
    fill = [n for n, c, f, a in full if f == "coded" and n not in tnames]
    repl = ", ".join(f'coalesce("{n}", 0) AS "{n}"' for n in fill)
    star = f"* REPLACE ({repl})" if fill else "*"
    return (f"{ctes}, tgt AS ({tgt}), b AS ({b})\n"
            f"SELECT {star} FROM (SELECT * FROM tgt t WHERE NOT EXISTS "
            f"(SELECT 1 FROM b WHERE {_nullsafe('b', 't', S.KEYS)})\n"
            f"UNION ALL BY NAME SELECT * FROM b)")


def incremental_queries() -> dict[str, str]:
    q = {}
    q["cursor_scan"] = with_views(f"SELECT * FROM obs WHERE greatest(date_created, date_voided) >= {INCR_T1}")
    q["high_water_marks"] = _incremental_ctes({"fo": S.flat_obs("old_"), "fa": S.flat_appointments("old_")}) + """
      SELECT 'obs_date_created' AS mark, max(date_created) AS value FROM fo
      UNION ALL SELECT 'appointment_date_changed', max(date_changed) FROM fa
      UNION ALL SELECT 'appointment_changed_or_created', max(greatest(date_changed, date_created)) FROM fa"""
    q["upsert_raw"] = with_views(f"""
      , b AS (SELECT * FROM obs WHERE greatest(date_created, date_voided) >= {UPSERT_T})
      SELECT * FROM old_obs WHERE obs_id NOT IN (SELECT obs_id FROM b)
      UNION ALL BY NAME SELECT * FROM b""", snapshots={"old_": _UT})
    q["upsert_no_cursor"] = with_views(f"""
      SELECT * FROM (SELECT * REPLACE (dose - 1 AS dose) FROM drug_order WHERE date_activated < {UPSERT_T})
      WHERE order_id NOT IN (SELECT order_id FROM drug_order)
      UNION ALL BY NAME
      SELECT * FROM drug_order QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY
        drug_inventory_id DESC, dose DESC, dose_units DESC, frequency DESC, date_activated DESC) = 1""")
    q["upsert_composite"] = with_views("""
      SELECT * FROM (SELECT * FROM user_role WHERE user_id % 2 = 0
                     UNION ALL SELECT user_id, 'Retired' FROM user_role WHERE user_id % 5 = 0) s
      WHERE NOT EXISTS (SELECT 1 FROM user_role b WHERE b.user_id = s.user_id AND b.role = s.role)
      UNION ALL SELECT * FROM user_role""")
    q["upsert_evolving_columns"] = evolving_query()
    q["delete_insert_observations"] = _incremental_ctes({
        "flat_old": S.flat_obs("old_"), "m": "SELECT max(date_created) AS s FROM flat_old"}) + \
        _flat_refresh("o.date_created >= (SELECT s FROM m)")
    q["delete_insert_no_bounds"] = with_views(S.flat_obs())
    q["delete_insert_appointments"] = _incremental_ctes({
        "fa_old": S.flat_appointments("old_"),
        "m": "SELECT max(greatest(date_changed, date_created)) AS s FROM fa_old",
        "ch": "SELECT patient_appointment_id FROM patient_appointment "
              "WHERE greatest(date_created, date_changed, date_voided) >= (SELECT s FROM m)"}) + \
        ("SELECT * FROM fa_old WHERE patient_appointment_id NOT IN (SELECT patient_appointment_id FROM ch)\n"
         "UNION ALL\n" + S.flat_appointments(extra="AND pa.patient_appointment_id IN "
                                              "(SELECT patient_appointment_id FROM ch)"))
    in_range = " OR ".join(f"{c} BETWEEN {RANGE[0]} AND {RANGE[1]}" for c in ("date_created", "date_changed", "date_voided"))
    q["delete_insert_appointments_range"] = _incremental_ctes({
        "fa_old": S.flat_appointments("old_"),
        "ch": f"SELECT patient_appointment_id FROM patient_appointment WHERE {in_range}"}) + \
        ("SELECT * FROM fa_old ANTI JOIN ch USING (patient_appointment_id)\n"
         "UNION ALL\n" + S.flat_appointments(extra="AND pa.patient_appointment_id IN (FROM ch)"))
    q["upsert_partial_key"] = with_views("SELECT user_id, max(role) AS role FROM user_role GROUP BY user_id")
    q["cursor_scan_business_time"] = with_views(f"""
      SELECT 'obs' AS table_name, obs_id AS id, obs_datetime AS happened FROM obs WHERE obs_datetime >= {INCR_T1}
      UNION ALL SELECT 'encounter', CAST(encounter_id AS VARCHAR), encounter_datetime FROM encounter WHERE encounter_datetime >= {INCR_T1}""")
    q["widen_window_mode"] = window_query()
    q["widen_range_mode"] = window_query(*RANGE)
    return q


def dictionary_edit_query() -> str:
    """The wide table over dictionaries with three renamed rows."""
    base = base_views()

    def renamed(table: str, hit: str, name: str) -> str:
        return f"SELECT * REPLACE (if({hit}, '{name}', name) AS name) FROM ({base[table]})"
    ctes = with_views("", extra={
        "location": renamed("location", "location_id = 3", "Moved clinic"),
        "encounter_type": renamed("encounter_type", "encounter_type_id = 2", "Laboratory"),
        "concept_name": renamed("concept_name", "concept_id = 1012 AND locale = 'en'", "Body mass (kg)"),
        "flat": S.flat_obs()})
    return ctes + S.pivot_select(S.pivot_catalog(ctes), "flat", "", S.KEYS)


GROUPS = f"SELECT DISTINCT {', '.join(S.KEYS)} FROM flat"
SCANNED_TABLES = ("person", "person_name", "patient_identifier", "encounter", "encounter_type", "obs",
                  "visit", "visit_type", "location", "provider", "concept_name", "program",
                  "program_workflow", "program_workflow_state", "patient_program", "patient_state",
                  "drug_order", "user_role", "patient_appointment", "appointment_service",
                  "appointment_service_type")


def missing_rates_query() -> str:
    ctes = _flat_ctes()
    cat = S.pivot_catalog(ctes)
    cols = list(S.KEYS) + ["date_created"] + [n for n, *_ in cat]
    rates = ", ".join(f'round(avg(CASE WHEN "{c}" IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS "{c}"'
                      for c in cols)
    return (f"{ctes}, wide AS ({S.pivot_select(cat)}), r AS (SELECT {rates} FROM wide)\n"
            f"UNPIVOT r ON COLUMNS(*) INTO NAME column_name VALUE null_rate")


def reporting_queries() -> dict[str, str]:
    f = _flat_ctes()
    q = {}
    q["obs_count_by_concept"] = with_views("""
      SELECT concept_name, CAST(sum(n) AS BIGINT) AS n_obs
      FROM (SELECT concept_id, count(*) AS n FROM obs GROUP BY concept_id)
      JOIN (SELECT concept_id, name AS concept_name FROM concept_name WHERE locale_preferred) USING (concept_id)
      GROUP BY concept_name ORDER BY n_obs DESC, concept_name""")
    # averages of wide cells: a cell is the greatest value of a numeric concept in one group of the wide table
    q["avg_vitals_by_visit"] = f + f"""
      , numeric_concepts AS (SELECT DISTINCT concept_name FROM flat WHERE {S.TYPE_CASE} = 'numeric'),
      cells AS (SELECT {', '.join(S.KEYS)}, if(concept_name IN (SELECT concept_name FROM numeric_concepts WHERE concept_name IS NOT NULL),
                       concept_name, NULL) AS measure, max(value_numeric) AS v FROM flat GROUP BY ALL)
      SELECT visit_date_started, person_id, round(avg(v) FILTER (starts_with(measure, 'Weight')), 6) AS avg_weight,
        round(avg(v) FILTER (starts_with(measure, 'Blood pressure')), 6) AS avg_systolic_bp
      FROM cells GROUP BY visit_date_started, person_id"""
    q["encounter_type_distribution"] = f + f"""
      SELECT encounter_type_name, count(*) AS n_rows FROM ({GROUPS}) GROUP BY 1"""
    q["lab_results_by_location"] = f + f"""
      SELECT location_name, count(*) AS n_rows FROM ({GROUPS}) WHERE encounter_type_name = 'Lab Results'
      GROUP BY 1"""
    q["clinical_totals"] = f + """
      SELECT 'patients' AS metric, count(DISTINCT person_id) AS value FROM flat
      UNION ALL SELECT 'encounters', count(DISTINCT encounter_id) FROM flat
      UNION ALL SELECT 'observations', count(DISTINCT obs_id) FROM flat"""
    q["top_locations"] = f + """
      SELECT location_name, count(DISTINCT visit_id) AS n_visits FROM flat GROUP BY 1
      ORDER BY n_visits DESC, location_name ASC NULLS LAST LIMIT 10"""
    q["visit_frequency"] = f + """
      SELECT person_id, count(DISTINCT visit_id) AS n_visits FROM flat GROUP BY 1"""
    q["reports_after_increment"] = f + f"""
      , g AS ({GROUPS}),
      top AS (SELECT location_name, count(DISTINCT visit_id) AS value FROM flat GROUP BY 1
              ORDER BY value DESC, location_name ASC NULLS LAST LIMIT 10),
      totals AS (SELECT 'patients' AS metric, count(DISTINCT person_id) AS value FROM flat
                 UNION ALL SELECT 'encounters', count(DISTINCT encounter_id) FROM flat
                 UNION ALL SELECT 'observations', count(DISTINCT obs_id) FROM flat)
      SELECT 'clinical_totals' AS report, metric AS location_name, CAST(NULL AS VARCHAR) AS encounter_type_name,
             CAST(NULL AS BIGINT) AS person_id, value FROM totals
      UNION ALL SELECT 'top_locations', location_name, NULL, NULL, value FROM top
      UNION ALL SELECT 'visit_frequency', NULL, NULL, person_id, count(DISTINCT visit_id) FROM flat GROUP BY person_id
      UNION ALL SELECT 'encounter_types_by_location', location_name, encounter_type_name, NULL, count(*) FROM g
                GROUP BY location_name, encounter_type_name
      UNION ALL SELECT 'encounter_type_distribution', NULL, encounter_type_name, NULL, count(*) FROM g GROUP BY encounter_type_name
      UNION ALL SELECT 'lab_results_by_location', location_name, NULL, NULL, count(*) FROM g
                WHERE encounter_type_name = 'Lab Results' GROUP BY location_name"""
    q["heavy_join_keys"] = with_views("""
      SELECT 'encounter' AS table_name, CAST(visit_id AS VARCHAR) AS join_key, count(*) AS n_rows FROM encounter GROUP BY visit_id
      HAVING count(*) >= 0.001 * (SELECT count(*) FROM encounter)
      UNION ALL
      SELECT 'patient_appointment', CAST(provider_id AS VARCHAR), count(*) FROM patient_appointment GROUP BY provider_id
      HAVING count(*) >= 0.001 * (SELECT count(*) FROM patient_appointment)""")
    q["daily_encounter_volume"] = with_views("""
      SELECT CAST(encounter_datetime AS DATE) AS day, count(*) AS n_encounters FROM encounter
      WHERE NOT voided GROUP BY 1""")
    q["encounter_types_by_location"] = f + f"""
      SELECT location_name, encounter_type_name, count(*) AS n_rows FROM ({GROUPS}) GROUP BY 1, 2"""
    q["provider_productivity"] = with_views("", extra={"fa": S.flat_appointments()}) + """
      SELECT provider_id, provider_name, count(*) AS n_appointments,
        CAST(sum(CASE WHEN status = 'Completed' THEN 1 ELSE 0 END) AS BIGINT) AS n_completed,
        CAST(sum(is_telehealth) AS BIGINT) AS n_telehealth,
        CAST(sum(duration_minutes) AS BIGINT) AS booked_minutes
      FROM fa GROUP BY 1, 2"""
    q["missing_value_rates"] = missing_rates_query()
    q["patient_vital_series"] = f + """
      , kinds(series, start) AS (VALUES ('weight', 'Weight'), ('blood_pressure', 'Blood pressure'), ('lab', 'Lab result'))
      SELECT series, person_id, date_created, concept_name, value_numeric
      FROM flat JOIN kinds ON starts_with(concept_name, start) WHERE value_numeric IS NOT NULL"""
    q["duplicate_keys"] = with_views("""
      SELECT order_id, count(*) AS n_rows FROM drug_order GROUP BY 1 HAVING count(*) > 1""")
    q["patients_with_identifiers"] = with_views("""
      SELECT person_id, gender, birthdate, identifier
      FROM (SELECT patient_id AS person_id, identifier FROM patient_identifier) JOIN person USING (person_id)""")
    q["recent_encounters"] = with_views("""
      SELECT encounter_id, person_id, type_name AS encounter_type, encounter_datetime, place AS location
      FROM (SELECT encounter_id, patient_id AS person_id, encounter_type AS encounter_type_id, location_id, encounter_datetime FROM encounter)
      SEMI JOIN person USING (person_id)
      JOIN (SELECT encounter_type_id, name AS type_name FROM encounter_type) USING (encounter_type_id)
      JOIN (SELECT location_id, name AS place FROM location) USING (location_id)
      ORDER BY encounter_datetime DESC""")
    q["recent_observations"] = with_views("""
      , preferred AS (SELECT concept_id, name FROM concept_name WHERE locale_preferred),
      named AS (
        SELECT obs_id, person_id, concept_name, value_numeric, value_text, coded_value, obs_datetime
        FROM obs JOIN (SELECT concept_id, name AS concept_name FROM preferred) USING (concept_id)
        LEFT JOIN (SELECT concept_id AS value_coded, name AS coded_value FROM preferred) USING (value_coded))
      SELECT * FROM named QUALIFY row_number() OVER (
        ORDER BY obs_datetime DESC, obs_id DESC, concept_name NULLS FIRST, coded_value NULLS FIRST) <= 20""")
    q["scan_catalog"] = with_views("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in SCANNED_TABLES))
    q["quarantine_counts"] = quarantine_query()
    q["load_typed"] = with_views(f"""
      SELECT 'accepted' AS state, 'obs' AS table_name, obs_id AS id, value_numeric, date_created, voided FROM obs
      WHERE value_numeric IS DISTINCT FROM 50 AND (date_created >= {UPSERT_T} OR date_voided >= {UPSERT_T})
      UNION ALL SELECT 'quarantined', 'obs', obs_id, NULL, NULL, NULL FROM obs WHERE value_numeric = 50
      UNION ALL SELECT 'quarantined', 'encounter', CAST(encounter_id AS VARCHAR), NULL, NULL, NULL FROM encounter WHERE encounter_id % 97 = 0""")
    q["replace_and_read"] = f + f"""
      SELECT 2 AS version, count(*) AS n_rows, count(DISTINCT encounter_id) AS n_encounters FROM ({GROUPS})"""
    # the stream ends with the stored wide table of the current data: the full rebuild
    return q


def quarantine_query() -> str:
    """Accepted rows of every table and rows per fault of the landed text."""
    faults = {"obs": [("value_numeric: not double", "value_numeric = 50")],
              "encounter": [("encounter_datetime: not timestamp_ntz", "encounter_id % 97 = 0"), ("location_id: not bigint", "encounter_id % 194 = 0")],
              "person": [("dead: not boolean", "person_id % 89 = 0")],
              "patient_identifier": [("patient_identifier_id: key is null", "patient_id % 101 = 0")]}
    parts = []
    for t in SCANNED_TABLES:
        fit = " AND ".join(f"({c}) IS NOT TRUE" for _, c in faults.get(t, ())) or "true"
        for reason, cond in [("accepted", fit), *faults.get(t, ())]:
            parts.append(f"SELECT '{t}' AS table_name, '{reason}' AS reason, count(*) AS n_rows FROM {t} WHERE {cond} HAVING count(*) > 0")
    return with_views("\nUNION ALL ".join(parts))


@lru_cache(maxsize=1)
def registry() -> dict[str, str]:
    out = {
        "flatten_observations": with_views(S.flat_obs()),
        "flatten_appointments": with_views(S.flat_appointments()),
        "flatten_patient_program": with_views(S.flat_programs()),
        "latest_state_lateral": with_views(S.LATEST_STATE),
        "value_type_classify": _flat_ctes() + f"""
          SELECT obs_id, concept_id, concept_name, value_coded_name, {S.TYPE_CASE} AS value_type FROM flat""",
        "concept_catalog": _flat_ctes() + f"""
          SELECT DISTINCT concept_name, {S.TYPE_CASE} AS value_type FROM flat WHERE concept_name IS NOT NULL""",
        "coded_answers": _flat_ctes() + f"""
          SELECT DISTINCT concept_name, value_coded_name AS answer FROM flat
          WHERE concept_name IS NOT NULL AND value_coded_name IS NOT NULL
            AND concept_name IN (SELECT concept_name FROM flat WHERE {S.TYPE_CASE} = 'coded')""",
        "pivot_column_catalog": _flat_ctes() + CATALOG_SQL,
        "widen_observations": pivot_query(),
        "widen_concept_subset": pivot_query(where=f"concept_name LIKE '{SUBSET_PATTERN}'"),
        "events_one_hot": pivot_query(flat_sql=EVENTS_LONG, keys=("user_id", "day")),
    }
    out["widen_long_plan"] = out["widen_observations"]
    out.update(incremental_queries())
    out["widen_touched_mode"] = out["widen_observations"]   # touched increment == full rebuild
    out["widen_delta"] = out["widen_observations"]          # counted cells after voids and edits == full rebuild
    out["stream_change_files"] = out["upsert_raw"]          # change files merged when read == one key-merge
    out["bootstrap_or_increment"] = out["widen_observations"]  # bootstrap then increment == full
    out["increment_after_crash"] = out["widen_observations"]
    out["increment_dictionary_edit"] = dictionary_edit_query()
    out["limit_read"] = f"SELECT * FROM ({out['widen_observations']}) ORDER BY {', '.join(k + ' NULLS FIRST' for k in S.KEYS)} LIMIT 100"
    out["widen_custom_aggregates"] = pivot_query(families=("numeric",)).replace("max(value_numeric)", "min(value_numeric)")
    out.update(reporting_queries())
    out["stream_available_now"] = out["widen_observations"]
    for fam, name in (("coded", "pivot_coded_onehot"), ("numeric", "pivot_numeric"), ("text", "pivot_text"),
                      ("datetime", "pivot_datetime"), ("drug", "pivot_drug")):
        out[name] = pivot_query(families=(fam,))
    return out
