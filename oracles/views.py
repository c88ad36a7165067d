"""DuckDB SQL for the clinical views of FIXTURES.md part B.

Written independently of the Spark code in ``chartfold.sources.derived``:
the driver registers the parquet tables as views, these CTEs derive the
clinical tables from them, and every oracle query is ``WITH <ctes> <query>``.
"""

from __future__ import annotations

import datetime as _dt

FACT_TABLES = ("obs", "encounter", "visit", "patient_appointment", "patient_program", "patient_state")


def _ts(v: _dt.datetime) -> str:
    return f"TIMESTAMP '{v.isoformat(sep=' ')}'"


def _question_name(n_name: str, k: str, series: str) -> str:
    base = (f"CASE {k} % 5 "
            f"WHEN 0 THEN concat('Weight ', {n_name}, ' (kg/m^2)') "
            f"WHEN 1 THEN concat('Visit type ', {n_name}, ' - follow-up') "
            f"WHEN 2 THEN concat('Concept ', {n_name}) "
            f"WHEN 3 THEN concat('Blood pressure (systolic), sitting position: ', {n_name}) "
            f"ELSE concat('Lab result #', {n_name}, ' [mmol/L]') END")
    return f"CASE WHEN {series} > 0 THEN concat({base}, ' v', CAST({series} AS VARCHAR)) ELSE {base} END"


VISIT_ID = "(o_custkey * 1000 + CAST((year(o_orderdate) - 1990) * 12 + month(o_orderdate) AS BIGINT))"


def _obs_id(o, p, ship, ln):
    return f"concat_ws('-', CAST({o} AS VARCHAR), strftime({ship}, '%Y%m%d'), CAST({p} AS VARCHAR), CAST({ln} AS VARCHAR))"


def base_views(n_concepts: int = 25) -> dict[str, str]:
    n_series = (n_concepts + 24) // 25
    v = {}
    v["concept_name"] = f"""
      WITH nat AS (
        SELECT n_nationkey, n_name, CAST(s.series AS BIGINT) AS series,
               CAST(n_nationkey AS BIGINT) + CAST(s.series AS BIGINT) * 25 AS k
        FROM nation, range(0, {n_series}) AS s(series)
      ), q AS (SELECT *, 1000 + k AS cid FROM nat WHERE k < {n_concepts}),
      r AS (SELECT r_regionkey, r_name, CAST(2000 + r_regionkey AS BIGINT) AS aid FROM region),
      u AS (
        SELECT cid * 10 + 1 AS concept_name_id, cid AS concept_id,
               {_question_name('n_name', 'k', 'series')} AS name,
               'en' AS locale, n_nationkey <> 21 AS locale_preferred FROM q
        UNION ALL
        SELECT cid * 10 + 2, cid, concat('Concept FR ', n_name), 'fr', true FROM q
        UNION ALL
        SELECT aid * 10 + 1, aid, r_name, 'en', r_regionkey <> 4 FROM r
        UNION ALL
        SELECT aid * 10 + 2, aid, concat('Region FR ', r_name), 'fr', true FROM r
        UNION ALL
        SELECT aid * 10 + 3, aid, 'Europe/EU', 'en', true FROM r WHERE r_regionkey = 3
      )
      SELECT concept_name_id, concept_id, name, concat('cn-', CAST(concept_name_id AS VARCHAR)) AS uuid,
             locale, locale_preferred, TIMESTAMP '1990-01-01 00:00:00' AS date_created FROM u"""
    c = f"(l_partkey % {n_concepts}) % 25"
    v["obs"] = f"""
      SELECT {_obs_id('l_orderkey', 'l_partkey', 'l_shipdate', 'l_linenumber')} AS obs_id,
        o_custkey AS person_id,
        CAST(1000 + l_partkey % {n_concepts} AS BIGINT) AS concept_id,
        l_orderkey AS encounter_id,
        CAST(o_custkey % 25 AS BIGINT) AS location_id,
        CAST(NULL AS BIGINT) AS obs_group_id,
        CAST(NULL AS VARCHAR) AS accession_number,
        CAST(NULL AS VARCHAR) AS form_namespace_and_path,
        CAST(CASE WHEN {c} < 8 THEN 2000 + l_suppkey % 5 END AS BIGINT) AS value_coded,
        CAST(NULL AS BIGINT) AS value_coded_name_id,
        CAST(CASE WHEN {c} BETWEEN 22 AND 23 THEN l_suppkey END AS BIGINT) AS value_drug,
        CASE WHEN {c} BETWEEN 20 AND 21 THEN l_shipdate END AS value_datetime,
        CAST(CASE WHEN {c} BETWEEN 8 AND 15 THEN l_quantity
                  WHEN {c} = 16 AND l_quantity >= 5 THEN l_quantity
                  WHEN {c} < 8 AND l_linenumber = 1 THEN l_quantity END AS DOUBLE) AS value_numeric,
        CAST(NULL AS VARCHAR) AS value_modifier,
        CASE WHEN {c} BETWEEN 17 AND 19 THEN concat(l_returnflag, l_linestatus)
             WHEN {c} = 16 AND l_quantity < 5 THEN 'low'
             WHEN {c} BETWEEN 8 AND 15 AND l_discount = 0 THEN 'n/a' END AS value_text,
        CASE WHEN {c} = 24 THEN concat('blob:', CAST(l_orderkey AS VARCHAR)) END AS value_complex,
        CAST(NULL AS VARCHAR) AS comments,
        CAST(1 AS BIGINT) AS creator,
        o_orderdate + to_hours(l_linenumber) AS date_created,
        o_orderdate + to_hours(l_linenumber) AS obs_datetime,
        l_linenumber = 7 AS voided,
        CASE WHEN l_linenumber = 7 THEN 'entered in error' END AS void_reason,
        CASE WHEN l_linenumber = 7 THEN o_orderdate + to_hours(l_linenumber) + INTERVAL 200 DAY END AS date_voided,
        CAST(NULL AS BIGINT) AS previous_version
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    v["encounter"] = f"""
      SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
        CASE WHEN o_orderkey % 10 <> 3 THEN {VISIT_ID} END AS visit_id,
        CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS encounter_type,
        CAST(o_custkey % 25 AS BIGINT) AS location_id,
        o_orderdate AS encounter_datetime, o_orderdate AS date_created,
        o_orderkey % 20 = 0 AS voided,
        CASE WHEN o_orderkey % 20 = 0 THEN o_orderdate + INTERVAL 30 DAY END AS date_voided
      FROM orders"""
    v["visit"] = f"""
      SELECT visit_id, patient_id, CAST(visit_id % 3 + 1 AS BIGINT) AS visit_type_id,
        CAST((patient_id + 1) % 25 AS BIGINT) AS location_id,
        min(o_orderdate) AS date_started, max(o_orderdate) + INTERVAL 1 DAY AS date_stopped,
        min(o_orderdate) AS date_created, false AS voided
      FROM (SELECT {VISIT_ID} AS visit_id, o_custkey AS patient_id, o_orderdate FROM orders)
      GROUP BY visit_id, patient_id"""
    v["encounter_type"] = """
      SELECT CAST(r_regionkey + 1 AS BIGINT) AS encounter_type_id,
        CASE r_regionkey + 1 WHEN 1 THEN 'Adult Visit' WHEN 2 THEN 'Lab Results' ELSE 'Triage' END AS name,
        concat('Encounter type ', CAST(r_regionkey + 1 AS VARCHAR)) AS description,
        concat('et-', CAST(r_regionkey + 1 AS VARCHAR)) AS uuid,
        false AS retired, TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM region WHERE r_regionkey < 3"""
    v["visit_type"] = """
      SELECT CAST(r_regionkey + 1 AS BIGINT) AS visit_type_id,
        CASE r_regionkey + 1 WHEN 1 THEN 'Outpatient' WHEN 2 THEN 'Inpatient' ELSE 'Follow-up' END AS name,
        concat('vt-', CAST(r_regionkey + 1 AS VARCHAR)) AS uuid,
        false AS retired, TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM region WHERE r_regionkey < 3"""
    v["location"] = """
      SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS name,
        concat('Location of ', n_name) AS description,
        concat(CAST(n_nationkey AS VARCHAR), ' Main Road') AS address1,
        CAST(NULL AS VARCHAR) AS address2,
        concat('City ', CAST(n_regionkey AS VARCHAR)) AS city_village,
        concat('Province ', CAST(n_regionkey AS VARCHAR)) AS state_province,
        concat('PC', CAST(n_nationkey AS VARCHAR)) AS postal_code,
        'Testland' AS country, n_nationkey % 10 = 9 AS retired,
        concat('loc-', CAST(n_nationkey AS VARCHAR)) AS uuid,
        TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM nation"""
    v["person"] = """
      SELECT c_custkey AS person_id,
        CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
        DATE '1930-01-01' + CAST(c_custkey % 30000 AS INTEGER) AS birthdate,
        c_custkey % 50 = 0 AS dead,
        CASE WHEN c_custkey % 50 = 0 THEN TIMESTAMP '2020-01-01 00:00:00' END AS death_date,
        TIMESTAMP '2000-01-01 00:00:00' AS date_created
      FROM customer"""
    v["person_name"] = """
      SELECT *, TIMESTAMP '2000-01-01 00:00:00' AS date_created FROM (
        SELECT c_custkey * 10 + 1 AS person_name_id, c_custkey AS person_id, c_name AS given_name,
               CAST(NULL AS VARCHAR) AS middle_name,
               CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS family_name,
               c_custkey % 11 <> 0 AS preferred, false AS voided FROM customer
        UNION ALL
        SELECT c_custkey * 10 + 2, c_custkey, concat('Alias ', c_name), CAST(NULL AS VARCHAR),
               c_mktsegment, true, false FROM customer WHERE c_custkey % 13 = 0
        UNION ALL
        SELECT c_custkey * 10 + 3, c_custkey, concat('Old ', c_name), CAST(NULL AS VARCHAR),
               c_mktsegment, true, true FROM customer WHERE c_custkey % 5 = 0
        UNION ALL
        SELECT (1000000000 + s_suppkey) * 10 + 1, 1000000000 + s_suppkey, s_name, CAST(NULL AS VARCHAR),
               CASE WHEN s_suppkey % 4 <> 0 THEN 'Provider' END, true, false FROM supplier)"""
    v["patient_identifier"] = """
      SELECT c_custkey AS patient_identifier_id, c_custkey AS patient_id,
        concat(if(c_custkey % 3 = 0, 'NID-', 'MRN-'), CAST(c_custkey AS VARCHAR)) AS identifier,
        TIMESTAMP '2000-01-01 00:00:00' AS date_created
      FROM customer"""
    v["provider"] = """
      SELECT s_suppkey AS provider_id, 1000000000 + s_suppkey AS person_id,
        s_suppkey % 10 = 9 AS retired, TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM supplier"""
    v["appointment_service"] = """
      SELECT CAST(r_regionkey + 1 AS BIGINT) AS appointment_service_id,
        concat(r_name, ' clinic') AS name, concat('Service for ', r_name) AS description,
        CAST(r_regionkey * 15 + 15 AS BIGINT) AS duration_mins,
        '08:00:00' AS start_time, '17:00:00' AS end_time,
        r_regionkey = 4 AS voided, TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM region"""
    v["appointment_service_type"] = """
      SELECT CAST(n_nationkey + 1 AS BIGINT) AS appointment_service_type_id,
        concat('Type ', n_name) AS name, CAST(n_nationkey * 5 + 10 AS BIGINT) AS duration_mins,
        n_nationkey % 10 = 9 AS voided, TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM nation"""
    v["patient_appointment"] = """
      SELECT patient_appointment_id, appointment_number, uuid, patient_id, s AS start_date_time,
        s + to_minutes(CAST(o_orderkey % 45 + 15 AS BIGINT)) + INTERVAL 1 SECOND AS end_date_time,
        date_appointment_scheduled, status, appointment_kind, priority, comments,
        appointment_service_id, appointment_service_type_id, location_id, provider_id,
        related_appointment_id, tele_health_video_link, date_created, date_changed, voided,
        void_reason, date_voided
      FROM (
        SELECT o_orderkey, o_orderkey AS patient_appointment_id,
          concat('APT-', CAST(o_orderkey AS VARCHAR)) AS appointment_number,
          concat('pa-', CAST(o_orderkey AS VARCHAR)) AS uuid,
          o_custkey AS patient_id,
          o_orderdate + to_minutes(CAST((o_orderkey % 13) * 37 AS BIGINT)) + INTERVAL 59 SECOND AS s,
          o_orderdate - INTERVAL 7 DAY AS date_appointment_scheduled,
          CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Scheduled' ELSE 'CheckedIn' END AS status,
          CASE WHEN o_orderkey % 5 = 0 THEN 'WalkIn' ELSE 'Scheduled' END AS appointment_kind,
          o_orderpriority AS priority,
          CASE WHEN o_orderkey % 9 = 0 THEN 'follow up' END AS comments,
          o_custkey % 5 + 1 AS appointment_service_id,
          o_orderkey % 25 + 1 AS appointment_service_type_id,
          o_custkey % 25 AS location_id,
          o_orderkey % 100 AS provider_id,
          CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey - 1 END AS related_appointment_id,
          CASE WHEN o_orderkey % 3 = 0 THEN concat('tele-', CAST(o_orderkey AS VARCHAR)) END AS tele_health_video_link,
          o_orderdate AS date_created,
          CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate + INTERVAL 3 DAY END AS date_changed,
          o_orderkey % 17 = 0 AS voided,
          CASE WHEN o_orderkey % 17 = 0 THEN 'cancelled' END AS void_reason,
          CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate + INTERVAL 5 DAY END AS date_voided
        FROM orders)"""
    v["program"] = """
      SELECT CAST(r_regionkey + 1 AS BIGINT) AS program_id, concat(r_name, ' care programme') AS name,
        concat('Programme in ', r_name) AS description,
        concat('prog-', CAST(r_regionkey + 1 AS VARCHAR)) AS uuid,
        r_regionkey = 4 AS retired, TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM region"""
    v["program_workflow"] = """
      SELECT CAST(r_regionkey + 1 AS BIGINT) AS program_workflow_id,
        CAST(2000 + r_regionkey AS BIGINT) AS concept_id, r_regionkey = 2 AS retired,
        TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM region"""
    v["program_workflow_state"] = """
      SELECT CAST(n_nationkey + 1 AS BIGINT) AS program_workflow_state_id,
        CAST(n_nationkey % 5 + 1 AS BIGINT) AS program_workflow_id,
        CAST(1000 + n_nationkey AS BIGINT) AS concept_id,
        n_nationkey % 3 = 0 AS initial, n_nationkey % 3 = 2 AS terminal, n_nationkey = 7 AS retired,
        TIMESTAMP '1990-01-01 00:00:00' AS date_created
      FROM nation"""
    v["patient_program"] = """
      SELECT o_orderkey AS patient_program_id, concat('pp-', CAST(o_orderkey AS VARCHAR)) AS uuid,
        o_custkey AS patient_id, o_orderkey % 5 + 1 AS program_id,
        o_orderdate AS date_enrolled,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(o_orderkey % 400 AS INTEGER)) END AS date_completed,
        CASE WHEN o_orderstatus = 'F' THEN 2000 + o_orderkey % 5 END AS outcome_concept_id,
        o_custkey % 25 AS location_id,
        o_orderdate AS date_created, CAST(NULL AS TIMESTAMP) AS date_changed,
        o_orderkey % 36 = 0 AS voided,
        CASE WHEN o_orderkey % 36 = 0 THEN 'withdrawn' END AS void_reason,
        CASE WHEN o_orderkey % 36 = 0 THEN o_orderdate + INTERVAL 10 DAY END AS date_voided
      FROM orders"""
    v["patient_state"] = f"""
      SELECT {_obs_id('l_orderkey', 'l_partkey', 'l_shipdate', 'l_linenumber')} AS patient_state_id,
        l_orderkey AS patient_program_id, l_suppkey % 25 + 1 AS state,
        CASE WHEN l_linenumber <> 6 THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS start_date,
        CAST(NULL AS DATE) AS end_date,
        concat('ps-', CAST({_obs_id('l_orderkey', 'l_partkey', 'l_shipdate', 'l_linenumber')} AS VARCHAR)) AS uuid,
        l_shipdate AS date_created, l_linenumber = 5 AS voided
      FROM lineitem"""
    v["drug_order"] = """
      SELECT l_orderkey AS order_id, l_partkey AS drug_inventory_id, l_quantity AS dose,
        'mg' AS dose_units, concat(l_linestatus, '-daily') AS frequency, l_shipdate AS date_activated
      FROM lineitem"""
    v["user_role"] = """
      SELECT s_suppkey AS user_id,
        CASE s_suppkey % 3 WHEN 0 THEN 'Clinician' WHEN 1 THEN 'Nurse' ELSE 'Clerk' END AS role FROM supplier
      UNION ALL
      SELECT s_suppkey, 'Admin' FROM supplier WHERE s_suppkey % 4 = 0"""
    return v


def _snapshot_sql(name: str, body: str, as_of: _dt.datetime) -> str:
    t = _ts(as_of)
    cols = body
    repl = []
    if "date_voided" in cols:
        repl += [f"(voided AND date_voided < {t}) AS voided",
                 f"CASE WHEN voided AND date_voided < {t} THEN date_voided END AS date_voided"]
        if "void_reason" in cols:
            repl.append(f"CASE WHEN voided AND date_voided < {t} THEN void_reason END AS void_reason")
    if "date_changed" in cols:
        repl.append(f"CASE WHEN date_changed < {t} THEN date_changed END AS date_changed")
    star = f"* REPLACE ({', '.join(repl)})" if repl else "*"
    return f"SELECT {star} FROM ({body}) WHERE date_created < {t}"


def views(n_concepts: int = 25, as_of: _dt.datetime | None = None, prefix: str = "") -> dict[str, str]:
    v = base_views(n_concepts)
    if as_of is not None:
        v = {k: (_snapshot_sql(k, b, as_of) if k in FACT_TABLES else b) for k, b in v.items()}
    if prefix:
        v = {prefix + k: b for k, b in v.items()}
    return v


def with_views(query: str, n_concepts: int = 25, as_of: _dt.datetime | None = None,
               extra: dict[str, str] | None = None, snapshots: dict[str, _dt.datetime] | None = None) -> str:
    """``WITH <clinical views> <query>``; ``snapshots`` adds prefixed as-of copies."""
    v = dict(views(n_concepts, as_of))
    for prefix, t in (snapshots or {}).items():
        v.update({prefix + k: b for k, b in views(n_concepts, t).items() if k in FACT_TABLES})
    v.update(extra or {})
    ctes = ",\n".join(f"{k} AS ({b})" for k, b in v.items())
    return f"WITH {ctes}\n{query}"
