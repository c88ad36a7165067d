"""Clinical raw tables derived from the driver's TPC-H-like parquet tables.

The source system's data is not available, so every clinical table is a
deterministic view over the given tables (see FIXTURES.md part B).  Each
view is a plain DataFrame expression: filters and projections reach the
parquet scan, and the work grows with the input tables.

``as_of`` gives the source as it looked at an earlier instant: fact rows
created later are absent, and rows voided or changed later show their old
state.  Increments are the difference between two such snapshots.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Driver tables used by the views.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fact tables that change over time (cursor = greatest of audit columns).
FACT_TABLES = ("obs", "encounter", "visit", "patient_appointment", "patient_program", "patient_state")

DIM_CREATED = _dt.datetime(1990, 1, 1)
PERSON_CREATED = _dt.datetime(2000, 1, 1)
DEATH_DATE = _dt.datetime(2020, 1, 1)
BIRTH_ORIGIN = _dt.date(1930, 1, 1)
PROVIDER_PERSON_BASE = 1_000_000_000

# Concept ids: 1000 + k for questions, 2000 + region key for coded answers.
QUESTION_BASE = 1000
ANSWER_BASE = 2000
MAX_CONCEPTS = 1000


def _L(v):
    return F.lit(v)


def obs_id_expr(orderkey: Column, partkey: Column, shipdate: Column, linenumber: Column) -> Column:
    """Deterministic obs id: the parts that are unique in lineitem together, as text, so no key is too large for it."""
    return F.concat_ws("-", orderkey.cast("string"), F.date_format(shipdate, "yyyyMMdd"), partkey.cast("string"), linenumber.cast("string"))


def visit_id_expr(custkey: str = "o_custkey", orderdate: str = "o_orderdate") -> Column:
    """Visit of an order: its patient and calendar month."""
    month_no = (F.year(orderdate) - 1990) * 12 + F.month(orderdate)
    return F.col(custkey) * 1000 + month_no.cast("long")


def question_name(nation_name: Column, k: Column, series: Column) -> Column:
    """Question concept name; shape chosen by k % 5 to exercise the naming rules."""
    shape = k % 5
    base = (F.when(shape == 0, F.concat(_L("Weight "), nation_name, _L(" (kg/m^2)")))
            .when(shape == 1, F.concat(_L("Visit type "), nation_name, _L(" - follow-up")))
            .when(shape == 2, F.concat(_L("Concept "), nation_name))
            .when(shape == 3, F.concat(_L("Blood pressure (systolic), sitting position: "), nation_name))
            .otherwise(F.concat(_L("Lab result #"), nation_name, _L(" [mmol/L]"))))
    return F.when(series > 0, F.concat(base, _L(" v"), series.cast("string"))).otherwise(base)


class ClinicalSource:
    """Lazily built clinical tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, n_concepts: int = 25,
                 as_of: _dt.datetime | None = None, drivers: dict | None = None, landed: dict | None = None):
        if not 1 <= n_concepts <= MAX_CONCEPTS:
            raise ValueError("n_concepts must be in [1, 1000]")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.n_concepts = n_concepts
        self.as_of = as_of
        self._built: dict[str, DataFrame] = {}
        self._drivers: dict[str, DataFrame] = {} if drivers is None else drivers
        self._landed: dict[str, DataFrame] = {} if landed is None else landed

    # -- plumbing ----------------------------------------------------------
    def driver(self, name: str) -> DataFrame:
        # one listing and footer read per source and its snapshots; a new source sees files that landed since
        if name not in self._drivers:
            self._drivers[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._drivers[name]

    def at(self, as_of: _dt.datetime | None) -> "ClinicalSource":
        return ClinicalSource(self.spark, self.sf_dir, self.n_concepts, as_of, self._drivers, self._landed)

    def land(self, names, materialize) -> "ClinicalSource":
        """Write the whole current tables once; this source and its snapshots read the copies instead of joining the driver tables each time."""
        for n in names:
            if n not in self._landed:
                self._landed[n] = materialize(getattr(self, "_" + n)(), "landed_" + n)
        return self

    def table(self, name: str) -> DataFrame:
        df = self._built.get(name)
        if df is None:
            df = self._landed[name] if name in self._landed else getattr(self, "_" + name)()
            if self.as_of is not None and name in FACT_TABLES:
                df = snapshot(df, self.as_of)
            self._built[name] = df
        return df

    def tables(self, names=None) -> "LazyTables":
        """Tables by name, each built on first access."""
        t = LazyTables(self)
        for n in names or ():
            t[n]
        return t

    # -- dictionary --------------------------------------------------------
    def _concept_name(self) -> DataFrame:
        n_series = (self.n_concepts + 24) // 25
        nat = self.driver("nation").select(
            "n_nationkey", "n_name",
            F.explode(F.sequence(_L(0), _L(n_series - 1))).alias("series"))
        k = F.col("n_nationkey").cast("long") + F.col("series").cast("long") * 25
        nat = nat.select("n_nationkey", "n_name", "series", k.alias("k")).where(F.col("k") < self.n_concepts)
        cid = (_L(QUESTION_BASE) + F.col("k")).cast("long")
        q_en = nat.select(
            (cid * 10 + 1).alias("concept_name_id"), cid.alias("concept_id"),
            question_name(F.col("n_name"), F.col("k"), F.col("series")).alias("name"),
            _L("en").alias("locale"),
            # nation 21: no preferred English name -> NULL concept_name downstream
            (F.col("n_nationkey") != 21).alias("locale_preferred"))
        q_fr = nat.select(
            (cid * 10 + 2).alias("concept_name_id"), cid.alias("concept_id"),
            F.concat(_L("Concept FR "), F.col("n_name")).alias("name"),
            _L("fr").alias("locale"), _L(True).alias("locale_preferred"))
        reg = self.driver("region")
        aid = (_L(ANSWER_BASE) + F.col("r_regionkey")).cast("long")
        a_en = reg.select(
            (aid * 10 + 1).alias("concept_name_id"), aid.alias("concept_id"),
            F.col("r_name").alias("name"), _L("en").alias("locale"),
            # region 4: answer without a preferred English name
            (F.col("r_regionkey") != 4).alias("locale_preferred"))
        a_fr = reg.select(
            (aid * 10 + 2).alias("concept_name_id"), aid.alias("concept_id"),
            F.concat(_L("Region FR "), F.col("r_name")).alias("name"),
            _L("fr").alias("locale"), _L(True).alias("locale_preferred"))
        # region 3: a second preferred English name (semantic fan-out)
        a_alias = reg.where(F.col("r_regionkey") == 3).select(
            (aid * 10 + 3).alias("concept_name_id"), aid.alias("concept_id"),
            _L("Europe/EU").alias("name"), _L("en").alias("locale"), _L(True).alias("locale_preferred"))
        out = q_en.unionByName(q_fr).unionByName(a_en).unionByName(a_fr).unionByName(a_alias)
        return out.select(
            "concept_name_id", "concept_id", "name",
            F.concat(_L("cn-"), F.col("concept_name_id").cast("string")).alias("uuid"),
            "locale", "locale_preferred", _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    # -- encounters --------------------------------------------------------
    def _obs(self) -> DataFrame:
        li = self.driver("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
        od = self.driver("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        k = F.col("l_partkey") % self.n_concepts
        c = k % 25
        qty = F.col("l_quantity")
        voided = F.col("l_linenumber") == 7
        numeric = (F.when(c.between(8, 15), qty)
                   .when((c == 16) & (qty >= 5), qty)
                   .when((c < 8) & (F.col("l_linenumber") == 1), qty))
        text = (F.when(c.between(17, 19), F.concat("l_returnflag", "l_linestatus"))
                .when((c == 16) & (qty < 5), _L("low"))
                .when(c.between(8, 15) & (F.col("l_discount") == 0), _L("n/a")))
        # values before the join: most rows have few of them, and the line's own columns are not shuffled
        li = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate",
                       F.when(c < 8, _L(ANSWER_BASE) + F.col("l_suppkey") % 5).cast("long").alias("x_coded"),
                       F.when(c.between(22, 23), F.col("l_suppkey")).cast("long").alias("x_drug"),
                       numeric.cast("double").alias("x_numeric"), text.alias("x_text"))
        j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
        null_long = _L(None).cast("long")
        null_str = _L(None).cast("string")
        # recorded during the encounter: the order date plus one hour per line
        created = F.col("o_orderdate") + F.make_dt_interval(_L(0), F.col("l_linenumber"))
        return j.select(
            obs_id_expr(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_shipdate"),
                        F.col("l_linenumber")).alias("obs_id"),
            F.col("o_custkey").alias("person_id"),
            (_L(QUESTION_BASE) + k).cast("long").alias("concept_id"),
            F.col("l_orderkey").alias("encounter_id"),
            (F.col("o_custkey") % 25).cast("long").alias("location_id"),
            null_long.alias("obs_group_id"),
            null_str.alias("accession_number"),
            null_str.alias("form_namespace_and_path"),
            F.col("x_coded").alias("value_coded"),
            null_long.alias("value_coded_name_id"),
            F.col("x_drug").alias("value_drug"),
            F.when(c.between(20, 21), F.col("l_shipdate")).alias("value_datetime"),
            F.col("x_numeric").alias("value_numeric"),
            null_str.alias("value_modifier"),
            F.col("x_text").alias("value_text"),
            F.when(c == 24, F.concat(_L("blob:"), F.col("l_orderkey").cast("string"))).alias("value_complex"),
            null_str.alias("comments"),
            _L(1).cast("long").alias("creator"),
            created.alias("date_created"),
            created.alias("obs_datetime"),
            voided.alias("voided"),
            F.when(voided, _L("entered in error")).alias("void_reason"),
            F.when(voided, created + F.expr("INTERVAL 200 DAYS")).alias("date_voided"),
            null_long.alias("previous_version"))

    def _encounter(self) -> DataFrame:
        o = self.driver("orders")
        voided = (F.col("o_orderkey") % 20) == 0
        etype = (F.when(F.col("o_orderstatus") == "F", 1)
                 .when(F.col("o_orderstatus") == "O", 2).otherwise(3)).cast("long")
        return o.select(
            F.col("o_orderkey").alias("encounter_id"),
            F.col("o_custkey").alias("patient_id"),
            F.when(F.col("o_orderkey") % 10 != 3, visit_id_expr()).alias("visit_id"),
            etype.alias("encounter_type"),
            (F.col("o_custkey") % 25).cast("long").alias("location_id"),
            F.col("o_orderdate").alias("encounter_datetime"),
            F.col("o_orderdate").alias("date_created"),
            voided.alias("voided"),
            F.when(voided, F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("date_voided"))

    def _visit(self) -> DataFrame:
        """One visit per patient and calendar month; its encounters are that month's orders."""
        o = self.driver("orders").select(visit_id_expr().alias("visit_id"),
                                         F.col("o_custkey").alias("patient_id"), "o_orderdate")
        v = o.groupBy("visit_id", "patient_id").agg(F.min("o_orderdate").alias("first"),
                                                    F.max("o_orderdate").alias("last"))
        return v.select(
            "visit_id", "patient_id",
            (F.col("visit_id") % 3 + 1).cast("long").alias("visit_type_id"),
            ((F.col("patient_id") + 1) % 25).cast("long").alias("location_id"),
            F.col("first").alias("date_started"),
            (F.col("last") + F.expr("INTERVAL 1 DAYS")).alias("date_stopped"),
            F.col("first").alias("date_created"),
            _L(False).alias("voided"))

    def _encounter_type(self) -> DataFrame:
        # encounter types keyed like the derived encounter.encounter_type
        o = self.driver("region").where(F.col("r_regionkey") < 3)
        tid = (F.col("r_regionkey") + 1).cast("long")
        name = (F.when(tid == 1, "Adult Visit").when(tid == 2, "Lab Results").otherwise("Triage"))
        return o.select(
            tid.alias("encounter_type_id"), name.alias("name"),
            F.concat(_L("Encounter type "), tid.cast("string")).alias("description"),
            F.concat(_L("et-"), tid.cast("string")).alias("uuid"),
            _L(False).alias("retired"), _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _visit_type(self) -> DataFrame:
        o = self.driver("region").where(F.col("r_regionkey") < 3)
        tid = (F.col("r_regionkey") + 1).cast("long")
        name = F.when(tid == 1, "Outpatient").when(tid == 2, "Inpatient").otherwise("Follow-up")
        return o.select(
            tid.alias("visit_type_id"), name.alias("name"),
            F.concat(_L("vt-"), tid.cast("string")).alias("uuid"),
            _L(False).alias("retired"), _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _location(self) -> DataFrame:
        n = self.driver("nation")
        key = F.col("n_nationkey").cast("long")
        return n.select(
            key.alias("location_id"), F.col("n_name").alias("name"),
            F.concat(_L("Location of "), F.col("n_name")).alias("description"),
            F.concat(key.cast("string"), _L(" Main Road")).alias("address1"),
            _L(None).cast("string").alias("address2"),
            F.concat(_L("City "), F.col("n_regionkey").cast("string")).alias("city_village"),
            F.concat(_L("Province "), F.col("n_regionkey").cast("string")).alias("state_province"),
            F.concat(_L("PC"), key.cast("string")).alias("postal_code"),
            _L("Testland").alias("country"),
            ((key % 10) == 9).alias("retired"),
            F.concat(_L("loc-"), key.cast("string")).alias("uuid"),
            _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    # -- people ------------------------------------------------------------
    def _person(self) -> DataFrame:
        c = self.driver("customer")
        key = F.col("c_custkey")
        dead = (key % 50) == 0
        return c.select(
            key.alias("person_id"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
            F.date_add(_L(BIRTH_ORIGIN), (key % 30000).cast("int")).alias("birthdate"),
            dead.alias("dead"),
            F.when(dead, _L(DEATH_DATE).cast("timestamp_ntz")).alias("death_date"),
            _L(PERSON_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _person_name(self) -> DataFrame:
        c = self.driver("customer")
        key = F.col("c_custkey")
        main = c.select(
            (key * 10 + 1).alias("person_name_id"), key.alias("person_id"),
            F.col("c_name").alias("given_name"), _L(None).cast("string").alias("middle_name"),
            F.when(key % 7 != 0, F.col("c_mktsegment")).alias("family_name"),
            (key % 11 != 0).alias("preferred"), _L(False).alias("voided"))
        alias = c.where(key % 13 == 0).select(
            (key * 10 + 2).alias("person_name_id"), key.alias("person_id"),
            F.concat(_L("Alias "), F.col("c_name")).alias("given_name"),
            _L(None).cast("string").alias("middle_name"),
            F.col("c_mktsegment").alias("family_name"), _L(True).alias("preferred"),
            _L(False).alias("voided"))
        old = c.where(key % 5 == 0).select(
            (key * 10 + 3).alias("person_name_id"), key.alias("person_id"),
            F.concat(_L("Old "), F.col("c_name")).alias("given_name"),
            _L(None).cast("string").alias("middle_name"),
            F.col("c_mktsegment").alias("family_name"), _L(True).alias("preferred"),
            _L(True).alias("voided"))
        s = self.driver("supplier")
        pkey = _L(PROVIDER_PERSON_BASE) + F.col("s_suppkey")
        prov = s.select(
            (pkey * 10 + 1).alias("person_name_id"), pkey.alias("person_id"),
            F.col("s_name").alias("given_name"), _L(None).cast("string").alias("middle_name"),
            F.when(F.col("s_suppkey") % 4 != 0, _L("Provider")).alias("family_name"),
            _L(True).alias("preferred"), _L(False).alias("voided"))
        out = main.unionByName(alias).unionByName(old).unionByName(prov)
        return out.withColumn("date_created", _L(PERSON_CREATED).cast("timestamp_ntz"))

    def _patient_identifier(self) -> DataFrame:
        c = self.driver("customer")
        return c.select(
            F.col("c_custkey").alias("patient_identifier_id"),
            F.col("c_custkey").alias("patient_id"),
            F.concat(F.when(F.col("c_custkey") % 3 == 0, "NID-").otherwise("MRN-"), F.col("c_custkey").cast("string")).alias("identifier"),
            _L(PERSON_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _provider(self) -> DataFrame:
        s = self.driver("supplier")
        return s.select(
            F.col("s_suppkey").alias("provider_id"),
            (_L(PROVIDER_PERSON_BASE) + F.col("s_suppkey")).alias("person_id"),
            ((F.col("s_suppkey") % 10) == 9).alias("retired"),
            _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    # -- appointments ------------------------------------------------------
    def _appointment_service(self) -> DataFrame:
        r = self.driver("region")
        rk = F.col("r_regionkey").cast("long")
        return r.select(
            (rk + 1).alias("appointment_service_id"),
            F.concat(F.col("r_name"), _L(" clinic")).alias("name"),
            F.concat(_L("Service for "), F.col("r_name")).alias("description"),
            (rk * 15 + 15).alias("duration_mins"),
            _L("08:00:00").alias("start_time"), _L("17:00:00").alias("end_time"),
            (rk == 4).alias("voided"), _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _appointment_service_type(self) -> DataFrame:
        n = self.driver("nation")
        nk = F.col("n_nationkey").cast("long")
        return n.select(
            (nk + 1).alias("appointment_service_type_id"),
            F.concat(_L("Type "), F.col("n_name")).alias("name"),
            (nk * 5 + 10).alias("duration_mins"),
            ((nk % 10) == 9).alias("voided"),
            _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _patient_appointment(self) -> DataFrame:
        o = self.driver("orders")
        key = F.col("o_orderkey")
        start = F.col("o_orderdate") + F.make_dt_interval(
            _L(0), _L(0), ((key % 13) * 37).cast("int"), _L(59))
        end = start + F.make_dt_interval(_L(0), _L(0), (key % 45 + 15).cast("int"), _L(1))
        voided = (key % 17) == 0
        return o.select(
            key.alias("patient_appointment_id"),
            F.concat(_L("APT-"), key.cast("string")).alias("appointment_number"),
            F.concat(_L("pa-"), key.cast("string")).alias("uuid"),
            F.col("o_custkey").alias("patient_id"),
            start.alias("start_date_time"), end.alias("end_date_time"),
            (F.col("o_orderdate") - F.expr("INTERVAL 7 DAYS")).alias("date_appointment_scheduled"),
            F.when(F.col("o_orderstatus") == "F", "Completed")
             .when(F.col("o_orderstatus") == "O", "Scheduled").otherwise("CheckedIn").alias("status"),
            F.when(key % 5 == 0, "WalkIn").otherwise("Scheduled").alias("appointment_kind"),
            F.col("o_orderpriority").alias("priority"),
            F.when(key % 9 == 0, _L("follow up")).alias("comments"),
            (F.col("o_custkey") % 5 + 1).alias("appointment_service_id"),
            (key % 25 + 1).alias("appointment_service_type_id"),
            (F.col("o_custkey") % 25).alias("location_id"),
            (key % 100).alias("provider_id"),
            F.when(key % 11 == 0, key - 1).alias("related_appointment_id"),
            F.when(key % 3 == 0, F.concat(_L("tele-"), key.cast("string"))).alias("tele_health_video_link"),
            F.col("o_orderdate").alias("date_created"),
            F.when(key % 2 == 1, F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")).alias("date_changed"),
            voided.alias("voided"),
            F.when(voided, _L("cancelled")).alias("void_reason"),
            F.when(voided, F.col("o_orderdate") + F.expr("INTERVAL 5 DAYS")).alias("date_voided"))

    # -- programs ----------------------------------------------------------
    def _program(self) -> DataFrame:
        r = self.driver("region")
        rk = F.col("r_regionkey").cast("long")
        return r.select(
            (rk + 1).alias("program_id"),
            F.concat(F.col("r_name"), _L(" care programme")).alias("name"),
            F.concat(_L("Programme in "), F.col("r_name")).alias("description"),
            F.concat(_L("prog-"), (rk + 1).cast("string")).alias("uuid"),
            (rk == 4).alias("retired"), _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _program_workflow(self) -> DataFrame:
        r = self.driver("region")
        rk = F.col("r_regionkey").cast("long")
        return r.select(
            (rk + 1).alias("program_workflow_id"), (_L(ANSWER_BASE) + rk).alias("concept_id"),
            (rk == 2).alias("retired"), _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _program_workflow_state(self) -> DataFrame:
        n = self.driver("nation")
        nk = F.col("n_nationkey").cast("long")
        return n.select(
            (nk + 1).alias("program_workflow_state_id"), (nk % 5 + 1).alias("program_workflow_id"),
            (_L(QUESTION_BASE) + nk).alias("concept_id"),
            (nk % 3 == 0).alias("initial"), (nk % 3 == 2).alias("terminal"),
            (nk == 7).alias("retired"), _L(DIM_CREATED).cast("timestamp_ntz").alias("date_created"))

    def _patient_program(self) -> DataFrame:
        o = self.driver("orders")
        key = F.col("o_orderkey")
        done = F.col("o_orderstatus") == "F"
        voided = (key % 36) == 0
        return o.select(
            key.alias("patient_program_id"),
            F.concat(_L("pp-"), key.cast("string")).alias("uuid"),
            F.col("o_custkey").alias("patient_id"),
            (key % 5 + 1).alias("program_id"),
            F.col("o_orderdate").alias("date_enrolled"),
            F.when(done, F.col("o_orderdate") + F.make_dt_interval((key % 400).cast("int"))).alias("date_completed"),
            F.when(done, _L(ANSWER_BASE) + key % 5).alias("outcome_concept_id"),
            (F.col("o_custkey") % 25).alias("location_id"),
            F.col("o_orderdate").alias("date_created"),
            _L(None).cast("timestamp_ntz").alias("date_changed"),
            voided.alias("voided"),
            F.when(voided, _L("withdrawn")).alias("void_reason"),
            F.when(voided, F.col("o_orderdate") + F.expr("INTERVAL 10 DAYS")).alias("date_voided"))

    def _patient_state(self) -> DataFrame:
        li = self.driver("lineitem")
        sid = obs_id_expr(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_shipdate"), F.col("l_linenumber"))
        return li.select(
            sid.alias("patient_state_id"),
            F.col("l_orderkey").alias("patient_program_id"),
            (F.col("l_suppkey") % 25 + 1).alias("state"),
            F.when(F.col("l_linenumber") != 6,
                   F.date_trunc("month", F.col("l_shipdate")).cast("date")).alias("start_date"),
            _L(None).cast("date").alias("end_date"),
            F.concat(_L("ps-"), sid.cast("string")).alias("uuid"),
            F.col("l_shipdate").alias("date_created"),
            (F.col("l_linenumber") == 5).alias("voided"))

    # -- tables merged without a cursor (full read + key merge) --------------
    def _drug_order(self) -> DataFrame:
        li = self.driver("lineitem")
        return li.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("drug_inventory_id"),
            F.col("l_quantity").alias("dose"), _L("mg").alias("dose_units"),
            F.concat(F.col("l_linestatus"), _L("-daily")).alias("frequency"),
            F.col("l_shipdate").alias("date_activated"))

    def _user_role(self) -> DataFrame:
        s = self.driver("supplier")
        k = F.col("s_suppkey")
        main = s.select(k.alias("user_id"),
                        F.when(k % 3 == 0, "Clinician").when(k % 3 == 1, "Nurse").otherwise("Clerk").alias("role"))
        extra = s.where(k % 4 == 0).select(k.alias("user_id"), _L("Admin").alias("role"))
        return main.unionByName(extra)

    def _events(self) -> DataFrame:
        return self.driver("events")


class LazyTables(dict):
    """dict of clinical tables that builds a table the first time it is looked up."""

    def __init__(self, src: ClinicalSource):
        super().__init__()
        self._src = src

    def __missing__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        df = self._src.table(name)
        self[name] = df
        return df


class Overlay(dict):
    """Some tables replaced on top of a (lazy) table dict; other names fall through."""

    def __init__(self, base, **replaced):
        super().__init__(replaced)
        self._base = base

    def __missing__(self, name: str) -> DataFrame:
        df = self._base[name]
        self[name] = df
        return df


def with_tables(base, **replaced) -> Overlay:
    return Overlay(base, **replaced)


TABLES = tuple(n[1:] for n in dir(ClinicalSource) if n.startswith("_") and not n.startswith("__"))


def snapshot(df: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """The table as it was at ``as_of``: later rows absent, later voids undone."""
    t = _L(as_of).cast("timestamp_ntz")
    out = df.where(F.col("date_created") < t)
    cols = set(df.columns)
    if "date_voided" in cols:
        was_void = F.col("voided") & (F.col("date_voided") < t)
        repl = {"voided": was_void, "date_voided": F.when(was_void, F.col("date_voided"))}
        if "void_reason" in cols:
            repl["void_reason"] = F.when(was_void, F.col("void_reason"))
        out = out.withColumns(repl)
    if "date_changed" in cols:
        out = out.withColumn("date_changed",
                             F.when(F.col("date_changed") < t, F.col("date_changed")))
    return out
