"""Reporting queries over raw, flat and wide tables.

Distinct counts are one per aggregate (no multi-distinct Expand); top-k
reports keep a total order and end in ``limit`` (TakeOrderedAndProject:
each task keeps only k rows).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from .pivot import PivotSpec, build_catalog, widen


def _count(name: str = "n_rows"):
    return F.count(F.lit(1)).alias(name)


def obs_count_by_concept(obs: DataFrame, concept_name: DataFrame) -> DataFrame:
    """Obs per preferred name (any locale, so one obs counts under each preferred name)."""
    cn = bounded_broadcast(concept_name.where(F.col("locale_preferred"))
                           .select("concept_id", F.col("name").alias("concept_name")))
    return obs.join(cn, "concept_id").groupBy("concept_name").agg(_count("n_obs")).orderBy(F.desc("n_obs"), "concept_name")


#: Series of measurements by the start of their concept names.
VITAL_SERIES = {"weight": "Weight", "blood_pressure": "Blood pressure", "lab": "Lab result"}


def avg_vitals_by_visit(flat: DataFrame, weight: str = VITAL_SERIES["weight"], bp: str = VITAL_SERIES["blood_pressure"]) -> DataFrame:
    """Average weight and systolic pressure per visit start and person, over the numeric columns of the wide table."""
    name = F.col("concept_name")
    spec = PivotSpec(concept_filter=name.startswith(weight) | name.startswith(bp), families=("numeric",))
    catalog = build_catalog(flat, spec)

    def mean(start, out):
        cells = [F.col(f"`{e.name}`") for e in catalog if e.concept.startswith(start)]
        if not cells:
            return F.lit(None).cast("double").alias(out)
        total = reduce(add, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cells])
        n = reduce(add, [c.isNotNull().cast("long") for c in cells])
        return F.round(F.when(F.sum(n) > 0, F.sum(total) / F.sum(n)), 6).alias(out)

    wide = widen(flat, spec, catalog=catalog)
    return wide.groupBy("visit_date_started", "person_id").agg(mean(weight, "avg_weight"), mean(bp, "avg_systolic_bp"))


def encounter_type_distribution(wide: DataFrame) -> DataFrame:
    """A15."""
    return wide.groupBy("encounter_type_name").agg(_count())


def lab_results_by_location(wide: DataFrame, encounter_type: str = "Lab Results") -> DataFrame:
    """A16 + F15."""
    return wide.where(F.col("encounter_type_name") == encounter_type).groupBy("location_name").agg(_count())


def clinical_totals(flat: DataFrame) -> DataFrame:
    """One row per metric; each distinct count is its own partial-aggregated job branch."""
    parts = [
        flat.select("person_id").distinct().agg(_count("value")).select(F.lit("patients").alias("metric"), "value"),
        flat.select("encounter_id").distinct().agg(_count("value")).select(F.lit("encounters").alias("metric"), "value"),
        flat.select("obs_id").distinct().agg(_count("value")).select(F.lit("observations").alias("metric"), "value"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_locations(flat: DataFrame, k: int = 10) -> DataFrame:
    """Locations by distinct visits, top k (ties by name)."""
    agg = flat.groupBy("location_name").agg(F.countDistinct("visit_id").alias("n_visits"))
    return agg.orderBy(F.desc("n_visits"), F.asc_nulls_last("location_name")).limit(k)


def visit_frequency(flat: DataFrame) -> DataFrame:
    """Distinct visits per patient."""
    return flat.groupBy("person_id").agg(F.countDistinct("visit_id").alias("n_visits"))


def daily_encounter_volume(encounter: DataFrame) -> DataFrame:
    """Live encounters per day."""
    live = encounter.where(~F.col("voided"))
    return live.groupBy(F.to_date("encounter_datetime").alias("day")).agg(_count("n_encounters"))


def encounter_types_by_location(wide: DataFrame) -> DataFrame:
    """A21."""
    return wide.groupBy("location_name", "encounter_type_name").agg(_count())


def provider_productivity(flat_appointments: DataFrame) -> DataFrame:
    """Appointments, completed, telehealth and booked minutes per provider."""
    return flat_appointments.groupBy("provider_id", "provider_name").agg(
        _count("n_appointments"),
        F.sum(F.when(F.col("status") == "Completed", 1).otherwise(0)).cast("long").alias("n_completed"),
        F.sum("is_telehealth").cast("long").alias("n_telehealth"),
        F.sum("duration_minutes").cast("long").alias("booked_minutes"))


def missing_value_rates(wide: DataFrame, columns=None) -> DataFrame:
    """NULL rate of every column, one aggregate pass, unpivoted to (column_name, null_rate)."""
    cols = list(columns or wide.columns)
    one = wide.agg(*[F.round(F.avg(F.col(f"`{c}`").isNull().cast("double")), 6).alias(f"c{i}")
                     for i, c in enumerate(cols)])
    stacked = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_rate"))
        for i, c in enumerate(cols)])).alias("s"))
    return stacked.select("s.column_name", "s.null_rate")


def patient_vital_series(flat: DataFrame, series: dict = VITAL_SERIES) -> DataFrame:
    """A person's measurements of each kind over time."""
    kind = F.coalesce(*[F.when(F.col("concept_name").startswith(start), F.lit(k)) for k, start in series.items()])
    return (flat.where(F.col("value_numeric").isNotNull())
                .select(kind.alias("series"), "person_id", "date_created", "concept_name", "value_numeric")
                .where(F.col("series").isNotNull()).orderBy("series", "person_id", "date_created"))


def patients_with_identifiers(person: DataFrame, patient_identifier: DataFrame) -> DataFrame:
    """J26."""
    pi = patient_identifier.select(F.col("patient_id").alias("person_id"), "identifier")
    return person.join(pi, "person_id").select("person_id", "gender", "birthdate", "identifier")


def recent_encounters(encounter: DataFrame, person: DataFrame, encounter_type: DataFrame,
                      location: DataFrame) -> DataFrame:
    """J27 + O5: encounters with type and location names, newest first."""
    e = encounter.select("encounter_id", "patient_id", F.col("encounter_type").alias("type_id"),
                         F.col("location_id").alias("e_location_id"), "encounter_datetime")
    et = bounded_broadcast(encounter_type.select("encounter_type_id", F.col("name").alias("type_name")))
    loc = bounded_broadcast(location.select(F.col("location_id").alias("l_id"), F.col("name").alias("location")))
    j = (e.join(person.select("person_id"), e.patient_id == F.col("person_id"))
          .join(et, F.col("type_id") == F.col("encounter_type_id"))
          .join(loc, F.col("e_location_id") == F.col("l_id")))
    return j.select("encounter_id", "person_id", F.col("type_name").alias("encounter_type"),
                    "encounter_datetime", "location").orderBy(F.desc("encounter_datetime"))


def recent_observations(obs: DataFrame, concept_name: DataFrame, k: int = 20) -> DataFrame:
    """J28 + O4: newest k observations with question and coded-answer names (total order)."""
    pref = concept_name.where(F.col("locale_preferred"))
    cn = bounded_broadcast(pref.select(F.col("concept_id").alias("q_id"), F.col("name").alias("concept_name")))
    c2 = bounded_broadcast(pref.select(F.col("concept_id").alias("a_id"), F.col("name").alias("coded_value")))
    j = obs.join(cn, obs.concept_id == cn.q_id).join(c2, obs.value_coded == c2.a_id, "left")
    out = j.select("obs_id", "person_id", "concept_name", "value_numeric", "value_text", "coded_value",
                   "obs_datetime")
    return out.orderBy(F.desc("obs_datetime"), F.desc("obs_id"), F.asc_nulls_first("concept_name"),
                       F.asc_nulls_first("coded_value")).limit(k)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(_count()).where(F.col("n_rows") > 1)
