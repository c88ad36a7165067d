import pytest
from pyspark.sql import functions as F

from chartfold.functions.naming import dedupe_names, safe_name_col

NAMES = {"Weight (kg)": "weight_kg", "A/B (x)": "a_b_x", "Visit type": "visit_type",
         "Follow-up": "follow-up",                              # '-' survives (D4)
         "  __lead and trail__ ": "lead_and_trail", "a b": "a_b", "a_b": "a_b", "x" * 60: "x" * 40,
         # truncation after strip may leave a trailing '_' (H9)
         "Blood pressure (systolic), sitting position: NATION_13": "blood_pressure_systolic_sitting_position",
         "TREATMENT AS of": "treatment_as_of"}


def test_spark_rule_examples(spark):
    df = spark.createDataFrame([(s,) for s in NAMES], "s string")
    assert {r.s: r.n for r in df.select("s", safe_name_col("s").alias("n")).collect()} == NAMES


def test_dedupe_names_suffixes_in_order():
    assert dedupe_names(["a", "b", "A", "a"]) == ["a", "b", "A_2", "a_3"]
    assert dedupe_names(["person_id", "x"], taken={"person_id"}) == ["person_id_2", "x"]
