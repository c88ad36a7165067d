"""Derived ids at any key size, and sources that see files landing later."""
import datetime as dt

from pyspark.sql import functions as F

from chartfold.session import scratch_path
from chartfold.sources.derived import ClinicalSource, obs_id_expr


def test_obs_ids_of_large_keys_never_collide(spark):
    day = dt.datetime(1990, 1, 2)
    keys = [(1, 1_000_005, day, 1), (1, 5, day + dt.timedelta(1), 1), (10 ** 8, 5, day, 1), (10 ** 8, 5, day, 10), (10 ** 8, 51, day, 0),
            (9 * 10 ** 18, 9 * 10 ** 18, day, 7), (10, 5, day, 1), (1, 5, day, 11), (1, 51, day, 1), (11, 5, day, 1)]
    df = spark.createDataFrame(keys, "o long, p long, d timestamp_ntz, l int").select(
        obs_id_expr(F.col("o"), F.col("p"), F.col("d"), F.col("l")).alias("id"))
    assert df.distinct().count() == len(keys)


def test_a_new_source_reads_files_that_landed_since(spark, small_dir):
    root = scratch_path(spark, "test-landing")
    table = spark.read.parquet(f"{small_dir}/supplier.parquet")
    table.write.parquet(f"{root}/supplier.parquet")
    before = ClinicalSource(spark, root).table("provider").count()
    table.write.mode("append").parquet(f"{root}/supplier.parquet")
    assert ClinicalSource(spark, root).table("provider").count() == 2 * before


def test_views_read_whole_tables(spark, small_dir):
    src = ClinicalSource(spark, small_dir)
    for view, table in (("patient_program", "orders"), ("patient_state", "lineitem"), ("drug_order", "lineitem"), ("patient_identifier", "customer"),
                        ("obs", "lineitem"), ("patient_appointment", "orders")):
        assert src.table(view).count() == src.driver(table).count(), view
