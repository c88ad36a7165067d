"""Raw scans: landed parquet tables, flag normalisation, cursor pushdown."""
import datetime as dt
import re

from pyspark.sql import functions as F

from chartfold.catalog import RAW_TABLES, cursor_tables, full_merge_tables
from chartfold.session import scratch_path
from chartfold.sources.raw import load_raw, normalize_flags, parquet_reader


def test_catalog_shape():
    assert len(RAW_TABLES) == 44
    assert len(cursor_tables()) == 39 and len(full_merge_tables()) == 5
    assert RAW_TABLES["user_role"].keys == ("user_id", "role")
    assert RAW_TABLES["user_role"].legacy_key == ("user_id",)
    assert RAW_TABLES["obs"].cursor == "obs_datetime"


def test_landed_tables_are_normalised_and_cursor_filtered(spark):
    root = scratch_path(spark, "landed")
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
    spark.createDataFrame(
        [(1, 0, t0, t0, None, None), (2, 1, t0, t0, t1, None), (3, 0, t1, t1, None, None)],
        "obs_id long, voided int, date_created timestamp_ntz, obs_datetime timestamp_ntz, "
        "date_voided timestamp_ntz, date_changed timestamp_ntz").write.parquet(f"{root}/obs")
    spark.createDataFrame([(7, "true"), (8, "0")], "location_id long, retired string") \
        .write.parquet(f"{root}/location")
    reader = parquet_reader(spark, root)
    raw = load_raw(reader, ["obs", "location"])
    assert dict(raw["obs"].dtypes)["voided"] == "boolean"
    assert sorted((r.location_id, r.retired) for r in raw["location"].collect()) == [(7, True), (8, False)]
    since = dt.datetime(2024, 2, 1)
    changed = load_raw(reader, ["obs"], since=since)["obs"]
    assert sorted(r.obs_id for r in changed.collect()) == [2, 3]           # new row + later void (H1)
    business = load_raw(reader, ["obs"], since=since, business_time=True)["obs"]
    assert sorted(r.obs_id for r in business.collect()) == [3]              # misses the void (S2a)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    changed = load_raw(reader, ["obs"], since=since)["obs"]
    plan = changed._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan)[1]
    assert all(f"GreaterThanOrEqual({c}," in pushed for c in ("date_created", "date_changed", "date_voided"))


def test_normalize_keeps_booleans(spark):
    df = spark.createDataFrame([(True,)], "voided boolean")
    assert normalize_flags(df).collect()[0].voided is True
