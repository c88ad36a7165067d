"""Schema contract of the raw tables and the quarantine."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartfold.catalog import RAW_TABLES, spec
from chartfold.queries import SCANNED_TABLES, TEXT_KEYS, source
from chartfold.session import scratch_path
from chartfold.sources.changes import ChangeTable, LatestRow
from chartfold.sources.contract import accepted, checked, column_type, load_typed, quarantine_into, rejected


def test_the_rule_gives_the_types_of_every_known_table(spark, small_dir):
    src = source(spark, small_dir)
    for name in SCANNED_TABLES:
        own = TEXT_KEYS.get(name, {})
        for column, have in src.table(name).dtypes:
            assert (own.get(column) or column_type(name, column)) == have, (name, column)
    for name, s in RAW_TABLES.items():
        assert all(column_type(name, k) == ("bigint" if k.endswith("_id") else "string") for k in s.keys)


ENCOUNTERS = [
    ("1", "2024-01-01 10:00:00", "0", "5", None), ("2", "2024-01-01", "TRUE", None, "kept"),     # fit
    ("3", "0000-00-00 00:00:00", "0", "5", None), ("4", "2024-02-30", "0", "5", None),           # no such dates
    ("5", "2024-01-01", "2", "5.5", None), (None, "2024-01-01", "no", "5", None), ("", "2024-01-01", "no", "5", None),
    ("99999999999999999999", "2024-01-01", "0", "5", None)]
DDL = "encounter_id string, encounter_datetime string, voided string, location_id string, note string"


def test_rows_that_do_not_fit(spark):
    df = spark.createDataFrame(ENCOUNTERS, DDL)
    s = spec("encounter")
    good = {r.encounter_id: r for r in accepted(df, s).collect()}
    assert sorted(good) == [1, 2] and good[1].voided is False and good[2].voided is True and good[2].note == "kept"
    assert good[1].encounter_datetime == dt.datetime(2024, 1, 1, 10) and good[2].location_id is None
    why = sorted((r.reasons, r.row_key) for r in rejected(df, s).collect())
    assert [w for w, _ in why] == sorted([
        ["encounter_datetime: not timestamp_ntz"], ["encounter_datetime: not timestamp_ntz"],
        ["voided: not boolean", "location_id: not bigint"], ["encounter_id: key is null"], ["encounter_id: not bigint"], ["encounter_id: not bigint"]])
    assert checked(df, s).count() == len(ENCOUNTERS)
    assert checked(df.limit(0), s).count() == 0 and rejected(df.limit(0), s).count() == 0
    with pytest.raises(ValueError):
        checked(df.drop("encounter_id"), s)


def test_numbers_and_dates_convert_without_loss(spark):
    df = spark.createDataFrame([(1.0, 1, dt.datetime(2024, 1, 1)), (2.5, 0, dt.datetime(2024, 1, 2)), (3.0, 7, dt.datetime(2024, 1, 2, 5))],
                               "person_id double, dead int, birthdate timestamp_ntz")
    rows = checked(df, spec("person")).collect()
    assert [r._reasons for r in rows] == [[], ["person_id: not bigint"], ["dead: not boolean", "birthdate: not date"]]
    assert rows[0].person_id == 1 and rows[0].dead is True and rows[0].birthdate == dt.date(2024, 1, 1)


def test_quarantine_keeps_each_broken_row_once(spark):
    df = spark.createDataFrame(ENCOUNTERS, DDL).withColumn("date_created", F.lit("2024-03-01"))
    held = ChangeTable(spark, "quarantine", LatestRow(("table_name", "row_digest")), root=scratch_path(spark, "test-quarantine"))
    for since in (None, dt.datetime(2024, 2, 1), dt.datetime(2025, 1, 1)):
        raw = load_typed(lambda name: df, ["encounter"], since=since, on_reject=quarantine_into(held))
        assert raw["encounter"].count() == (0 if since and since.year == 2025 else 2)
        assert held.read().count() == 6


def test_typed_columns_keep_their_pushed_filters(spark):
    path = scratch_path(spark, "test-typed")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "0")], "obs_id long, date_created timestamp_ntz, voided string").write.parquet(path)
    raw = load_typed(lambda name: spark.read.parquet(path), ["obs"], since=dt.datetime(2024, 1, 1))
    plan = raw["obs"]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_created" in plan and "IsNotNull(obs_id)" in plan
    assert raw["obs"].count() == 1
