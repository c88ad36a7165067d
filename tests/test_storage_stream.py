"""Versioned tables (S6-S9, S11-S12) and the availableNow ingest stream."""
import os

from pyspark.sql import functions as F

from chartfold.session import scratch_path
from chartfold.sources.storage import VersionedTable
from chartfold.streaming.ingest import ingest_available


def test_versions_and_uncommitted_are_ignored(spark):
    t = VersionedTable(spark, "t", root=scratch_path(spark, "test-tables"))
    assert not t.exists()
    t.write(spark.range(3))
    t.write(spark.range(5))
    assert t.versions() == [1, 2] and t.read().count() == 5
    # a half-written version (no _SUCCESS) is never read
    spark.range(7).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(t.path + "/v=3")
    assert t.versions() == [1, 2] and t.read().count() == 5
    for _ in range(3):
        t.write(spark.range(1))
    assert len(t.versions()) == 3


def test_stream_merge_is_idempotent(spark):
    root = scratch_path(spark, "test-stream")
    table = VersionedTable(spark, "obs", root=root + "/tables")
    table.write(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "obs_id long, v string, date_created long"))
    landing = root + "/landing"
    spark.createDataFrame([(2, "B", 2), (3, "c", 2)], "obs_id long, v string, date_created long") \
        .write.mode("append").parquet(landing)
    schema = table.read().schema
    ingest_available(spark, "obs", landing, table, schema, checkpoint=root + "/ckpt")
    first = sorted(map(tuple, table.read().collect()))
    assert first == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]
    # a rerun with nothing new, and a replay of the same batch, leave the table unchanged
    ingest_available(spark, "obs", landing, table, schema, checkpoint=root + "/ckpt")
    ingest_available(spark, "obs", landing, table, schema, checkpoint=root + "/ckpt-replay")
    assert sorted(map(tuple, table.read().collect())) == first
