"""Plan properties the design relies on (checked on the executed physical plan)."""
import re

from pyspark.sql import functions as F

from chartfold.operators.joins import bounded_broadcasts
from chartfold.plans.flatten import flatten_observations
from chartfold.plans.pivot import build_catalog, widen
from chartfold.sources.derived import ClinicalSource


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_within_the_bound(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    fact = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    ok, too_big = bounded_broadcasts([small, big], max_rows=100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only our hint may broadcast
    try:
        assert "BroadcastHashJoin" in _plan(fact.join(ok, "k"))
        assert "BroadcastHashJoin" not in _plan(fact.join(too_big, "k"))   # the other way: a shuffle join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_widen_reuses_the_flatten_partitioning(spark, small_dir):
    flat = flatten_observations(ClinicalSource(spark, small_dir).tables())
    cat = build_catalog(flat)
    n_flat = len(re.findall(r"Exchange hashpartitioning", _plan(flat)))
    n_both = len(re.findall(r"Exchange hashpartitioning", _plan(widen(flat, catalog=cat, strategy="conditional"))))
    assert n_both == n_flat            # the group-by needs no exchange of its own


def test_broadcast_decision_follows_a_folder_that_grows(spark):
    from chartfold.session import scratch_path
    path = scratch_path(spark, "test-grows")
    spark.range(5).withColumnRenamed("id", "k").write.parquet(path)
    fact = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before, = bounded_broadcasts([spark.read.parquet(path)], max_rows=100)
        assert "BroadcastHashJoin" in _plan(fact.join(before, "k"))
        spark.range(5, 1005).withColumnRenamed("id", "k").write.mode("append").parquet(path)
        after, = bounded_broadcasts([spark.read.parquet(path)], max_rows=100)
        assert "BroadcastHashJoin" not in _plan(fact.join(after, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10_000).alias("v"))
    fact = spark.range(5000).select((F.col("id") % 50).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept, = bounded_broadcasts([wide], max_rows=100, max_bytes=100_000)
        assert "BroadcastHashJoin" not in _plan(fact.join(kept, "k"))
        sent, = bounded_broadcasts([wide], max_rows=100, max_bytes=10_000_000)
        assert "BroadcastHashJoin" in _plan(fact.join(sent, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
