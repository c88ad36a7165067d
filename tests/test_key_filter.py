"""Semi and anti joins behind a key filter: rows of the plain joins, few rows shuffled, a broadcast of bounded size; raw tables landed once."""
import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from chartfold import queries
from chartfold.operators import joins
from chartfold.operators.joins import rows_with_keys, rows_without_keys
from chartfold.operators.upsert import delete_insert, upsert_by_key
from chartfold.plans import incremental as incr
from chartfold.plans.refresh import WideStore
from chartfold.sources.derived import ClinicalSource

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def shuffled_joins(spark):
    """Plain joins stay shuffle joins and the plan has its metrics in place after it ran."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _metric(df, node, name):
    """The metric of every operator of that name in the plan of ``df``, run to its end."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        todo += joins._seq(p.children())
        if p.nodeName() == node and p.metrics().contains(name):
            out.append(p.metrics().apply(name).value())
    return out


@pytest.mark.parametrize("bits", [64, 1 << 26])          # 64: most rows are false hits
@pytest.mark.parametrize("null_safe", [False, True])
def test_rows_of_the_plain_joins(spark, monkeypatch, bits, null_safe):
    monkeypatch.setattr(joins, "FILTER_BITS", bits)
    df = spark.createDataFrame([(i % 700, str(i % 3) if i % 5 else None, i) for i in range(1500)], "k long, s string, v long")
    other = spark.createDataFrame([(i, str(i % 3) if i % 5 else None) for i in range(0, 900, 7)] * 2, "k long, s string")
    o = other.toDF("ok", "os")
    cond = (df.k.eqNullSafe(o.ok) & df.s.eqNullSafe(o.os)) if null_safe else ((df.k == o.ok) & (df.s == o.os))
    for fn, how in ((rows_with_keys, "left_semi"), (rows_without_keys, "left_anti")):
        assert _sorted(fn(df, other, ["k", "s"], null_safe)) == _sorted(df.join(o, cond, how))


def test_keys_of_other_types_take_the_plain_join(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    ints = spark.createDataFrame([(3,), (4,)], "k int")
    assert _sorted(rows_with_keys(df, ints, ["k"])) == [(3,), (4,)]
    assert len(rows_without_keys(df, ints, ["k"]).collect()) == 8


def test_merge_and_delete_do_not_shuffle_the_target(spark, shuffled_joins):
    target = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("v"))
    batch = spark.range(19_990, 20_040).select(F.col("id").cast("string").alias("id"), F.lit("b").alias("v"))
    for out in (upsert_by_key(target, batch, ["id"], null_safe=False), upsert_by_key(target, batch, ["id"]),
                delete_insert(target, batch, batch.select("id"), "id")):
        assert sum(_metric(out, "Exchange", "shuffleRecordsWritten")) < 2_000
        assert out.count() == 20_040


def test_changed_parents_are_not_broadcast_row_by_row(spark, shuffled_joins):
    n = 50_000
    obs = spark.range(n).select(F.col("id").alias("obs_id"), F.col("id").alias("encounter_id"), F.lit(T0).cast("timestamp_ntz").alias("date_created"))
    enc = spark.range(n).select(F.col("id").alias("encounter_id"), F.col("id").alias("visit_id"), F.lit(T1).cast("timestamp_ntz").alias("date_created"))
    visit = spark.range(n).select(F.col("id").alias("visit_id"), F.lit(T0).cast("timestamp_ntz").alias("date_created"))
    raw = {"obs": obs, "encounter": enc, "visit": visit}
    seen = {t: SimpleNamespace(n=n) for t in raw}
    changed = WideStore._changed_obs(None, raw, dict.fromkeys(raw, T1), seen)
    cut = incr.restrict_to_encounters(raw)
    pages = joins.FILTER_BITS >> 15
    for df, rows in ((changed, n), (cut["encounter"], n), (cut["visit"], n)):
        assert all(r <= pages for r in _metric(df, "BroadcastExchange", "numOutputRows"))
        assert df.count() == rows


def test_landed_tables_are_read_by_snapshots(spark, small_dir):
    plain = ClinicalSource(spark, small_dir)
    src = queries.landed(spark, small_dir)
    for name in ("obs", "visit"):
        for as_of in (None, queries.INCR_T1):
            a, b = src.at(as_of).table(name), plain.at(as_of).table(name)
            assert not any("lineitem" in f or "orders" in f for f in a.inputFiles())
            assert a.columns == b.columns and _sorted(a) == _sorted(b)


def test_a_filter_for_many_keys_stays_sparse(spark, monkeypatch):
    """Its bits follow the number of keys where that is known: few rows without a match go through the exact join."""
    monkeypatch.setattr(joins, "FILTER_BITS", 1 << 12)
    assert joins.filter_bits() == 1 << 12 and joins.filter_bits(5000) == 1 << 16 and joins.filter_bits(1 << 40) == joins.MOST_FILTER_BITS
    df, other = spark.range(20000).withColumnRenamed("id", "k"), spark.range(5000).withColumnRenamed("id", "k")
    free, joined = joins.parts_without_keys(df, other, ["k"], n_keys=5000)
    assert free.count() > 13000 and sorted(r[0] for r in free.unionByName(joined).collect()) == list(range(5000, 20000))
    assert joins.parts_without_keys(df, other, ["k"])[0].count() < 8000
