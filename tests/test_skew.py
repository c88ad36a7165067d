"""Joins with heavy keys split apart: the rows of the plain join, dealt evenly."""
import statistics

import pytest
from pyspark.sql import functions as F

from chartfold.operators import skew
from chartfold.operators.skew import heavy_key_counts, heavy_keys, split_join


@pytest.fixture(scope="module")
def fact(spark):
    """Half the rows on one key, a fifth without one, the rest on keys of their own."""
    i = F.col("id")
    key = F.when(i % 2 == 0, F.lit(7)).when(i % 10 < 4, F.lit(None)).otherwise(i % 5_000 + 100)
    return spark.range(120_000).select(i.alias("row"), key.cast("long").alias("k"))


@pytest.fixture
def sixteen(spark):
    """Sixteen shuffle partitions as they are dealt; no broadcast, no adaptive splitting."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _sizes(df, n):
    got = {r[0]: r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()}
    return [got.get(i, 0) for i in range(n)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_largest_task_within_twice_the_median(spark, fact, sixteen, how):
    dim = spark.range(6_000).select(F.col("id").alias("d"), (F.col("id") * 3).alias("v"))
    plain = _sizes(fact.join(dim, fact.k == dim.d, how), 16)
    split = _sizes(split_join(fact, dim, "k", "d", how, spread="row"), 16)
    assert sum(split) == sum(plain)
    assert max(plain) > 5 * statistics.median(plain)
    assert max(split) <= 2 * statistics.median(split)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("spread", ["row", None])
def test_same_rows_as_the_plain_join(spark, fact, how, spread):
    # two rows on the heavy key, a row without a key, keys that no fact row has; a fact row twice
    dim = spark.createDataFrame([(7, "a"), (7, "b"), (None, "n"), (101, "c"), (103, "d"), (-1, "e")], "d long, v string")
    some = fact.where("row < 4000")
    some = some.unionByName(some.where("row < 20"))
    want = some.join(dim, some.k == dim.d, how)
    got = split_join(some, dim, "k", "d", how, spread=spread, partitions=8)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_empty_tables_and_even_keys(spark, fact):
    dim = spark.createDataFrame([(7, "a")], "d long, v string")
    assert split_join(fact.limit(0), dim, "k", "d").count() == 0
    assert split_join(fact, dim.limit(0), "k", "d", "inner", spread="row").count() == 0
    assert split_join(fact, dim.limit(0), "k", "d", "left", spread="row").count() == 120_000
    even = spark.range(20_000).select(F.col("id").alias("k"))
    joined = split_join(even, dim, "k", "d", partitions=8)
    assert "x_piece" not in joined._jdf.queryExecution().analyzed().toString()          # the plain join
    assert joined.where("v is not null").count() == 1
    with pytest.raises(ValueError):
        split_join(fact, dim, "k", "d", "full")
    with pytest.raises(ValueError):
        split_join(fact, dim.withColumn("row", F.lit(1)), "k", "d")


def test_the_sketch_misses_no_heavy_key(spark):
    # keys 0..39 with 100 * (key + 1) rows, in an order that mixes them with many light keys; text keys, a NULL one
    heavy = spark.range(40).select(F.col("id").cast("string").alias("k"), F.explode(F.sequence(F.lit(1), (F.col("id") + 1) * 100)).alias("i"))
    light = spark.range(60_000).select(F.concat(F.lit("x"), "id").alias("k"), F.col("id").cast("int").alias("i"))
    none = spark.range(5_000).select(F.lit(None).cast("string").alias("k"), F.col("id").cast("int").alias("i"))
    df = heavy.unionByName(light).unionByName(none).repartition(16, "i")
    total = 82_000 + 60_000 + 5_000
    for share in (0.03, 0.01, 0.005):
        want = {(str(k), 100 * (k + 1)) for k in range(40) if 100 * (k + 1) >= share * total}
        want |= {(None, 5_000)} if 5_000 >= share * total else set()
        assert {tuple(r) for r in heavy_key_counts(df, "k", share).collect()} == want
        assert {k for k, _ in want} <= {k for k, _, _ in heavy_keys(df, "k", share)}
    assert heavy_keys(df.limit(0), "k", 0.01) == []
    assert heavy_key_counts(df.limit(0), "k", 0.01).count() == 0


def test_flat_tables_are_the_same_split_or_not(spark, small_dir, monkeypatch):
    from chartfold.plans import flatten
    from chartfold.sources.derived import ClinicalSource
    t = ClinicalSource(spark, small_dir).tables()
    assert any(k is None for k, _, _ in heavy_keys(t["encounter"], "visit_id", skew.HEAVY_FILL / 8))     # encounters without a visit
    split, plain = flatten.flatten_observations(t), flatten.flatten_observations(t, split_visits=False)
    assert split.exceptAll(plain).count() == 0 and split.count() == plain.count()
    few = flatten.flatten_appointments(t, as_of=flatten._dt.date(2024, 1, 1))
    monkeypatch.setattr(flatten, "bounded_broadcasts", lambda dfs: list(dfs))                             # as with providers beyond the bound
    many = flatten.flatten_appointments(t, as_of=flatten._dt.date(2024, 1, 1))
    assert many.exceptAll(few).count() == 0 and many.count() == few.count()
