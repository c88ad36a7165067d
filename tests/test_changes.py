"""Change files merged when read (U1) and counted cells under insert, edit and void (A10, H5)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartfold.operators.joins import rows_by_key_filter
from chartfold.plans.cells import CellStore, count_cells, refresh_wide_cells
from chartfold.plans.pivot import PivotSpec, build_catalog, widen
from chartfold.session import scratch_path
from chartfold.sources import changes
from chartfold.sources.changes import ChangeTable, LatestRow, SignedCounts
from chartfold.streaming.ingest import ingest_available
from tests.helpers import flat_df, obs

DDL = "obs_id long, v string, date_created long"


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def table(spark):
    t = ChangeTable(spark, "obs", LatestRow(("obs_id",)), root=scratch_path(spark, "test-changes"))
    t.write(spark.createDataFrame([(i, f"row {i}", 1) for i in range(20_000)], DDL))
    return t


def test_bytes_written_follow_the_batch(spark, table):
    before = table._listing()
    base = table.bytes_of("v", 1)
    n = table.append(spark.createDataFrame([(3, "three", 2), (20_001, "new", 2)], DDL))
    assert table._listing()["v"] == before["v"] and table.bytes_of("c", n) < base / 10
    got = table.read()
    assert got.count() == 20_001 and rows(got.where("obs_id in (3, 20001)")) == [(3, "three", 2), (20_001, "new", 2)]


def test_later_change_wins_and_within_a_change_the_latest_version(spark, table):
    table.append(spark.createDataFrame([(1, "b", 9), (1, "a", 5)], DDL))
    assert rows(table.read().where("obs_id = 1")) == [(1, "b", 9)]
    table.append(spark.createDataFrame([(1, "un-voided", 2)], DDL))      # arrives later with an older date
    assert rows(table.read().where("obs_id = 1")) == [(1, "un-voided", 2)]


def test_a_write_that_died_is_not_read_and_its_number_is_used_again(spark, table):
    spark.createDataFrame([(1, "half", 2)], DDL).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(table._folder("c", 2))
    assert table.last() == 1 and rows(table.read().where("obs_id = 1")) == [(1, "row 1", 1)]
    assert table.append(spark.createDataFrame([(1, "whole", 2)], DDL)) == 2
    assert rows(table.read().where("obs_id = 1")) == [(1, "whole", 2)]


def test_compaction_keeps_the_rows(spark, table, monkeypatch):
    monkeypatch.setattr(changes, "MERGE_FOLDERS", 3)
    for i in range(3):
        table.append(spark.createDataFrame([(i, f"change {i}", 2), (0, f"again {i}", 2)], DDL))
    want = rows(table.read())
    assert table.compact() == "m" and table._live() == (1, [("m", 4)]) and rows(table.read()) == want
    assert rows(table.read(upto=2).where("obs_id < 3")) == [(0, "change 0", 2), (1, "row 1", 1), (2, "row 2", 1)]   # a tie goes by the other columns
    table.append(spark.createDataFrame([(i, f"all {i}", 3) for i in range(20_000)], DDL))
    want = rows(table.read())
    assert table.compact() == "v" and table._live() == (5, []) and rows(table.read()) == want
    table.write(spark.createDataFrame([(1, "only", 1)], DDL))
    assert rows(table.read()) == [(1, "only", 1)]
    assert [n for n, _ in table._listing()["v"]] == [5, 6] and not table._listing()["c"] and not table._listing()["m"]


def test_stream_writes_change_files(spark, table):
    root = scratch_path(spark, "test-stream")
    for i in range(3):
        spark.createDataFrame([(i, "streamed", 2)], DDL).coalesce(1).write.mode("append").parquet(root + "/landing")
    ingest_available(spark, "obs", root + "/landing", table, table.read().schema, checkpoint=root + "/ckpt", files_per_batch=1)
    assert table._live()[0] == 1 and table.last() >= 4
    want = rows(table.read())
    assert rows(table.read().where("obs_id < 4"))[:3] == [(i, "streamed", 2) for i in range(3)]
    ingest_available(spark, "obs", root + "/landing", table, table.read().schema, checkpoint=root + "/replay")
    assert rows(table.read()) == want


def test_signed_counts_drop_what_is_gone(spark):
    t = ChangeTable(spark, "n", SignedCounts(), root=scratch_path(spark, "test-changes"))
    t.write(spark.createDataFrame([("a", 2), ("b", 1), (None, 1)], "k string, n long"))
    change = spark.createDataFrame([("a", -1), ("b", -1), (None, 2), ("c", 1), ("d", 1), ("d", -1)], "k string, n long")
    n = t.append(change)
    want = [("a", 1), ("c", 1), (None, 3)]
    assert sorted(map(tuple, t.read().collect()), key=str) == want
    t.append(change, number=n)                                           # the same run again
    assert sorted(map(tuple, t.read().collect()), key=str) == want


# -- counted cells -------------------------------------------------------------

def shown(df):
    return sorted(str(r).replace("=-0.0", "=0.0") for r in df.collect())        # as text: NaN equals itself


def check(spark, before, after, spec=PivotSpec()):
    """The wide table kept by an increment equals a rebuild from all rows."""
    store = CellStore(spark, scratch_path(spark, "test-cells"), spec)
    old, new = flat_df(spark, before), flat_df(spark, after)
    store.build(old)
    wide_old, cat_old = store.wide(), store.catalog()
    full = widen(old, spec)
    assert wide_old.columns == full.columns and shown(wide_old) == shown(full)
    gone, come = old.exceptAll(new), new.exceptAll(old)
    delta = store.apply(gone, come)
    full = widen(new, spec)
    for wide in (refresh_wide_cells(wide_old, cat_old, store, delta)[0], store.wide()):
        assert wide.columns == full.columns
        assert shown(wide) == shown(full)
    return store, delta


D1 = dt.datetime(2024, 2, 1)


def test_greatest_value_voided(spark):
    rest = [obs(1, 10, "Weight", num=5.0, obs_id=1), obs(2, 20, "Weight", num=7.0, obs_id=3)]
    _, delta = check(spark, rest + [obs(1, 10, "Weight", num=9.0, obs_id=2, created=D1)], rest)
    assert {r.encounter_id for r in delta.collect()} == {10}


def test_one_of_two_equal_values_voided(spark):
    rest = [obs(1, 10, "Weight", num=9.0, obs_id=1), obs(1, 10, "Result", coded=1, answer="Yes", obs_id=4)]
    check(spark, rest + [obs(1, 10, "Weight", num=9.0, obs_id=2), obs(1, 10, "Result", coded=1, answer="Yes", obs_id=5)], rest)


def test_edit_moves_a_row_to_another_group_and_null_keys(spark):
    a = obs(1, 10, "Weight", num=9.0, obs_id=1, location=None, visit=None)
    check(spark, [a, obs(1, 10, None, text="no concept", obs_id=2)], [obs(1, 10, "Weight", num=9.0, obs_id=1, location="B")])


def test_family_gained_and_answer_lost(spark):
    """Rule (a): a numeric row of one group makes a column that older rows of other groups have values for."""
    mixed = obs(2, 20, "Glucose", coded=1, answer="High", num=8.5, obs_id=2)
    before = [mixed, obs(3, 30, "Result", coded=1, answer="Rare", obs_id=3)]
    store, _ = check(spark, before, [mixed, obs(1, 10, "Glucose", num=4.5, obs_id=1)])
    assert not any(e.answer == "Rare" for e in store.catalog())


def test_last_concept_voided_and_first_gained(spark):
    none = [obs(1, 10, None, text="x", obs_id=1)]
    some = none + [obs(2, 20, "Weight", num=1.0, obs_id=2)]
    check(spark, some, none)
    check(spark, none, some)
    check(spark, [], some)
    check(spark, some, [])


def test_all_value_kinds_and_least(spark):
    before = [obs(1, 10, "When", when=D1, obs_id=1), obs(1, 10, "When", when=dt.datetime(2023, 1, 1), obs_id=2),
              obs(1, 10, "Drug", drug=7, obs_id=3), obs(1, 10, "Note", text="b", obs_id=4), obs(1, 10, "Note", text="", obs_id=5),
              obs(1, 10, "N", num=float("nan"), obs_id=6), obs(1, 10, "N", num=-0.0, obs_id=7), obs(1, 10, "Other", complex_="c", obs_id=8)]
    check(spark, before, before[1:5] + before[6:])
    check(spark, before, before[:5], PivotSpec(aggregates={"numeric": F.min}, families=("numeric", "text")))
    with pytest.raises(ValueError):
        CellStore(spark, "x", PivotSpec(aggregates={"numeric": F.sum}))


def test_a_run_that_died_between_the_tables(spark):
    store = CellStore(spark, scratch_path(spark, "test-cells"))
    old, new = flat_df(spark, [obs(1, 10, "Weight", num=5.0, obs_id=1)]), flat_df(spark, [obs(1, 10, "Height", num=6.0, obs_id=1)])
    store.build(old)
    append, store.types.append = store.types.append, None
    with pytest.raises(TypeError):
        store.apply(old, new)
    store.types.append = append
    assert store.wide().collect() == widen(old).collect()                # still the last number that both tables hold
    store.apply(old, new)
    assert store.wide().collect() == widen(new).collect()


def _exchanged(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unchanged_counts_are_not_folded_again(spark):
    """Base rows that the changes do not name pass by the fold: only the key filter's hits are shuffled."""
    t = ChangeTable(spark, "n", SignedCounts(), root=scratch_path(spark, "test-changes"))
    t.write(spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("n")))
    t.append(spark.createDataFrame([("7", -1), ("8", 1), ("new", 2)], "k string, n long"))
    hits = [r for r in t.read().collect() if r.k in ("7", "8", "new")]
    assert sorted(map(tuple, hits)) == [("8", 2), ("new", 2)] and t.read().count() == 20_000
    base, folders = t._live()
    free, hit = rows_by_key_filter(spark.read.parquet(t._folder("v", base)), t._changes(folders), ["k"])
    assert hit.count() < 100 and free.count() + hit.count() == 20_000
    assert "Union" in _exchanged(t.read())


def test_a_base_with_repeated_rows_is_stored_once_each(spark):
    t = ChangeTable(spark, "n", SignedCounts(), root=scratch_path(spark, "test-changes"))
    t.write(spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 2)], "k string, n long"))
    t.append(spark.createDataFrame([("b", 1), (None, -3)], "k string, n long"))
    assert sorted(map(tuple, t.read().collect())) == [("a", 2), ("b", 1)]


def test_counted_cells_shuffle_a_group_once(spark):
    """Counting shuffles flat rows, not their entries; and the fold needs one shuffle for both its steps."""
    store = CellStore(spark, scratch_path(spark, "test-cells"))
    flat = flat_df(spark, [obs(1, 10, "Weight", num=5.0, obs_id=1), obs(2, 20, "Result", coded=1, answer="Yes", obs_id=2)])
    counted = count_cells(flat)
    assert _exchanged(counted).count("Exchange hashpartitioning") == 1
    store.build(flat)
    assert _exchanged(store.wide()).count("Exchange hashpartitioning") == 1


def test_stored_rows_are_sorted_once(spark):
    flat = flat_df(spark, [obs(1, 10, "Note", text="b", obs_id=1), obs(1, 10, "Note", text="a", obs_id=2), obs(2, 20, "Weight", num=1.0, obs_id=3)])
    path = scratch_path(spark, "test-flat")
    flat.write.parquet(path)
    stored = spark.read.parquet(path)
    cat = build_catalog(stored)
    for strategy in ("conditional", "long"):
        plan = widen(stored, catalog=cat, strategy=strategy, stored=True)
        text = _exchanged(plan)                              # before it runs: the final plan would stand beside it
        assert text.count("Exchange hashpartitioning") == 1
        assert "Sort [" not in text[text.index("Exchange hashpartitioning"):]        # nothing is sorted below the shuffle
        assert shown(plan) == shown(widen(stored, catalog=cat, strategy=strategy))
