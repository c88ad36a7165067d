"""Key-merge contract (S3-S5) and delete+insert."""
import datetime as dt

from chartfold.operators.upsert import change_order, changed_between, delete_insert, duplicate_keys, latest_per_key, upsert_by_key


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_replaces_and_appends(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, ts long")
    batch = spark.createDataFrame([(2, "B", 2), (3, "c", 2)], "id long, v string, ts long")
    out = upsert_by_key(target, batch, ["id"], order_by=["ts"])
    assert _sorted(out) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, ts long")
    batch = spark.createDataFrame([(2, "B", 2), (2, "X", 1), (3, "c", 2)], "id long, v string, ts long")
    once = upsert_by_key(target, batch, ["id"], order_by=["ts"])
    twice = upsert_by_key(once, batch, ["id"], order_by=["ts"])
    assert _sorted(once) == _sorted(twice)


def test_batch_keeps_latest_then_greatest_rest(spark):
    batch = spark.createDataFrame([(1, "a", 5), (1, "z", 5), (1, "q", 9)], "id long, v string, ts long")
    assert _sorted(latest_per_key(batch, ["id"], ["ts"])) == [(1, "q", 9)]
    tie = spark.createDataFrame([(1, "a", 5), (1, "z", 5)], "id long, v string, ts long")
    assert _sorted(latest_per_key(tie, ["id"], ["ts"])) == [(1, "z", 5)]


def test_null_keys_match_each_other(spark):
    target = spark.createDataFrame([(None, "old")], "id long, v string")
    batch = spark.createDataFrame([(None, "new")], "id long, v string")
    assert _sorted(upsert_by_key(target, batch, ["id"])) == [(None, "new")]


def test_composite_key_keeps_both_roles(spark):
    stored = spark.createDataFrame([(1, "Nurse")], "user_id long, role string")
    batch = spark.createDataFrame([(1, "Nurse"), (1, "Admin")], "user_id long, role string")
    assert _sorted(upsert_by_key(stored, batch, ["user_id", "role"])) == [(1, "Admin"), (1, "Nurse")]
    # the single-column key collapses a user's roles to one row (H2)
    assert len(upsert_by_key(stored, batch, ["user_id"]).collect()) == 1


def test_evolving_columns_fill(spark):
    target = spark.createDataFrame([(1, 1)], "id long, a_yes int")
    batch = spark.createDataFrame([(2, 0, 1)], "id long, a_yes int, a_no int")
    out = upsert_by_key(target, batch, ["id"], fill={"a_no": 0})
    assert _sorted(out.select("id", "a_yes", "a_no")) == [(1, 1, 0), (2, 0, 1)]


def test_delete_insert_and_duplicates(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    fresh = spark.createDataFrame([(2, "B")], "id long, v string")
    deleted = spark.createDataFrame([(2,), (3,)], "id long")
    assert _sorted(delete_insert(target, fresh, deleted, "id")) == [(1, "a"), (2, "B")]
    dup = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    assert _sorted(duplicate_keys(dup, ["id"])) == [(1, 2)]


def test_primary_key_merge_equals_null_safe_merge(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, ts long")
    batch = spark.createDataFrame([(2, "B", 2), (2, "X", 1), (3, "c", 2)], "id long, v string, ts long")
    a = upsert_by_key(target, batch, ["id"], order_by=["ts"])
    b = upsert_by_key(target, batch, ["id"], order_by=["ts"], null_safe=False)
    assert _sorted(a) == _sorted(b)


def _versions(spark, rows):
    return spark.createDataFrame(rows, "id long, v double, voided boolean, date_created timestamp_ntz, date_changed timestamp_ntz, "
                                       "date_voided timestamp_ntz, _ingest_seq long")


def test_later_edit_wins_though_its_value_is_smaller(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 5)]
    batch = _versions(spark, [(1, 70.0, False, t[0], t[1], None, 1), (1, 60.0, False, t[0], t[2], None, 2)])
    stored = batch.limit(0).drop("_ingest_seq")
    for b in (batch, batch.drop("_ingest_seq")):
        out = upsert_by_key(stored, b, ["id"], order_by=change_order(b), null_safe=False).collect()
        assert [r.v for r in out] == [60.0] and "_ingest_seq" not in out[0]


def test_unvoid_wins_by_arrival(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 5)]
    batch = _versions(spark, [(1, 5.0, True, t[0], None, t[2], 1), (1, 5.0, False, t[0], None, None, 2)])
    out = upsert_by_key(batch.limit(0).drop("_ingest_seq"), batch, ["id"], order_by=change_order(batch)).collect()
    assert [r.voided for r in out] == [False]


def test_range_keeps_a_row_created_in_it_and_changed_after(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 9)]
    rows = spark.createDataFrame([(1, t[1], t[6]), (2, t[0], t[6]), (3, t[0], t[2]), (4, t[0], None)],
                                 "id long, date_created timestamp_ntz, date_changed timestamp_ntz")
    assert sorted(r.id for r in rows.where(changed_between(rows, t[1], t[3])).collect()) == [1, 3]
