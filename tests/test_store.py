"""Stored tables (S9-S12, H10): increments equal a full rebuild, read what they touch, and survive a crash at any step."""
import datetime as dt
import re
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from chartfold.plans import refresh
from chartfold.plans.flatten import flatten_observations
from chartfold.plans.pivot import widen
from chartfold.plans.refresh import WideStore
from chartfold.session import scratch_path
from chartfold.sources.derived import ClinicalSource, with_tables
from helpers import D0, base_tables, table


def _same(a, b):
    cols = b.columns
    return sorted(map(tuple, a.select(*cols).collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def assert_like_rebuild(store, raw):
    """Same rows under the same columns as a rebuild of ``raw``; columns by identity, as stored names are kept for good."""
    from chartfold.plans.pivot import build_catalog
    flat = flatten_observations(raw)
    cat = build_catalog(flat)
    name_of = {(e.concept, e.family, e.answer): e.name for e in store.catalog()}
    assert set(name_of) == {(e.concept, e.family, e.answer) for e in cat}
    full = widen(flat, catalog=cat)
    wide = store.wide()
    keys = full.columns[:len(full.columns) - len(cat)]
    assert _same(wide.select(*keys, *[F.col(f"`{name_of[(e.concept, e.family, e.answer)]}`").alias(e.name) for e in cat]), full)
    assert _same(store.flat().drop("part_month"), flat)


def test_bootstrap_then_increments_match_rebuild(spark, small_dir):
    src = ClinicalSource(spark, small_dir)
    store = WideStore(spark, root=scratch_path(spark, "test-store"))
    cuts = [dt.datetime(2000, 12, 1), dt.datetime(2001, 7, 10)]
    assert store.refresh(src.at(cuts[0]).tables(), since=cuts[0]) == "full"
    marks = store.marks()
    assert store.refresh(src.at(cuts[1]).tables()) == "increment"             # from the stored marks
    assert all(store.marks()[t] > marks[t] for t in ("obs", "encounter", "visit"))
    assert store.refresh(src.tables(), since=cuts[1]) == "increment"
    assert_like_rebuild(store, src.tables())


@pytest.fixture(scope="module")
def world(spark):
    """Three patients in three months, one visit-less encounter.

    Rows with the date of the mark are read again, so the latest rows of each fact table (number 99) show in no table.
    """
    latest = D0 + dt.timedelta(days=90)
    t = base_tables(spark)
    t["encounter"] = table(spark, "encounter", [
        {"encounter_id": e, "patient_id": e, "visit_id": v, "encounter_type": 1, "location_id": 1, "date_created": d, "encounter_datetime": d, "voided": False}
        for e, v, d in ((10, 5, D0), (11, 6, dt.datetime(2024, 2, 3)), (12, 7, dt.datetime(2024, 3, 3)), (13, None, dt.datetime(2024, 3, 9)), (99, None, latest))])
    t["visit"] = table(spark, "visit", [
        {"visit_id": v, "patient_id": v, "visit_type_id": 1, "location_id": 1, "date_started": dt.datetime(2024, m, 1), "date_created": d, "voided": False}
        for v, m, d in ((5, 1, D0), (6, 2, D0), (7, 3, D0), (99, 3, latest))])
    t["obs"] = table(spark, "obs", [obs_row(i, e, c, **v) for i, e, c, v in (
        (1, 10, 100, {"value_numeric": 65.5}), (2, 10, 300, {"value_text": "warm"}), (3, 11, 100, {"value_numeric": 70.0}),
        (4, 11, 300, {"value_coded": 200, "value_numeric": 38.5}), (5, 12, 100, {"value_numeric": 80.0}), (6, 13, 100, {"value_numeric": 90.0}),
        (99, 98, 100, {"created": latest}))])
    root = scratch_path(spark, "test-world")
    for name, df in t.items():
        df.coalesce(1).write.parquet(f"{root}/{name}")
        t[name] = spark.read.parquet(f"{root}/{name}")
    return t


@pytest.fixture(scope="module", autouse=True)
def small_jobs(spark):
    """A handful of rows: few tasks and no compiled code, whose making takes longer than the jobs."""
    small = {"spark.sql.shuffle.partitions": "2", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    before, buckets = {k: spark.conf.get(k, None) for k in small}, refresh.INDEX_BUCKETS
    for k, v in small.items():
        spark.conf.set(k, v)
    refresh.INDEX_BUCKETS = 4
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    refresh.INDEX_BUCKETS = buckets


@pytest.fixture(scope="module")
def built(spark, world):
    root = scratch_path(spark, "test-built")
    WideStore(spark, root=root, reports=True).build_full(world)
    return root


@pytest.fixture
def store(spark, built):
    """A store of ``world``, built once and copied for each test."""
    root = scratch_path(spark, "test-store")
    shutil.copytree(built, root)
    return WideStore(spark, root=root)


def obs_row(i, enc, concept, created=D0, **more):
    return {"obs_id": i, "person_id": enc, "concept_id": concept, "encounter_id": enc, "location_id": 1, "date_created": created, "voided": False, **more}


LATER = dt.datetime(2024, 6, 1)


def test_emptied_partition_is_removed(spark, world, store):
    gone = dict(world, obs=world["obs"].withColumns({
        "voided": F.col("encounter_id") == 12, "date_voided": F.when(F.col("encounter_id") == 12, F.lit(LATER).cast("timestamp_ntz"))}))
    info = store.increment(gone)
    assert info["partitions"] == [202403]
    assert "202403" not in store.commit()["parts"]["flat"] and "202403" not in store.commit()["parts"]["wide"]
    assert_like_rebuild(store, gone)


def test_visit_less_encounters_go_by_their_own_month(spark, world, store):
    assert sorted(map(int, store.commit()["parts"]["flat"])) == [-202403, 202401, 202402, 202403]


def test_a_new_answer_rewrites_only_months_that_hold_it(spark, world, store):
    before = {(e.concept, e.family, e.answer): (e.col_id, e.name) for e in store.registry()}
    pointed = dict(store.commit()["parts"]["wide"])
    more = dict(world, obs=world["obs"].unionByName(table(spark, "obs", [obs_row(7, 12, 100, LATER, value_coded=200)])))
    info = store.increment(more)
    assert info["catalog_changed"] and info["pivoted"] == [202403]
    after = {(e.concept, e.family, e.answer): (e.col_id, e.name) for e in store.registry()}
    assert before.items() <= after.items()
    assert after[("Weight (kg)", "coded", "Yes")] == (len(before), "weight_kg_yes")
    now = store.commit()["parts"]["wide"]
    assert {p for p in now if now[p] != pointed.get(p)} == {"202403"}
    assert_like_rebuild(store, more)
    assert {r.encounter_id: r.weight_kg_yes for r in store.wide().collect()} == {10: 0, 11: 0, 12: 1, 13: 0}


def test_a_new_value_family_reaches_rows_of_other_types_in_untouched_months(spark, world, store):
    more = dict(world, obs=world["obs"].unionByName(table(spark, "obs", [obs_row(7, 12, 300, LATER, value_numeric=36.5)])))
    info = store.increment(more)
    assert info["partitions"] == [202403] and info["pivoted"] == [202402, 202403]       # obs 4: a coded row with a number
    assert_like_rebuild(store, more)


def test_a_column_that_comes_back_keeps_its_identity(spark, world, store):
    text = next(e for e in store.registry() if e.family == "text")
    void = F.col("obs_id") == 2
    gone = dict(world, obs=world["obs"].withColumns({"voided": void, "date_voided": F.when(void, F.lit(LATER).cast("timestamp_ntz"))}))
    store.increment(gone)
    assert text.name not in store.wide().columns
    assert_like_rebuild(store, gone)
    back = dict(world, obs=gone["obs"].withColumn("voided", F.lit(False)).unionByName(
        table(spark, "obs", [obs_row(8, 13, 300, LATER + dt.timedelta(1), value_text="cold")])))
    store.increment(back)
    assert next(e for e in store.catalog() if e.family == "text") == text
    assert_like_rebuild(store, back)


def test_obs_and_encounters_that_move(spark, world, store):
    moved = dict(world)
    hit = F.col("obs_id") == 3                                              # to another encounter and month
    moved["obs"] = world["obs"].withColumns({"encounter_id": F.when(hit, 12).otherwise(F.col("encounter_id")),
                                             "date_created": F.when(hit, F.lit(LATER)).otherwise(F.col("date_created")).cast("timestamp_ntz")})
    other = F.col("visit_id") == 5                                          # a visit that began in another month
    moved["visit"] = world["visit"].withColumns({"date_started": F.when(other, F.lit(dt.datetime(2023, 12, 30))).otherwise(F.col("date_started")).cast("timestamp_ntz"),
                                                 "date_created": F.when(other, F.lit(LATER)).otherwise(F.col("date_created")).cast("timestamp_ntz")})
    assert 202312 in store.increment(moved)["partitions"]
    assert_like_rebuild(store, moved)


def test_many_runs_write_the_index_anew(spark, world, store, monkeypatch):
    monkeypatch.setattr(refresh, "INDEX_CHANGES", 3)
    raw, runs = world, []
    for k in range(5):
        at = LATER + dt.timedelta(days=k)
        raw = dict(raw, obs=raw["obs"].unionByName(table(spark, "obs", [obs_row(100 + k, 10 + k % 4, 100, at, value_numeric=float(k))])))
        store.increment(raw)
        runs.append(len(store.commit()["runs"]["index"]))
    assert max(runs) <= 3 and 1 in runs
    assert_like_rebuild(store, raw)
    assert len(store.log.numbers()) == 3 and len(store.log._names("flat")) <= 7      # old commits and folders go


# -- dictionaries -----------------------------------------------------------------

def _edit(df, key, value, **columns):
    return df.withColumns({c: F.when(F.col(key) == value, F.lit(v)).otherwise(F.col(c)) for c, v in columns.items()})


@pytest.mark.parametrize("name,key,value,columns", [
    ("location", "location_id", 1, {"name": "Clinic B", "postal_code": "9"}),
    ("encounter_type", "encounter_type_id", 1, {"name": "Child Visit"}),
    ("visit_type", "visit_type_id", 1, {"name": "Ward"}),
    ("concept_name", "concept_id", 100, {"name": "Mass (kg)"}),
    ("concept_name", "concept_id", 200, {"name": "Positive"}),
    ("concept_name", "concept_id", 300, {"locale_preferred": False}),
])
def test_dictionary_edits_reach_the_stored_tables(spark, world, store, name, key, value, columns):
    """Without any audit date: the stored digests tell."""
    edited = dict(world, **{name: _edit(world[name], key, value, **columns)})
    store.increment(edited)
    assert_like_rebuild(store, edited)


def test_a_dictionary_edit_touches_only_months_that_hold_it(spark, world, store):
    edited = dict(world, concept_name=_edit(world["concept_name"], "concept_id", 200, name="Positive"))
    assert 202401 not in store.increment(edited)["partitions"]
    removed = dict(edited, location=edited["location"].where("location_id != 1"))
    store.increment(removed)
    assert_like_rebuild(store, removed)
    assert store.increment(removed)["catalog_changed"] is False


# -- what an increment reads --------------------------------------------------------

def test_every_scan_of_flat_names_its_months(spark, world, store, monkeypatch):
    read = []
    real = WideStore._months

    def months(self, commit, table, parts=None):
        df = real(self, commit, table, parts)
        read.append((table, parts, df))
        return df
    monkeypatch.setattr(WideStore, "_months", months)
    info = store.increment(dict(world, obs=world["obs"].unionByName(table(spark, "obs", [obs_row(7, 12, 100, LATER, value_numeric=1.0)]))), LATER)
    assert info["partitions"] == [202403]
    scans = [(parts, df) for name, parts, df in read if name == "flat"]
    assert len(scans) >= 3
    for parts, df in scans:
        assert parts == [202403]
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*part_month", plan) and "1 paths" in plan, plan
        assert {f.split("part_month=")[1].split("/")[0] for f in df.inputFiles()} == {"202403"}


def test_the_index_is_read_by_buckets(spark, world, store, monkeypatch):
    c = store.commit()
    from pyspark.sql.types import StructType
    df = store._runs(c, "index", StructType.fromJson(c["schemas"]["index"])).where(F.col("b").isin([3]))
    assert re.search(r"PartitionFilters: \[[^\]]*b#", df._jdf.queryExecution().executedPlan().toString())


# -- crashes -------------------------------------------------------------------------

STEPS = ("flat", "wide", "index", "publish", "vacuum")


class Died(RuntimeError):
    pass


def dies_at(store, step, monkeypatch):
    """A driver that is lost right after it has written ``step``, or instead of publishing."""
    write, publish, vacuum = store._write, store.log.publish, store.log.vacuum

    def dying_write(df, name, run, by):
        out = write(df, name, run, by)
        if name == step:
            raise Died(step)
        return out

    def dying_publish(commit, after):
        if step == "publish":
            raise Died(step)
        return publish(commit, after)

    def dying_vacuum(tables, keep=3):
        if step == "vacuum":
            raise Died(step)
        return vacuum(tables, keep)
    monkeypatch.setattr(store, "_write", dying_write)
    monkeypatch.setattr(store.log, "publish", dying_publish)
    monkeypatch.setattr(store.log, "vacuum", dying_vacuum)


@pytest.mark.parametrize("step", STEPS)
def test_crash_at_each_step_then_a_run_with_its_own_mark(spark, world, store, step):
    root = store.root
    before, marks = sorted(map(str, store.wide().collect())), store.marks()
    first = dict(world, obs=world["obs"].unionByName(table(spark, "obs", [obs_row(7, 12, 100, LATER, value_coded=200), obs_row(8, 10, 300, LATER, value_text="x")])),
                 location=_edit(world["location"], "location_id", 1, name="Clinic B"))
    dying = WideStore(spark, root=root)
    with pytest.MonkeyPatch.context() as m:
        dies_at(dying, step, m)
        with pytest.raises(Died):
            dying.increment(first)
    if step != "vacuum":                                     # nothing of the dead run is seen
        assert sorted(map(str, WideStore(spark, root=root).wide().collect())) == before
        assert WideStore(spark, root=root).marks() == marks
    else:                                                    # published: all of it is
        assert_like_rebuild(WideStore(spark, root=root), first)
    # the next run passes its own, later mark and has no row of the dead run among its changes
    at = LATER + dt.timedelta(days=9)
    second = dict(first, obs=first["obs"].unionByName(table(spark, "obs", [obs_row(9, 11, 100, at, value_numeric=3.0)])))
    store = WideStore(spark, root=root)
    store.increment(second, since=at)
    assert_like_rebuild(store, second)


def test_crash_in_the_first_build_leaves_nothing(spark, world):
    root = scratch_path(spark, "test-store-crash-full")
    dying = WideStore(spark, root=root)
    with pytest.MonkeyPatch.context() as m:
        dies_at(dying, "wide", m)
        with pytest.raises(Died):
            dying.refresh(world)
    store = WideStore(spark, root=root)
    assert not store.exists()
    assert store.refresh(world) == "full"
    assert_like_rebuild(store, world)


def test_a_reader_keeps_its_commit(spark, world, store):
    pinned = store.wide()
    before = sorted(map(str, pinned.collect()))
    store.increment(dict(world, obs=world["obs"].where("obs_id != 1").unionByName(table(spark, "obs", [obs_row(1, 10, 100, LATER, value_numeric=1.0)]))))
    assert sorted(map(str, pinned.collect())) == before


def test_two_runs_cannot_publish_the_same_number(spark, world, store):
    commit = store.commit()
    store.log.publish(commit, 1)
    with pytest.raises(Exception, match="exist"):
        store.log.publish(commit, 1)


def assert_reports_like_full_scans(store, raw):
    from chartfold.plans import analytics as an
    from chartfold.plans import reports as rp
    from chartfold.plans.pivot import ENCOUNTER_KEYS
    flat = flatten_observations(raw)
    groups = flat.select(*ENCOUNTER_KEYS).distinct()
    states = store.report_states()
    for report, full in ((rp.clinical_totals, an.clinical_totals(flat)), (rp.top_locations, an.top_locations(flat)),
                         (rp.visit_frequency, an.visit_frequency(flat)), (rp.encounter_types_by_location, an.encounter_types_by_location(groups)),
                         (rp.encounter_type_distribution, an.encounter_type_distribution(groups)),
                         (rp.lab_results_by_location, an.lab_results_by_location(groups))):
        kept = report(states)
        assert set(kept.columns) == set(full.columns)
        assert _same(kept, full), report.__name__


def test_reports_from_month_states_equal_full_scans(spark, world, store):
    assert_reports_like_full_scans(store, world)
    at = F.lit(LATER).cast("timestamp_ntz")
    # an encounter voided, a visit that loses its start date while its encounters lie in two months, obs at another place and without a person
    enc, visit = F.col("encounter_id") == 12, F.col("visit_id") == 6
    moved = dict(world)
    moved["encounter"] = world["encounter"].withColumns({
        "voided": enc, "date_voided": F.when(enc, at), "visit_id": F.when(F.col("encounter_id") == 13, 6).otherwise(F.col("visit_id")),
        "date_created": F.when(F.col("encounter_id") == 13, at).otherwise(F.col("date_created"))})
    moved["visit"] = world["visit"].withColumns({"date_started": F.when(~visit, F.col("date_started")),
                                                 "date_created": F.when(visit, at).otherwise(F.col("date_created"))})
    moved["obs"] = world["obs"].unionByName(table(spark, "obs", [
        {**obs_row(20, 13, 100, LATER, value_numeric=1.0), "location_id": None, "person_id": 11},
        {**obs_row(21, 10, 100, LATER, value_numeric=2.0), "person_id": None}]))
    info = store.increment(moved)
    assert 202403 in info["partitions"] and "202403" not in store.commit()["parts"]["reports"]
    assert store.report_states().where("kind = 'loose'").select(refresh.PART).distinct().count() == 2
    assert_reports_like_full_scans(store, moved)
    more = dict(moved, obs=moved["obs"].unionByName(table(spark, "obs", [obs_row(22, 10, 300, LATER + dt.timedelta(1), value_text="hot")])))
    store.increment(more, since=LATER + dt.timedelta(hours=1))
    assert_reports_like_full_scans(store, more)


def test_reports_read_states_only(spark, store):
    from chartfold.plans.reports import REPORTS
    for report in REPORTS.values():
        files = report(store.report_states()).inputFiles()
        assert files and all("/reports/run=" in f for f in files)


def test_a_store_without_reports_says_so(spark, world):
    bare = WideStore(spark, root=scratch_path(spark, "test-store"))
    bare.build_full(world)
    with pytest.raises(ValueError):
        bare.report_states()


def _flat_writes(monkeypatch):
    """[(dealt, optimized plan)] of every write of the flat table from now on."""
    seen, write = [], WideStore._write

    def spy(self, df, table, run, by, dealt=False):
        if table == "flat":
            seen.append((dealt, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, df, table, run, by, dealt)
    monkeypatch.setattr(WideStore, "_write", spy)
    return seen


def _one_more_obs(spark, world):
    return with_tables(world, obs=world["obs"].unionByName(table(spark, "obs", [obs_row(7, 10, 100, LATER, value_numeric=66.0)])))


def test_kept_rows_of_a_rewritten_month_are_not_dealt_again(spark, world, store, monkeypatch):
    seen, now = _flat_writes(monkeypatch), _one_more_obs(spark, world)
    store.increment(now)
    (dealt, plan), = seen
    assert dealt and plan.count("RebalancePartitions") == 1
    assert "LeftAnti" in plan.split("RebalancePartitions")[1].splitlines()[1]     # only what the exact join has dealt by id
    assert_like_rebuild(store, now)


def test_every_so_many_commits_kept_rows_are_dealt_again(spark, world, store, monkeypatch):
    monkeypatch.setattr(refresh, "DEAL_KEPT", 2)
    seen, now = _flat_writes(monkeypatch), _one_more_obs(spark, world)
    store.increment(now)                                     # commit 2
    store.increment(now)
    assert [dealt for dealt, _ in seen] == [False, True]
    assert_like_rebuild(store, now)


@pytest.mark.parametrize("large", [False, True])
def test_flat_rows_are_dealt_before_the_dictionaries_are_joined(spark, world, monkeypatch, large):
    from chartfold.plans import flatten
    if large:                                                # dictionaries that are not broadcast: dealt after their joins
        monkeypatch.setattr(flatten, "bounded_broadcasts", list)
    flat = flatten_observations(world, source_ids=True, by=(refresh.PART, refresh.part_month("e_date")))
    plain = flatten_observations(world, source_ids=True).withColumn(refresh.PART, refresh.part_month())
    assert flat.columns == plain.columns and _same(flat, plain)
    above = flat._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")[0]
    assert above.count("Join LeftOuter") == (0 if large else 5)


def test_an_increment_holds_one_key_filter_and_one_job_at_a_time(spark, world, store, monkeypatch):
    """What the driver holds of a running plan: the broadcasts of its key filters and of plans beside it."""
    filters, threads, staged, write = {}, set(), WideStore._staged, WideStore._write

    def held(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("bit_or(")

    def staging(self, df, name):
        filters[name] = held(df)
        return staged(self, df, name)

    def writing(self, df, table, run, by, dealt=False):
        threads.add((threading.get_ident(), held(df) if table == "index" else 0))
        return write(self, df, table, run, by, dealt)
    monkeypatch.setattr(WideStore, "_staged", staging)
    monkeypatch.setattr(WideStore, "_write", writing)
    at, enc, visit = F.lit(LATER).cast("timestamp_ntz"), F.col("encounter_id") == 13, F.col("visit_id") == 6
    now = _one_more_obs(spark, world)                        # changed obs, and obs of a changed encounter and a changed visit
    now["encounter"] = world["encounter"].withColumns({
        "visit_id": F.when(enc, 6).otherwise(F.col("visit_id")), "date_created": F.when(enc, at).otherwise(F.col("date_created"))})
    now["visit"] = world["visit"].withColumns({
        "date_started": F.when(visit, F.lit(dt.datetime(2023, 12, 30)).cast("timestamp_ntz")).otherwise(F.col("date_started")),
        "date_created": F.when(visit, at).otherwise(F.col("date_created"))})
    store.increment(now)
    assert max(filters.values()) == 1 and filters["obs"] == 1 and filters["fresh"] == 0
    assert threads == {(threading.get_ident(), 0)}
    assert_like_rebuild(store, now)
