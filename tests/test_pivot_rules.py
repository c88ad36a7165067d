"""Pivot rules on hand-made literal fixtures (FIXTURES.md part C)."""
import datetime as dt
import random

import pytest

from chartfold.plans.pivot import PivotSpec, build_catalog, widen
from helpers import D0, flat_df, obs, rows_by

STRATEGIES = ["conditional", "long"]


@pytest.fixture
def readme_example(spark):
    return flat_df(spark, [
        obs(1, 10, "Scheduled visit", coded=1065, answer="Yes"),
        obs(1, 10, "Weight (kg)", num=65.5),
        obs(1, 10, "Visit type", coded=2001, answer="Follow-up"),
        obs(2, 20, "Scheduled visit", coded=1066, answer="No"),
        obs(2, 20, "Weight (kg)", num=70.0),
    ])


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_long_to_wide_example(spark, readme_example, strategy):
    w = rows_by(widen(readme_example, strategy=strategy))
    assert w[1]["scheduled_visit_yes"] == 1
    assert w[1]["weight_kg_value"] == 65.5
    assert w[1]["visit_type_follow-up"] == 1
    # one-hot absent is 0, never NULL
    assert w[2]["scheduled_visit_yes"] == 0 and w[2]["visit_type_follow-up"] == 0
    assert w[2]["scheduled_visit_no"] == 1


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_precedence_and_mixed_types(spark, strategy):
    df = flat_df(spark, [
        obs(1, 1, "Q", coded=5, answer="A", num=3.0),      # coded wins over numeric
        obs(2, 2, "Q", coded=5, answer="A"),
        obs(3, 3, "M", text="high"),                       # one concept, two types
        obs(3, 3, "M", num=7.0),
    ])
    cat = build_catalog(df)
    names = [e.name for e in cat]
    assert "q_a" in names and "q_value" not in names       # no numeric-classified row for Q
    assert "m_text" in names and "m_value" in names
    w = rows_by(widen(df, strategy=strategy, catalog=cat))
    assert w[3]["m_text"] == "high" and w[3]["m_value"] == 7.0


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_values_come_from_any_row_of_the_concept(spark, strategy):
    df = flat_df(spark, [
        obs(1, 1, "Q", coded=5, answer="A", num=9.0),      # classified coded, numeric present
        obs(2, 2, "Q", num=4.0),                           # makes Q_value exist
    ])
    w = rows_by(widen(df, strategy=strategy))
    assert w[1]["q_value"] == 9.0 and w[1]["q_a"] == 1
    assert w[2]["q_value"] == 4.0 and w[2]["q_a"] == 0


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_no_column_for_other_unnamed_answer_and_null_concept(spark, strategy):
    df = flat_df(spark, [
        obs(1, 1, "Coded no name", coded=5, answer=None),
        obs(2, 2, "Blob", complex_="x"),
        obs(3, 3, None, num=1.0),
        obs(4, 4, "Kept", num=2.0),
    ])
    w = widen(df, strategy=strategy)
    assert [c for c in w.columns if c not in PivotSpec().keys and c != "date_created"] == ["kept_value"]
    assert sorted(r.person_id for r in w.collect()) == [1, 2, 3, 4]   # rows still grouped


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_repeated_value_takes_max_and_datetime_drug(spark, strategy):
    t1, t2 = dt.datetime(2024, 1, 2), dt.datetime(2024, 3, 4)
    df = flat_df(spark, [
        obs(1, 1, "W", num=60.0), obs(1, 1, "W", num=61.5),
        obs(1, 1, "Seen", when=t1), obs(1, 1, "Seen", when=t2),
        obs(1, 1, "Drug", drug=7), obs(1, 1, "Drug", drug=3),
        obs(1, 1, "Note", text="abc"), obs(1, 1, "Note", text="abd"),
    ])
    r = rows_by(widen(df, strategy=strategy))[1]
    assert r["w_value"] == 61.5 and r["seen_datetime"] == t2 and r["drug_drug_id"] == 7
    assert r["note_text"] == "abd"


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_name_edges_and_collisions(spark, strategy):
    long_name = "Systolic blood pressure measured sitting, left arm (mmHg)"
    df = flat_df(spark, [
        obs(1, 1, "a b", num=1.0),
        obs(1, 1, "a_b", num=2.0),
        obs(1, 1, "A/B (x)", num=3.0),
        obs(1, 1, long_name, num=4.0),
        obs(1, 1, "TREATMENT AS of", num=5.0),
    ])
    cat = build_catalog(df)
    names = {e.concept: e.name for e in cat}
    assert names["a b"] == "a_b_value" and names["a_b"] == "a_b_value_2"   # sorted, suffixed (H7)
    assert names["A/B (x)"] == "a_b_x_value"
    assert names[long_name] == "systolic_blood_pressure_measured_sitting_value"
    assert names["TREATMENT AS of"] == "treatment_as_of_value"              # H6
    r = rows_by(widen(df, strategy=strategy, catalog=cat))[1]
    assert r["a_b_value"] == 1.0 and r["a_b_value_2"] == 2.0


def test_strategies_agree_and_row_order_does_not_matter(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        p = rnd.randint(1, 20)
        kind = rnd.choice(["c", "n", "t"])
        concept = f"C{rnd.randint(1, 6)}"
        if kind == "c":
            rows.append(obs(p, p * 10, concept, coded=1, answer=rnd.choice(["Yes", "No", "Maybe"])))
        elif kind == "n":
            rows.append(obs(p, p * 10, concept, num=float(rnd.randint(0, 99))))
        else:
            rows.append(obs(p, p * 10, concept, text=rnd.choice(["lo", "hi"])))
    a = flat_df(spark, rows)
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    b = flat_df(spark, shuffled)
    ca, cb = build_catalog(a), build_catalog(b)
    assert [e.name for e in ca] == [e.name for e in cb]          # catalog deterministic
    wa = widen(a, strategy="conditional", catalog=ca)
    wb = widen(b, strategy="long", catalog=cb)
    assert wa.columns == wb.columns
    assert sorted(map(tuple, wa.collect()), key=repr) == sorted(map(tuple, wb.collect()), key=repr)
    onehot = [e.name for e in ca if e.family == "coded"]
    assert all(r[c] is not None for r in wb.collect() for c in onehot)


def test_concept_filter_keeps_all_groups(spark, readme_example):
    from pyspark.sql import functions as F
    w = widen(readme_example, PivotSpec(concept_filter=F.col("concept_name").like("Weight%")))
    assert set(w.columns) - set(PivotSpec().keys) == {"date_created", "weight_kg_value"}
    assert w.count() == 2


def test_no_concepts_emit_nothing(spark):
    df = flat_df(spark, [obs(1, 1, None, num=1.0)])
    w = widen(df)
    assert w.count() == 0 and "date_created" in w.columns
    # a concept without a column still makes its groups
    other = widen(flat_df(spark, [obs(1, 1, "Picture", complex_="blob"), obs(2, 2, None, num=1.0)]))
    assert other.count() == 2 and set(other.columns) == {*PivotSpec().keys, "date_created"}


def test_type_map_remaps_families(spark):
    df = flat_df(spark, [obs(1, 1, "Rx", drug=5), obs(1, 1, "W", num=2.0)])
    w = widen(df, PivotSpec(type_map={"drug": "other"}))      # drop drug columns
    assert "rx_drug_id" not in w.columns and "w_value" in w.columns


def test_both_plans_aggregate_before_shuffling(spark, readme_example):
    """A hot encounter is combined map-side: partial aggregates precede every exchange."""
    for strategy in STRATEGIES:
        plan = widen(readme_example, strategy=strategy)._jdf.queryExecution().executedPlan().toString()
        assert "partial_max" in plan, strategy


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("fn,weight,flag", [("sum", 12.0, 1), ("avg", 6.0, 1), ("min", 5.0, 1), ("count", 2, 1)])
def test_aggregates_see_cells_only_in_both_plans(spark, strategy, fn, weight, flag):
    from pyspark.sql import functions as F
    df = flat_df(spark, [obs(1, 1, "Weight", num=5.0), obs(1, 1, "Weight", num=7.0), obs(1, 1, "Flag", coded=5, answer="Yes"),
                         obs(2, 2, "Note", text="x")])
    agg = getattr(F, fn)
    w = rows_by(widen(df, PivotSpec(aggregates={"numeric": agg, "coded": agg}), strategy=strategy))
    assert w[1]["weight_value"] == weight and w[1]["flag_yes"] == flag
    assert w[2]["weight_value"] is None and w[2]["flag_yes"] == 0
