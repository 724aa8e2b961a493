"""Splits, preparation, metrics and champion decisions."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from premiere.operators import champion, metrics, preprocess, ranks


def test_chronological_split_keeps_days_together(spark):
    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i // 3)) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, launch_date date")
    out = ranks.chronological_split(df, 0.70, 0.15).collect()
    assert len(out) == 60
    names = {}
    for r in out:
        names.setdefault(r.launch_date, set()).add(r.dataset_split)
    assert all(len(v) == 1 for v in names.values())
    order = [names[d].copy().pop() for d in sorted(names)]
    # 21 distinct values with NULL first: percent ranks 1/20 ... 20/20.
    assert order == ["train"] * 13 + ["validation"] * 3 + ["test"] * 4


def test_one_launch_date_is_all_train(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1))] * 3, "id int, launch_date date")
    assert {r.dataset_split for r in ranks.chronological_split(df, 0.7, 0.15).collect()} == {"train"}


def test_stratified_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    once = ranks.stratified_split(df, "y", "id", 0.2, 42)
    counts = {(r.y, r.dataset_split): r["count"] for r in once.groupBy("y", "dataset_split").count().collect()}
    assert counts == {(0, "train"): 720, (0, "test"): 180, (1, "train"): 80, (1, "test"): 20}
    again = ranks.stratified_split(df.repartition(7), "y", "id", 0.2, 42)
    assert once.exceptAll(again).count() == 0
    assert once.exceptAll(ranks.stratified_split(df, "y", "id", 0.2, 43)).count() > 0


def test_shuffle_is_a_permutation(spark):
    out = ranks.seeded_shuffle(spark.range(5000), "id", 1).orderBy("id").collect()
    assert sorted(r.position for r in out) == list(range(1, 5001))
    assert [r.position for r in out] != list(range(1, 5001))


def test_preparation(spark):
    rows = [("b", 1.0, 5.0, None), ("a", 3.0, 5.0, None), (None, None, 5.0, None), ("b", 5.0, 5.0, None)]
    df = spark.createDataFrame(rows, "brand string, x double, fixed double, missing double")
    stats = {r.feature: (r["mean"], r["std"]) for r in preprocess.scaler_stats(df, ("x", "fixed", "missing")).collect()}
    assert stats["x"] == (3.0, pytest.approx(np.std([1, 3, 5])))
    assert stats["fixed"] == (5.0, 1e-6) and stats["missing"] == (0.0, 1e-6)
    words = preprocess.vocabulary(df, "brand")
    assert [tuple(r) for r in words.orderBy("id").collect()] == [("a", 1), ("b", 2)]
    seen = spark.createDataFrame([("b",), ("new",), (None,)], "brand string")
    coded = preprocess.encode_category(seen, words, "brand", "code").collect()
    assert {r.brand: r.code for r in coded} == {"b": 2, "new": 0, None: 0}


def test_forecast_metrics(spark):
    rng = np.random.default_rng(0)
    y, p = rng.uniform(0, 9, (50, 3)), rng.uniform(0, 9, (50, 3))
    columns = [f"target_m{i}_qty" for i in (1, 2, 3)] + [f"prediction_m{i}" for i in (1, 2, 3)]
    df = spark.createDataFrame(np.hstack([y, p]).tolist(), columns)
    got = {r.horizon: r for r in metrics.forecast_metrics(df).collect()}
    sides = {f"m{i + 1}": (y[:, i], p[:, i]) for i in range(3)} | {"three_month": (y.sum(1), p.sum(1))}
    for h, (actual, predicted) in sides.items():
        e = predicted - actual
        assert got[h].mae == pytest.approx(abs(e).mean()) and got[h].rmse == pytest.approx(np.sqrt((e**2).mean()))
        assert got[h].wape == pytest.approx(abs(e).sum() / abs(actual).sum())
    flat = {r.metric for r in metrics.flat_metrics(metrics.forecast_metrics(df)).collect()}
    assert len(flat) == 12 and "test_three_month_wape" in flat


def test_no_demand_at_all(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0, 0.0, 0.0)], [f"target_m{i}_qty" for i in (1, 2, 3)] + [f"prediction_m{i}" for i in (1, 2, 3)])
    got = {r.horizon: r.wape for r in metrics.forecast_metrics(df).collect()}
    assert got["m1"] == pytest.approx(1e9) and got["m2"] == 0.0


@pytest.mark.parametrize("digits, seed", [(1, 1), (6, 2), (0, 3)])
def test_auc_against_all_pairs(spark, digits, seed):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.3), round(rng.random(), digits)) for _ in range(400)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = metrics.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()[0]
    assert got == pytest.approx(want)


def test_auc_of_one_class_is_undefined(spark):
    assert metrics.roc_auc(spark.createDataFrame([(0, 0.5)], "y int, s double"), "y", "s").first()[0] is None


def test_class_figures(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4, "y int, p int")
    s = metrics.classifier_summary(df, "y", "p").first()
    assert tuple(s) == pytest.approx((0.7, 0.6, 0.75, 2 / 3))
    report = {r["class"]: r for r in metrics.class_report(df, "y", "p").collect()}
    assert report["Legitimate"].support == 6 and report["Fraud"].support == 4
    assert report["weighted avg"].recall == pytest.approx(0.7)
    assert report["macro avg"].precision == pytest.approx((0.8 + 0.6) / 2)
    nothing = metrics.classifier_summary(spark.createDataFrame([(1, 0), (0, 0)], "y int, p int"), "y", "p").first()
    assert tuple(nothing) == (0.5, 0.0, 0.0, 0.0)


def decide(spark, values, lower=True):
    rows = [(f"r{i}", dt.datetime(2024, 1, 1 + i), "m", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(
        rows, "run_id string, evaluated_at timestamp, selection_metric string, selection_metric_value double"
    )
    return champion.champion_history(df, lower).orderBy("run_id").collect()


def test_champion_decisions(spark):
    out = decide(spark, [0.5, 0.4, 0.45, 0.4, 0.39999, None, 0.3])
    assert [r.promoted for r in out] == [True, True, False, False, True, False, True]
    assert out[0].reason == champion.FIRST_REASON and out[0].improvement_pct is None
    assert out[1].reason == "Candidate improved by 20.00%" and out[2].reason == "Candidate is worse by 12.50%"
    assert out[3].reason == "Candidate is equal to champion (+0.00% difference)"
    assert out[4].reason.startswith("Candidate is equal")
    assert out[6].champion_metric == 0.39999


def test_champion_when_higher_is_better_or_unmeasured(spark):
    assert [r.promoted for r in decide(spark, [0.5, 0.4, 0.6], lower=False)] == [True, False, True]
    out = decide(spark, [None, 0.7, 0.8])
    assert [r.promoted for r in out] == [True, True, False]
    assert out[1].reason == champion.UNMEASURED_REASON


def test_zero_champion_metric(spark):
    out = decide(spark, [0.0, 0.1])
    assert out[1].promoted is False and out[1].improvement_pct is None


def test_metrics_of_one_log_do_not_compete(spark):
    rows = [("a", 1, "wape", 0.5), ("b", 2, "mae", 100.0), ("c", 3, "wape", 0.45), ("d", 4, "mae", 90.0)]
    schema = "run_id string, evaluated_at int, selection_metric string, selection_metric_value double"
    log = spark.createDataFrame(rows, schema)
    out = {r.run_id: (r.promoted, r.reason) for r in champion.champion_history(log).collect()}
    assert out["b"] == (True, champion.FIRST_REASON)
    assert out["c"] == (True, "Candidate improved by 10.00%") and out["d"] == (True, "Candidate improved by 10.00%")


def test_auc_of_large_counts_does_not_overflow(spark):
    expression = F.lit(5_000_000_000).cast("double") * F.lit(5_000_000_000)
    assert spark.range(1).select(expression).first()[0] == 25e18
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (0, 0.9), (1, 0.5)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first()[0] == 0.625


def test_latest_rows(spark):
    days = [("b", dt.datetime(2024, 1, 2)), ("a", dt.datetime(2024, 1, 3)), ("c", dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(days, "run_id string, evaluated_at timestamp")
    assert champion.latest_evaluation(df).first().run_id == "a"
    assert champion.latest_run(df.withColumnRenamed("evaluated_at", "started_at")).first().run_id == "a"
