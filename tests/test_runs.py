"""Published runs, ranges, title weights and sketched reach."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from premiere.functions import vectors
from premiere.operators import metrics, point_in_time, preprocess, ranks, running
from premiere.plans import runs


class Model:
    """Stands for a fitted model: saves, or fails on its way."""

    def __init__(self, fails=False):
        self.fails = fails

    def save(self, spark, path):
        if self.fails:
            raise RuntimeError("lost")
        spark.range(1).write.parquet(path)


def rows_of(spark, counts):
    rows = [(f"p{i}-{s}", s) for s, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "product_id string, dataset_split string")


def test_a_failed_run_leaves_the_one_before(spark, tmp_path):
    root, day = str(tmp_path), dt.datetime(2024, 1, 1)
    runs.publish(Model(), rows_of(spark, {"train": 5, "validation": 2, "test": 3}), root, "one", day, "huber")
    with pytest.raises(RuntimeError):
        runs.publish(Model(fails=True), rows_of(spark, {"train": 9}), root, "two", day + dt.timedelta(1), "huber")
    assert runs.latest_run(spark, root).first().run_id == "one"
    assert runs.read_splits(spark, root, "one").count() == 10
    # Run again under its id, it replaces its own partitions and is the latest.
    runs.publish(Model(), rows_of(spark, {"train": 4, "test": 1}), root, "two", day + dt.timedelta(2), "mse")
    last = runs.published_runs(spark, root).filter("run_id = 'two'").first()
    assert (last.train_rows, last.validation_rows, last.test_rows, last.loss) == (4, 0, 1, "mse")
    assert runs.latest_run(spark, root).first().run_id == "two"
    assert {n: runs.read_splits(spark, root, n).count() for n in ("one", "two")} == {"one": 10, "two": 5}


def test_positions_of_one_prefix_and_of_ties(spark):
    df = spark.range(5000).select(F.format_string("brand%06d", F.col("id") * 7 % 5000).alias("value"))
    ranged = ranks.in_ranges(df, ["value"], range_rows=200)
    sizes = [r["count"] for r in ranged.groupBy("__range").count().collect()]
    assert len(sizes) >= 20 and max(sizes) < 600
    got = ranks.ordered_position(df, ["value"], "position", range_rows=200).collect()
    assert sorted((r.value, r.position) for r in got) == [(f"brand{i:06d}", i + 1) for i in range(5000)]
    words = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("",)], "x string")
    assert sorted((r.value, r.id) for r in preprocess.vocabulary(words, "x").collect()) == [("", 1), ("a", 2), ("b", 3)]


def test_auc_over_many_ranges_equals_pairs(spark, monkeypatch):
    monkeypatch.setattr(ranks.in_ranges, "__defaults__", (20,))
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 400), np.round(rng.random(400), 2)
    wins = (s[y == 1][:, None] > s[y == 0]).sum() + (s[y == 1][:, None] == s[y == 0]).sum() / 2
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first()[0] == pytest.approx(wins / ((y == 1).sum() * (y == 0).sum()))


def test_windows_of_a_hot_key_hold_days_only(spark):
    """Ten times the rows of a category: a node of the price tree holds as many days as before."""
    for n in (300, 3000):
        rows = spark.range(n).selectExpr("'category' kind", "'hot' key", "CAST(id % 50 AS INT) day", "CAST(id * 31 % 997 AS DOUBLE) price")
        asked = rows.filter("price < 40")
        got = running.price_standing(rows, rows.select("kind", "key", "day").distinct(), asked).collect()
        known = [(r.day, r.price) for r in rows.collect()]
        for r in got:
            earlier = sorted(p for d, p in known if d < r.day)
            if r.want == "median":
                assert r.median == earlier[(len(earlier) + 1) // 2 - 1]
            else:
                assert r.not_above == sum(p <= r.price for p in earlier)
        assert {r.day for r in got if r.want == "median"} == set(range(1, 50))
        per_node = rows.groupBy("day").count().count()
        assert per_node == 50


def test_title_weights(spark):
    rows = [("a", "Sony camera"), ("b", "sony SONY lens"), ("c", None), ("d", "--")]
    df = spark.createDataFrame(rows, "product_id string, product_name string")
    table = {r.bucket: r for r in vectors.document_frequencies(df, dimensions=16).collect()}
    assert sorted(table) == list(range(16)) and sum(r.titles > 0 for r in table.values()) <= 3
    for r in table.values():
        assert r.weight == pytest.approx(math.log(5 / (1 + r.titles)))
    weights = vectors.document_frequencies(df, dimensions=16)
    made = {r.product_id: r.product_embedding for r in vectors.weighted_title_vectors(df, weights).collect()}
    alone = {r.product_id: r.product_embedding for r in vectors.weighted_title_vectors(df.filter("product_id = 'b'"), weights).collect()}
    assert alone["b"] == made["b"] and np.linalg.norm(made["b"]) == pytest.approx(1.0, abs=1e-5)
    assert not any(made["c"]) and not any(made["d"])


def test_sketched_reach(spark):
    fact = spark.range(20_000).selectExpr(
        "CAST(id % 7001 AS STRING) customer_id", "date_add(DATE'2024-01-01', CAST(id % 40 AS INT)) order_date",
        "IF(id % 3 = 0, 'x', 'y') brand", "IF(id % 5 = 0, 'c', 'd') functional_category",
    )
    asked = spark.createDataFrame(
        [(f"p{i}", b, c, dt.date(2024, 1, 1) + dt.timedelta(d)) for i, (b, c, d) in enumerate(
            [("x", "c", 0), ("x", "c", 5), ("y", "d", 30), ("x", None, 20), (None, "c", 50), ("z", "q", 9), (None, None, 9)])]
        + [("none", "x", "c", None)],
        "product_id string, brand string, functional_category string, launch_date date",
    )
    exact = {r.product_id: r.eligible_customer_count for r in point_in_time.eligible_customers(asked, fact).collect()}
    got = {r.product_id: r.eligible_customer_count for r in point_in_time.eligible_customers_sketched(asked, fact).collect()}
    assert got.keys() == exact.keys()
    for p, n in exact.items():
        assert abs(got[p] - n) <= max(2, 0.05 * n), (p, n, got[p])
