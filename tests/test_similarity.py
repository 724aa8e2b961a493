"""Block search next to brute force: ties, copies, zero and missing vectors."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from premiere.config import DemandConfig
from premiere.functions import vectors
from premiere.operators import analogs, similarity

DAY0 = dt.date(2020, 1, 31)
SCHEMA = """product_id string, launch_date date, product_name string, brand string, functional_category string,
    product_embedding array<float>, m1_qty double, m2_qty double, m3_qty double, qty_90d double,
    customers_90d long, orders_90d long, avg_order_qty_90d double"""


def products(n, prefix, seed, clustered):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    hot = centres[0].astype(np.float32)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = hot  # a third of all rows are copies
        elif clustered:
            v = (centres[rng.integers(6)] + 0.05 * rng.normal(size=8)).astype(np.float32)
        else:
            v = rng.normal(size=8).astype(np.float32)
        v = None if i % 29 == 1 else np.zeros(8, np.float32) if i % 31 == 2 else v
        launch = None if i % 37 == 5 else DAY0 + dt.timedelta(days=int(rng.integers(0, 200)))
        q = float(rng.integers(0, 50))
        rows.append(
            (
                f"{prefix}{i}",
                launch,
                f"name {i}",
                [None, "a", "b"][i % 3],
                ["x", "y"][i % 2],
                None if v is None else [float(x) for x in v],
                q,
                1.0,
                None if i % 23 == 7 else 2.0,
                None if i % 17 == 3 else 3 * q,
                i % 5,
                2,
                q / 2,
            )
        )
    return rows


def plain_similarity(a, b):
    if a is None or b is None:
        return None
    a, b = np.asarray(a, np.float32).astype(float), np.asarray(b, np.float32).astype(float)
    length = np.sqrt(a @ a) * np.sqrt(b @ b)
    return round(float(a @ b / length), 9) + 0.0 if length else 0.0


def plain_best(q, history, k, open_on):
    if q[1] is None:
        return []
    seen = [(plain_similarity(q[5], h[5]), h) for h in history if h[1] and h[8] is not None and open_on(h[1]) <= q[1]]
    seen.sort(key=lambda x: (x[0] is None, -(x[0] or 0.0), x[1][0]))
    return seen[:k]


def next_day(d):
    return d + dt.timedelta(days=1)


@pytest.mark.parametrize(
    "clustered, tasks, grid_rows, same",
    [(False, 1, 100_000, True), (False, 0, 100_000, True), (False, 1, 40, True), (True, 9, 20, True), (True, 9, 20, False)],
)
def test_top_k_equals_brute_force(spark, clustered, tasks, grid_rows, same):
    known = products(260, "h", 1, clustered)
    asked = known if same else products(90, "q", 2, clustered)
    cfg = DemandConfig(search_tasks=tasks, grid_rows=grid_rows)
    ranked = analogs.ranked_analogs(spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(known, SCHEMA), cfg)
    got = {r.product_id: [(a.analog_id, a.similarity) for a in r.analogs] for r in ranked.collect()}
    for q in asked:
        want = [(h[0], s) for s, h in plain_best(q, known, 5, next_day)]
        assert len(got.get(q[0], [])) == len(want), q[0]
        for (gi, gs), (wi, ws) in zip(got.get(q[0], []), want):
            assert gi == wi and (gs == ws or abs(gs - ws) < 2e-9), (q[0], got[q[0]], want)


def test_only_matured_analogs(spark):
    known = products(120, "h", 3, True)
    cfg = DemandConfig(require_matured=True)
    df = spark.createDataFrame(known, SCHEMA)
    dates = {r[0]: r[1] for r in known}
    ranked = analogs.ranked_analogs(df, df, cfg).collect()
    assert ranked
    assert all(a.analog_launch + dt.timedelta(days=89) <= dates[r.product_id] for r in ranked for a in r.analogs)


@pytest.mark.parametrize("tasks", [8, 72])
def test_vectors_are_dealt_once_per_row_or_column(spark, tasks):
    """Dealt vectors grow with N x sqrt(tasks), a cell's sides with N / sqrt(tasks); the plan holds ids only."""
    for n in (300, 3000):
        df = spark.createDataFrame(products(n, "h", 4, True), SCHEMA)
        cfg = DemandConfig(search_tasks=tasks)
        side = similarity.grid_side(n, tasks, cfg.grid_rows)
        assert side == np.ceil(np.sqrt(2 * tasks))
        candidates = similarity._candidates(df, cfg).drop("vector_key").withColumnRenamed("product_id", "id")
        columns = similarity._ranged(candidates, ["id"], "test-candidates", cfg)
        rows = similarity._ranged(similarity.query_points(df).drop("product_id"), ["vector_key"], "test-queries", cfg)
        plan = similarity.search_plan(rows, columns)
        assert plan.columns == ["range", "tile", "tile_part", "part"]
        cells = plan.distinct().count()
        assert cells == plan.count() <= 0.75 * (side + 1) ** 2
        for given, out in zip((rows, columns), similarity.dealt(rows, columns, plan)):
            assert out.count() <= given.count() * (side + 1)
            keys = ["range", "part"]
            assert given.groupBy(keys).count().agg(F.max("count")).first()[0] <= 2 * n / side + 30


def test_no_exchange_carries_packed_vectors(spark):
    df = spark.createDataFrame(products(300, "h", 4, True), SCHEMA)
    found = similarity.similar_launches(df, df, DemandConfig(search_tasks=8))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_grid_side():
    assert similarity.grid_side(0, 1, 10) == 2 and similarity.grid_side(10**6, 8, 16_384) == 62


def test_a_hot_day_is_split(spark):
    rows = spark.range(1000).selectExpr("id", "CAST(IF(id < 900, 7, id % 10) AS INT) day")
    groups = similarity._in_blocks(rows, 50, ["id"]).groupBy("range", "part").count()
    assert groups.agg(F.max("count")).first()[0] < 150 and groups.agg(F.sum("count")).first()[0] == 1000


def test_missing_elements_are_no_shorter_vector(spark):
    df = spark.createDataFrame([("a", [1.0, None, 2.0]), ("b", [1.0, 2.0])], "product_id string, product_embedding array<float>")
    assert df.select(similarity._vector_key("product_embedding")).distinct().count() == 2


def test_analog_features_against_plain_sums(spark):
    known = products(150, "h", 5, False)
    df = spark.createDataFrame(known, SCHEMA)
    ranked = analogs.ranked_analogs(df, df, DemandConfig())
    got = {r.product_id: r for r in analogs.analog_features(ranked, DemandConfig()).collect()}
    checked = 0
    for q in known:
        best = plain_best(q, known, 5, next_day)
        if not best:
            assert q[0] not in got
            continue
        r = got[q[0]]
        real = [s for s, _ in best if s is not None]
        if not real:
            assert r.top1_similarity is None and r.analog_weighted_m1_qty is None and r.analog_demand_dispersion == 0.0
            continue
        w = [(np.exp(10 * s), h) for s, h in best if s is not None]
        total = sum(x for x, _ in w)
        assert r.top1_similarity == pytest.approx(max(real)) and r.top5_mean_similarity == pytest.approx(np.mean(real))
        assert r.analog_weighted_m1_qty == pytest.approx(sum(x * h[6] for x, h in w) / total)
        # A missing outcome is skipped above, but not below the line.
        mean = sum(x * h[9] for x, h in w if h[9] is not None) / total
        square = sum(x * h[9] ** 2 for x, h in w if h[9] is not None) / total
        if any(h[9] is not None for _, h in w):
            assert r.analog_demand_dispersion == pytest.approx(np.sqrt(max(square - mean**2, 0.0)), abs=1e-5)
        brands = [float(q[3] == h[3]) for _, h in best if q[3] is not None and h[3] is not None]
        assert r.top5_same_brand_share == (pytest.approx(np.mean(brands)) if brands else None)
        checked += 1
    assert checked > 100


def test_explanations_are_ranked(spark):
    df = spark.createDataFrame(products(60, "h", 6, True), SCHEMA)
    for r in analogs.similar_products(analogs.ranked_analogs(df, df, DemandConfig())).collect():
        entries = r.top5_similar_products
        assert [e.rank for e in entries] == list(range(1, len(entries) + 1)) and len(entries) <= 5
        assert entries[0].asDict().keys() == {
            "rank", "aid", "aname", "similarity", "ad", "m1_qty", "m2_qty", "m3_qty",
        }


def test_cosine_expression(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0]), ([1.0, 0.0], None)]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    assert [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [0.96, 0.0, None, None]
    assert df.select(vectors.unit(F.col("a"))).first()[0] == pytest.approx([0.6, 0.8])


def test_title_vectors(spark):
    df = spark.createDataFrame([("sony camera",), ("Camera SONY",), (None,)], "product_name string")
    rows = [r.product_embedding for r in vectors.hashed_title_vectors(df, dimensions=32).collect()]
    assert rows[0] == rows[1] and np.linalg.norm(rows[0]) == pytest.approx(1.0)
    assert not any(rows[2]) and len(rows[2]) == 32


def test_own_encoder(spark):
    def make():
        return lambda titles: [[float(len(t)), 1.0] for t in titles]

    df = spark.createDataFrame([("abc",), (None,)], "product_name string")
    assert [r.product_embedding for r in vectors.encoded_title_vectors(df, make).collect()] == [[3.0, 1.0], [0.0, 1.0]]
