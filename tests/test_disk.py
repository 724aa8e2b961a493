"""What large tables write and shuffle: the same rows, with less carried along."""

import datetime as dt

import numpy as np
import pyarrow as pa

from premiere.config import DemandConfig
from premiere.operators import history, kernels, point_in_time, similarity
from premiere.session import materialise
from premiere.sources import adapters, orders

DAY0 = dt.date(2020, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _launches(spark, copies):
    """Eight vectors, each launched on `copies` days, and one product without a vector a day."""
    rng = np.random.default_rng(7)
    vectors = [[float(x) for x in rng.normal(size=4).astype(np.float32)] for _ in range(8)] + [None]
    rows = [
        (f"p{day:03d}{i}", DAY0 + dt.timedelta(days=day), vectors[i], 1.0) for day in range(copies) for i in range(len(vectors))
    ]
    return rows, spark.createDataFrame(rows, "product_id string, launch_date date, product_embedding array<float>, m3_qty double")


def test_a_vector_is_dealt_once_per_range_of_days(spark, monkeypatch):
    """Launches that share a vector travel as days and ids beside it."""
    rows, df = _launches(spark, 60)
    written = {}

    def kept(frame, label, by=None):
        written[label] = materialise(frame, label, by)
        return written[label]

    monkeypatch.setattr(similarity, "materialise", kept)
    found = similarity.similar_launches(df, df, DemandConfig(search_tasks=8)).collect()
    assert written["similarity-points"].count() == len(rows)
    ranges = written["similarity-candidates"].select("range").distinct().count()
    assert ranges > 2
    for side in ("similarity-asked", "similarity-blocks"):
        assert written[side].count() <= 9 * ranges < len(rows) / 4
    # Every point has its five best, of its own vector where five days have gone by.
    assert {(r.vector_key, r.day) for r in found if r.rank == 5} == {(r.vector_key, r.day) for r in found}
    first = min(r.day for r in found) - 1
    late = [r for r in found if r.day - first >= 10 and r.similarity is not None]
    assert late and all(r.similarity > 0.999999 and r.analog_id == f"p{r.rank - 1:03d}{r.analog_id[-1]}" for r in late)


def test_search_cell_answers_whole_groups_or_days():
    """Packed rows give what plain rows give: one list for a group if all candidates are open, else one per day."""
    rng = np.random.default_rng(5)
    asked, offered = rng.normal(size=(6, 4)), rng.normal(size=(30, 4))
    offered[3] = offered[4]

    def vectors(v):
        return pa.array([list(x) for x in v], pa.list_(pa.float32()))

    for from_day in (4, 50):
        q_days = [[from_day + i, from_day + 3 * i + 1] for i in range(6)]
        c_days = [sorted(int(x) for x in rng.integers(0, 20, 8)) for _ in range(30)]
        ids = [[f"c{i}-{j}" for j in range(8)] for i in range(30)]
        queries = pa.table({"group": pa.array(range(6), pa.int64()), "vector": vectors(asked), "days": pa.array(q_days, pa.list_(pa.int32()))})
        blocks = pa.table({"vector": vectors(offered), "days": pa.array(c_days, pa.list_(pa.int32())), "ids": ids})
        got = {}
        for r in kernels.search_cell(3, 9)(queries, blocks).to_pylist():
            for day in [r["day"]] if r["day"] is not None else q_days[r["group"]]:
                got.setdefault((r["group"], day), []).append((r["analog_id"], r["similarity"]))
        points = [(g, d) for g in range(6) for d in q_days[g]]
        plain_q = pa.table({"point": pa.array(range(len(points)), pa.int64()), "day": pa.array([d for _, d in points], pa.int32()),
                            "vector": vectors([asked[g] for g, _ in points])})
        flat = [(i, j) for i in range(30) for j in range(8)]
        plain_c = pa.table({"id": [ids[i][j] for i, j in flat], "day": pa.array([c_days[i][j] for i, j in flat], pa.int32()),
                            "vector": vectors([offered[i] for i, _ in flat])})
        want = {}
        for r in kernels.search(3, 9)(plain_q, plain_c).to_pylist():
            want.setdefault(points[r["point"]], []).append((r["analog_id"], r["similarity"]))
        assert got == want and len(want) > 6


def test_lines_in_buckets_of_products_are_not_shuffled_again(spark):
    lines = spark.range(4000).selectExpr(
        "CAST(id % 50 AS STRING) product_id", "CAST(id AS STRING) order_id", "CAST(id % 300 AS STRING) customer_id",
        "date_add(DATE'2024-01-01', CAST(id % 200 AS INT)) order_date", "CAST(id % 7 AS DOUBLE) quantity",
        "CAST(id % 200 AS TIMESTAMP) order_ts", "'n' product_name", "'b' brand", "'c' functional_category", "CAST(id % 90 AS DOUBLE) unit_price",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = materialise(lines, "lines", by="product_id")
        profile = materialise(history.launch_profile(fact, DemandConfig()), "profile", by="product_id")
        for df in (history.launch_visits(fact, profile).drop("month"), fact.groupBy("product_id").count()):
            df = df.groupBy("product_id").count() if "units" in df.columns else df
            df.collect()
            assert "hashpartitioning(product_id" not in _plan(df).split("Initial Plan")[0], _plan(df)
        by_path = history.product_history(materialise(lines, "plain"), DemandConfig()).collect()
        assert sorted(map(str, by_path)) == sorted(map(str, history.product_history(fact, DemandConfig()).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_dealt_by_customer_once(spark):
    lines = spark.range(600).selectExpr(
        "CAST(id % 37 AS STRING) customer_id", "date_add(DATE'2024-01-01', CAST(id % 23 AS INT)) order_date",
        "CONCAT('b', id % 5) brand", "CONCAT('c', id % 3) functional_category",
    )
    asked = spark.sql("SELECT 'x' product_id, 'b1' brand, 'c1' functional_category, DATE'2024-01-09' launch_date")
    out = point_in_time.eligible_customers(asked, lines)
    assert _plan(out).count("hashpartitioning(customer_id") == 1
    met = lines.filter("(brand = 'b1' OR functional_category = 'c1') AND order_date < DATE'2024-01-09'")
    assert out.first().eligible_customer_count == met.select("customer_id").distinct().count()
    # What several runs look back on is dealt when it is written, and not again.
    first = materialise(point_in_time.first_purchases(lines), "first", by="customer_id")
    again = point_in_time.eligible_customers(asked, None, first)
    assert "hashpartitioning(customer_id" not in _plan(again) and again.collect() == out.collect()


def test_the_lines_of_both_sources_are_not_shuffled_to_meet(spark, folder):
    """Orders and sales lie by order_id when they are united; sales are dealt before ids and names are worked out."""
    both = orders.order_lines("union", adapters.raw_orders(spark, folder), adapters.raw_sales(spark, folder))
    rows = both.count()
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Union")]
    two = [orders.order_lines("sales_order", orders=adapters.raw_orders(spark, folder)), orders.order_lines("sales", sales=adapters.raw_sales(spark, folder))]
    assert rows == two[0].unionByName(two[1]).select(*orders.ORDER_LINE_KEY).distinct().count()
