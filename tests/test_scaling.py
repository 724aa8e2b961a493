"""Steps that were mended for size: same rows as the plain form, with less carried along."""

import datetime as dt
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from premiere.config import DemandConfig
from premiere.functions import text, vectors
from premiere.operators import history, kernels, point_in_time
from premiere.sources import adapters
from premiere.sources.orders import ORDER_LINE_KEY, keep_one


def _depth(plan, word):
    return next((i for i, line in enumerate(plan.splitlines()) if word in line), 10**6)


def test_fact_lines_keep_the_smallest_copy(spark, tmp_path):
    """Copies of lines, orders and parts, NULL flags and customers: the rows of a plain keep_one over the joined lines."""
    day = dt.datetime(2020, 1, 1)
    tables = {
        "lineitem": (
            [(1, 1, 1, 2.0, 10.0, 0.1), (1, 1, 2, 2.0, 10.0, None), (1, 1, 3, 2.0, 10.0, 0.0), (1, 2, 4, 1.0, 3.0, 0.0),
             (2, 1, 1, 4.0, 10.0, 0.5), (2, 9, 2, 4.0, 10.0, 0.5), (7, 1, 1, 1.0, 1.0, 0.0), (None, 1, 1, 1.0, 1.0, 0.0)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double",
        ),
        "orders": (
            [(1, 10, day), (1, 9, day + dt.timedelta(days=1)), (2, 3, day), (2, None, day), (3, 1, day)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp",
        ),
        "part": (
            [(1, "B2", "x  y", "LARGE", 50, 1.0), (1, "B10", "z", None, None, 1.0), (2, None, None, "PROMO", 1, 2.0)],
            "p_partkey long, p_brand string, p_name string, p_type string, p_size int, p_retailprice double",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = adapters.fact_order_lines(spark, str(tmp_path))
    title = text.clean_text(F.col("title"))
    parts = adapters.products(spark, str(tmp_path)).withColumns(
        {"product_name": title, "brand": text.first_word(title), "functional_category": text.title_category(F.col("title"))}
    )
    known = {
        "order_id": F.col("l_orderkey").cast("string"), "customer_id": F.col("o_custkey").cast("string"),
        "order_ts": F.col("o_orderdate"), "order_date": F.to_date("o_orderdate"), "quantity": F.col("l_quantity"),
        "currency": F.lit("USD"), "unit": F.lit("ea"), "promotion_flag": (F.col("l_discount") > 0).cast("int"),
        "promotion_discount": F.lit(0.0), "source": F.lit("sales_order"),
    }
    joined = adapters._flat_lines(spark, str(tmp_path), parts)
    plain = keep_one(joined.select(*[known.get(c, F.col(c)).alias(c) for c in got.columns]), ORDER_LINE_KEY)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert got.count() == 3
    # Whole lines are not grouped once more after the joins.
    optimised = got._jdf.queryExecution().optimizedPlan().toString()
    assert _depth(optimised, "Join") < _depth(optimised, "Aggregate")


def test_first_known_values_with_ties(spark):
    """Spellings at one time go by order id, a missing time is the earliest, unknown names are skipped."""
    t = dt.datetime(2020, 1, 1)
    schema = """product_id string, order_ts timestamp, order_id string, order_date date, product_name string, brand string,
        functional_category string, unit_price double"""
    rows = [
        ("a", t, "2", t.date(), "new", "x", "c", 1.0), ("a", t, "1", t.date(), "old", None, "c", 2.0), ("a", t, "3", None, "abc", "w", "c", 3.0),
        ("b", None, "9", None, "late", "x", "c", 1.0), ("b", t, "1", t.date(), "early", "y", None, None),
        ("c", t, "1", t.date(), None, None, None, None), (None, t, "1", t.date(), "n", "n", "n", 1.0), (None, t, "0", t.date(), "m", "n", "n", 1.0),
    ]
    rows += [("d", t + dt.timedelta(days=i), str(i), t.date(), f"n{i}", "x", "c", 1.0) for i in range(5)]
    fact = spark.createDataFrame(rows, schema)
    plain = fact.groupBy("product_id").agg(
        F.min("order_date").alias("launch_date"),
        *[F.min(F.when(F.col(c).isNotNull(), F.struct("order_ts", "order_id", c)))[c].alias(c) for c in history.FIRST_KNOWN],
    )
    assert sorted(map(str, history.first_known(fact).collect())) == sorted(map(str, plain.collect()))
    prices = {r.product_id: r.launch_price for r in history.launch_profile(fact, DemandConfig()).collect()}
    assert prices == {"a": 2.0, "b": 1.0, "c": None, "d": 1.0, None: 1.0}
    # Without ties no line is compared by its order id.
    alone = history.launch_profile(fact.filter("product_id = 'd'"), DemandConfig())
    assert "struct(order_ts" not in alone._jdf.queryExecution().optimizedPlan().toString()


def test_search_kernel_decides_near_ties_in_double():
    """Candidates closer to each other than single precision can tell, beside thousands of others."""
    rng = np.random.default_rng(3)
    near = np.array([1.0, 0, 0, 0]) + 1e-7 * rng.random((40, 4))
    rows = np.concatenate([rng.normal(size=(5000, 4)), near])
    order = rng.permutation(len(rows))
    rows = rows[order]
    asked = np.array([[1.0, 0, 0, 0], [0, 1.0, 0, 0]])
    days = rng.integers(0, 50, len(rows))

    def arrow(v):
        return pa.array([list(x) for x in v], pa.list_(pa.float64()))

    queries = pa.table({"point": pa.array([7, 8], pa.int64()), "day": pa.array([60, 25], pa.int32()), "vector": arrow(asked)})
    names = [f"p{i}" for i in range(len(rows))]
    found = kernels.search(5, 9)(queries, pa.table({"id": names, "day": pa.array(days, pa.int32()), "vector": arrow(rows)}))
    assert found.schema.names == ["point", "analog_id", "similarity"]
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    for point, day, v in ((7, 60, asked[0]), (8, 25, asked[1])):
        s = np.round(unit @ v, 9)
        want = sorted((-s[i], names[i]) for i in range(len(rows)) if days[i] <= day)[:5]
        got = [(-r["similarity"], r["analog_id"]) for r in found.to_pylist() if r["point"] == point]
        assert [g[1] for g in got] == [w[1] for w in want]


def test_grid_of_many_products_is_small():
    """A hundred thousand products on both sides take no more cells than asked for (57,600 with ranges of 500 rows)."""
    from premiere import queries
    from premiere.operators import similarity

    for cfg in (queries.SIMILARITY, queries.DEMAND):
        assert similarity.grid_side(120_000, 200, cfg.grid_rows) == similarity.grid_side(1_200_000, 200, cfg.grid_rows) == 20


def test_weighted_title_vectors_are_computed_once(spark):
    """Length one or none, as by hand; a title's words are hashed once, not once per dimension and element."""
    titles = spark.createDataFrame([("a", "red red fox"), ("b", "blue fox"), ("c", None)], "product_id string, product_name string")
    weights = vectors.document_frequencies(titles, dimensions=16)
    got = vectors.weighted_title_vectors(titles, weights)
    known = {r.bucket: r.weight for r in weights.collect()}
    held = titles.select("product_id", vectors.word_buckets(F.col("product_name"), 16).alias("b")).collect()
    for r in held:
        plain = np.array([known[i] * r.b.count(i) for i in range(16)])
        length = np.sqrt((plain**2).sum()) or 1.0
        found = got.filter(F.col("product_id") == r.product_id).first().product_embedding
        np.testing.assert_allclose(found, plain / length, atol=1e-6)
    # The digest of the words stands outside the loops over dimensions.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1, plan


def test_stages_of_the_session_outlive_a_batch(spark):
    """A stage or model first asked for inside a stream's batch is still there after it; the batch's own stages are not."""
    from premiere import queries
    from premiere.session import materialise, scratch_scope

    rows = spark.range(3)
    with scratch_scope(spark):
        own = materialise(rows, "own")
        stage = queries._stage(spark, "batch-test", "kept", lambda: materialise(rows, "inner"))
        model = queries._fitted(spark, "batch-test", "model", lambda: materialise(rows, "model"))
        assert own.count() == 3
        path = own.inputFiles()[0]
    assert stage.count() == model.count() == 3
    assert queries._stage(spark, "batch-test", "kept", lambda: None).count() == 3
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _reach(spark):
    """Lines and launches of few customers, brands and categories, some of them unknown."""
    lines = spark.range(600).selectExpr(
        "IF(id % 41 = 0, NULL, CAST(id % 37 AS STRING)) customer_id", "date_add(DATE'2024-01-01', CAST(id % 23 AS INT)) order_date",
        "IF(id % 11 = 0, NULL, CONCAT('b', id % 5)) brand", "IF(id % 13 = 0, NULL, CONCAT('c', id % 3)) functional_category",
    )
    asked = spark.range(60).selectExpr(
        "CAST(id AS STRING) product_id", "IF(id % 7 = 0, NULL, CONCAT('b', id % 6)) brand", "IF(id % 9 = 0, NULL, CONCAT('c', id % 4)) functional_category",
        "IF(id = 5, NULL, date_add(DATE'2024-01-01', CAST(id % 20 AS INT))) launch_date",
    )
    want = {}
    sold = [r for r in lines.collect() if r.customer_id]
    for q in asked.collect():
        met = {r.customer_id for r in sold if q.launch_date and r.order_date < q.launch_date and (
            (q.brand and r.brand == q.brand) or (q.functional_category and r.functional_category == q.functional_category))}
        want[q.product_id] = len(met)
    return lines, asked, want


def test_customers_are_dealt_once(spark):
    """Brands and categories of a customer meet where the customer lies: no shuffle by customer and key."""
    lines, asked, want = _reach(spark)
    out = point_in_time.eligible_customers(asked, lines)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id" in plan
    assert not re.search(r"hashpartitioning\(customer_id#\d+, (brand|functional_category)", plan)
    assert {r.product_id: r.eligible_customer_count for r in out.collect()} == want


def test_products_carry_no_sketches(spark):
    """Sketches are estimated once per brand, category and day; products meet numbers."""
    lines, asked, want = _reach(spark)
    out = point_in_time.eligible_customers_sketched(asked, lines)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    estimates = [line for line in plan if "hll_sketch_estimate" in line]
    assert estimates and not any("product_id" in line for line in estimates)
    assert {r.product_id: r.eligible_customer_count for r in out.collect()} == want
