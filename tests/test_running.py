"""Point-in-time operators next to brute force on awkward small data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from premiere.config import DemandConfig
from premiere.operators import history, point_in_time, running

DAY0 = dt.date(2020, 1, 1)
HISTORY = """product_id string, launch_date date, brand string, functional_category string, launch_price double,
    m3_qty double, qty_90d double"""
FACT = """order_id string, customer_id string, order_ts timestamp, order_date date, product_id string,
    product_name string, brand string, functional_category string, unit_price double, quantity double"""


def day(n):
    return DAY0 + dt.timedelta(days=n)


def launches(seed, n=160, prefix="h"):
    """A third of all rows share one brand, category, price and day."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((f"{prefix}{i}", day(40), "hot", "camera", 9.99, 1.0, float(i % 7)))
            continue
        rows.append(
            (
                f"{prefix}{i}",
                rng.choice([None, *map(day, range(0, 60, 3))]),
                rng.choice([None, "", "a", "b", "hot"]),
                rng.choice([None, "camera", "speaker"]),
                rng.choice([None, 0.5, 9.99, round(rng.uniform(1, 50), 2)]),
                rng.choice([None, 0.0, 2.0]),
                rng.choice([None, 1.0, 5.0]),
            )
        )
    return rows


def sold(seed, n=400):
    rng = random.Random(seed)
    return [
        (
            f"o{i}",
            rng.choice([None, "guest", "guest", *[f"c{j}" for j in range(12)]]),
            None,
            rng.choice([None, *[day(d) for d in range(-370, 60, 5)]]),
            f"p{rng.randrange(9)}",
            "x",
            rng.choice([None, "", "a", "b", "hot"]),
            rng.choice([None, "camera", "speaker"]),
            1.0,
            float(rng.randrange(1, 6)),
        )
        for i in range(n)
    ]


def plain_stats(q, earlier):
    """The left join of one query with every earlier launch, spelled out."""
    same = lambda c: [h for h in earlier if q[c] is not None and h[c] == q[c]]
    brand, category = same(2), same(3)

    def mean(rows):
        known = [h[6] for h in rows if h[6] is not None]
        return sum(known) / len(known) if known else None

    def ratio(rows):
        prices = sorted(h[4] for h in rows if h[4] is not None)
        median = prices[(len(prices) + 1) // 2 - 1] if prices else None
        return None if q[4] is None else q[4] / max(median or 1.0, 1.0)

    cheaper = [h for h in category if q[4] is not None and h[4] is not None and h[4] <= q[4]]
    return (
        ratio(category),
        ratio(brand),
        len(cheaper) / len(earlier) if earlier else 0.0,
        len(brand),
        mean(brand),
        len(category),
        mean(category),
    )


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 1e-9)


@pytest.mark.parametrize("queries, fan", [("h", 32), ("h", 2), ("q", 3)])
def test_earlier_launches(spark, monkeypatch, queries, fan):
    monkeypatch.setattr(running, "FAN", fan)  # few ranges a node: many levels
    known = launches(1)
    asked = known if queries == "h" else launches(2, 60, "q")
    out = point_in_time.earlier_launch_stats(spark.createDataFrame(asked, HISTORY), spark.createDataFrame(known, HISTORY))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    got = {r.product_id: tuple(r)[1:] for r in out.collect()}
    assert len(got) == len(asked)
    for q in asked:
        earlier = [h for h in known if h[1] and q[1] and h[1] < q[1] and h[5] is not None]
        assert all(map(close, got[q[0]], plain_stats(q, earlier))), (q, got[q[0]], plain_stats(q, earlier))


def test_category_demand_borders(spark):
    def line(n, category="camera", quantity=1.0):
        return (f"o{n}", "c", None, day(n), "p", "x", "a", category, 1.0, quantity)

    fact = spark.createDataFrame(
        [line(-366, quantity=64.0), line(-365, quantity=1.0), line(-91, quantity=2.0), line(-90, quantity=4.0),
         line(-1, quantity=8.0), line(0, quantity=16.0), line(-1, "speaker", 32.0)],
        FACT,
    )
    asked = [("a", day(0), "a", "camera", 1.0, 1.0, 1.0), ("b", day(0), "a", None, 1.0, 1.0, 1.0),
             ("c", None, "a", "camera", 1.0, 1.0, 1.0), ("d", day(-366), "a", "camera", 1.0, 1.0, 1.0)]
    out = point_in_time.category_demand(spark.createDataFrame(asked, HISTORY), fact, DemandConfig())
    got = {r.product_id: tuple(r)[1:] for r in out.collect()}
    # Total 15, same calendar month (January): the order 365 days before.
    assert got["a"] == (12.0, 13.0 / 4.0, 1.0 / 1.25)
    assert got["b"] == got["c"] == got["d"] == (0.0, 1.0, 0.0)


def test_category_demand_against_plain_sums(spark):
    lines, asked = sold(5), launches(3, 50)
    out = point_in_time.category_demand(
        spark.createDataFrame(asked, HISTORY), spark.createDataFrame(lines, FACT), DemandConfig()
    )
    got = {r.product_id: tuple(r)[1:] for r in out.collect()}
    for q in asked:
        ago = [
            ((q[1] - f[3]).days, f) for f in lines if q[1] and f[3] and q[3] is not None and f[7] == q[3]
        ]
        recent = sum(f[9] for n, f in ago if 1 <= n <= 90)
        prev = sum(f[9] for n, f in ago if 91 <= n <= 365)
        same = sum(f[9] for n, f in ago if 1 <= n <= 365 and f[3].month == q[1].month)
        want = (recent, (recent + 1) / (prev + 1), same / max((recent + prev) / 12, 1.0))
        assert all(map(close, got[q[0]], want))


def test_eligible_customers_against_plain_sets(spark):
    lines, asked = sold(7), launches(4, 60)
    out = point_in_time.eligible_customers(spark.createDataFrame(asked, HISTORY), spark.createDataFrame(lines, FACT))
    got = {r.product_id: r.eligible_customer_count for r in out.collect()}
    for q in asked:
        want = {
            f[1]
            for f in lines
            if f[1] and f[3] and q[1] and f[3] < q[1]
            and ((q[2] is not None and f[6] == q[2]) or (q[3] is not None and f[7] == q[3]))
        }
        assert got[q[0]] == len(want)


def test_later_orders_change_nothing(spark):
    """What happens on or after the launch must not reach the point-in-time features."""
    known = [r for r in launches(8, 60) if r[1]]
    lines = [f for f in sold(9) if f[3]]
    cut = day(30)
    asked = spark.createDataFrame([r for r in known if r[1] <= cut], HISTORY)
    cfg = DemandConfig()

    def features(rows, facts):
        out = point_in_time.point_in_time_features(
            asked, spark.createDataFrame(rows, HISTORY), spark.createDataFrame(facts, FACT), cfg
        )
        return sorted(map(tuple, out.collect()))

    before = features([r for r in known if r[1] < cut], [f for f in lines if f[3] < cut])
    assert before == features(known, lines)


def test_no_ask_sees_its_own_day(spark):
    rows = spark.createDataFrame([("k", 1, 1.0), ("k", 1, 2.0), ("k", 3, 4.0)], "key string, day int, v double")
    points = spark.createDataFrame([("k", 1), ("k", 2), ("k", 3), ("k", 9), ("z", 9)], "key string, day int")
    out = running.totals_before(rows, points, ["key"], ["v"])
    assert {(r.key, r.day): r.v for r in out.collect()} == {
        ("k", 1): None, ("k", 2): 3.0, ("k", 3): 3.0, ("k", 9): 7.0, ("z", 9): None,
    }


def test_launch_history(spark):
    def line(order, customer, product, date, quantity, price=1.0, name="a b"):
        return (order, customer, None, date, product, name, "a", "other", price, quantity)

    jan31 = dt.date(2023, 1, 31)
    lines = [
        line("o1", "c1", "m", jan31, 1.0, 3.0, None),
        line("o2", "c1", "m", dt.date(2023, 2, 28), 2.0, 1.0, "first known"),
        line("o2", None, "m", dt.date(2023, 2, 28), 2.0, 2.0, "second known"),
        line("o3", "c2", "m", dt.date(2023, 4, 30), 4.0, 9.0),
        line("o4", "c3", "m", dt.date(2023, 4, 29), 8.0, 9.0),
        line("o5", "c1", "one", dt.date(2023, 5, 1), 5.0),
        line("o6", "c1", "undated", None, 5.0),
    ]
    out = {r.product_id: r for r in history.product_history(spark.createDataFrame(lines, FACT), DemandConfig()).collect()}
    m = out["m"]
    assert (m.launch_date, m.product_name, m.launch_price) == (jan31, "first known", 3.0)
    # 28 February ends month one, 30 April ends month three.
    assert (m.m1_qty, m.m2_qty, m.m3_qty, m.qty_90d) == (1.0, 4.0, 8.0, 13.0)
    assert (m.customers_90d, m.orders_90d, m.avg_order_qty_90d) == (2, 3, 13.0 / 3)
    assert (out["one"].m1_qty, out["one"].m2_qty, out["one"].m3_qty) == (5.0, 0.0, 0.0)
    assert out["undated"].launch_date is None and out["undated"].m3_qty is None
    assert out["undated"].launch_price == 1.0
