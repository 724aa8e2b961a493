import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premiere import schemas
from premiere.functions import dates, text
from premiere.sources import adapters, orders, tables


def item(id="p1", name="Sony Camera", price="10", qty="2", **more):
    return {"id": id, "name": name, "price": price, "qty": qty, "curr": "USD", "unit": "ea", **more}


def raw(spark, rows):
    return spark.createDataFrame(
        rows,
        "order_number string, customer_id string, order_datetime string, number_of_line_items int, ordered_products string",
    )


def test_broken_or_empty_products_drop_the_order(spark):
    rows = [
        ("null", "c", "0", 1, None),
        ("empty", "c", "0", 0, "[]"),
        ("broken", "c", "0", 1, '[{"id": "p1", "na'),
        ("single", "c", "0", 1, json.dumps(item(price=10, qty=2))),
        ("list", "c", "0", 1, json.dumps([item(promotion_info={"code": "x"})])),
    ]
    out = {r.order_id: r for r in orders.lines_from_orders(raw(spark, rows)).collect()}
    assert set(out) == {"single", "list"}
    assert (out["single"].unit_price, out["single"].quantity) == (10.0, 2.0)
    assert (out["single"].promotion_flag, out["list"].promotion_flag) == (0, 1)
    assert out["list"].brand == "sony" and out["list"].functional_category == "camera"


def test_latest_version_wins_then_more_items(spark):
    rows = [
        ("a", "c", "100", 3, json.dumps([item(qty="1")])),
        ("a", "c", "200", 1, json.dumps([item(qty="9")])),
        ("b", "c", "100", 1, json.dumps([item(qty="1")])),
        ("b", "c", "100", 2, json.dumps([item(qty="5"), item(id="p2")])),
        ("d", "c", None, 9, json.dumps([item(qty="1")])),
        ("d", "c", "1", 1, json.dumps([item(qty="7")])),
        (None, "c", "1", 1, json.dumps([item(qty="1")])),
        (None, "c", "2", 1, json.dumps([item(qty="3")])),
    ]
    out = orders.lines_from_orders(raw(spark, rows)).collect()
    assert sorted((r.order_id or "", r.product_id, r.quantity) for r in out) == [
        ("", "p1", 3.0),
        ("a", "p1", 9.0),
        ("b", "p1", 5.0),
        ("b", "p2", 2.0),
        ("d", "p1", 7.0),
    ]


def test_only_positive_quantities_of_known_products(spark):
    items = [item(qty="0"), item(qty="-1"), item(qty=None), item(qty="x"), item(id=None), item(id="ok")]
    out = orders.lines_from_orders(raw(spark, [("a", "c", "1", 6, json.dumps(items))])).collect()
    assert [r.product_id for r in out] == ["ok"]


def test_copies_of_a_line_collapse_to_the_same_row_in_any_order(spark):
    items = [item(unit="ea"), item(unit="box"), item(qty="3")]
    for given in (items, items[::-1]):
        out = orders.lines_from_orders(raw(spark, [("a", "c", "1", 3, json.dumps(given))])).collect()
        assert sorted((r.quantity, r.unit) for r in out) == [(2.0, "box"), (3.0, "ea")]


def test_of_copies_the_smallest_clean_name_then_category_stays(spark):
    # As given, " Zeta" is the smallest name; cleaned, "alpha" is. A tab keeps "memory card" out of its category.
    items = [item(name=" Zeta"), item(name="Alpha"), item(id="p2", name="Memory Card X"), item(id="p2", name="memory\tcard x")]
    for given in (items, items[::-1]):
        out = orders.lines_from_orders(raw(spark, [("a", "c", "1", 4, json.dumps(given))])).collect()
        got = sorted((r.product_id, r.product_name, r.brand, r.functional_category) for r in out)
        assert got == [("p1", "alpha", "alpha", "other"), ("p2", "memory card x", "memory", "other")]


def test_json_is_parsed_once_per_sales_row(spark):
    sales = spark.range(3).selectExpr(
        "string(id) AS customer_id", "'2024-01-05' AS order_date",
        "to_json(named_struct('id', string(id), 'qty', '2')) AS product", "'JBL' AS product_name", "'Audio' AS product_category",
    )
    out = orders.lines_from_sales(sales)
    assert out.count() == 3
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_the_union_sorts_its_lines_after_the_shuffle_only(spark, folder):
    both = orders.order_lines("union", adapters.raw_orders(spark, folder), adapters.raw_sales(spark, folder))
    plan = both._jdf.queryExecution().sparkPlan().toString()
    union = plan[: plan.index("Union")]
    assert "REPARTITION_BY_COL" in union and "SortAggregate" not in union[union.index("REPARTITION_BY_COL") :]


def test_order_times(spark):
    given = ["86400", "1970-01-03 01:02:03", "", "never", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    out = [r.t for r in df.select("i", dates.order_time(F.col("v")).alias("t")).orderBy("i").collect()]
    assert out == [dt.datetime(1970, 1, 2), dt.datetime(1970, 1, 3, 1, 2, 3), None, None, None]


def test_sales_rows(spark):
    rows = [
        ("c1", "2024-01-05", json.dumps(item(name="ignored", price=3, qty="4")), " JBL  Speaker ", "Audio"),
        ("c1", "2024-01-05", json.dumps(item(name="again")), "JBL Speaker", "Audio"),
        (None, "2024-01-05", json.dumps(item()), "JBL Speaker", None),
        ("c2", "no date", json.dumps(item()), None, "Audio"),
        ("c3", "2024-01-05", "broken", "x", "y"),
    ]
    sales = spark.createDataFrame(
        rows, "customer_id string, order_date string, product string, product_name string, product_category string"
    )
    out = {r.customer_id: r for r in orders.lines_from_sales(sales).collect()}
    assert set(out) == {"c1", None, "c2"}
    assert out["c1"].product_name == "jbl speaker" and out["c1"].brand == "audio"
    assert out["c2"].order_date is None and out["c2"].product_name == "" and out["c2"].functional_category == "other"
    assert out[None].brand == ""
    assert len({r.order_id for r in out.values()}) == 3 and all(len(r.order_id) == 64 for r in out.values())


def test_unknown_source_mode():
    with pytest.raises(ValueError):
        orders.order_lines("files")


def test_star_schema_shortcut_equals_the_nested_path(spark, folder):
    nested = orders.lines_from_orders(adapters.raw_orders(spark, folder))
    flat = adapters.fact_order_lines(spark, folder).select(nested.columns)
    assert nested.exceptAll(flat).count() == 0 and flat.exceptAll(nested).count() == 0


@pytest.mark.parametrize(
    "title, clean, brand, category, accessory, refurbished",
    [
        (None, "", "", "other", 0, 0),
        ("", "", "", "other", 0, 0),
        (" \tSony   ZV-1\nCAMERA ", "sony zv-1 camera", "sony", "camera", 0, 0),
        ("Football", "football", "football", "storage_memory", 0, 0),
        ("Camera bag", "camera bag", "camera", "camera", 1, 0),
        ("Logi mouse (Renewed)", "logi mouse (renewed)", "logi", "accessory", 1, 1),
        ("Refurbished gaming laptop", "refurbished gaming laptop", "refurbished", "computer", 0, 1),
        ("7.2 Channel AV Receiver", "7.2 channel av receiver", "7.2", "receiver_amplifier", 0, 0),
        ("Soundbar with subwoofer", "soundbar with subwoofer", "soundbar", "speaker", 0, 0),
    ],
)
def test_titles(spark, title, clean, brand, category, accessory, refurbished):
    df = spark.createDataFrame([(title,)], "t string").withColumn("c", text.clean_text(F.col("t")))
    kind = text.title_category(F.col("t"))
    row = df.select(
        "c",
        text.first_word(F.col("c")),
        kind,
        text.accessory_flag(F.col("c"), kind),
        text.refurbished_flag(F.col("c")),
    ).first()
    assert tuple(row) == (clean, brand, category, accessory, refurbished)


def test_padded_ids_keep_long_numbers(spark):
    df = spark.createDataFrame([(42,), (123456,)], "i long")
    assert [r[0] for r in df.select(text.padded_id("TXN", F.col("i"))).collect()] == ["TXN00042", "TXN123456"]


def spark_month_index(order, launch):
    """Whole months when days match or both are month ends, else a 31st per day; first month is 1."""
    last = lambda d: (d + dt.timedelta(days=1)).month != d.month
    months = (order.year - launch.year) * 12 + order.month - launch.month
    if order.day == launch.day or (last(order) and last(launch)):
        return months + 1
    return int((round(months + (order.day - launch.day) / 31, 8)) // 1) + 1


def test_launch_months(spark):
    launches = [dt.date(2023, 1, 31), dt.date(2024, 1, 30), dt.date(2023, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 11, 15)]
    pairs = [(l, l + dt.timedelta(days=n)) for l in launches for n in range(0, 130)]
    df = spark.createDataFrame(pairs, "l date, o date").withColumn("m", dates.launch_month(F.col("o"), F.col("l")))
    rows = df.collect()
    assert all(r.m == spark_month_index(r.o, r.l) for r in rows)
    for launch in launches:
        months = [r.m for r in sorted(rows, key=lambda r: r.o) if r.l == launch]
        assert months == sorted(months)


def test_records_with_iso_dates(spark):
    record = {
        "product_id": "NEW_SKU_001",
        "product_name": "Zamaha 7.2 Channel Wireless 4K AV Receiver Black",
        "brand": "Zamaha",
        "launch_price": 599.0,
        "launch_date": "2026-09-01",
    }
    other = dict(record, product_id="x", brand=None, launch_date=dt.date(2026, 9, 2))
    out = tables.table_from_records(spark, [record, other], schemas.NEW_PRODUCTS).collect()
    assert [r.launch_date for r in out] == [dt.date(2026, 9, 1), dt.date(2026, 9, 2)]
    assert out[1].brand is None


def test_catalog_tables(spark, tmp_path):
    tables.ensure_database(spark, "premiere_test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    tables.overwrite_table(df, "premiere_test.kept", bucket_by=(4, "id"))
    tables.overwrite_table(df.filter("id = 1"), "premiere_test.kept", bucket_by=(4, "id"))
    assert tables.read_table(spark, "premiere_test.kept").count() == 1
    path = str(tmp_path / "log")
    tables.append_table(df, path)
    tables.append_table(df.withColumn("w", F.lit(2.5)), path)
    grown = tables.read_evolving(spark, path)
    assert grown.columns == ["id", "v", "w"] and grown.filter("w is null").count() == 2
    spark.sql("DROP TABLE premiere_test.kept")
    spark.sql("DROP DATABASE premiere_test")


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("t1", 1.5, 3)], "id string, amount double, hour int")
    tables.write_csv(df, path)
    assert tables.read_csv(spark, path).dtypes == df.dtypes
    declared = T.StructType.fromDDL("id string, amount double, hour double")
    assert tables.read_csv(spark, path, declared).first().hour == 3.0


def test_broken_numbers_and_epochs_become_null(spark):
    numbers = (("NaN", "1"), ("Infinity", "1"), ("2", "NaN"), ("3", "4"))
    items = json.dumps([item(qty=q, price=p) for q, p in numbers])
    rows = orders.lines_from_orders(raw(spark, [("1", "c", "99999999999999", 4, items)])).collect()
    assert sorted((r.quantity, r.unit_price) for r in rows if r.unit_price) == [(3.0, 4.0)]
    assert {r.quantity for r in rows} == {2.0, 3.0} and {r.order_ts for r in rows} == {None}


def test_copies_inside_an_order_and_after_the_union(spark):
    one = item(price="2")
    items = json.dumps([one | {"unit": "z"}, one, item(price="3"), item(price=None), item(price=None)])
    lines = orders.lines_from_orders(raw(spark, [("1", "c", "2024-01-01", 5, items)]))
    assert sorted(((r.unit_price or 0), r.unit) for r in lines.collect()) == [(0, "ea"), (2.0, "ea"), (3.0, "ea")]
    plan = lines._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert orders.keep_one(lines.unionByName(lines), orders.ORDER_LINE_KEY).count() == 3


def test_catalog_append_gains_a_column(spark):
    name = "appended_log"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    tables.append_table(df.drop("y"), name)
    tables.append_table(df, name)
    tables.append_table(df.select("y"), name)
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == sorted([(1, None), (1, "a"), (None, "a")], key=str)
    spark.sql(f"DROP TABLE {name}")
