"""The star-schema tables seen as the raw tables the jobs expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from premiere.functions import risk, text

# The noun each part type contributes to a product title.
TYPE_NOUNS = {
    "ECONOMY": "Charger",
    "PROMO": "Speaker",
    "LARGE": "Receiver",
    "STANDARD": "Camera",
    "SMALL": "Memory Card",
    "MEDIUM": "Laptop",
}
RENEWED_ABOVE_SIZE = 45


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _noun(part_type: Column) -> Column:
    pairs = [F.lit(x) for pair in TYPE_NOUNS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), part_type)


def products(spark: SparkSession, folder: str) -> DataFrame:
    """product_id, raw title, part brand and list price of every part."""
    title = F.concat_ws(
        " ",
        "p_brand",
        "p_name",
        _noun(F.col("p_type")),
        F.when(F.col("p_size") > RENEWED_ABOVE_SIZE, "Renewed"),
    )
    return table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("product_id"),
        title.alias("title"),
        "p_brand",
        F.col("p_retailprice").alias("list_price"),
    )


def _flat_lines(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
    )


def fact_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines straight from the star schema, without the detour through JSON.

    One row per key, the smallest in its other columns, as `keep_one` picks it: orders and parts are reduced to
    their smallest row before they meet the lines, and copies of a line fall where the orders are joined, so
    lines travel twice, as numbers; the second time by product, and so they stay. Title expressions run once per part, before the join, not once per line.
    """
    title = text.clean_text(F.col("title"))
    parts = products(spark, folder).select(
        "product_id",
        F.struct(
            title.alias("product_name"),
            text.first_word(title).alias("brand"),
            text.title_category(F.col("title")).alias("functional_category"),
        ).alias("part"),
    )
    parts = parts.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.min("part").alias("part"))
    head = F.struct(F.col("o_custkey").cast("string").alias("customer_id"), F.col("o_orderdate").alias("at"))
    heads = table(spark, folder, "orders").groupBy(F.col("o_orderkey").alias("l_orderkey"))
    heads = heads.agg(F.min(head).alias("head")).select("l_orderkey", "head.*")
    # A NULL flag is the smallest, as in a struct.
    flag = F.coalesce((F.col("l_discount") > 0).cast("int"), F.lit(-1))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", flag.alias("flag")
    )
    sold = (
        lines.join(heads, "l_orderkey")
        .groupBy(
            "l_orderkey", "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            "l_quantity", "customer_id", "at",
        )
        .agg(F.min("flag").alias("flag"))
    )
    sold = sold.withColumn("product_id", F.col("l_partkey").cast("string")).repartition("product_id")
    return sold.join(parts, "product_id").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        "customer_id",
        F.col("at").cast("timestamp").alias("order_ts"),
        F.to_date("at").alias("order_date"),
        "product_id",
        "part.product_name",
        "part.brand",
        "part.functional_category",
        "unit_price",
        F.col("l_quantity").alias("quantity"),
        F.lit("USD").alias("currency"),
        F.lit("ea").alias("unit"),
        F.nullif("flag", F.lit(-1)).alias("promotion_flag"),
        F.lit(0.0).alias("promotion_discount"),
        F.lit("sales_order").alias("source"),
    )


def _payload(line: Column) -> Column:
    discount = line["l_discount"]
    return F.struct(
        line["product_id"].alias("id"),
        F.lit("USD").alias("curr"),
        line["title"].alias("name"),
        line["unit_price"].alias("price"),
        line["l_quantity"].alias("qty"),
        F.lit("ea").alias("unit"),
        F.when(discount > 0, F.create_map(F.lit("discount"), discount.cast("string"))).alias("promotion_info"),
    )


def _line() -> Column:
    return F.struct("l_linenumber", "product_id", "title", "unit_price", "l_quantity", "l_discount")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Nested orders: epoch text for even keys, ISO text for odd ones.

    Every fifth order also comes in an older version with doubled quantities, and every
    seventh order carries a line of quantity zero; neither may survive the parse.
    """
    key = F.col("l_orderkey")
    parts, lines = products(spark, folder), table(spark, folder, "lineitem")
    lines = lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # JSON documents are one per order, so the list is one order's lines. The parts come first: where lines meet
    # their orders they are grouped.
    nested = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_orderkey", "o_custkey", "o_orderdate")
        .agg(F.sort_array(F.collect_list(_line())).alias("lines"))
        .withColumn("items", F.transform("lines", _payload))
    )
    dud = F.transform(F.slice("items", 1, 1), lambda x: x.withField("qty", F.lit(0.0)))
    doubled = F.transform("items", lambda x: x.withField("qty", x["qty"] * 2))
    now = F.col("o_orderdate").cast("timestamp")
    versions = F.when(
        key % 5 == 0,
        F.array(
            F.struct(now.alias("at"), F.col("items").alias("items")),
            F.struct((now - F.expr("INTERVAL 1 DAY")).alias("at"), doubled.alias("items")),
        ),
    ).otherwise(F.array(F.struct(now.alias("at"), F.col("items").alias("items"))))
    return (
        nested.withColumn("items", F.when(key % 7 == 0, F.concat("items", dud)).otherwise(F.col("items")))
        .select("l_orderkey", "o_custkey", F.explode(versions).alias("v"))
        .select(
            key.alias("order_number"),
            F.col("o_custkey").alias("customer_id"),
            F.when(key % 2 == 0, F.unix_timestamp("v.at").cast("string"))
            .otherwise(F.date_format("v.at", "yyyy-MM-dd HH:mm:ss"))
            .alias("order_datetime"),
            F.size("v.items").alias("number_of_line_items"),
            F.to_json("v.items").alias("ordered_products"),
        )
    )


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON product per row."""
    return _flat_lines(spark, folder, products(spark, folder)).select(
        F.col("o_custkey").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.to_json(_payload(_line())).alias("product"),
        F.col("title").alias("product_name"),
        F.col("p_brand").alias("product_category"),
    )


def product_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """product_id and embedding of every part; parts share the vectors in turn."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("product_embedding"))
    size = vectors.agg(F.count(F.lit(1))).scalar()
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), (F.col("p_partkey") % size).alias("vec_id")
    )
    return parts.join(vectors, "vec_id").select("product_id", "product_embedding")


def new_products(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as an announced product: title, list price, launch on its first order date.

    Only every second part names its brand; the others leave it to the title.
    """
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    first = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy("l_partkey")
        .agg(F.to_date(F.min("o_orderdate")).alias("launch_date"))
    )
    return (
        products(spark, folder)
        .join(first, F.col("p_partkey") == F.col("l_partkey"))
        .select(
            "product_id",
            F.col("title").alias("product_name"),
            F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("brand"),
            F.col("list_price").alias("launch_price"),
            "launch_date",
        )
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as card transactions with the user's earlier count and mean amount.

    Running values come from day totals plus a window inside the user's day, so no window
    spans a busy user's whole history. Sums and means are in whole cents.
    """
    events = (
        table(spark, folder, "events")
        .select("event_id", "ts", "user_id", "event_type", "value", "props")
        .withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
        .withColumn("day", F.to_date("ts"))
    )
    before_day = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    in_day = (
        Window.partitionBy("user_id", "day")
        .orderBy("ts", "event_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    days = (
        events.groupBy("user_id", "day")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("s"))
        .select(
            "user_id",
            "day",
            F.coalesce(F.sum("n").over(before_day), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("s").over(before_day), F.lit(0)).alias("s_before"),
        )
    )
    running = (
        events.withColumn("n_day", F.count(F.lit(1)).over(in_day))
        .withColumn("s_day", F.coalesce(F.sum("cents").over(in_day), F.lit(0)))
        .join(days, ["user_id", "day"])
        .withColumn("previous", (F.col("n_before") + F.col("n_day")).cast("int"))
        .withColumn("spent", F.col("s_before") + F.col("s_day"))
    )
    hour = F.hour("ts")
    average = F.coalesce(F.floor(F.try_divide("spent", "previous")) / F.lit(100.0), F.lit(0.0))
    slot = F.get_json_object("props", "$.k").cast("int") % (len(risk.MERCHANT_CODES) + 1)
    merchants = F.array(*[F.lit(m) for m in (*risk.MERCHANT_CODES, "kiosk")])
    rows = running.select(
        text.padded_id("TXN", F.col("event_id")).alias("transaction_id"),
        F.col("value").alias("amount"),
        hour.alias("hour"),
        F.weekday("ts").alias("day_of_week"),
        F.get(merchants, slot).alias("merchant_type"),
        (F.lit(18) + F.col("user_id") % 63).cast("int").alias("customer_age"),
        F.col("previous").alias("num_prev_txns"),
        average.alias("avg_txn_amount"),
        "event_type",
    )
    big = F.col("amount") > 3 * F.col("avg_txn_amount")
    failed_at_night = (F.col("event_type") == "error") & (risk.is_night(F.col("hour")) == 1)
    return rows.withColumn("is_fraud", (big | failed_at_night).cast("int")).drop("event_type")
