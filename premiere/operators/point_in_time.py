"""What a brand and a category had shown before a launch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiere.config import DemandConfig
from premiere.functions import dates, numeric
from premiere.operators import running
from premiere.session import materialise

_AT = ["kind", "key", "day"]


def _by_kind(df: DataFrame, *columns: str) -> DataFrame:
    """One row per known brand and one per known category, so both share every shuffle."""
    kinds = F.array(
        F.struct(F.lit("brand").alias("kind"), F.col("brand").alias("key")),
        F.struct(F.lit("category").alias("kind"), F.col("functional_category").alias("key")),
    )
    return (
        df.select(F.explode(kinds).alias("k"), *columns)
        .select("k.kind", "k.key", *columns)
        .filter(F.col("key").isNotNull())
    )


def _launches(df: DataFrame) -> DataFrame:
    return df.filter(F.col("launch_date").isNotNull()).withColumn("day", dates.day_number(F.col("launch_date")))


def _attach(base: DataFrame, found: DataFrame, kind: str, key: str, *columns: Column) -> DataFrame:
    """Left join of one kind's answers on (key, day)."""
    side = found.filter(F.col("kind") == kind).select(F.col("key").alias(key), "day", *columns)
    return base.join(side, [key, "day"], "left")


def earlier_launch_stats(queries: DataFrame, history: DataFrame) -> DataFrame:
    """Counts, mean demand, median prices and price percentile of strictly earlier launches."""
    points = queries.select("product_id", "brand", "functional_category", "launch_price", "launch_date")
    points = points.withColumn("day", dates.day_number(F.col("launch_date")))
    launched = _launches(history).filter(F.col("m3_qty").isNotNull())
    launched = launched.select("brand", "functional_category", "day", "qty_90d", F.col("launch_price").alias("price"))
    rows = _by_kind(launched, "day", "price", "qty_90d")
    asked = _by_kind(_launches(points).withColumnRenamed("launch_price", "price"), "day", "price")
    spots = asked.select(*_AT).distinct()

    track = running.totals_before(
        rows.select(
            *_AT, F.lit(1).alias("n"), "qty_90d", F.col("qty_90d").isNotNull().cast("int").alias("known")
        ),
        spots,
        ["kind", "key"],
        ["n", "qty_90d", "known"],
    )
    track = track.withColumn("avg_qty", F.try_divide("qty_90d", "known"))
    answers = running.price_standing(rows.select(*_AT, "price"), spots, asked.filter(F.col("kind") == "category"))
    answers = materialise(answers, "price-standing")  # read by both sides of the join below
    medians, standing = running.split_answers(answers)
    ever = running.totals_before(
        launched.select(F.lit("all").alias("kind"), "day", F.lit(1).alias("n")),
        _launches(points).select(F.lit("all").alias("kind"), "day").distinct(),
        ["kind"],
        ["n"],
    ).select("day", F.col("n").alias("launches"))

    out = points
    for kind, key in (("brand", "brand"), ("category", "functional_category")):
        out = _attach(
            out,
            track.join(medians, _AT, "left"),
            kind,
            key,
            F.col("n").alias(f"{kind}_n"),
            F.col("avg_qty").alias(f"{kind}_avg_first_90d_qty"),
            F.col("median").alias(f"{kind}_median"),
        )
    place = standing.select(
        F.col("key").alias("functional_category"), "day", F.col("price").alias("launch_price"), "not_above"
    )
    out = out.join(place, ["functional_category", "day", "launch_price"], "left").join(ever, "day", "left")

    def count(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    return out.select(
        "product_id",
        numeric.price_ratio(F.col("launch_price"), F.col("category_median")).alias("price_to_category_median"),
        numeric.price_ratio(F.col("launch_price"), F.col("brand_median")).alias("price_to_brand_median"),
        F.coalesce(F.try_divide("not_above", "launches"), F.lit(0.0)).alias("category_price_percentile"),
        count("brand_n").alias("brand_historical_launch_count"),
        "brand_avg_first_90d_qty",
        count("category_n").alias("category_historical_launch_count"),
        "category_avg_first_90d_qty",
    )


def category_demand(queries: DataFrame, fact: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Units the category sold before the launch: recent, previous, same month, trend, season.

    The fact shrinks to category x day before anything is ordered. The same-month figure uses
    the same trick with the calendar month as a further key: of the lookback, only days in the
    launch's own month share its window.
    """
    points = queries.select("product_id", "functional_category", "launch_date")
    points = points.withColumn("day", dates.day_number(F.col("launch_date")))
    points = points.withColumn("month", F.month("launch_date"))
    daily = (
        fact.filter(F.col("order_date").isNotNull() & F.col("functional_category").isNotNull())
        .groupBy("functional_category", "order_date")
        .agg(F.sum("quantity").alias("quantity"))
        .withColumn("day", dates.day_number(F.col("order_date")))
        .withColumn("month", F.month("order_date"))
    )
    spots = _launches(points).filter(F.col("functional_category").isNotNull())
    spots = spots.select("functional_category", "day", "month").distinct()
    lookback = (-cfg.lookback_days, -1)
    spans = {
        "recent": (-cfg.recent_days, -1),
        "prev": (-cfg.lookback_days, -cfg.recent_days - 1),
        "total": lookback,
    }
    sums = running.windowed_totals(daily, spots, ["functional_category"], "quantity", spans)
    month = running.windowed_totals(
        daily, spots, ["functional_category", "month"], "quantity", {"same": lookback}
    ).drop("month")
    found = points.join(sums, ["functional_category", "day"], "left")
    found = found.join(month, ["functional_category", "day"], "left")
    sold = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("recent", "prev", "same")}
    return found.select(
        "product_id",
        sold["recent"].alias("category_recent_demand"),
        numeric.demand_trend(sold["recent"], sold["prev"]).alias("category_demand_trend"),
        numeric.month_index(sold["same"], F.col("total")).alias("category_launch_month_index"),
    )


def first_purchases(fact: DataFrame) -> DataFrame:
    """(customer_id, kind, key, day): every customer's first day per brand and per category; lines are dealt by customer once."""
    bought = fact.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    bought = bought.select("customer_id", "brand", "functional_category", dates.day_number(F.col("order_date")).alias("day"))
    kinds = _by_kind(bought.repartition("customer_id"), "customer_id", "day")
    return kinds.groupBy("customer_id", "kind", "key").agg(F.min("day").alias("day"))


def _first_days(first: DataFrame, asked: DataFrame) -> DataFrame:
    """(brand, functional_category, day) of every customer's first purchase of an asked brand, category or both.

    What is not meant is NULL; of a brand and a category the later day counts. A customer's short lists of brands
    and categories, and their pairs, follow where the customer lies.
    """
    of_kind = {k: F.collect_list(F.when(F.col("kind") == k, F.struct("key", "day"))) for k in ("brand", "category")}
    # Besides what was bought, nothing at all, on no day.
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("int").alias("day")))
    held = first.groupBy("customer_id").agg(*[F.concat(c, nothing).alias(k) for k, c in of_kind.items()])
    met = held.select(F.explode("brand").alias("b"), "category").select("b", F.explode("category").alias("c"))
    met = met.select(F.col("b.key").alias("brand"), F.col("c.key").alias("functional_category"), F.greatest("b.day", "c.day").alias("day"))
    wanted = asked.select(F.col("brand").alias("asked_brand"), F.col("functional_category").alias("asked_category"))
    is_asked = F.col("brand").eqNullSafe(F.col("asked_brand")) & F.col("functional_category").eqNullSafe(F.col("asked_category"))
    return met.join(wanted, is_asked).drop("asked_brand", "asked_category")


def eligible_customers(queries: DataFrame, fact: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """Distinct customers who bought the brand or the category before the launch.

    Only a customer's first day per brand and per category matters, and
    |B or C| = |B| + |C| - |B and C|. Each term is a running count of first days, where the
    third takes the later of the two days, so queries never meet customers. All three are counted in one pass.
    `first` is first_purchases(fact), for callers that keep it written.
    """
    points = queries.select("product_id", "brand", "functional_category", "launch_date")
    points = points.withColumn("day", dates.day_number(F.col("launch_date")))
    none = F.lit(None).cast("string")
    terms = F.array(
        F.struct(F.col("brand"), none.alias("functional_category"), F.lit(1).alias("sign")),
        F.struct(none.alias("brand"), F.col("functional_category"), F.lit(1).alias("sign")),
        F.struct(F.col("brand"), F.col("functional_category"), F.lit(-1).alias("sign")),
    )
    known = F.filter(terms, lambda t: F.when(t["sign"] < 0, t["brand"].isNotNull() & t["functional_category"].isNotNull())
                     .otherwise(F.coalesce(t["brand"], t["functional_category"]).isNotNull()))
    of = {"of_brand": "brand", "of_category": "functional_category"}
    spots = _launches(points).select(*[F.col(c).alias(n) for n, c in of.items()], "day", known.alias("terms")).distinct()
    asks = spots.select(*of, "day", F.inline("terms"))
    # Written, so that its true size decides whether it is broadcast.
    keys = ["brand", "functional_category"]
    asked = materialise(asks.select(*keys).distinct(), "asked-pairs")
    daily = _first_days(first_purchases(fact) if first is None else first, asked).groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("n"))
    reached = running.totals_before(daily, asks.select(*keys, "day").distinct(), keys, ["n"])
    reached = reached.select(F.col("brand").alias("r_brand"), F.col("functional_category").alias("r_category"), F.col("day").alias("r_day"), "n")
    own = F.col("brand").eqNullSafe(F.col("r_brand")) & F.col("functional_category").eqNullSafe(F.col("r_category"))
    total = asks.join(reached, own & (F.col("day") == F.col("r_day")))
    total = total.groupBy(*of, F.col("day").alias("of_day")).agg(F.sum(F.col("sign") * F.col("n")).alias("total"))
    own = F.col("brand").eqNullSafe(F.col("of_brand")) & F.col("functional_category").eqNullSafe(F.col("of_category"))
    found = points.join(total, own & (F.col("day") == F.col("of_day")), "left")
    return found.select("product_id", F.coalesce("total", F.lit(0)).cast("bigint").alias("eligible_customer_count"))


def eligible_customers_sketched(queries: DataFrame, fact: DataFrame, lg_k: int = 12) -> DataFrame:
    """eligible_customers as an estimate: mergeable sketches per key and day, united over the earlier days.

    No customer is joined or kept, a key holds a sketch of at most 2^lg_k registers a day. The standard error
    is about 0.8 / sqrt(2^lg_k), 1.3 % by default; small counts are exact.
    """
    points = _launches(queries.select("product_id", "brand", "functional_category", "launch_date"))
    bought = fact.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    daily = (
        _by_kind(bought.withColumn("day", dates.day_number(F.col("order_date"))), "day", "customer_id")
        .groupBy(*_AT)
        .agg(F.hll_sketch_agg(F.col("customer_id").cast("string"), lg_k).alias("sketch"))
    )
    spots = _by_kind(points, "day").distinct().withColumn("asked", F.lit(True))
    both = daily.join(spots, _AT, "full")
    earlier = Window.partitionBy("kind", "key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    held = both.withColumn("until", F.hll_union_agg("sketch").over(earlier)).filter("asked").select(*_AT, "until")
    # Sketches are kilobytes: they meet the distinct points, and products get numbers.
    asked = points.select("brand", "functional_category", "day").distinct()
    for kind, key in (("brand", "brand"), ("category", "functional_category")):
        asked = _attach(asked, held, kind, key, F.col("until").alias(f"{kind}_sketch"))
    brand, category = F.col("brand_sketch"), F.col("category_sketch")
    reach = F.when(brand.isNull(), F.hll_sketch_estimate(category)).when(category.isNull(), F.hll_sketch_estimate(brand))
    reach = reach.otherwise(F.hll_sketch_estimate(F.hll_union(brand, category)))
    reached = asked.select(
        F.col("brand").alias("of_brand"), F.col("functional_category").alias("of_category"), F.col("day").alias("on_day"), reach.alias("n")
    )
    own = (
        F.col("brand").eqNullSafe(F.col("of_brand"))
        & F.col("functional_category").eqNullSafe(F.col("of_category"))
        & (F.col("day") == F.col("on_day"))
    )
    found = points.join(reached, own, "left").select("product_id", "n")
    out = queries.select("product_id").join(found, "product_id", "left")
    return out.select("product_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("eligible_customer_count"))


def point_in_time_features(
    queries: DataFrame, history: DataFrame, fact: DataFrame, cfg: DemandConfig, first: DataFrame | None = None
) -> DataFrame:
    return (
        earlier_launch_stats(queries, history)
        .join(category_demand(queries, fact, cfg), "product_id", "left")
        .join(eligible_customers(queries, fact, first), "product_id", "left")
    )
