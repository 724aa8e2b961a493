"""Running figures at points in time.

Each operator asks: what had happened strictly before this day, for this key? Nothing here
joins queries with the rows they look back on. Rows shrink to one per key and day first, so
a key holds at most as many rows as the calendar has days, however hot it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiere.operators import ranks
from premiere.session import materialise


def totals_before(
    events: DataFrame, points: DataFrame, keys: list[str], sums: list[str], day: str = "day"
) -> DataFrame:
    """For each distinct (keys, day) of `points`: the sums of `events` on earlier days.

    A point with no earlier events gets NULL sums.
    """
    asked = points.select(*keys, day, *[F.lit(None).cast("double").alias(s) for s in sums], F.lit(1).alias("ask"))
    happened = events.select(*keys, day, *[F.col(s).cast("double") for s in sums], F.lit(0).alias("ask"))
    daily = (
        happened.unionByName(asked)
        .groupBy(*keys, day)
        .agg(*[F.sum(s).alias(s) for s in sums], F.max("ask").alias("ask"))
    )
    earlier = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    return (
        daily.select(*keys, day, "ask", *[F.sum(s).over(earlier).alias(s) for s in sums])
        .filter(F.col("ask") == 1)
        .drop("ask")
    )


def windowed_totals(
    events: DataFrame,
    points: DataFrame,
    keys: list[str],
    value: str,
    spans: dict[str, tuple[int, int]],
    day: str = "day",
) -> DataFrame:
    """Like totals_before, but over day ranges relative to the point, e.g. (-90, -1)."""
    asked = points.select(*keys, day, F.lit(None).cast("double").alias(value), F.lit(1).alias("ask"))
    happened = events.select(*keys, day, F.col(value).cast("double").alias(value), F.lit(0).alias("ask"))
    daily = (
        happened.unionByName(asked)
        .groupBy(*keys, day)
        .agg(F.sum(value).alias(value), F.max("ask").alias("ask"))
    )
    ordered = Window.partitionBy(*keys).orderBy(day)
    return (
        daily.select(
            *keys,
            day,
            "ask",
            *[F.sum(value).over(ordered.rangeBetween(a, b)).alias(n) for n, (a, b) in spans.items()],
        )
        .filter(F.col("ask") == 1)
        .drop("ask")
    )


def cogroup_on(left: DataFrame, right: DataFrame, keys: list[str], groups: int = 0):
    """Cogroup two frames that may come from one table, over `groups` partitions if that is more than usual.

    The right side is renamed onto itself first: with attributes shared between the sides,
    Spark 4.1 may prune a column of the right side that the function still needs.
    """
    own = right.select(*[F.col(c).alias(c) for c in right.columns])
    # A given number of partitions is not coalesced: the groups are few bytes but much work.
    spread = max(groups, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        left.repartition(spread, *keys).groupBy(*keys).cogroup(own.repartition(spread, *keys).groupBy(*keys))
    )


# Order statistics -----------------------------------------------------------------------
#
# Every price gets its rank among all prices, written in digits of base FAN. The digits are the path down a
# tree of price ranges: a node holds at most FAN ranges, a leaf one price. Going down one level takes the
# earlier rows of every range of a node, which are FAN running counts over the days of that node. A median
# follows the range that holds its place; a price's standing adds the ranges below its own. A window runs over
# the days of one node, however many rows or prices a key has.

FAN = 32


def _counts(at: Column) -> list[Column]:
    return [F.sum(F.when(at == i, F.col("n"))).alias(f"c{i}") for i in range(FAN)]


def _digit(rank: str, step: int) -> Column:
    return F.floor(F.col(rank) / step) % FAN


def price_standing(rows: DataFrame, median_points: DataFrame, price_points: DataFrame) -> DataFrame:
    """Exact running order statistics.

    rows(kind, key, day, price); median_points(kind, key, day); price_points(kind, key, day, price).
    Answers carry want = "median" with the lower median of the earlier rows, or want = "place"
    with not_above, the count of earlier rows priced no higher. Points with no earlier rows of
    their key are absent. Runs jobs when called: every level of the tree is written.
    """
    at, node = ["kind", "key", "day"], ["kind", "key", "node"]
    daily = rows.filter(F.col("price").isNotNull()).groupBy(*at, "price").agg(F.count(F.lit(1)).alias("n"))
    priced = price_points.filter(F.col("price").isNotNull()).select(*at, "price").distinct()
    prices = daily.select("price").unionByName(priced.select("price")).distinct()
    ranked = ranks.ordered_position(prices, ["price"], "rank").withColumn("rank", F.col("rank") - 1)
    ranked = materialise(ranked, "price-ranks")
    daily = materialise(daily.join(ranked, "price").drop("price"), "price-days")
    asks = (
        median_points.select(*at, F.lit("median").alias("want"), F.lit(None).cast("double").alias("price"))
        .distinct()
        .unionByName(priced.select(*at, F.lit("place").alias("want"), "price"))
        .join(ranked, "price", "left")
    )
    asks = asks.withColumns({"node": F.lit(0).cast("bigint"), "left": F.lit(None).cast("bigint"), "below": F.lit(0).cast("bigint")})
    levels = 1
    while FAN**levels < (ranked.agg(F.max("rank")).first()[0] or 0) + 1:
        levels += 1
    for level in range(levels):
        step = FAN ** (levels - 1 - level)
        events = daily.withColumn("node", F.floor(F.col("rank") / (step * FAN)))
        events = events.groupBy(*node, "day").agg(*_counts(_digit("rank", step)))
        names = [f"c{i}" for i in range(FAN)]
        asks = materialise(asks, "price-asks")
        earlier = totals_before(events, asks.select(*node, "day").distinct(), node, names)
        held = F.transform(F.array(*names), lambda c: F.coalesce(c, F.lit(0)).cast("bigint"))
        met = asks.join(earlier.select(*node, "day", held.alias("held")), [*node, "day"])
        if not level:
            total = F.aggregate("held", F.lit(0).cast("bigint"), lambda a, c: a + c)
            met = met.withColumn("total", total).filter(F.col("total") > 0)
            met = met.withColumn("left", F.floor((F.col("total") + 1) / 2)).drop("total")
        # Rows up to the end of every range; the median's is the first that reaches its place.
        upto = F.transform(F.sequence(F.lit(1), F.lit(FAN)), lambda i: F.aggregate(F.slice("held", 1, i), F.lit(0).cast("bigint"), lambda a, c: a + c))
        met = met.withColumn("upto", upto)
        own = F.size(F.filter("upto", lambda c: c < F.col("left"))).cast("bigint")
        met = met.withColumn("digit", F.when(F.col("want") == "median", own).otherwise(_digit("rank", step)))
        lower = F.when(F.col("digit") > 0, F.get("upto", F.col("digit").cast("int") - 1)).otherwise(F.lit(0))
        met = met.withColumn("lower", lower)
        if level == levels - 1:
            met = met.withColumn("below", F.col("below") + F.get("upto", F.col("digit").cast("int")))
        else:
            met = met.withColumn("below", F.col("below") + F.col("lower"))
        met = met.withColumns({"node": F.col("node") * FAN + F.col("digit"), "left": F.col("left") - F.col("lower")})
        asks = met.drop("held", "upto", "digit", "lower")
    asks = materialise(asks, "price-asks")
    # The node is a rank now: the median's price, or the asked one.
    found = asks.join(ranked.select(F.col("rank").alias("node"), F.col("price").alias("found")), "node")
    median = F.when(F.col("want") == "median", F.col("found"))
    return found.select(*at, "want", "price", median.alias("median"), F.col("below").alias("not_above"))


def split_answers(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The medians and the standings of one set of answers."""
    median = answers.filter(F.col("want") == "median").select("kind", "key", "day", "median")
    standing = answers.filter(F.col("want") == "place").select("kind", "key", "day", "price", "not_above")
    return median, standing
