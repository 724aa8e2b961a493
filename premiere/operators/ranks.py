"""Row numbers and splits that never order a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiere.session import materialise

# Rows of a range that one task orders.
RANGE_ROWS = 1 << 20

# Leading hex digits of a digest that form a bucket: 65,536 buckets.
_PREFIX = 4


def seeded_digest(seed: int, key: str) -> Column:
    """The same pseudo-random order in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def digest_position(df: DataFrame, digest: str, keys: list[str], out: str) -> DataFrame:
    """1-based position by digest within `keys`.

    Digests spread evenly, so their prefix cuts any group, hot or not, into even buckets:
    position = rows in lower buckets + row number in the bucket. Digests must be unique.
    """
    bucketed = df.withColumn("__bucket", F.substring(digest, 1, _PREFIX))
    lower = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most 65,536 rows per group.
    offsets = (
        bucketed.groupBy(*keys, "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, "__bucket", F.coalesce(F.sum("__n").over(lower), F.lit(0)).alias("__lower"))
    )
    inside = Window.partitionBy(*keys, "__bucket").orderBy(digest)
    return (
        bucketed.withColumn("__row", F.row_number().over(inside))
        .join(offsets, [*keys, "__bucket"])
        .withColumn(out, (F.col("__lower") + F.col("__row")).cast("bigint"))
        .drop("__bucket", "__row", "__lower")
    )


def in_ranges(df: DataFrame, order: list[Column | str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows with the number of their range, `__range`: ranges follow each other in the given order.

    Borders come from a sample, so ranges are even whatever the values look like; only rows that are equal in
    all order columns cannot be parted. Runs jobs when called; the rows are written.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(df, "unranged")
    ranged = rows.repartitionByRange(max(least, rows.count() // range_rows), *order)
    return materialise(ranged.withColumn("__range", F.spark_partition_id()), "ranged")


def totals_below(ranged: DataFrame, amount: Column) -> DataFrame:
    """(__range, __below): the amount in all lower ranges. One row per range."""
    lower = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__range").agg(F.sum(amount).alias("__amount"))
    return totals.select("__range", F.coalesce(F.sum("__amount").over(lower), F.lit(0)).alias("__below"))


def ordered_position(df: DataFrame, order: list[str], out: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """1-based position in the order of columns: rows in lower ranges + row number in the range."""
    ranged = in_ranges(df, list(order), range_rows)
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    placed = ranged.withColumn("__row", inside).join(totals_below(ranged, F.lit(1)), "__range")
    return placed.withColumn(out, (F.col("__below") + F.col("__row")).cast("bigint")).drop("__range", "__row", "__below")


def seeded_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """A full shuffle of the rows, as a `position` column, repeatable by seed."""
    digested = df.withColumn("__digest", seeded_digest(seed, key))
    return digest_position(digested, "__digest", [], "position").drop("__digest")


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float, seed: int) -> DataFrame:
    """Exactly the given share of every class goes to test, picked by seeded digest."""
    digested = df.withColumn("__digest", seeded_digest(seed, key))
    placed = digest_position(digested, "__digest", [label], "__position").drop("__digest")
    # One row per class.
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__size"))
    train = F.col("__position") <= F.col("__size") - F.round(F.col("__size") * F.lit(test_fraction))
    return (
        placed.join(sizes, label)
        .withColumn("dataset_split", F.when(train, "train").otherwise("test"))
        .drop("__position", "__size")
    )


def chronological_split(
    df: DataFrame, train_fraction: float, validation_fraction: float, date: str = "launch_date"
) -> DataFrame:
    """Whole launch dates go to train, validation or test by percent rank of the date.

    Only the distinct dates are ordered together, so the single-task window holds one row
    per calendar day.
    """
    days = df.select(date).distinct().withColumn("__r", F.percent_rank().over(Window.orderBy(date)))
    split = (
        F.when(F.col("__r") < train_fraction, "train")
        .when(F.col("__r") < train_fraction + validation_fraction, "validation")
        .otherwise("test")
    )
    return df.join(F.broadcast(days.select(date, split.alias("dataset_split"))), date)
