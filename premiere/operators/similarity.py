"""The k most similar earlier products, exactly, on a grid of matrix products in launch order.

1. Copies collapse. Equal vectors have equal similarities, so queries are reduced to distinct
   (vector, launch day), and of candidates with one vector and one day only the k smallest
   ids can ever be among the k best. Vectors go by their digest until the grid is dealt.
2. Queries and candidates are each cut into as many ranges of launch days as the grid has rows and
   columns; a day with more rows than a range is split by hash. The grid has about the asked number of
   live cells, and more only where a range would pass `grid_rows`, which bounds what a task holds.
3. A row meets the columns that open no later than its last day, by number: the plan holds ids only.
   When launches query their own history, about half of all cells are live.
4. Within a range a vector is one row, a group, with its days (and ids) beside it. It goes to every live cell of its
   row or column: with T cells about sqrt(T) times, however many pairs there are. A cell is one cogroup, searched
   as matrix products of 128 queries at a time, in single precision, and what comes near a query's bar again in
   double. If all its candidates are open by its first asked day, one list answers all days of a group, else there is
   one per day. Lists meet by group, are cut to k, spread over the group's days and cut again.

Exact search of vectors without structure has to compare every query with all earlier launches; what
can be bounded, and is, is what a task holds and what is handed on.

Ranking is by similarity rounded to `similarity_digits`, then by product id, so that the
last bits of a matrix product cannot reorder equal vectors.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiere.config import DemandConfig
from premiere.functions import dates
from premiere.operators import kernels, running
from premiere.session import materialise


def _available_day(cfg: DemandConfig) -> Column:
    """First day on which a launch may serve as an analog."""
    if cfg.require_matured:
        return dates.day_number(F.add_months("launch_date", 3))
    return dates.day_number(F.col("launch_date")) + F.lit(1)


def _vector_key(v: str) -> Column:
    return F.coalesce(F.unhex(F.sha2(F.to_json(v), 256)), F.lit(b"none"))


def query_points(queries: DataFrame) -> DataFrame:
    """product_id with the (vector_key, day) that decides its analogs."""
    return queries.filter(F.col("launch_date").isNotNull()).select(
        "product_id",
        _vector_key("product_embedding").alias("vector_key"),
        dates.day_number(F.col("launch_date")).alias("day"),
        F.col("product_embedding").alias("vector"),
    )


def _candidates(history: DataFrame, cfg: DemandConfig) -> DataFrame:
    rows = history.filter(F.col("launch_date").isNotNull() & F.col("m3_qty").isNotNull()).select(
        "product_id",
        _vector_key("product_embedding").alias("vector_key"),
        _available_day(cfg).alias("day"),
    )
    copies = Window.partitionBy("vector_key", "day").orderBy("product_id")
    return (
        rows.withColumn("__copy", F.row_number().over(copies)).filter(F.col("__copy") <= cfg.top_k).drop("__copy")
    )


def _in_blocks(rows: DataFrame, size: int, spread: list[str]) -> DataFrame:
    """Rows with the block (range, part) of their day; ranges are numbered by day from 0.

    A range starts a new one every `size` rows; a day with more than `size` rows is dealt to parts by
    the hash of `spread`. Windows run over days of the calendar only.
    """
    per_day = rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    by_day = Window.orderBy("day")
    before = F.coalesce(F.sum("n").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = per_day.withColumn("start", F.floor(before / size)).withColumn("parts", F.ceil(F.col("n") / size).cast("int"))
    ranges = ranges.withColumn("range", (F.dense_rank().over(Window.orderBy("start")) - 1).cast("int"))
    part = F.pmod(F.xxhash64(*spread), F.col("parts")).cast("int")
    # One row per day of the calendar.
    return rows.join(F.broadcast(ranges.select("day", "range", "parts")), "day").withColumn("part", part).drop("parts")


def search_plan(tiles: DataFrame, blocks: DataFrame) -> DataFrame:
    """(tile, tile_part, range, part): the pairs to search. A range of blocks opens on its first day."""
    opens = blocks.groupBy("range").agg(F.min("day").alias("day"))
    last = tiles.groupBy("range", "part").agg(F.max("day").alias("day"))
    days = opens.select("day", F.col("range").alias("open")).unionByName(
        last.select("day").distinct().withColumn("open", F.lit(None).cast("int"))
    )
    # One row per block range or day: the last range open on each day.
    upto = days.groupBy("day").agg(F.max("open").alias("open"))
    upto = upto.withColumn("open", F.max("open").over(Window.orderBy("day")))
    pairs = last.join(upto, "day").filter(F.col("open").isNotNull()).select(
        F.col("range").alias("tile"), F.col("part").alias("tile_part"), F.explode(F.sequence(F.lit(0), "open")).alias("range")
    )
    return pairs.join(blocks.select("range", "part").distinct(), "range")


def grid_side(rows: int, tasks: int, grid_rows: int) -> int:
    """Rows, and columns, of the grid: half of its cells are about `tasks`, a range has at most `grid_rows`."""
    return max(1, math.ceil(math.sqrt(2 * tasks)), math.ceil(rows / grid_rows))


def _ranged(rows: DataFrame, spread: list[str], label: str, cfg: DemandConfig) -> DataFrame:
    """Rows with their range of days (range, part), written: one side of the grid. Reads the rows twice."""
    tasks = cfg.search_tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    size = math.ceil(n / grid_side(n, tasks, cfg.grid_rows)) or 1
    return materialise(_in_blocks(rows, size, spread), label)


def dealt(queries: DataFrame, candidates: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with one row per live cell (tile, tile_part, range, part) of their grid row or column."""
    asked = queries.withColumnsRenamed({"range": "tile", "part": "tile_part"})
    return plan.join(asked, ["tile", "tile_part"]), plan.join(candidates, ["range", "part"])


def _vectors(queries: DataFrame, history: DataFrame) -> DataFrame:
    """(vector_key, vector): every vector of both sides once, in buckets of the key."""
    sides = [queries] if queries is history else [queries, history]
    keyed = [s.select(_vector_key("product_embedding").alias("vector_key"), F.col("product_embedding").alias("vector")) for s in sides]
    each = reduce(DataFrame.unionByName, keyed).groupBy("vector_key").agg(F.first("vector").alias("vector"))
    return materialise(each, "similarity-vectors", by="vector_key")


def _packed(ranged: DataFrame, vectors: DataFrame, lists: dict[str, str], label: str) -> DataFrame:
    """One row per vector of a block, numbered by `group`, with lists of its rows' columns; written.

    A list is no longer than the rows of a block.
    """
    rows = F.array_sort(F.collect_list(F.struct(*lists)))
    per_vector = ranged.repartition("vector_key").groupBy("vector_key", "range", "part").agg(rows.alias("rows"))
    packed = per_vector.join(vectors, "vector_key").withColumn("group", F.monotonically_increasing_id())
    lists = [F.col("rows")[c].alias(name) for c, name in lists.items()]
    return materialise(packed.select("group", "vector_key", "range", "part", "vector", *lists), label)


def similar_launches(queries: DataFrame, history: DataFrame, cfg: DemandConfig) -> DataFrame:
    """(vector_key, day, rank, analog_id, similarity): the k best earlier launches of each point.

    Runs jobs when called: both sides, their vectors, the plan of the grid and the lists of its cells are written.
    """
    k = cfg.top_k
    vectors = _vectors(queries, history)
    points = materialise(query_points(queries).select("vector_key", "day").distinct(), "similarity-points")
    candidates = materialise(_candidates(history, cfg).withColumnRenamed("product_id", "id"), "similarity-offered")
    columns = _ranged(candidates, ["vector_key"], "similarity-candidates", cfg)
    rows = _ranged(points, ["vector_key"], "similarity-queries", cfg)
    plan = materialise(search_plan(rows, columns), "similarity-plan")
    groups = _packed(rows, vectors, {"day": "days"}, "similarity-asked")
    blocks = _packed(columns, vectors, {"day": "days", "id": "ids"}, "similarity-blocks")
    asked, offered = dealt(groups.drop("vector_key"), blocks.drop("vector_key", "group"), plan)
    cells = running.cogroup_on(asked, offered, ["tile", "tile_part", "range", "part"], plan.count())
    lists = cells.applyInArrow(kernels.search_cell(k, cfg.similarity_digits), kernels.CELL_ROW)

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("group", "day").orderBy(F.col("similarity").desc(), F.col("analog_id"))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # Cells that are open as a whole answer all days of a group at once, the others day by day. A group's lists
    # are dealt once, by group, before they are cut, spread over its days and cut again.
    of_days = F.when(F.col("day").isNull(), F.col("days")).otherwise(F.array("day"))
    met = best(lists.repartition("group")).join(groups.select("group", "vector_key", "days"), "group")
    ranked = best(met.withColumn("day", F.explode(of_days)))
    similarity = F.when(F.col("similarity") > kernels.UNKNOWN, F.col("similarity")).alias("similarity")
    return ranked.select("vector_key", "day", "rank", "analog_id", similarity)
