"""Analog features and the explanation list, both from one set of similar launches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiere.config import DemandConfig
from premiere.functions import numeric
from premiere.operators import similarity
from premiere.session import materialise

# Feature name -> outcome it averages.
WEIGHTED_OUTCOMES = {
    "analog_weighted_m1_qty": "m1_qty",
    "analog_weighted_m2_qty": "m2_qty",
    "analog_weighted_m3_qty": "m3_qty",
    "analog_weighted_90d_customers": "customers_90d",
    "analog_weighted_90d_orders": "orders_90d",
    "analog_weighted_avg_order_qty": "avg_order_qty_90d",
}
_OUTCOMES = (*WEIGHTED_OUTCOMES.values(), "qty_90d")


def ranked_analogs(queries: DataFrame, history: DataFrame, cfg: DemandConfig) -> DataFrame:
    """product_id, brand, functional_category and `analogs`, the k best earlier launches by rank.

    The list is built once per distinct (vector, day), then handed to every product that
    shares it. Lists never exceed k entries.
    """
    best = materialise(similarity.similar_launches(queries, history, cfg), "similar-launches")
    known = history.select(
        F.col("product_id").alias("analog_id"),
        F.col("product_name").alias("analog_name"),
        F.col("brand").alias("analog_brand"),
        F.col("functional_category").alias("analog_category"),
        F.col("launch_date").alias("analog_launch"),
        *_OUTCOMES,
    )
    entry = F.struct("rank", "similarity", *known.columns)
    lists = (
        best.join(known, "analog_id").groupBy("vector_key", "day").agg(F.sort_array(F.collect_list(entry)).alias("analogs"))
    )
    points = similarity.query_points(queries).drop("vector")
    identity = queries.select("product_id", "brand", "functional_category")
    # Narrow rows meet first; the lists come last.
    return points.join(identity, "product_id").join(lists, ["vector_key", "day"]).drop("vector_key", "day")


def _total(value) -> Column:
    """Sum over the analog list; missing terms are skipped."""
    return F.aggregate(
        F.transform("analogs", value),
        F.lit(0.0),
        lambda acc, x: acc + F.coalesce(x.cast("double"), F.lit(0.0)),
    )


def _mean(value) -> Column:
    """Mean over the analogs that have the value; NULL when none has."""
    known = F.size(F.filter(F.transform("analogs", value), lambda x: x.isNotNull()))
    return F.try_divide(_total(value), known)


def analog_features(ranked: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Similarity figures and weighted outcomes from each product's short analog list."""

    def weight(a: Column) -> Column:
        return numeric.similarity_weight(a["similarity"], cfg.analog_temperature)

    weights = F.when(F.exists("analogs", lambda a: a["similarity"].isNotNull()), _total(weight))

    def weighted(column: str, power: int = 1) -> Column:
        known = F.exists("analogs", lambda a: a[column].isNotNull() & a["similarity"].isNotNull())
        terms = _total(lambda a: weight(a) * (a[column] if power == 1 else a[column] * a[column]))
        return F.try_divide(F.when(known, terms), weights)

    mean_qty = weighted("qty_90d")
    spread = F.sqrt(F.greatest(weighted("qty_90d", 2) - mean_qty * mean_qty, F.lit(0.0)))
    return ranked.select(
        "product_id",
        F.array_max(F.transform("analogs", lambda a: a["similarity"])).alias("top1_similarity"),
        _mean(lambda a: a["similarity"]).alias("top5_mean_similarity"),
        _mean(lambda a: (a["analog_brand"] == F.col("brand")).cast("double")).alias("top5_same_brand_share"),
        _mean(lambda a: (a["analog_category"] == F.col("functional_category")).cast("double")).alias(
            "top5_same_category_share"
        ),
        *[weighted(column).alias(name) for name, column in WEIGHTED_OUTCOMES.items()],
        spread.alias("analog_demand_dispersion"),
    )


def similar_products(ranked: DataFrame) -> DataFrame:
    """The explanation list: ranked analogs with name, similarity, launch and outcomes."""
    entry = F.transform(
        "analogs",
        lambda a: F.struct(
            a["rank"].alias("rank"),
            a["analog_id"].alias("aid"),
            a["analog_name"].alias("aname"),
            a["similarity"].alias("similarity"),
            a["analog_launch"].alias("ad"),
            a["m1_qty"].alias("m1_qty"),
            a["m2_qty"].alias("m2_qty"),
            a["m3_qty"].alias("m3_qty"),
        ),
    )
    return ranked.select("product_id", entry.alias("top5_similar_products"))
