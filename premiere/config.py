"""Parameters of the demand and risk jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Feature names and their order are the contract of the feature table.
VECTOR_FEATURE = "product_embedding"
CATEGORICAL_FEATURES = ("brand", "functional_category")
NUMERIC_FEATURES = (
    "log_launch_price",
    "price_to_category_median",
    "price_to_brand_median",
    "category_price_percentile",
    "launch_month_sin",
    "launch_month_cos",
    "accessory_flag",
    "refurbished_flag",
    "top1_similarity",
    "top5_mean_similarity",
    "top5_same_brand_share",
    "top5_same_category_share",
    "analog_weighted_m1_qty",
    "analog_weighted_m2_qty",
    "analog_weighted_m3_qty",
    "analog_weighted_90d_customers",
    "analog_weighted_90d_orders",
    "analog_weighted_avg_order_qty",
    "analog_demand_dispersion",
    "brand_historical_launch_count",
    "brand_avg_first_90d_qty",
    "category_historical_launch_count",
    "category_avg_first_90d_qty",
    "category_recent_demand",
    "category_demand_trend",
    "category_launch_month_index",
    "eligible_customer_count",
)
FEATURES = (VECTOR_FEATURE, *CATEGORICAL_FEATURES, *NUMERIC_FEATURES)
TARGETS = ("target_m1_qty", "target_m2_qty", "target_m3_qty")
PRODUCT_COLUMNS = ("product_id", "product_name", "launch_date", "launch_price")


@dataclass(frozen=True)
class DemandConfig:
    """Feature parameters, then the sizing knobs of the distributed operators."""

    source_mode: str = "sales_order"  # or "sales", or "union" of the two
    top_k: int = 5
    analog_temperature: float = 10.0
    lookback_days: int = 365
    recent_days: int = 90
    # Only use analogs whose three launch months ended before the query's launch.
    require_matured: bool = False

    similarity_digits: int = 9
    # Live cells of the search grid (0: the shuffle partitions), and vectors of a side a cell may hold.
    search_tasks: int = 0
    # 131,072 vectors of 64 numbers take 100 MB of a Python worker.
    grid_rows: int = 131_072


@dataclass(frozen=True)
class TrainingConfig:
    train_fraction: float = 0.70
    validation_fraction: float = 0.15
    seed: int = 42
    loss: str = "huber"  # huber | mse | poisson | trees
    max_iter: int = 100
    tolerance: float = 1e-6
    patience: int = 12  # steps without a better validation loss
    huber_delta: float = 1.0  # where squared loss turns linear
    selection_metric: str = "test_three_month_wape"
    lower_metric_is_better: bool = True
    # Risk model
    test_fraction: float = 0.20
    num_trees: int = 100
    max_depth: int = 5
