"""Transaction features, validation and the rule part of scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiere.functions import dates, risk

# Model inputs, in order.
MODEL_INPUTS = (
    "amount",
    "hour",
    "day_of_week",
    "merchant_type",
    "customer_age",
    "num_prev_txns",
    "avg_txn_amount",
    "is_night",
    "is_weekend",
    "amount_vs_avg",
    "amount_log",
)


def encode(df: DataFrame) -> DataFrame:
    """The merchant as its code plus four derived features; the rest is untouched.

    `merchant_name` keeps the name for reasons.
    """
    return df.withColumns(
        {
            "merchant_name": F.col("merchant_type"),
            "merchant_type": risk.merchant_code(F.col("merchant_type")),
            "is_night": risk.is_night(F.col("hour")),
            "is_weekend": risk.is_weekend(F.col("day_of_week")),
            "amount_vs_avg": risk.amount_vs_average(F.col("amount"), F.col("avg_txn_amount")),
            "amount_log": risk.amount_log(F.col("amount")),
        }
    )


def features_and_target(df: DataFrame) -> DataFrame:
    """Model inputs and label only."""
    return encode(df).select(*MODEL_INPUTS, "is_fraud")


def validate(df: DataFrame) -> DataFrame:
    """Adds `failed`, the fields outside their accepted range, and `is_valid`."""
    checked = df.withColumn("failed", risk.failed_limits({c: F.col(c) for c in df.columns}))
    return checked.withColumn("is_valid", F.size("failed") == 0)


def explain(encoded: DataFrame) -> DataFrame:
    """Labels a reader understands: part of day, weekday, amount level and reasons."""
    return encoded.withColumns(
        {
            "part_of_day": dates.part_of_day(F.col("hour")),
            "weekday": dates.weekday_name(F.col("day_of_week")),
            "amount_level": risk.amount_level(F.col("amount_vs_avg")),
            "reasons": risk.reasons(
                F.col("hour"),
                F.col("day_of_week"),
                F.col("amount_vs_avg"),
                F.col("num_prev_txns"),
                F.col("merchant_name"),
            ),
        }
    )


def judge(scored: DataFrame, probability: str = "probability_fraud", label: str = "predicted") -> DataFrame:
    """Verdict, confidence and risk level from a label and a probability."""
    return scored.withColumns(
        {
            "prediction": risk.verdict(F.col(label)),
            "confidence": risk.confidence(F.col(probability)),
            "risk_level": risk.risk_level(F.col(probability)),
        }
    )
