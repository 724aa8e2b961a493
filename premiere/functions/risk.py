"""Transaction features, limits, levels and reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Merchant codes; an unknown merchant counts as retail.
MERCHANT_CODES = {
    "grocery": 0,
    "restaurant": 1,
    "retail": 2,
    "pharmacy": 3,
    "fuel": 4,
    "electronics": 5,
    "online": 6,
    "jewellery": 7,
}
UNKNOWN_MERCHANT = 2
RISKY_MERCHANTS = ("electronics", "jewellery", "online")

# Accepted input ranges.
LIMITS = {
    "amount": (1, 1_000_000),
    "hour": (0, 23),
    "day_of_week": (0, 6),
    "customer_age": (18, 80),
    "num_prev_txns": (0, 500),
    "avg_txn_amount": (1, 500_000),
}

# Message texts.
NIGHT_REASON = "🌙 Late night transaction — high fraud signal"
WEEKEND_REASON = "📅 Weekend transaction"
NEWCOMER_REASON = "👤 Very few previous transactions"
AMOUNT_REASON = "💰 Amount is %sx higher than customer average"
MERCHANT_REASON = "🏪 %s has higher fraud rates"
NO_REASON = "No major risk signals detected"


def merchant_code(merchant: Column) -> Column:
    pairs = [F.lit(x) for pair in MERCHANT_CODES.items() for x in pair]
    code = F.try_element_at(F.create_map(*pairs), F.coalesce(merchant, F.lit("")))
    return F.coalesce(code, F.lit(UNKNOWN_MERCHANT))


def is_night(hour: Column) -> Column:
    return F.coalesce(((hour >= 22) | (hour <= 5)).cast("int"), F.lit(0))


def is_weekend(day: Column) -> Column:
    return F.coalesce((day >= 5).cast("int"), F.lit(0))


def amount_vs_average(amount: Column, average: Column) -> Column:
    return F.round(F.try_divide(amount, average + 1), 2)


def amount_log(amount: Column) -> Column:
    return F.round(F.log1p(amount), 4)


def risk_level(p: Column) -> Column:
    return F.when(p >= 0.70, "HIGH").when(p >= 0.40, "MEDIUM").otherwise("LOW")


def verdict(label: Column) -> Column:
    return F.when(label == 1, "FRAUD").otherwise("LEGITIMATE")


def confidence(p: Column) -> Column:
    return F.round(p * 100, 1)


def amount_level(ratio: Column) -> Column:
    return F.when(ratio > 5, "HIGH").otherwise("NORMAL")


def reasons(hour: Column, day: Column, ratio: Column, previous: Column, merchant: Column) -> Column:
    """Every reason that applies, in fixed order; one default entry when none does."""
    found = F.array_compact(
        F.array(
            F.when(is_night(hour) == 1, NIGHT_REASON),
            F.when(is_weekend(day) == 1, WEEKEND_REASON),
            F.when(ratio > 5, F.format_string(AMOUNT_REASON, ratio.cast("string"))),
            F.when(previous < 5, NEWCOMER_REASON),
            F.when(
                merchant.isin(*RISKY_MERCHANTS),
                F.format_string(MERCHANT_REASON, F.initcap(merchant)),
            ),
        )
    )
    return F.when(F.size(found) == 0, F.array(F.lit(NO_REASON))).otherwise(found)


def failed_limits(row: dict[str, Column]) -> Column:
    """Names of the fields outside their accepted range; a missing value fails too."""
    checks = [
        F.when(~F.coalesce(row[name].between(low, high), F.lit(False)), name)
        for name, (low, high) in LIMITS.items()
    ]
    known = F.coalesce(row["merchant_type"].isin(*MERCHANT_CODES), F.lit(False))
    return F.array_compact(F.array(*checks, F.when(~known, "merchant_type")))
