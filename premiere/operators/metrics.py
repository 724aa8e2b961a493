"""Forecast and classifier metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiere.operators import ranks

HORIZONS = ("m1", "m2", "m3")
TOTAL_HORIZON = "three_month"


def forecast_metrics(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, horizon, mae, rmse, wape) for each horizon and for the three-month total.

    Expects prediction_<h> and target_<h>_qty per horizon.
    """
    sides = [(h, F.col(f"prediction_{h}"), F.col(f"target_{h}_qty")) for h in HORIZONS]
    sides.append((TOTAL_HORIZON, sum((s[1] for s in sides), F.lit(0.0)), sum((s[2] for s in sides), F.lit(0.0))))
    long = df.select(
        *keys,
        F.inline(
            F.array(*[F.struct(F.lit(h).alias("horizon"), (p - y).alias("error"), y.alias("actual")) for h, p, y in sides])
        ),
    )
    size = F.abs("error")
    return long.groupBy(*keys, "horizon").agg(
        F.avg(size).alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        (F.sum(size) / F.greatest(F.sum(F.abs("actual")), F.lit(1e-9))).alias("wape"),
    )


def flat_metrics(metrics: DataFrame) -> DataFrame:
    """(metric, value) with names test_<horizon>_<measure>."""
    names = ("mae", "rmse", "wape")
    entries = F.array(
        *[
            F.struct(
                F.concat(F.lit("test_"), "horizon", F.lit(f"_{n}")).alias("metric"), F.col(n).alias("value")
            )
            for n in names
        ]
    )
    keys = [c for c in metrics.columns if c not in ("horizon", *names)]
    return metrics.select(*keys, F.inline(entries))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = {"tp": y & p, "fp": ~y & p, "fn": y & ~p, "tn": ~y & ~p}
    return df.agg(*[F.coalesce(F.count_if(c), F.lit(0)).alias(n) for n, c in counts.items()])


def classifier_summary(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; undefined ratios are 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _confusion(df, label, prediction).select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class, then accuracy, macro and weighted averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn

    def measures(hit: Column, wrong: Column, missed: Column) -> dict[str, Column]:
        return {
            "precision": _ratio(hit, hit + wrong),
            "recall": _ratio(hit, hit + missed),
            "f1": _ratio(2 * hit, 2 * hit + wrong + missed),
        }

    legit, fraud = measures(tn, fn, fp), measures(tp, fp, fn)
    sizes = (tn + fp, tp + fn)

    def entry(name: str, values: dict[str, Column], support: Column) -> Column:
        columns = [values[m].cast("double").alias(m) for m in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("class"), *columns, support.cast("bigint").alias("support"))

    accuracy = _ratio(tp + tn, total)
    macro = {m: (legit[m] + fraud[m]) / 2 for m in legit}
    weighted = {m: _ratio(legit[m] * sizes[0] + fraud[m] * sizes[1], total) for m in legit}
    entries = [
        entry("Legitimate", legit, sizes[0]),
        entry("Fraud", fraud, sizes[1]),
        entry("accuracy", dict.fromkeys(legit, accuracy), total),
        entry("macro avg", macro, total),
        entry("weighted avg", weighted, total),
    ]
    return _confusion(df, label, prediction).select(F.inline(F.array(*entries)))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve by rank sums; tied scores count half.

    Rows shrink to one per distinct score. Scores are ordered in ranges, so the negatives below a score are
    those of lower ranges and those below it in its own. Runs jobs when called.
    """
    by_score = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    order = F.col("s").asc_nulls_last()
    ranged = ranks.in_ranges(by_score, [order])
    inside = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    won = F.col("pos").cast("double") * (F.col("__below") + F.col("below") + F.col("neg") / 2)
    return (
        ranked.join(ranks.totals_below(ranged, F.col("neg")), "__range")
        .agg(F.sum(won).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(F.try_divide(F.col("w"), F.col("p").cast("double") * F.col("n")).alias("roc_auc"))
    )
