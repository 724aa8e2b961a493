"""Registered queries: every operator run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from premiere.config import NUMERIC_FEATURES, TARGETS, DemandConfig, TrainingConfig
from premiere.functions import numeric, risk, text, vectors
from premiere.operators import (
    analogs,
    champion,
    history,
    metrics,
    point_in_time,
    preprocess,
    ranks,
    similarity,
    transactions,
)
from premiere.plans import features, runs, training
from premiere.schemas import NEW_PRODUCTS, TRANSACTIONS
from premiere.session import materialise, outside_scopes, scratch_path
from premiere.sources import adapters, orders, tables
from premiere.streaming import scoring

DEMAND = DemandConfig()
TRAINING = TrainingConfig()
FOREST = TrainingConfig()
SIMILARITY = DemandConfig()

Query = Callable[[SparkSession, str], DataFrame]

# Stage tables already written by this session, by (application, folder, stage).
_STAGES: dict[tuple[str, str, str], DataFrame] = {}


def _stage(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STAGES:
        # Kept for the session, also when a stream's batch asks first.
        with outside_scopes():
            _STAGES[key] = materialise(build(), name, by)
    return _STAGES[key]


# Models fitted by this session, kept like the stages.
_MODELS: dict[tuple[str, str, str], object] = {}


def _fitted(spark: SparkSession, folder: str, name: str, fit: Callable[[], object]):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _MODELS:
        with outside_scopes():
            _MODELS[key] = fit()
    return _MODELS[key]


def forget_stages() -> None:
    """Make the next query write its stages and fit its models again."""
    _STAGES.clear()
    _MODELS.clear()


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return _stage(spark, folder, "fact-order-line", lambda: adapters.fact_order_lines(spark, folder), "product_id")


def launched(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        return history.product_history(fact(spark, folder), DEMAND, adapters.product_vectors(spark, folder))

    return _stage(spark, folder, "product-history", build, "product_id")


def _ranked(spark: SparkSession, folder: str) -> DataFrame:
    rows = launched(spark, folder)
    return _stage(spark, folder, "ranked-analogs", lambda: analogs.ranked_analogs(rows, rows, SIMILARITY))


def _first(spark: SparkSession, folder: str) -> DataFrame:
    """First purchases, which training and announced products both look back on."""
    return _stage(spark, folder, "first-purchases", lambda: point_in_time.first_purchases(fact(spark, folder)), "customer_id")


def _features(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        lines, rows = fact(spark, folder), launched(spark, folder)
        return features.training_features(lines, rows, DEMAND, _first(spark, folder)).features

    return _stage(spark, folder, "product-features", build)


def _split(spark: SparkSession, folder: str) -> DataFrame:
    return ranks.chronological_split(_features(spark, folder), TRAINING.train_fraction, TRAINING.validation_fraction)


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _stage(spark, folder, "transactions", lambda: adapters.transactions(spark, folder))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal.

    Prices end in cents over small counts: more digits keep them off rounding borders. A
    spread near zero has few certain digits.
    """
    special = {"unit_price": 9, "launch_price": 9, "analog_demand_dispersion": min(digits, 4)}

    def show(name: str, kind: str) -> Column:
        if kind != "double":
            return F.col(name)
        return (F.round(F.col(name), special.get(name, digits)) + F.lit(0.0)).alias(name)

    return df.select(*[show(n, k) for n, k in df.dtypes])


# Sources ------------------------------------------------------------------------------


def order_lines_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(orders.order_lines("sales_order", orders=adapters.raw_orders(spark, folder)))


def order_lines_from_sales(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(orders.order_lines("sales", sales=adapters.raw_sales(spark, folder)))


def order_lines_union(spark: SparkSession, folder: str) -> DataFrame:
    both = orders.order_lines("union", adapters.raw_orders(spark, folder), adapters.raw_sales(spark, folder))
    return rounded(both)


def transactions_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "transactions-csv")
    tables.write_csv(_transactions(spark, folder), path)
    return tables.read_csv(spark, path, TRANSACTIONS)


def split_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Launches written partitioned by split, read back, counted."""
    path = scratch_path(spark, "split-tables")
    split = ranks.chronological_split(launched(spark, folder), TRAINING.train_fraction, TRAINING.validation_fraction)
    tables.overwrite_table(split.drop("product_embedding"), path, partition_by=("dataset_split",))
    written = tables.read_table(spark, path)
    return rounded(
        written.groupBy("dataset_split").agg(
            F.count(F.lit(1)).alias("products"),
            F.min("launch_date").alias("first_launch"),
            F.max("launch_date").alias("last_launch"),
            F.sum("qty_90d").alias("units"),
        )
    )


def appended_evaluations(spark: SparkSession, folder: str) -> DataFrame:
    """An append log that gains a column half way."""
    path = scratch_path(spark, "evaluation-log")
    log = _evaluations(spark, folder)
    early = F.col("run_id") < "1996"
    tables.append_table(log.filter(early).select("run_id", "selection_metric_value"), path)
    tables.append_table(log.filter(~early).select("run_id", "selection_metric_value", "selection_metric"), path)
    return rounded(tables.read_evolving(spark, path).select("run_id", "selection_metric", "selection_metric_value"))


# Expressions --------------------------------------------------------------------------


def title_features(spark: SparkSession, folder: str) -> DataFrame:
    """Every document text, page address and product title through the title expressions."""
    texts = (
        adapters.table(spark, folder, "documents")
        .select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), F.col("text").alias("title"))
        .unionByName(
            adapters.table(spark, folder, "pages").select(
                F.concat(F.lit("p"), F.col("page_id")).alias("id"), F.col("url").alias("title")
            )
        )
        .unionByName(
            adapters.products(spark, folder).select(F.concat(F.lit("t"), F.col("product_id")).alias("id"), "title")
        )
    )
    title = F.col("title")
    clean = text.clean_text(title)
    category = text.title_category(title)
    return texts.select(
        "id",
        F.md5(clean).alias("clean_md5"),
        text.first_word(clean).alias("brand"),
        text.brand_or_first_word(F.when(F.length(title) % 2 == 0, F.lit(" Own  Brand ")), title).alias("known_brand"),
        category.alias("functional_category"),
        text.accessory_flag(clean, category).alias("accessory_flag"),
        text.refurbished_flag(clean).alias("refurbished_flag"),
    )


def vector_expressions(spark: SparkSession, folder: str) -> DataFrame:
    """Unit length and cosine with the vector's own mirror image, natively."""
    v = F.col("embedding")
    return rounded(
        adapters.table(spark, folder, "embeddings").select(
            "vec_id",
            vectors.norm(v).alias("length"),
            vectors.norm(vectors.unit(v)).alias("unit_length"),
            vectors.cosine(v, F.reverse(v)).alias("mirror_cosine"),
            vectors.cosine(v, F.transform(v, lambda x: x * 0)).alias("zero_cosine"),
            vectors.cosine(v, F.lit(None).cast("array<float>")).alias("missing_cosine"),
        )
    )


def title_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Hashed title embeddings of all parts."""
    titles = adapters.products(spark, folder).select("product_id", F.col("title").alias("product_name"))
    embedded = vectors.hashed_title_vectors(titles)
    v = F.col("product_embedding")
    return rounded(
        embedded.select(
            "product_id",
            F.size(v).alias("dimensions"),
            vectors.norm(v).alias("length"),
            vectors.as_ml_vector(v).isNotNull().alias("is_vector"),
        )
    )


def title_idf_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Titles with each word bucket and its weight, over all parts; every part's weighted vector has length one or none."""
    titles = adapters.products(spark, folder).select("product_id", F.col("title").alias("product_name"))
    weights = materialise(vectors.document_frequencies(titles), "document-frequencies")
    embedded = vectors.weighted_title_vectors(titles, weights)
    length = vectors.norm(F.col("product_embedding"))
    off = embedded.agg(F.count_if((F.abs(length - 1) > 1e-4) & (length > 0)).alias("off"))
    return rounded(weights.join(off).select("bucket", "titles", "weight", (F.col("off") == 0).alias("unit_length")))


def target_transform(spark: SparkSession, folder: str) -> DataFrame:
    y = F.col("qty_90d")
    return rounded(
        launched(spark, folder).select(
            "product_id",
            numeric.to_log_target(y - 40).alias("log_target"),
            numeric.from_log_target(numeric.to_log_target(y)).alias("restored"),
            numeric.from_log_target(-numeric.to_log_target(y)).alias("floored"),
        )
    )


# Demand features ----------------------------------------------------------------------


def launch_month_demand(spark: SparkSession, folder: str) -> DataFrame:
    lines = fact(spark, folder)
    return rounded(history.launch_outcomes(lines, history.launch_profile(lines, DEMAND)))


def product_history(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(history.product_history(fact(spark, folder), DEMAND))


def similar_products_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = launched(spark, folder)
    lists = analogs.similar_products(analogs.ranked_analogs(rows, rows, SIMILARITY))
    return rounded(lists.select("product_id", F.inline("top5_similar_products")))


def matured_similar_products(spark: SparkSession, folder: str) -> DataFrame:
    """Only analogs whose three launch months were over."""
    rows = launched(spark, folder)
    points = similarity.query_points(rows).drop("vector")
    best = similarity.similar_launches(rows, rows, replace(SIMILARITY, require_matured=True))
    return rounded(
        points.join(best, ["vector_key", "day"]).select("product_id", "rank", "analog_id", "similarity")
    )


def analog_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(analogs.analog_features(_ranked(spark, folder), DEMAND))


def earlier_launch_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = launched(spark, folder)
    return rounded(point_in_time.earlier_launch_stats(rows, rows))


def category_demand(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(point_in_time.category_demand(launched(spark, folder), fact(spark, folder), DEMAND))


def eligible_customers(spark: SparkSession, folder: str) -> DataFrame:
    return point_in_time.eligible_customers(launched(spark, folder), fact(spark, folder))


def eligible_customers_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """The exact reach, and whether the sketched one is within a twentieth or two customers of it."""
    rows, lines = launched(spark, folder), fact(spark, folder)
    exact = point_in_time.eligible_customers(rows, lines)
    estimate = point_in_time.eligible_customers_sketched(rows, lines).withColumnRenamed("eligible_customer_count", "estimate")
    gap = F.abs(F.col("estimate") - F.col("eligible_customer_count"))
    close = gap <= F.greatest(F.col("eligible_customer_count") * 0.05, F.lit(2.0))
    return exact.join(estimate, "product_id").select("product_id", "eligible_customer_count", close.alias("is_close"))


def point_in_time_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = launched(spark, folder)
    return rounded(point_in_time.point_in_time_features(rows, rows, fact(spark, folder), DEMAND))


def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run, from nested raw orders to the written feature table."""
    run = features.create_and_save_features(
        spark,
        scratch_path(spark, "demand-run"),
        DEMAND,
        orders=adapters.raw_orders(spark, folder),
        vectors=adapters.product_vectors(spark, folder),
    )
    return rounded(run.features.drop("product_embedding"))


def new_product_features(spark: SparkSession, folder: str) -> DataFrame:
    """Every part announced under its list price on its launch date, as of that date."""
    announced = adapters.new_products(spark, folder)
    return rounded(
        features.new_product_features(
            announced,
            launched(spark, folder),
            fact(spark, folder),
            DEMAND,
            vectors=adapters.product_vectors(spark, folder),
            first=_first(spark, folder),
        ).drop("product_embedding")
    )


# Preparation --------------------------------------------------------------------------


def chronological_split(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).select("product_id", "launch_date", "dataset_split")


def _train(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).filter(F.col("dataset_split") == "train")


def scaler_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(preprocess.scaler_stats(_train(spark, folder)))


def standardised_features(spark: SparkSession, folder: str) -> DataFrame:
    fitted = preprocess.Preprocessor.fit(_train(spark, folder))
    logged = {f"log_{t}": numeric.to_log_target(F.col(t)) for t in TARGETS}
    scaled = fitted.standardised(_split(spark, folder)).withColumns(logged)
    return rounded(scaled.select("product_id", *NUMERIC_FEATURES, *logged), 4)


def category_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    train = _train(spark, folder)
    both = [
        preprocess.vocabulary(train, c).select(F.lit(c).alias("feature"), "value", "id")
        for c in ("brand", "functional_category")
    ]
    return both[0].unionByName(both[1])


def encoded_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Brand and category ids of all products by the train split's vocabularies."""
    fitted = preprocess.Preprocessor.fit(_train(spark, folder))
    names = ("brand", "functional_category")
    return fitted.encoded(_split(spark, folder)).select("product_id", *names, *[f"{c}_id" for c in names])


# Transactions -------------------------------------------------------------------------


def transaction_features(spark: SparkSession, folder: str) -> DataFrame:
    encoded = transactions.encode(_transactions(spark, folder))
    return rounded(encoded.select("transaction_id", *transactions.MODEL_INPUTS, "is_fraud"))


def transaction_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(tables.load_profile(_transactions(spark, folder), "is_fraud"))


def transaction_validation(spark: SparkSession, folder: str) -> DataFrame:
    checked = transactions.validate(_transactions(spark, folder))
    return checked.select("transaction_id", "is_valid", F.concat_ws(",", "failed").alias("failed"))


def transaction_reasons(spark: SparkSession, folder: str) -> DataFrame:
    explained = transactions.explain(transactions.encode(_transactions(spark, folder)))
    return explained.select(
        "transaction_id",
        "part_of_day",
        "weekday",
        "amount_level",
        F.concat_ws("; ", "reasons").alias("reasons"),
    )


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """A given score: the share of amount in amount + mean amount, in whole thousandths."""
    amount, mean = (F.round(F.col(c) * 100).cast("bigint") for c in ("amount", "avg_txn_amount"))
    p = F.floor(1000 * amount / (amount + mean + 100)) / F.lit(1000.0)
    return (
        _transactions(spark, folder)
        .withColumn("probability_fraud", p)
        .withColumn("predicted", (p >= 0.5).cast("int"))
    )


def transaction_risk(spark: SparkSession, folder: str) -> DataFrame:
    judged = transactions.judge(_scored(spark, folder))
    return judged.select("transaction_id", "prediction", "confidence", "risk_level")


def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    split = ranks.stratified_split(
        _transactions(spark, folder), "is_fraud", "transaction_id", FOREST.test_fraction, FOREST.seed
    )
    return split.select("transaction_id", "is_fraud", "dataset_split")


def seeded_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    """Both classes put together again, then shuffled."""
    rows = _transactions(spark, folder).select("transaction_id", "is_fraud")
    both = rows.filter(F.col("is_fraud") == 0).unionByName(rows.filter(F.col("is_fraud") == 1))
    return ranks.seeded_shuffle(both, "transaction_id", FOREST.seed)


def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The five first training rows in seeded order."""
    shuffled = ranks.seeded_shuffle(_train(spark, folder).select("product_id", "product_name"), "product_id", 42)
    return shuffled.orderBy("position").limit(5)


# Evaluation ---------------------------------------------------------------------------


def _forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """A persistence forecast: each month repeats the one before, the first is a third of all."""
    rows = launched(spark, folder).filter(F.col("m3_qty").isNotNull())
    return rows.select(
        "product_id",
        "launch_date",
        (F.col("qty_90d") / 3).alias("prediction_m1"),
        F.col("m1_qty").alias("prediction_m2"),
        F.col("m2_qty").alias("prediction_m3"),
        *[F.col(t.removeprefix("target_")).alias(t) for t in TARGETS],
    )


def forecast_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.flat_metrics(metrics.forecast_metrics(_forecasts(spark, folder))))


def _evaluations(spark: SparkSession, folder: str) -> DataFrame:
    """One evaluation run per launch month."""
    monthly = _forecasts(spark, folder).withColumn("run_id", F.date_format("launch_date", "yyyy-MM"))
    return (
        metrics.forecast_metrics(monthly, ("run_id",))
        .filter(F.col("horizon") == metrics.TOTAL_HORIZON)
        .select(
            "run_id",
            F.to_timestamp(F.concat("run_id", F.lit("-01"))).alias("evaluated_at"),
            F.lit(TRAINING.selection_metric).alias("selection_metric"),
            F.col("wape").alias("selection_metric_value"),
        )
    )


def champion_history(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions over one log with two metrics, read in both directions."""
    wape = _evaluations(spark, folder)
    negated = -F.col("selection_metric_value")
    log = wape.unionByName(wape.withColumns({"selection_metric": F.lit("negated"), "selection_metric_value": negated}))
    both = [champion.champion_history(log, d).withColumn("lower_is_better", F.lit(d)) for d in (True, False)]
    return rounded(both[0].unionByName(both[1]))


def latest_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(champion.latest_evaluation(_evaluations(spark, folder)))


def class_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.class_report(_scored(spark, folder), "is_fraud", "predicted"))


def classifier_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.classifier_summary(_scored(spark, folder), "is_fraud", "predicted"))


def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.roc_auc(_scored(spark, folder), "is_fraud", "probability_fraud"))


# Models and streams: rows and rule columns are checked by SQL, model figures as facts ----


def _level_agrees() -> Column:
    level, c = F.col("risk_level"), F.col("confidence")
    high, low = (level == "HIGH") & (c >= 70), (level == "LOW") & (c <= 40)
    return high | low | ((level == "MEDIUM") & c.between(40, 70))


def _score_facts(scored: DataFrame, *columns: str) -> DataFrame:
    """Given columns, reasons, and what must hold for every score."""
    return scored.select(
        "transaction_id",
        *columns,
        F.concat_ws("; ", "reasons").alias("reasons"),
        F.col("prediction").isin("FRAUD", "LEGITIMATE").alias("is_verdict"),
        F.col("confidence").between(0, 100).alias("is_confidence"),
        _level_agrees().alias("level_agrees"),
    )


def _forecast_facts(scored: DataFrame, *more: Column) -> DataFrame:
    months = [F.col(f"prediction_{h}") for h in metrics.HORIZONS]
    total = F.abs(sum(months, F.lit(0.0)) - F.col("prediction_3m_total"))
    return scored.select(
        "product_id",
        (F.least(*months) >= 0).alias("is_forecast"),
        (total <= 1e-6 * F.greatest(F.col("prediction_3m_total"), F.lit(1.0))).alias("adds_up"),
        *more,
    )


def _risk_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = _transactions(spark, folder)
    return ranks.stratified_split(rows, "is_fraud", "transaction_id", FOREST.test_fraction, FOREST.seed)


def _risk_model(spark: SparkSession, folder: str):
    """Fitted on the train split, saved and loaded."""

    def fit():
        train = transactions.encode(_risk_split(spark, folder).filter(F.col("dataset_split") == "train"))
        path = scratch_path(spark, "risk-model")
        training.fit_risk_model(train, FOREST).write().overwrite().save(path)
        return training.load_risk_model(path)

    return _fitted(spark, folder, "risk-model", fit)


def _demand_model(spark: SparkSession, folder: str):
    """Fitted on the train split, and the split table."""
    return _fitted(spark, folder, "demand-model", lambda: training.run_training(_features(spark, folder), TRAINING))


def fraud_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Forest fitted on the train split, saved, loaded, applied to the test split."""
    test = _risk_split(spark, folder).filter(F.col("dataset_split") == "test")
    return _score_facts(training.score_transactions(test, _risk_model(spark, folder)), "is_fraud")


def risk_model_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows, and whether the forest reaches the published accuracy and 0.92 area under the curve on them."""
    _, scored = training.train_risk_model(_transactions(spark, folder), FOREST)
    scored = materialise(scored, "risk-scores")
    auc = metrics.roc_auc(scored, "is_fraud", "probability_fraud").first()[0]
    return metrics.classifier_summary(scored, "is_fraud", "predicted").select(
        F.lit(scored.count()).alias("test_rows"),
        (F.col("accuracy") >= 0.92).alias("accuracy_reached"),
        F.lit(auc >= 0.92).alias("auc_reached"),
    )


def demand_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Models of the three months fitted on the train split, applied to the test split."""
    model, split = _demand_model(spark, folder)
    return _forecast_facts(model.predict(split.filter(F.col("dataset_split") == "test")))


def training_history(spark: SparkSession, folder: str) -> DataFrame:
    """Per horizon: whether every epoch has its losses, the kept one is the best, and the train loss fell."""
    model, _ = _demand_model(spark, folder)
    steps = training.training_history(spark, model)
    first, last = (f("train_loss", "epoch") for f in (F.min_by, F.max_by))
    kept = F.min(F.when(F.col("kept"), F.col("validation_loss")))
    return steps.groupBy("horizon").agg(
        (F.count(F.lit(1)) == F.max("epoch")).alias("all_epochs"),
        (F.count_if(F.col("train_loss").isNull() | F.col("validation_loss").isNull()) == 0).alias("all_losses"),
        (kept <= F.min("validation_loss") + TRAINING.tolerance).alias("best_is_kept"),
        (F.max("epoch") - F.max(F.when(F.col("kept"), F.col("epoch"))) <= TRAINING.patience).alias("patient"),
        (last <= first + 1e-9).alias("loss_fell"),
    )


def demand_model_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Three-month error of forecasts without a model on the test rows, and whether the model's is below that of none.

    The forecasts: nothing at all, and the train median of every month. The given demand is drawn without regard
    to the features, so the model is not asked to be below the median.
    """
    model, split = _demand_model(spark, folder)
    months = [F.col(t) for t in TARGETS]
    actual = sum(months, F.lit(0.0))
    # Three numbers come to the driver.
    medians = split.filter(F.col("dataset_split") == "train").agg(*[F.median(m) for m in months]).first()
    test = model.predict(split.filter(F.col("dataset_split") == "test"))

    def wape(guess: Column) -> Column:
        return F.sum(F.abs(actual - guess)) / F.greatest(F.sum(F.abs(actual)), F.lit(1e-9))

    below = wape(F.col("prediction_3m_total")) < wape(F.lit(0.0))
    guesses = {"nothing": 0.0, "train median": float(sum(medians))}
    entries = [F.struct(F.lit(n).alias("forecast"), wape(F.lit(g)).alias("wape"), below.alias("model_below_nothing")) for n, g in guesses.items()]
    return rounded(test.agg(F.array(*entries).alias("x")).select(F.inline("x")))


def evaluation_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs' whole evaluation rows appended to a log and read back, metric by metric."""
    path = scratch_path(spark, "evaluations")
    forecasts = _forecasts(spark, folder)
    early = F.col("launch_date") < F.lit("1996-01-01").cast("date")
    for run_id, rows in (("early", forecasts.filter(early)), ("late", forecasts.filter(~early))):
        tables.append_table(training.evaluation_row(metrics.forecast_metrics(rows), run_id, TRAINING), path)
    log = tables.read_evolving(spark, path).filter(F.col("evaluated_at").isNotNull())
    long = log.select("run_id", "selection_metric", "selection_metric_value", F.explode("metrics").alias("horizon", "m"))
    measures = [F.col("m")[n].alias(n) for n in ("mae", "rmse", "wape")]
    return rounded(long.select("run_id", "selection_metric", "selection_metric_value", "horizon", *measures))


def published_run(spark: SparkSession, folder: str) -> DataFrame:
    """The split tables of the latest of two published runs, counted as the run's row says."""
    root = scratch_path(spark, "published-runs")
    model, split = _demand_model(spark, folder)
    days = [datetime(2020, 1, d) for d in (1, 2)]
    runs.publish(model, split.limit(3), root, "first", days[0], TRAINING.loss)
    runs.publish(model, split, root, "second", days[1], TRAINING.loss)
    last = runs.latest_run(spark, root).first()["run_id"]
    row = runs.published_runs(spark, root).filter(F.col("run_id") == last)
    said = row.select(F.inline(F.array(*[F.struct(F.lit(s).alias("dataset_split"), F.col(f"{s}_rows").alias("said")) for s in runs.SPLITS])))
    found = runs.read_splits(spark, root, last).groupBy("dataset_split").agg(F.count(F.lit(1)).alias("products"))
    return found.join(said, "dataset_split").select(F.lit(last).alias("run_id"), "dataset_split", "products", "said")


def _predict_announced(spark: SparkSession, folder: str, announced: DataFrame) -> DataFrame:
    model, _ = _demand_model(spark, folder)
    known, first = adapters.product_vectors(spark, folder), _first(spark, folder)
    return training.predict_announced(
        announced, model, launched(spark, folder), fact(spark, folder), DEMAND, vectors=known, first=first
    )


def appended_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """All announced parts, predicted by the fitted model and appended to a log twice over."""
    model, _ = _demand_model(spark, folder)
    log, announced = scratch_path(spark, "prediction-log"), adapters.new_products(spark, folder)
    training.append_predictions(
        announced, model, launched(spark, folder), fact(spark, folder), DEMAND, log,
        adapters.product_vectors(spark, folder), first=_first(spark, folder),
    )
    return _forecast_facts(tables.read_evolving(spark, log))


def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    return champion.latest_run(_evaluations(spark, folder).withColumnRenamed("evaluated_at", "started_at"))


def stream_transaction_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All transactions as a stream, scored as they arrive by a model of the train split."""
    rows = _transactions(spark, folder)
    feed = scratch_path(spark, "transaction-feed")
    tables.overwrite_table(rows, feed)
    out = scratch_path(spark, "transaction-scores")
    stream = scoring.parquet_stream(spark, feed, rows.schema)
    scoring.score_transaction_stream(
        stream, _risk_model(spark, folder), out, scratch_path(spark, "transaction-offsets"), available_now=True
    ).awaitTermination()
    return _score_facts(tables.read_table(spark, out))


def stream_product_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All announced parts as a stream, scored against the launch history, next to the batch's scores row by row."""
    announced = adapters.new_products(spark, folder)
    feed = scratch_path(spark, "product-feed")
    tables.overwrite_table(announced, feed)
    out = scratch_path(spark, "product-scores")
    scoring.score_product_stream(
        scoring.parquet_stream(spark, feed, NEW_PRODUCTS),
        lambda batch: _predict_announced(spark, folder, batch),
        out,
        scratch_path(spark, "product-offsets"),
        available_now=True,
    ).awaitTermination()
    streamed = tables.read_evolving(spark, out)
    batch = _predict_announced(spark, folder, announced).select("product_id", F.col("prediction_3m_total").alias("batch_total"))
    both = streamed.join(batch, "product_id", "full")
    gap = F.abs(F.col("prediction_3m_total") - F.col("batch_total"))
    same = F.coalesce(gap <= 1e-6 * F.greatest(F.col("batch_total"), F.lit(1.0)), F.lit(False))
    return _forecast_facts(both, same.alias("as_batch"))


ALL: tuple[Query, ...] = (
    launch_month_demand,
    order_lines_from_orders,
    order_lines_from_sales,
    order_lines_union,
    transactions_csv,
    split_tables,
    appended_evaluations,
    title_features,
    vector_expressions,
    title_vectors,
    target_transform,
    product_history,
    similar_products_topk,
    matured_similar_products,
    analog_features,
    earlier_launch_stats,
    category_demand,
    eligible_customers,
    point_in_time_features,
    feature_matrix,
    new_product_features,
    chronological_split,
    scaler_stats,
    standardised_features,
    category_vocabulary,
    encoded_categories,
    transaction_features,
    transaction_profile,
    transaction_validation,
    transaction_reasons,
    transaction_risk,
    stratified_split,
    seeded_shuffle,
    sample_rows,
    forecast_metrics,
    champion_history,
    latest_evaluation,
    class_report,
    classifier_summary,
    roc_auc,
    fraud_scores,
    risk_model_quality,
    demand_forecast,
    training_history,
    demand_model_quality,
    evaluation_log,
    published_run,
    title_idf_weights,
    eligible_customers_sketched,
    appended_predictions,
    latest_run,
    stream_transaction_scores,
    stream_product_scores,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in ALL}
