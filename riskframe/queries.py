"""The registered queries: every operator over the driver's whole tables.

Each takes (spark, folder of parquet tables). Doubles are rounded so that engines
that sum in another order agree; features are rounded before they are binned, so
that a value on an edge falls into the same bin everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions import scalars as S
from riskframe.functions import sql
from riskframe.functions.columns import (
    nans_to_nulls,
    numeric_columns,
    replace_columns,
    round_doubles,
    string_columns,
)
from riskframe.operators import binning, distribution, label, metrics, profile, split
from riskframe.operators import features as feat
from riskframe.operators.classifiers import FOREST, GBT, LOGISTIC, assembler, grid_points, predict
from riskframe.operators.kmeans import UNIT
from riskframe.operators.quantiles import quantile_table
from riskframe.operators.scale import standardize
from riskframe.operators.winsorize import NOT_CAPPED, winsorize_iqr
from riskframe.operators.woe import WoeEncoder
from riskframe.plans.build import fit_encoding, with_aggregation
from riskframe.plans.score import score_payloads, score_transactions
from riskframe.plans.train import fit_family, scored, training_set
from riskframe.schema import AMOUNT, CUSTOMER_ID, FEATURES, FRAUD, LABEL, RFM, START_TIME
from riskframe.session import stage
from riskframe.sources.adapters import (
    tx_events,
    tx_events_bad_dates,
    tx_events_dates,
    tx_orders,
    tx_orders_missing,
    tx_orders_nan,
)
from riskframe.sources.files import kind_of, merged_type
from riskframe.sources.payloads import explode_payloads, rejected_payloads, to_payloads

Query = Callable[[SparkSession, str], DataFrame]
# Amounts run to millions, so the last digits of a double are noise there.
AMOUNT_DIGITS = 4
DIGITS = 6
NUDGE = 1e-9

# Centroids in scaled (recency, frequency, monetary); cluster 0 is risky.
CENTROIDS = {0: (2.0, -1.0, -0.8), 1: (-0.2, -0.4, -0.4), 2: (-0.3, 1.0, 1.0)}

# Requests are made of so many events by one task: a task's time then is the same at every size.
EVENTS_PER_TASK = 25_000

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def rounded(df: DataFrame, digits: int = AMOUNT_DIGITS) -> DataFrame:
    return round_doubles(df, digits, NUDGE)


# --- shared inputs ----------------------------------------------------------


def labelled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, features, RFM, cluster and label by the fixed centroids.

    All of it is an expression over the stored grouping of the transactions.
    """
    customers = rounded(feat.features_and_rfm(tx_orders(spark, sf_dir)))
    return label.flag_high_risk(fixed_clusters(customers)).drop(*label.SCALED)


def fixed_clusters(rfm_table: DataFrame) -> DataFrame:
    scaled = label.scaled_rfm(rfm_table)
    scaled = replace_columns(scaled, {c: f"round({c}, {DIGITS})" for c in label.SCALED})
    return label.assign_cluster(scaled, CENTROIDS)


def features_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_customers(spark, sf_dir).select(CUSTOMER_ID, *FEATURES, LABEL)


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three made models: scores are a hash of the customer, moved up for the label."""
    made = []
    for i, (name, lift) in enumerate((("plain", 0.2), ("strong", 0.4), ("weak", 0.0))):
        uniform = f"cast(conv(substring(md5({CUSTOMER_ID}), {4 * i + 1}, 4), 16, 10) as double) / 65535"
        score = f"round({uniform}, 2) + if(label = 1, {lift}D, 0D)"
        made.append(f"struct('{name}' as model, round(least({score}, 1D), 2) as score)")
    return (
        labelled_customers(spark, sf_dir)
        .select(CUSTOMER_ID, F.col(LABEL).alias("label"))
        .selectExpr(CUSTOMER_ID, "label", f"inline(array({', '.join(made)}))")
        .selectExpr("*", "int(score >= 0.5D) as prediction")
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event transactions as JSON requests; some cut short, emptied, or missing a field."""
    events = tx_events(spark, sf_dir)
    packed = to_payloads(events, tasks=max(1, -(-events.count() // EVENTS_PER_TASK)))
    parts = F.split("request_id", "-")
    number = parts[0].cast("bigint") + parts[1].cast("bigint")
    body = F.col("payload")
    return packed.withColumn(
        "payload",
        F.when(number % 13 == 0, F.substring(body, F.lit(1), F.length(body) - 2))
        .when(number % 17 == 1, F.replace(body, F.lit('"Amount":'), F.lit('"Amt":')))
        .when(number % 19 == 2, F.lit("[]"))
        .otherwise(body),
    )


# --- sources, projection, scalar functions ----------------------------------


@query
def payload_explode(spark, sf_dir):
    exploded = explode_payloads(requests(spark, sf_dir))
    return feat.with_timestamp(exploded)


@query
def payload_rejects(spark, sf_dir):
    return rejected_payloads(requests(spark, sf_dir))


@query
def inferred_types(spark, sf_dir):
    """The types a reader finds for the transactions as text, from all rows."""
    tx = tx_orders_missing(spark, sf_dir)
    texts = tx.select(*[F.col(c).cast("string").alias(c) for c in tx.columns])
    kinds = [F.struct(F.lit(c).alias("column"), F.expr(kind_of(c)).alias("kind")) for c in tx.columns]
    merged = texts.select(F.inline(F.array(*kinds))).groupBy("column").agg(F.bit_or("kind").alias("kinds"))
    names = [x for k in range(16) for x in (F.lit(k), F.lit(merged_type(k)))]
    return merged.select("column", F.create_map(*names)[F.col("kinds")].alias("type"))


@query
def drop_columns(spark, sf_dir):
    return tx_orders(spark, sf_dir).drop(FRAUD)


@query
def numeric_projection(spark, sf_dir):
    tx = tx_orders(spark, sf_dir)
    return tx.select("TransactionId", *numeric_columns(tx, NOT_CAPPED))


@query
def string_projection(spark, sf_dir):
    tx = tx_orders(spark, sf_dir)
    return tx.select(*string_columns(tx))


@query
def lenient_timestamps(spark, sf_dir):
    tx = feat.with_timestamp(tx_events_bad_dates(spark, sf_dir))
    return tx.select("TransactionId", START_TIME)


@query
def dropped_timestamps(spark, sf_dir):
    """How many rows the lenient reading of times loses."""
    return feat.undated_rows(tx_events_bad_dates(spark, sf_dir))


@query
def timestamp_parts(spark, sf_dir):
    return tx_events(spark, sf_dir).select(
        "TransactionId",
        S.hour(START_TIME).alias("hour"),
        S.day(START_TIME).alias("day"),
        S.month(START_TIME).alias("month"),
        S.year(START_TIME).alias("year"),
    )


@query
def elapsed_days(spark, sf_dir):
    """Whole days from each transaction to the day after the last one of all."""
    tx = tx_events(spark, sf_dir).select("TransactionId", START_TIME)
    last = tx.agg(S.plus_one_day(F.max(START_TIME)).alias("_snapshot"))
    return tx.crossJoin(F.broadcast(last)).select(
        "TransactionId", S.elapsed_days(START_TIME, "_snapshot").alias("days")
    )


@query
def clamp_values(spark, sf_dir):
    tx = tx_orders_missing(spark, sf_dir)
    return tx.select("TransactionId", S.clamp(AMOUNT, 50_000, 300_000).alias(AMOUNT))


@query
def fill_missing(spark, sf_dir):
    tx = tx_orders_missing(spark, sf_dir)
    return tx.select(
        "TransactionId",
        S.fill(AMOUNT, 0.0).alias(AMOUNT),
        S.as_category("ProductCategory").alias("ProductCategory"),
    )


# --- customers ---------------------------------------------------------------


@query
def customer_features(spark, sf_dir):
    return rounded(feat.customer_features(tx_orders(spark, sf_dir)))


@query
def customer_features_hours(spark, sf_dir):
    return rounded(feat.customer_features(tx_events(spark, sf_dir)))


@query
def customer_features_gaps(spark, sf_dir):
    """Features where amounts, categories and customers are missing."""
    return rounded(feat.customer_features(tx_orders_missing(spark, sf_dir)))


@query
def customer_features_lenient(spark, sf_dir):
    """Features where some times cannot be read."""
    return rounded(feat.customer_features(tx_events_bad_dates(spark, sf_dir)))


@query
def customer_features_formats(spark, sf_dir):
    """Features of transactions whose times are written day first."""
    tx = tx_events_dates(spark, sf_dir)
    return rounded(feat.customer_features(tx, formats=["dd/MM/yyyy HH:mm:ss"]))


@query
def customer_target_max(spark, sf_dir):
    tx = tx_orders(spark, sf_dir)
    return rounded(feat.customer_features(tx, target_col=FRAUD))


@query
def rfm(spark, sf_dir):
    return rounded(feat.rfm(tx_orders(spark, sf_dir)))


@query
def features_and_rfm(spark, sf_dir):
    return rounded(feat.features_and_rfm(tx_orders_missing(spark, sf_dir)))


@query
def latest_transaction(spark, sf_dir):
    return tx_orders(spark, sf_dir).agg(F.max(START_TIME).alias("latest"))


@query
def first_per_customer(spark, sf_dir):
    return feat.first_per_customer(tx_orders_missing(spark, sf_dir))


@query
def align_features_label(spark, sf_dir):
    """Inner join of features with a label that only part of the customers have."""
    table = labelled_customers(spark, sf_dir)
    known = table.select(CUSTOMER_ID, LABEL).filter(F.col(CUSTOMER_ID).cast("bigint") % 7 != 0)
    return split.align(table.select(CUSTOMER_ID, *FEATURES), known)


@query
def attach_label(spark, sf_dir):
    table = labelled_customers(spark, sf_dir)
    known = table.select(CUSTOMER_ID, LABEL).filter(F.col(CUSTOMER_ID).cast("bigint") % 7 != 0)
    return split.attach_label(table.select(CUSTOMER_ID, *FEATURES), known)


# --- profiles ----------------------------------------------------------------


@query
def table_shape(spark, sf_dir):
    return profile.table_shape(tx_orders(spark, sf_dir))


@query
def first_rows(spark, sf_dir):
    tx = tx_orders(spark, sf_dir).withColumn("_key", F.col("TransactionId").cast("bigint"))
    return profile.first_rows(tx, ["_key"]).drop("_key")


@query
def column_info(spark, sf_dir):
    return profile.column_info(tx_orders_missing(spark, sf_dir))


@query
def describe_numeric(spark, sf_dir):
    return rounded(profile.describe_numeric(tx_orders_missing(spark, sf_dir)))


@query
def describe_numeric_nan(spark, sf_dir):
    """The same where missing amounts are NaN."""
    return rounded(profile.describe_numeric(tx_orders_nan(spark, sf_dir)))


@query
def quantiles_nan(spark, sf_dir):
    tx = tx_orders_nan(spark, sf_dir)
    return rounded(quantile_table(tx, [AMOUNT, "Value"], [0.05, 0.25, 0.5, 0.75, 0.95]))


@query
def winsorize_nan(spark, sf_dir):
    capped = winsorize_iqr(tx_orders_nan(spark, sf_dir))
    return rounded(nans_to_nulls(capped.select("TransactionId", AMOUNT, "Value")))


@query
def describe_capped(spark, sf_dir):
    """The profile of the numeric columns after capping."""
    return rounded(profile.describe_numeric(winsorize_iqr(tx_events(spark, sf_dir))))


@query
def describe_categorical(spark, sf_dir):
    return profile.describe_categorical(tx_orders_missing(spark, sf_dir))


@query
def missing_report(spark, sf_dir):
    return rounded(profile.missing_report(tx_orders_missing(spark, sf_dir)), DIGITS)


@query
def missing_pattern(spark, sf_dir):
    return profile.missing_pattern(tx_orders_missing(spark, sf_dir))


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(tx_orders_missing(spark, sf_dir))


@query
def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(tx_orders_missing(spark, sf_dir)), DIGITS)


@query
def redundant_pairs(spark, sf_dir):
    """Correlated pairs among the customer features."""
    table = stage(feat.customer_features(tx_orders(spark, sf_dir)), "customers")
    return rounded(profile.redundant_pairs(table.select(*FEATURES), threshold=0.5), DIGITS)


@query
def constant_columns(spark, sf_dir):
    return profile.constant_columns(tx_orders(spark, sf_dir))


@query
def class_balance(spark, sf_dir):
    return rounded(profile.class_balance(tx_orders(spark, sf_dir), FRAUD), DIGITS)


@query
def quantiles(spark, sf_dir):
    tx = tx_orders_missing(spark, sf_dir)
    found = quantile_table(
        tx, [AMOUNT, "Value", "PricingStrategy"], [0.05, 0.25, 0.5, 0.75, 0.95]
    )
    return rounded(found)


@query
def boxplot_stats(spark, sf_dir):
    return rounded(profile.boxplot_stats(tx_orders_missing(spark, sf_dir)))


@query
def histogram(spark, sf_dir):
    return rounded(distribution.histogram(tx_orders_missing(spark, sf_dir)))


@query
def kde(spark, sf_dir):
    """Curves, and the density as a share of what its bandwidth allows."""
    curves = distribution.kde(tx_orders_missing(spark, sf_dir))
    return rounded(curves.withColumn("density", F.col("density") * 1e6))


# --- capping, bins, weight of evidence, scaling -------------------------------


@query
def winsorize(spark, sf_dir):
    capped = winsorize_iqr(tx_events(spark, sf_dir))
    return rounded(capped.select("TransactionId", AMOUNT, "Value", "PricingStrategy", FRAUD))


@query
def bin_edges_quantile(spark, sf_dir):
    table = features_label(spark, sf_dir)
    return rounded(binning.edge_table(spark, binning.quantile_edges(table, FEATURES)))


@query
def bin_edges_uniform(spark, sf_dir):
    table = features_label(spark, sf_dir)
    return rounded(binning.edge_table(spark, binning.uniform_edges(table, FEATURES)))


@query
def assign_bin(spark, sf_dir):
    table = features_label(spark, sf_dir)
    edges = binning.quantile_edges(table, FEATURES)
    return binning.assign_bins(table, edges).drop(LABEL)


def _encoder(table: DataFrame):
    return WoeEncoder(inputCols=list(FEATURES), labelCol=LABEL).fit(table)


@query
def woe_fit(spark, sf_dir):
    return rounded(_encoder(features_label(spark, sf_dir)).table(), DIGITS)


@query
def woe_fit_categories(spark, sf_dir):
    """Transactions by category and channel against the fraud flag, gaps as a category."""
    tx = tx_orders_missing(spark, sf_dir)
    encoder = WoeEncoder(categoryCols=["ProductCategory", "ChannelId", "ProductId"], labelCol=FRAUD)
    return rounded(encoder.fit(tx).table(), DIGITS)


@query
def woe_transform(spark, sf_dir):
    table = features_label(spark, sf_dir)
    return rounded(_encoder(table).transform(table).drop(LABEL), DIGITS)


@query
def woe_transform_categories(spark, sf_dir):
    tx = tx_orders_missing(spark, sf_dir)
    names = ["ProductCategory", "ChannelId", "ProductId"]
    model = WoeEncoder(categoryCols=names, labelCol=FRAUD).fit(tx)
    return rounded(model.transform(tx.select("TransactionId", *names)), DIGITS)


@query
def standardized_features(spark, sf_dir):
    table = features_label(spark, sf_dir).drop(LABEL)
    return rounded(standardize(table, FEATURES), DIGITS)


@query
def model_features(spark, sf_dir):
    """Aggregation, weight of evidence and scaling in turn."""
    table = features_label(spark, sf_dir)
    return rounded(fit_encoding(table).transform(table).drop(LABEL), DIGITS)


# --- label --------------------------------------------------------------------


@query
def cluster_profile_fixed(spark, sf_dir):
    table = labelled_customers(spark, sf_dir)
    return rounded(label.cluster_profile(table))


@query
def high_risk_pick_fixed(spark, sf_dir):
    table = labelled_customers(spark, sf_dir)
    return rounded(table.select(CUSTOMER_ID, *RFM, "Cluster", LABEL))


@query
def high_risk_cluster_fixed(spark, sf_dir):
    """The cluster the three-key order puts first."""
    profiled = label.cluster_profile(labelled_customers(spark, sf_dir))
    return label.high_risk_cluster(profiled)


def _label_facts(table: DataFrame) -> DataFrame:
    """The label, and what must hold of it: the risky cluster is the one that the order of
    mean recency, frequency and monetary puts first."""
    risky = label.high_risk_cluster(label.cluster_profile(table)).withColumnRenamed("Cluster", "_risky")
    return table.crossJoin(F.broadcast(risky)).select(
        CUSTOMER_ID,
        *RFM,
        "Cluster",
        LABEL,
        F.col(LABEL).isin(0, 1).alias("label_is_binary"),
        ((F.col(LABEL) == 1) == (F.col("Cluster") == F.col("_risky"))).alias("label_is_risky_cluster"),
    )


@query
def high_risk_target(spark, sf_dir):
    table = stage(label.high_risk_target(tx_orders(spark, sf_dir)), "target")
    return rounded(_label_facts(table))


def _fitted_clusters(spark: SparkSession, sf_dir: str):
    scaled = label.scaled_rfm(stage(feat.rfm(tx_orders(spark, sf_dir)), "rfm"))
    return scaled, label.fit_kmeans(scaled)


@query
def kmeans_rfm(spark, sf_dir):
    """The clusters of the start that ended best: centres and their distances, every customer
    being nearest to its own."""
    scaled, fit = _fitted_clusters(spark, sf_dir)
    clustered = fit.transform(scaled, "_own")
    nearest = label.assign_cluster(clustered, fit.centres)
    found = nearest.groupBy(F.col("_own").alias("Cluster")).agg(
        F.count(F.lit(1)).alias("n_customers"),
        *[F.avg(s).alias(f"centre_{c.lower()}") for s, c in zip(label.SCALED, RFM)],
        (F.count_if(F.col("_own") == F.col("Cluster")) == F.count(F.lit(1))).alias("all_nearest"),
    )
    return rounded(found)


@query
def kmeans_starts(spark, sf_dir):
    """Where each start of the search for clusters ended, and which one was kept."""
    _, fit = _fitted_clusters(spark, sf_dir)
    rows = [
        (i, k, n, *[x / UNIT for x in centre], one.inertia / UNIT**2, i == fit.chosen)
        for i, one in enumerate(fit.starts)
        for k, (n, centre) in enumerate(zip(one.sizes, one.centres))
    ]
    columns = ", ".join(f"centre_{c.lower()} double" for c in RFM)
    made = spark.createDataFrame(
        rows, f"start int, Cluster int, n_customers bigint, {columns}, inertia double, chosen boolean"
    )
    return rounded(made)


# --- split, weights -------------------------------------------------------------


@query
def stratified_split(spark, sf_dir):
    table = labelled_customers(spark, sf_dir).select(CUSTOMER_ID, LABEL)
    return split.stratified_split(table)


@query
def stratified_split_whole(spark, sf_dir):
    """A test side of exactly the rounded-up share of all customers."""
    table = stage(labelled_customers(spark, sf_dir).select(CUSTOMER_ID, LABEL), "labelled")
    return split.stratified_split(table, shares="whole")


@query
def stratified_folds(spark, sf_dir):
    table = labelled_customers(spark, sf_dir).select(CUSTOMER_ID, LABEL)
    return split.stratified_folds(table)


@query
def class_counts(spark, sf_dir):
    return profile.class_counts(labelled_customers(spark, sf_dir), LABEL)


@query
def balanced_weights(spark, sf_dir):
    table = labelled_customers(spark, sf_dir).select(CUSTOMER_ID, LABEL)
    return rounded(split.balanced_weights(table), DIGITS)


# --- metrics --------------------------------------------------------------------


@query
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(stage(model_scores(spark, sf_dir), "scores")), DIGITS)


@query
def binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(model_scores(spark, sf_dir)), DIGITS)


@query
def classification_report(spark, sf_dir):
    return rounded(metrics.classification_report(model_scores(spark, sf_dir)), DIGITS)


@query
def model_comparison(spark, sf_dir):
    return rounded(metrics.model_comparison(stage(model_scores(spark, sf_dir), "scores")), DIGITS)


@query
def best_run(spark, sf_dir):
    """The comparison as run records, and the run that wins by AUC."""
    compared = metrics.model_comparison(stage(model_scores(spark, sf_dir), "scores"))
    names = ("roc_auc", *metrics.METRICS)
    entries = [x for m in names for x in (F.lit(m), F.col(m))]
    runs = compared.select(F.col("model").alias("run_name"), F.create_map(*entries).alias("metrics"))
    best = metrics.best_run(runs)
    return rounded(best.select("run_name", F.col("metrics")["roc_auc"].alias("roc_auc")), DIGITS)


# --- classifiers and scoring ------------------------------------------------------


def _encoded(spark: SparkSession, sf_dir: str):
    """Encoded features with the label, stored, and the encoding.

    Features and label are stored too: the fit goes over them several times.
    """
    table = stage(features_label(spark, sf_dir), "labelled")
    encoding = fit_encoding(table)
    return stage(encoding.transform(table), "encoded"), encoding


def _score_facts(scores: DataFrame, score: str, prediction: str) -> dict:
    """Scores are probabilities, and the prediction follows from them."""
    return {
        "scores_are_probabilities": F.coalesce(F.col(score).between(0, 1), F.lit(False)),
        "prediction_follows": F.coalesce((F.col(score) > 0.5) == (F.col(prediction) == 1), F.lit(False)),
    }


def _evaluated(spark: SparkSession, sf_dir: str, family, tuned: bool, measured: bool = False) -> DataFrame:
    """A fit with the library's grid and folds, and what must hold of its scores.

    ``measured`` adds the metrics themselves, which SQL can check where the fit is unique.
    """
    table, _ = _encoded(spark, sf_dir)
    data = training_set(table)
    grid = family.grid if tuned else None
    fitted = fit_family(data, family, tuned, grid, tasks=_tasks(data))
    scores = stage(scored([fitted], data.test), "scores")
    facts = _score_facts(scores, "score", "prediction")
    summary = scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sum("label").cast("long").alias("n_positive"),
        *[F.min(v).alias(k) for k, v in facts.items()],
    )
    better = metrics.roc_auc(scores).select("model", (F.col("roc_auc") > 0.5).alias("auc_above_half"))
    result = summary.join(better, "model")
    if measured:
        result = result.join(rounded(metrics.model_comparison(scores), DIGITS), "model")
    if tuned:
        axes = {k: sorted(map(str, v)) for k, v in grid.items()}
        chosen = all(str(fitted.params[k]) in v for k, v in axes.items())
        result = result.withColumns(
            {
                "n_points": F.lit(len(grid_points(grid))).cast("long"),
                "n_folds": F.lit(data.n_folds).cast("long"),
                "chosen_from_grid": F.lit(chosen),
                "cv_auc_above_half": F.lit(fitted.cv_roc_auc > 0.5),
            }
        )
    return result


@query
def fitted_model_comparison(spark, sf_dir):
    """The three baselines on the held-out customers: ROC AUC and metrics of each, in one table."""
    table, _ = _encoded(spark, sf_dir)
    data = training_set(table)
    models = [fit_family(data, family, False, tasks=_tasks(data)) for family in (LOGISTIC, FOREST, GBT)]
    return rounded(metrics.model_comparison(stage(scored(models, data.test), "scores")), DIGITS)


def _tasks(data) -> int:
    """One task per 20,000 training rows: many short passes go over them."""
    return max(1, -(-data.rows // 20_000))


@query
def logistic_baseline(spark, sf_dir):
    return _evaluated(spark, sf_dir, LOGISTIC, tuned=False, measured=True)


@query
def logistic_tuned(spark, sf_dir):
    return _evaluated(spark, sf_dir, LOGISTIC, tuned=True)


@query
def forest_baseline(spark, sf_dir):
    return _evaluated(spark, sf_dir, FOREST, tuned=False)


@query
def forest_tuned(spark, sf_dir):
    return _evaluated(spark, sf_dir, FOREST, tuned=True)


@query
def gbt_baseline(spark, sf_dir):
    return _evaluated(spark, sf_dir, GBT, tuned=False)


@query
def gbt_tuned(spark, sf_dir):
    return _evaluated(spark, sf_dir, GBT, tuned=True)


def _fitted_logistic(spark: SparkSession, sf_dir: str):
    from pyspark.ml import PipelineModel

    table, encoding = _encoded(spark, sf_dir)
    data = training_set(table)
    fitted = fit_family(data, LOGISTIC, tuned=False, tasks=_tasks(data))
    return data, fitted, with_aggregation(encoding, digits=AMOUNT_DIGITS), PipelineModel([assembler(), fitted.model])


@query
def class_probability(spark, sf_dir):
    """Every test customer with its label, its score, and what must hold of that."""
    data, fitted, _, _ = _fitted_logistic(spark, sf_dir)
    scores = predict(fitted.model, data.test, fitted.name, keep=[CUSTOMER_ID])
    facts = _score_facts(scores, "score", "prediction")
    return rounded(scores.withColumns(facts), DIGITS)


def _scored_facts(scores: DataFrame) -> DataFrame:
    return rounded(scores.withColumns(_score_facts(scores, "risk_probability", LABEL)), DIGITS)


@query
def score_transactions_batch(spark, sf_dir):
    """One score per customer."""
    _, _, encoder, classifier = _fitted_logistic(spark, sf_dir)
    scores = score_transactions(tx_orders(spark, sf_dir).drop(FRAUD), encoder, classifier)
    return _scored_facts(scores)


@query
def score_payloads_batch(spark, sf_dir):
    """One score per readable request and customer; ``requests`` says what a request holds."""
    _, _, encoder, classifier = _fitted_logistic(spark, sf_dir)
    return _scored_facts(score_payloads(requests(spark, sf_dir), encoder, classifier))
