"""The named queries over the test tables. Each takes (spark, directory)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise import config
from cartwise.functions.expressions import add_baby_age_feature
from cartwise.functions.quantiles import long_form, union_all
from cartwise.operators import (
    candidates,
    cleaning,
    eda,
    evaluation,
    features,
    models,
    ranking,
    reports,
    sampling,
    segments,
    submission,
)
from cartwise.operators.windows import lookback_window
from cartwise.plans import pipelines
from cartwise.plans import testdata as td
from cartwise.session import materialize, shared_folder
from cartwise.sources import artifacts, readers, schemas

Query = Callable[[SparkSession, str], DataFrame]

# A fixed linear scorer: keeps ranking and metrics independent of model fitting.
WEIGHTS = dict(
    zip(
        config.FEATURE_COLUMNS,
        (0.5, 0.25, 0.125, -0.001953125, 0.25, 1.0, 0.125)
        + (2.0, 0.0625, -0.5, 0.03125, -1.0, 0.015625),
        strict=True,
    )
)
SEGMENT_PATTERN = "PROMO"
AGE_GROUPS = [f"Step {i}" for i in range(1, 6)]
SAMPLE_METHOD = "multiplicative"
SUBMISSION_CUSTOMERS = 500
COVERAGE_CUT_OFFS = (50, 250, 1000)
BIRTH_REFERENCE = date(2001, 1, 1)

QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns rounded: sums of doubles depend on the order of addition."""
    return df.select(
        [F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _feature_table(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    d = td.load_domain(spark, sf_dir)
    return features.build_feature_label_table(
        d.transactions,
        d.items,
        d.users,
        td.BEGIN_HIST,
        td.END_HIST,
        td.BEGIN_RECENT,
        td.END_RECENT,
        **options,
    )


# The feature table and the predictions are tables that later steps read, as in
# the pipelines. They are written once per application and input directory.
_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def _staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = materialize(build(), name)
    return _STAGED[key]


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _cached_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/cache-{spark.sparkContext.applicationId}-{sf_dir.strip("/").replace("/", "-")}"
    return artifacts.features_cache(spark, path, lambda: _feature_table(spark, sf_dir, by_customer=True))


def staged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, stored by customer in parts of a bounded number of pairs: ranking
    sorts a part in memory and moves nothing."""
    key = (spark.sparkContext.applicationId, sf_dir, "features")
    if key not in _STAGED:
        _STAGED[key] = _cached_features(spark, sf_dir)
    return _STAGED[key]


def _scored(table: DataFrame, n_features: int = 13) -> DataFrame:
    weights = {c: WEIGHTS[c] for c in config.FEATURE_SETS[n_features]}
    return table.select("customer_id", "item_id", ranking.linear_score(weights).alias("score"))


def staged_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best items per customer."""

    def build() -> DataFrame:
        return ranking.rank_topk(_scored(staged_features(spark, sf_dir)), 20)

    return _staged(spark, sf_dir, "predictions", build)


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.load_domain(spark, sf_dir).recent.select("customer_id", "item_id").distinct()


def set_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(feature_count, metric, k, value)`` of the scorer on every ablation set."""

    def build() -> DataFrame:
        table, truth = staged_features(spark, sf_dir), _truth(spark, sf_dir)
        return union_all(
            [
                evaluation.evaluate_recommendations(_scored(table, n), truth).select(
                    F.lit(n).cast("long").alias("feature_count"), "metric", "k", "value"
                )
                for n in config.FEATURE_SETS
            ]
        )

    return _staged(spark, sf_dir, "set-metrics", build)


# --- sources ----------------------------------------------------------------


def _stored_history(spark, sf_dir) -> str:
    """The purchases of the test tables as a history laid out by month, with its own time column."""
    path = _new_folder(spark, "history")
    rows = td.load_domain(spark, sf_dir).transactions.withColumnRenamed("created_date", "created_at")
    readers.write_transactions(rows, path, "created_at")
    return path


@query("scan_transactions")
def scan_transactions(spark, sf_dir):
    return readers.load_transactions(spark, _stored_history(spark, sf_dir))


@query("scan_window")
def scan_window(spark, sf_dir):
    """The label window's rows: of a history laid out by month, its month alone is read."""
    path = _stored_history(spark, sf_dir)
    return readers.load_transactions(spark, path, begin=td.BEGIN_RECENT, end=td.END_RECENT)


def _stored_chunks(table: DataFrame, name: str) -> str:
    """A table as files of one folder, as an export leaves them; returns their glob."""
    return f"{materialize(table, name)._stored_at}/*.parquet"


@query("scan_items")
def scan_items(spark, sf_dir):
    return readers.load_items(spark, _stored_chunks(td.load_domain(spark, sf_dir).items, "items"))


@query("scan_users")
def scan_users(spark, sf_dir):
    return readers.load_users(spark, _stored_chunks(td.load_domain(spark, sf_dir).users, "users"))


@query("declared_schemas")
def declared_schemas(spark, sf_dir):
    # No order id in the source: the declared schema adds it as null.
    events = td.purchase_events(spark, sf_dir).drop("order_id")
    return schemas.conform(events, schemas.TRANSACTIONS, "transactions")


@query("load_table")
def load_table(spark, sf_dir):
    return readers.load_any_parquet(spark, "part", sf_dir)


@query("profile_table")
def profile_table(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    tables = {"transactions": d.transactions, "items": d.items, "users": d.users}
    return union_all([readers.profile_table(df, name) for name, df in tables.items()])


@query("explore_files")
def explore_files(spark, sf_dir):
    return readers.explore_files(spark, sf_dir).groupBy("table_name", "status").agg(
        F.sum("n_rows").alias("n_rows")
    )


@query("explore_dataset")
def explore_dataset(spark, sf_dir):
    return readers.explore_dataset(spark, sf_dir)


@query("explore_samples")
def explore_samples(spark, sf_dir):
    return readers.explore_samples(spark, sf_dir)


@query("features_cache")
def features_cache(spark, sf_dir):
    return features.class_balance(_cached_features(spark, sf_dir))


@query("predictions_io")
def predictions_io(spark, sf_dir):
    path = _new_folder(spark, "predictions_linear")
    artifacts.write_predictions(staged_predictions(spark, sf_dir), path)
    return artifacts.read_predictions(spark, path)


def _metrics_folder(spark, sf_dir) -> str:
    """One metrics file per feature set, written the way a training run writes them."""
    folder = _new_folder(spark, "metrics")
    names = {
        3: "metrics_3features",
        5: "metrics_5features",
        9: "metrics_9features",
        10: "metrics_without_history",
        13: "metrics_tuned",
    }
    table = set_metrics(spark, sf_dir)
    for n, name in names.items():
        rows = table.where(F.col("feature_count") == n).select("metric", "k", "value", "feature_count")
        artifacts.write_metrics(rows, f"{folder}/{name}")
    return folder


@query("metrics_io")
def metrics_io(spark, sf_dir):
    stored = artifacts.read_metrics(spark, f"{_metrics_folder(spark, sf_dir)}/metrics_*")
    return rounded(artifacts.feature_set_metrics(stored))


@query("latest_artifact")
def latest_artifact(spark, sf_dir):
    folder = _metrics_folder(spark, sf_dir)
    name = artifacts.latest_artifact(spark, folder, "metrics_")
    return rounded(artifacts.read_metrics(spark, f"{folder}/{name}").drop("feature_count"))


@query("metric_curves")
def metric_curves(spark, sf_dir):
    stored = artifacts.read_metrics(spark, f"{_metrics_folder(spark, sf_dir)}/metrics_*")
    return rounded(reports.metric_curves(stored))


@query("ground_truth_pairs")
def ground_truth_pairs(spark, sf_dir):
    # One entry per purchase of the label window, in the three forms that occur:
    # a list, a list in a list, and a bare text that is no list.
    recent = td.load_domain(spark, sf_dir).recent
    item = F.col("item_id").cast("string")
    form = F.pmod("order_id", F.lit(3))
    items = (
        F.when(form == 0, F.concat(F.lit("["), item, F.lit("]")))
        .when(form == 1, F.concat(F.lit("[["), item, F.lit("],[-1]]")))
        .otherwise(F.concat(F.lit('"'), item, F.lit('"')))
    )
    return evaluation.ground_truth_pairs(recent.select("customer_id", items.alias("items")))


@query("ground_truth_from_label")
def ground_truth_from_label(spark, sf_dir):
    return features.ground_truth_from_label(_feature_table(spark, sf_dir))


# --- sampling, windows, cleaning --------------------------------------------


@query("time_window")
def time_window(spark, sf_dir):
    return td.load_domain(spark, sf_dir).hist


@query("hash_sample")
def hash_sample(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    return sampling.hash_sample(d.transactions, method=SAMPLE_METHOD)


@query("sample_customers")
def sample_customers(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    return sampling.sample_customers(d.transactions, method=SAMPLE_METHOD)


@query("sample_rows_cap")
def sample_rows_cap(spark, sf_dir):
    table = staged_features(spark, sf_dir).select("customer_id", "item_id", "Y")
    return sampling.sample_rows_cap(table, max_rows=10_000, method=SAMPLE_METHOD)


@query("restrict_customers")
def restrict_customers(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    return sampling.restrict_customers(d.hist, d.recent)


@query("clean_transactions")
def clean_transactions(spark, sf_dir):
    return cleaning.clean_transactions(td.load_domain(spark, sf_dir).transactions)


def _untidy_items(spark, sf_dir) -> DataFrame:
    """Items with gaps and copies, derived from the part table."""
    items = td.load_domain(spark, sf_dir).items
    gaps = items.select(
        F.when(F.col("item_id") % 97 != 0, F.col("item_id")).alias("item_id"),
        F.when(F.col("item_id") % 7 != 0, F.col("brand")).alias("brand"),
        F.when(F.col("item_id") % 11 != 0, F.col("age_group")).alias("age_group"),
        F.when(F.col("item_id") % 13 != 0, F.col("category")).alias("category"),
    )
    return gaps.unionByName(items.where("item_id % 5 = 0"))


@query("clean_items")
def clean_items(spark, sf_dir):
    return cleaning.clean_items(_untidy_items(spark, sf_dir))


@query("clean_users")
def clean_users(spark, sf_dir):
    users = td.load_domain(spark, sf_dir).users
    gaps = users.withColumn("customer_id", F.expr("nullif(customer_id % 1000, 0)"))
    return cleaning.clean_users(gaps)


# --- candidates -------------------------------------------------------------

_BASKET = ["customer_id", "order_id"]


@query("item_cooccurrence")
def item_cooccurrence(spark, sf_dir):
    return candidates.build_item_cooccurrence(td.load_domain(spark, sf_dir).hist, _BASKET)


@query("item_cooccurrence_by_customer")
def item_cooccurrence_by_customer(spark, sf_dir):
    # Baskets of a customer's whole history, blocks small enough to be used.
    hist = td.load_domain(spark, sf_dir).hist
    return candidates.build_item_cooccurrence(hist, ["customer_id"], block_items=8)


@query("candidates_from_cooc")
def candidates_from_cooc(spark, sf_dir):
    hist = td.load_domain(spark, sf_dir).hist
    pairs = candidates.build_item_cooccurrence(hist, _BASKET)
    bought = hist.select("customer_id", "item_id").distinct()
    return candidates.generate_candidates_from_cooc(bought, pairs)


def _generated(strategy: str) -> Query:
    def run(spark, sf_dir):
        d = td.load_domain(spark, sf_dir)
        return candidates.generate_candidates(
            d.transactions, d.items, d.users, td.OBSERVATION_DATE, strategy
        )

    return run


QUERIES["cand_user_history"] = _generated("user_history")
QUERIES["cand_popular"] = _generated("popular_items")
QUERIES["cand_category"] = _generated("category_based")
QUERIES["cand_hybrid"] = _generated("hybrid")


@query("generate_candidates")
def generate_candidates(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    return candidates.generate_candidates(
        d.transactions,
        d.items,
        d.users,
        td.OBSERVATION_DATE,
        lookback_days=300,
    )


@query("filter_already_purchased")
def filter_already_purchased(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    pairs = candidates.user_history_candidates(d.transactions, td.OBSERVATION_DATE, 90, 100)
    return candidates.filter_already_purchased(pairs, d.transactions, td.OBSERVATION_DATE)


@query("training_candidates")
def training_candidates(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    return features.training_candidates(d.hist, d.recent, d.items)


# --- features ---------------------------------------------------------------


@query("feat_age_months")
def feat_age_months(spark, sf_dir):
    return add_baby_age_feature(td.load_domain(spark, sf_dir).users, td.END_HIST)


@query("item_segment")
def item_segment(spark, sf_dir):
    items = td.load_domain(spark, sf_dir).items
    return segments.build_item_segment_step1(items, SEGMENT_PATTERN)


@query("customer_segment")
def customer_segment(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    item_segment = segments.build_item_segment_step1(d.items, SEGMENT_PATTERN)
    return segments.build_customer_segment_from_step1(d.hist, item_segment)


def _candidate_features(spark, sf_dir) -> DataFrame:
    d = td.load_domain(spark, sf_dir)
    # Read for the counts by item, the category sets and the maps: order lines are joined once.
    hist = materialize(d.hist, "history")
    pairs = features.training_candidates(hist, d.recent, d.items, by_customer=True)
    return features.candidate_features(pairs, hist, d.items)


QUERIES["candidate_features"] = _candidate_features


def _match_feature(column: str) -> Query:
    return lambda spark, sf_dir: _candidate_features(spark, sf_dir).select(
        "customer_id", "item_id", column
    )


QUERIES["x1_brand_cnt"] = _match_feature(config.FEATURE_COLUMNS[0])
QUERIES["x2_age_group_cnt"] = _match_feature(config.FEATURE_COLUMNS[1])
QUERIES["x3_category_cnt"] = _match_feature(config.FEATURE_COLUMNS[2])


def _customer_feature(build: Callable[[td.Domain], DataFrame], column: str) -> Query:
    return lambda spark, sf_dir: build(td.load_domain(spark, sf_dir)).select(
        "customer_id", column
    )


_X = dict(enumerate(config.FEATURE_COLUMNS, start=1))
QUERIES["x4_recency"] = _customer_feature(
    lambda d: features.recency_features(d.hist, td.END_HIST), _X[4]
)
QUERIES["x5_frequency"] = _customer_feature(lambda d: features.frequency_features(d.hist), _X[5])
QUERIES["x6_power_user"] = _customer_feature(lambda d: features.frequency_features(d.hist), _X[6])
QUERIES["x7_items_per_order"] = _customer_feature(
    lambda d: features.monetary_features(d.hist), _X[7]
)
QUERIES["x8_top_brand_ratio"] = _customer_feature(
    lambda d: features.brand_loyalty_features(d.hist, d.items), _X[8]
)
QUERIES["x9_brand_diversity"] = _customer_feature(
    lambda d: features.brand_loyalty_features(d.hist, d.items), _X[9]
)
QUERIES["x10_category_diversity"] = _customer_feature(
    lambda d: features.category_diversity_features(d.hist, d.items), _X[10]
)
QUERIES["x11_day_mode"] = _customer_feature(lambda d: features.temporal_features(d.hist), _X[11])
QUERIES["x12_new_customer"] = _customer_feature(
    lambda d: features.new_customer_features(d.hist), _X[12]
)
QUERIES["x13_avg_item_popularity"] = _customer_feature(
    lambda d: features.cold_start_features(d.hist, d.items), _X[13]
)


@query("x4_recency_intraday")
def x4_recency_intraday(spark, sf_dir):
    # Times of day: a purchase less than 24 hours before the end is 0 days old.
    events = td.purchase_events(spark, sf_dir)
    return features.recency_features(events, datetime(2024, 2, 15))


@query("label_y")
def label_y(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    pairs = features.training_candidates(d.hist, d.recent, d.items, by_customer=True)
    return features.label_candidates(pairs, d.recent)


@query("feature_table")
def feature_table(spark, sf_dir):
    return _feature_table(spark, sf_dir)


@query("feature_table_given_pairs")
def feature_table_given_pairs(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    pairs = candidates.user_history_candidates(d.transactions, td.END_RECENT, 120, 100)
    return _feature_table(spark, sf_dir, candidates=pairs)


@query("feature_subset")
def feature_subset(spark, sf_dir):
    return features.feature_subset(staged_features(spark, sf_dir), 5)


# --- models -----------------------------------------------------------------


@query("class_balance")
def class_balance(spark, sf_dir):
    return features.class_balance(staged_features(spark, sf_dir))


def _fit(kind: str, spark, sf_dir, params=None):
    table = staged_features(spark, sf_dir)
    return models.train_model(table, model_type=kind, model_params=params)


def _training(kind: str, params=None) -> Query:
    def run(spark, sf_dir):
        model = _fit(kind, spark, sf_dir, params)
        return models.predict_and_rank(model, staged_features(spark, sf_dir), top_k=10)

    return run


QUERIES["train_logistic"] = _training("logistic")
QUERIES["train_random_forest"] = _training("random_forest")
QUERIES["train_gbt_xgb"] = _training("xgboost")
QUERIES["train_gbt_lgbm"] = _training("lightgbm")
QUERIES["train_gbt_tuned"] = _training("lightgbm", models.TUNED_PARAMS)


@query("training_accuracy")
def training_accuracy(spark, sf_dir):
    model = _fit("logistic", spark, sf_dir)
    return models.training_accuracy(model, staged_features(spark, sf_dir))


@query("predict_scores")
def predict_scores(spark, sf_dir):
    return models.predict_scores(
        _fit("logistic", spark, sf_dir), staged_features(spark, sf_dir)
    )


@query("model_io")
def model_io(spark, sf_dir):
    path = _new_folder(spark, "model")
    models.save_model(_fit("logistic", spark, sf_dir), path)
    return models.predict_and_rank(
        models.load_model(path), staged_features(spark, sf_dir), top_k=5
    )


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return models.get_feature_importance(_fit("random_forest", spark, sf_dir))


@query("feature_importance_split")
def feature_importance_split(spark, sf_dir):
    """Inner nodes by feature, over a forest and boosted trees fitted on the feature table."""
    counted = []
    for kind, params in (("random_forest", None), ("xgboost", {"maxIter": 10})):
        path = _new_folder(spark, "model")
        models.save_model(_fit(kind, spark, sf_dir, params), path)
        counts = models.split_counts(models.tree_nodes(spark, path), config.FEATURE_COLUMNS)
        counted.append(counts.select(F.lit(kind).alias("model_type"), "feature", "n_splits"))
    return union_all(counted)


@query("train_all")
def train_all(spark, sf_dir):
    return pipelines.train_all(staged_features(spark, sf_dir))


@query("rank_topk")
def rank_topk(spark, sf_dir):
    return ranking.rank_topk(_scored(_feature_table(spark, sf_dir)), 10)


@query("rank_all")
def rank_all(spark, sf_dir):
    return ranking.rank_topk(_scored(staged_features(spark, sf_dir)))


@query("importance_pct")
def importance_pct(spark, sf_dir):
    # Importance of a feature: its absolute correlation with the label.
    table = staged_features(spark, sf_dir)
    one_row = table.agg(
        *[F.coalesce(F.abs(F.corr(c, "Y")), F.lit(0.0)).alias(c) for c in config.FEATURE_COLUMNS]
    )
    importance = long_form(one_row, list(config.FEATURE_COLUMNS)).select(
        F.col("metric").alias("feature"), F.round("value", 6).alias("importance")
    )
    return rounded(reports.importance_pct(importance))


# --- evaluation -------------------------------------------------------------


def _metric(fn) -> Query:
    return lambda spark, sf_dir: rounded(
        fn(staged_predictions(spark, sf_dir), _truth(spark, sf_dir), 10)
    )


QUERIES["precision_at_k"] = _metric(evaluation.precision_at_k)
QUERIES["recall_at_k"] = _metric(evaluation.recall_at_k)
QUERIES["ndcg_at_k"] = _metric(evaluation.ndcg_at_k)
QUERIES["map_at_k"] = _metric(evaluation.mean_average_precision_at_k)


@query("evaluate_recommendations")
def evaluate_recommendations(spark, sf_dir):
    return rounded(
        evaluation.evaluate_recommendations(
            _scored(staged_features(spark, sf_dir)), _truth(spark, sf_dir)
        )
    )


def _ranking_metric(metric: str) -> Query:
    return lambda spark, sf_dir: rounded(
        evaluation.evaluate_ranking(staged_predictions(spark, sf_dir), _truth(spark, sf_dir)).where(
            F.col("metric") == metric
        )
    )


QUERIES["ranking_precision"] = _ranking_metric("precision")
QUERIES["ranking_ndcg"] = _ranking_metric("ndcg")


@query("groundtruth_eval")
def groundtruth_eval(spark, sf_dir):
    # Lists cut at 10, evaluated at 5, 10 and 20.
    cut = staged_predictions(spark, sf_dir).where("rank <= 10")
    return rounded(evaluation.evaluate_ground_truth(cut, _truth(spark, sf_dir)))


@query("mark_hits")
def mark_hits(spark, sf_dir):
    top = staged_predictions(spark, sf_dir).where("rank <= 10")
    return reports.mark_hits(top, _truth(spark, sf_dir))


@query("case_best_worst")
def case_best_worst(spark, sf_dir):
    return reports.case_best_worst(
        staged_predictions(spark, sf_dir), _truth(spark, sf_dir)
    )


@query("case_random")
def case_random(spark, sf_dir):
    return reports.case_random(
        staged_predictions(spark, sf_dir), _truth(spark, sf_dir), method=SAMPLE_METHOD
    )


@query("case_status")
def case_status(spark, sf_dir):
    return reports.customer_cases(staged_predictions(spark, sf_dir), _truth(spark, sf_dir))


@query("overview_counts")
def overview_counts(spark, sf_dir):
    return reports.overview_counts(staged_predictions(spark, sf_dir), _truth(spark, sf_dir))


@query("compare_feature_sets")
def compare_feature_sets(spark, sf_dir):
    return rounded(reports.compare_feature_sets(set_metrics(spark, sf_dir)))


@query("improvement_vs_baseline")
def improvement_vs_baseline(spark, sf_dir):
    return rounded(reports.improvement_vs_baseline(set_metrics(spark, sf_dir)), 4)


@query("improvement_vs_constants")
def improvement_vs_constants(spark, sf_dir):
    full = set_metrics(spark, sf_dir).where("feature_count = 13")
    return rounded(reports.improvement_vs_constants(full, reports.DEFAULT_BOOSTING), 4)


@query("impact_class")
def impact_class(spark, sf_dir):
    reduced = set_metrics(spark, sf_dir).where("feature_count = 10")
    return rounded(reports.improvement_vs_constants(reduced, reports.WITH_HISTORY), 4)


@query("comparison_summary")
def comparison_summary(spark, sf_dir):
    summary = reports.comparison_summary(set_metrics(spark, sf_dir), "2001-07-01 00:00:00")
    return rounded(summary.select("comparison_date", "models_compared", F.inline("results")))


# --- submission -------------------------------------------------------------


@query("top_customers_by_score")
def top_customers_by_score(spark, sf_dir):
    return rounded(
        submission.top_customers_by_score(staged_predictions(spark, sf_dir), SUBMISSION_CUSTOMERS)
    )


def _lists(spark, sf_dir) -> DataFrame:
    return submission.submission_lists(staged_predictions(spark, sf_dir))


@query("submission_lists")
def submission_lists(spark, sf_dir):
    return _lists(spark, sf_dir).select("customer_id", F.array_join("items", ",").alias("items"))


@query("submission_json")
def submission_json(spark, sf_dir):
    path = _new_folder(spark, "submission")
    submission.write_submission(_lists(spark, sf_dir), path)
    return spark.read.text(path)


@query("submission_size")
def submission_size(spark, sf_dir):
    everyone = submission.submission_lists(staged_predictions(spark, sf_dir))
    return submission.submission_size(everyone)


@query("prediction_coverage")
def prediction_coverage(spark, sf_dir):
    return submission.prediction_coverage(
        staged_predictions(spark, sf_dir), _truth(spark, sf_dir)
    )


# --- exploration ------------------------------------------------------------


@query("null_rates")
def null_rates(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    tables = {"transactions": d.transactions, "items": _untidy_items(spark, sf_dir), "users": d.users}
    return union_all([eda.compute_null_rates(df, name) for name, df in tables.items()])


def _over_transactions(fn) -> Query:
    return lambda spark, sf_dir: fn(td.load_domain(spark, sf_dir).transactions)


def _over_transactions_items(fn) -> Query:
    def run(spark, sf_dir):
        d = td.load_domain(spark, sf_dir)
        return fn(d.transactions, d.items)

    return run


QUERIES["customer_stats"] = _over_transactions(eda.customer_stats)
QUERIES["top_customers"] = _over_transactions(eda.top_customers)
QUERIES["time_range"] = _over_transactions(eda.time_range)
QUERIES["daily_volume"] = _over_transactions(eda.daily_volume)
QUERIES["cohort_retention"] = _over_transactions(eda.cohort_retention)
QUERIES["cohort_sample"] = _over_transactions(
    lambda t: eda.cohort_sample(eda.cohort_retention(t))
)
QUERIES["sparsity"] = _over_transactions(lambda t: rounded(eda.sparsity(t), 8))
QUERIES["item_stats"] = _over_transactions_items(eda.item_stats)
QUERIES["top_items"] = _over_transactions_items(eda.top_items)
QUERIES["category_volume"] = _over_transactions_items(eda.category_volume)


def _distribution(column: str) -> Query:
    return lambda spark, sf_dir: eda.value_distribution(
        td.load_domain(spark, sf_dir).items, column
    )


QUERIES["brand_distribution"] = _distribution("brand")
QUERIES["age_group_distribution"] = _distribution("age_group")
QUERIES["category_distribution"] = _distribution("category")


@query("brand_age_matrix")
def brand_age_matrix(spark, sf_dir):
    return eda.brand_age_matrix(td.load_domain(spark, sf_dir).items, AGE_GROUPS)


def _customer_metrics(spark, sf_dir) -> DataFrame:
    return eda.customer_stats(td.load_domain(spark, sf_dir).transactions)


@query("describe_stats")
def describe_stats(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    scores = staged_predictions(spark, sf_dir)
    return rounded(
        union_all(
            [
                eda.describe_stats(eda.customer_stats(d.transactions), eda.CUSTOMER_METRICS),
                eda.describe_stats(eda.item_stats(d.transactions, d.items), ["num_customers"]),
                eda.describe_stats(scores, ["score"]),
            ]
        )
    )


@query("box_stats")
def box_stats(spark, sf_dir):
    return rounded(eda.box_stats(_customer_metrics(spark, sf_dir), eda.CUSTOMER_METRICS))


@query("iqr_outliers")
def iqr_outliers(spark, sf_dir):
    return rounded(eda.iqr_outliers(_customer_metrics(spark, sf_dir), eda.CUSTOMER_METRICS))


@query("iqr_outliers_nearest")
def iqr_outliers_nearest(spark, sf_dir):
    stats = _customer_metrics(spark, sf_dir)
    return rounded(eda.iqr_outliers(stats, eda.CUSTOMER_METRICS, "nearest"))


@query("histogram_bins")
def histogram_bins(spark, sf_dir):
    return rounded(eda.histogram_bins(_customer_metrics(spark, sf_dir), eda.CUSTOMER_METRICS))


@query("metric_correlation")
def metric_correlation(spark, sf_dir):
    return rounded(eda.metric_correlation(_customer_metrics(spark, sf_dir), eda.CUSTOMER_METRICS))


@query("duplicate_rows")
def duplicate_rows(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    tables = {"transactions": d.transactions, "items": d.items, "users": d.users}
    return union_all([eda.duplicate_rows(df, name) for name, df in tables.items()])


@query("orphan_ids")
def orphan_ids(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    return eda.orphan_ids(d.transactions, d.items, d.users)


@query("future_birth_dates")
def future_birth_dates(spark, sf_dir):
    return eda.future_birth_dates(td.load_domain(spark, sf_dir).users, BIRTH_REFERENCE)


@query("lookback_window")
def lookback(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    return lookback_window(d.transactions, td.OBSERVATION_DATE, config.DEFAULT_LOOKBACK_DAYS)


# --- predictions ------------------------------------------------------------


def _over_predictions(fn, digits: int = 6) -> Query:
    return lambda spark, sf_dir: rounded(fn(staged_predictions(spark, sf_dir)), digits)


QUERIES["prediction_overview"] = _over_predictions(reports.prediction_overview)
QUERIES["top_recommended"] = _over_predictions(reports.top_recommended)
QUERIES["rank_distribution"] = _over_predictions(reports.rank_distribution)
QUERIES["recs_per_customer"] = _over_predictions(reports.recs_per_customer)
QUERIES["item_rec_frequency"] = _over_predictions(reports.item_rec_frequency)
QUERIES["sample_customer_recs"] = _over_predictions(
    lambda p: reports.sample_customer_recs(p, method=SAMPLE_METHOD), 9
)


# --- customers by behaviour -------------------------------------------------


def _cases(spark, sf_dir) -> DataFrame:
    return reports.customer_cases(staged_predictions(spark, sf_dir), _truth(spark, sf_dir))


QUERIES["purchase_count_distribution"] = _over_transactions(
    lambda t: rounded(reports.purchase_count_distribution(t))
)


@query("precision_tiers")
def precision_tiers(spark, sf_dir):
    return rounded(reports.precision_tiers(_cases(spark, sf_dir)))


@query("precision_by_loyalty")
def precision_by_loyalty(spark, sf_dir):
    d = td.load_domain(spark, sf_dir)
    ratio = features.brand_loyalty_features(d.hist, d.items).select("customer_id", _X[8])
    return rounded(reports.precision_by_loyalty(_cases(spark, sf_dir), ratio))


@query("coverage_tradeoff")
def coverage_tradeoff(spark, sf_dir):
    return rounded(
        reports.coverage_tradeoff(
            staged_predictions(spark, sf_dir), _cases(spark, sf_dir), COVERAGE_CUT_OFFS
        )
    )


@query("truth_coverage")
def truth_coverage(spark, sf_dir):
    return rounded(
        reports.truth_coverage(staged_predictions(spark, sf_dir), _truth(spark, sf_dir))
    )
