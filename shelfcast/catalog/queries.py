"""Registered queries: each takes (spark, folder of the test tables) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast import standins as fx
from shelfcast.catalog.ensembles import NODES
from shelfcast.functions import floor_qty
from shelfcast.functions.dates import parse_ymd
from shelfcast.operators import (
    checks,
    dataset,
    features,
    lags,
    metrics,
    models,
    outliers,
    ranging,
    sales,
    scoring,
    tail,
    trees,
    weather,
)
from shelfcast.plans import pipeline
from shelfcast.sources.schemas import CLUSTER_MODEL_COLUMNS, SINGLE_MODEL_COLUMNS
from shelfcast.sources.tables import stage, with_position

GRAIN = checks.GRAIN

# What of the flagged sales the inputs of the cluster models are made of.
INPUT_SOURCES = [
    *GRAIN, "qty", "day_of_week", "day_of_week_no", "weekend_flag", "bank_holiday_flag", "out_of_range", "outlier",
]


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# --- shared plans ---------------------------------------------------------------------


def _quarters(spark: SparkSession, d: str) -> DataFrame:
    return sales.launch_calendar(fx.calendar(spark, d), fx.launch_windows(spark, d))


def _extract(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.sales_extract(
        fx.daily_sales(spark, d),
        fx.shop_day_totals(spark, d),
        fx.clusters(spark, d),
        _quarters(spark, d),
    )


def _stored_sales(spark: SparkSession, d: str) -> DataFrame:
    """The sales as a table, for queries that read them several times."""
    return stage(fx.daily_sales(spark, d), "sales")


def _series(spark: SparkSession, d: str) -> DataFrame:
    """The sales, spread by series, for windows."""
    return features.spread_series(fx.daily_sales(spark, d))


def _stored_quarters(spark: SparkSession, d: str) -> DataFrame:
    return stage(_quarters(spark, d), "quarters")


def _stored_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The clusters as a table of known size, for joins to sales, which then need no shuffle for it."""
    return stage(fx.clusters(spark, d), "clusters")


def _stored_sites(spark: SparkSession, d: str) -> DataFrame:
    return stage(fx.weather_sites(spark, d), "sites")


def _coded(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """Coded forecasts, staged; codes are counted on ``rows``."""
    codes = weather.fit_weather_codes(rows, _stored_sites(spark, d), fx.weather_forecast(spark, d))
    return stage(weather.code_forecast(fx.weather_forecast(spark, d), stage(codes, "codes")), "forecast")


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """Stored sales with launch names: what the range and outlier rules read, several times."""
    return sales.add_quarters(_stored_sales(spark, d), _stored_quarters(spark, d))


def _base(spark: SparkSession, d: str, columns: Sequence[str] = ()) -> DataFrame:
    """The base table, or the ``columns`` of it that are read, staged as the pipeline does between its jobs."""
    table = pipeline.base_table(
        _stored_sales(spark, d), fx.shop_day_totals(spark, d), _stored_clusters(spark, d), _stored_quarters(spark, d)
    )
    return stage(checks.project(table, columns) if columns else table, "base")


def _ranged(spark: SparkSession, d: str) -> DataFrame:
    return ranging.range_finder(_labelled(spark, d))


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    """Sales with two deterministic stand-in predictions."""
    table = features.sales_features(dataset.add_new_qty(_series(spark, d)), "new_qty")
    return table.select(
        *GRAIN,
        "qty",
        "new_qty",
        F.col("rolling_4_days").alias("predictions"),
        F.col("same_last_4_days").alias("predictions_b"),
    )


def _training_table(
    spark: SparkSession, d: str, before: str | None = None, columns: Sequence[str] = ()
) -> DataFrame:
    """The training table, up to the day ``before`` if given: features look back only, so later rows need none made.

    Flags and weather codes rest on all rows either way. It is made of the ``columns`` of the base table, or of all.
    """
    base = _base(spark, d, columns)
    coded = _coded(spark, d, pipeline.kept_sales(base))
    rows = base if before is None else base.where(F.col("t_date") < F.lit(parse_ymd(before)))
    return pipeline.training_table(rows, _stored_sites(spark, d), coded, fx.holidays(spark, d))


def _feature_table(spark: SparkSession, d: str, extra: Sequence[str] = ()) -> DataFrame:
    base = _base(spark, d)
    coded = _coded(spark, d, pipeline.kept_sales(base))
    return pipeline.feature_table(base, _stored_sites(spark, d), coded, extra)


def _lag_feature_table(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.lag_feature_table(
        fx.daily_sales(spark, d), fx.shop_day_totals(spark, d), _stored_clusters(spark, d)
    )


def _scoring_input(spark: SparkSession, d: str) -> DataFrame:
    return dataset.scoring_input(
        _feature_table(spark, d), fx.holidays(spark, d), _stored_clusters(spark, d), fx.SCORING_AS_OF
    )


# --- sources, projections, filters ----------------------------------------------------


def scan_sales(spark: SparkSession, d: str) -> DataFrame:
    return fx.daily_sales(spark, d).orderBy("t_date", "shop_id", "product_id")


def filter_recent_6m(spark: SparkSession, d: str) -> DataFrame:
    return sales.recent_sales(fx.daily_sales(spark, d), fx.RECENT_AS_OF)


def filter_range_cluster(spark: SparkSession, d: str) -> DataFrame:
    return sales.sales_between(_extract(spark, d), "19960101", "19991231", 3)


def filter_from_as_of(spark: SparkSession, d: str) -> DataFrame:
    return sales.from_date(fx.daily_sales(spark, d), fx.SCORING_AS_OF)


def drop_outliers(spark: SparkSession, d: str) -> DataFrame:
    flagged = outliers.flag_outliers(_labelled(spark, d))
    return sales.drop_outliers(flagged).select(*pipeline.ANOMALY_COLUMNS)


def qty_floor(spark: SparkSession, d: str) -> DataFrame:
    return fx.daily_sales(spark, d).select(*GRAIN, "qty", floor_qty("qty").alias("new_qty"))


def latest_rows(spark: SparkSession, d: str) -> DataFrame:
    return sales.latest_rows(fx.daily_sales(spark, d), 20)


def profile_sales(spark: SparkSession, d: str) -> DataFrame:
    return checks.profile(fx.daily_sales(spark, d))


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Products sold in several shops on a date: the sales table on a key that is not unique."""
    return checks.duplicate_keys(fx.daily_sales(spark, d), ["product_id", "t_date"])


# --- joins ----------------------------------------------------------------------------


def sales_enriched(spark: SparkSession, d: str) -> DataFrame:
    return _extract(spark, d)


def launch_calendar(spark: SparkSession, d: str) -> DataFrame:
    return _quarters(spark, d)


def holiday_join(spark: SparkSession, d: str) -> DataFrame:
    return dataset.add_holidays(fx.daily_sales(spark, d).select(*GRAIN, "qty"), fx.holidays(spark, d))


def scoring_input(spark: SparkSession, d: str) -> DataFrame:
    return _scoring_input(spark, d)


def unrouted_rows(spark: SparkSession, d: str) -> DataFrame:
    shops = fx.clusters(spark, d).select("shop_id", "cluster")
    return scoring.unrouted(fx.daily_sales(spark, d).join(shops, "shop_id", "left"))


# --- range and outliers ---------------------------------------------------------------


def days_sold(spark: SparkSession, d: str) -> DataFrame:
    return ranging.days_sold(sales.add_quarters(fx.daily_sales(spark, d), _quarters(spark, d)))


def trading_days(spark: SparkSession, d: str) -> DataFrame:
    return ranging.trading_days(sales.add_quarters(fx.daily_sales(spark, d), _quarters(spark, d)))


def product_range(spark: SparkSession, d: str) -> DataFrame:
    return ranging.product_range(_labelled(spark, d))


def range_finder(spark: SparkSession, d: str) -> DataFrame:
    return _ranged(spark, d)


def outlier_means(spark: SparkSession, d: str) -> DataFrame:
    return outliers.outlier_means(_ranged(spark, d))


def outlier_flags(spark: SparkSession, d: str) -> DataFrame:
    return outliers.flag_outliers(_labelled(spark, d))


def outlier_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _round(outliers.outlier_ratio(outliers.flag_outliers(_labelled(spark, d))), "outlier_ratio")


def anomaly_table(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.anomaly_table(_stored_sales(spark, d), _stored_quarters(spark, d))


def anomaly_table_recent(spark: SparkSession, d: str) -> DataFrame:
    """The anomaly table as in the original: the last six months, all four joins before the flags."""
    recent = stage(sales.recent_sales(fx.daily_sales(spark, d), fx.RECENT_AS_OF), "sales")
    return pipeline.anomaly_table(
        recent, _stored_quarters(spark, d), fx.shop_day_totals(spark, d), fx.clusters(spark, d)
    )


# --- windows --------------------------------------------------------------------------


def rolling_7d_mean(spark: SparkSession, d: str) -> DataFrame:
    return _series(spark, d).select(*GRAIN, features.rolling_days("qty").alias("mean_7d"))


def rolling_7d_std(spark: SparkSession, d: str) -> DataFrame:
    return _round(features.rolling_std(_series(spark, d)).select(*GRAIN, "rolling_std"), "rolling_std")


def rolling_week_sales(spark: SparkSession, d: str) -> DataFrame:
    return features.week_features(_series(spark, d)).select(*GRAIN, "rolling_week_sales")


def weekly_trend(spark: SparkSession, d: str) -> DataFrame:
    return features.week_features(_series(spark, d)).select(*GRAIN, *features.WEEK_COLUMNS)


def same_weekday_means(spark: SparkSession, d: str) -> DataFrame:
    return features.same_weekday_features(_series(spark, d)).select(*GRAIN, *features.SAME_DAY_COLUMNS)


def rolling_weekpart(spark: SparkSession, d: str) -> DataFrame:
    return features.weekpart_features(_series(spark, d)).select(*GRAIN, *features.WEEKPART_COLUMNS)


def feature_fill(spark: SparkSession, d: str) -> DataFrame:
    table = features.fill_features(features.rolling_features(_series(spark, d)))
    names = [*features.WEEK_COLUMNS, *features.SAME_DAY_COLUMNS, *features.WEEKPART_COLUMNS]
    return table.select(*GRAIN, "qty", *names)


def daily_trend(spark: SparkSession, d: str) -> DataFrame:
    return features.sales_features(_series(spark, d)).select(
        *GRAIN, *features.SAME_DAY_COLUMNS, "daily_trend"
    )


def sales_features(spark: SparkSession, d: str) -> DataFrame:
    return features.sales_features(_series(spark, d))


def same_day_lags(spark: SparkSession, d: str) -> DataFrame:
    return lags.same_day_lags(_series(spark, d)).select(*GRAIN, "qty", *lags.SAME_DAY_TRAINING)


def fill_zero(spark: SparkSession, d: str) -> DataFrame:
    return lags.fill_same_day(same_day_lags(spark, d), zero=True)


def fill_cascade(spark: SparkSession, d: str) -> DataFrame:
    return lags.fill_same_day(same_day_lags(spark, d), zero=False)


def rolling_stats(spark: SparkSession, d: str) -> DataFrame:
    table = lags.rolling_stats(_series(spark, d))
    return table.select(*GRAIN, *[name for name in table.columns if name.startswith("rolling_")])


def lag_feature_table(spark: SparkSession, d: str) -> DataFrame:
    return _lag_feature_table(spark, d)


# --- weather --------------------------------------------------------------------------


def weather_join(spark: SparkSession, d: str) -> DataFrame:
    return weather.join_weather(
        fx.daily_sales(spark, d).select(*GRAIN, "qty"), fx.weather_sites(spark, d), fx.weather_forecast(spark, d)
    )


def weather_codes(spark: SparkSession, d: str) -> DataFrame:
    return weather.fit_weather_codes(
        fx.daily_sales(spark, d), fx.weather_sites(spark, d), fx.weather_forecast(spark, d)
    )


def label_codes(spark: SparkSession, d: str) -> DataFrame:
    """The general fit, counted on the joined rows themselves."""
    return weather.fit_label_codes(weather_join(spark, d), "WeatherDescriptor", "Weather_Code")


def weather_code(spark: SparkSession, d: str) -> DataFrame:
    joined = weather_join(spark, d)
    coded = weather.apply_label_codes(joined, weather_codes(spark, d), "WeatherDescriptor", "Weather_Code")
    return coded.select(*GRAIN, "WeatherDescriptor", "Weather_Code")


def temp_bins(spark: SparkSession, d: str) -> DataFrame:
    return weather.add_temperature_bins(
        weather_join(spark, d).select(*GRAIN, "FeelsLikeTemperature")
    )


def weather_features(spark: SparkSession, d: str) -> DataFrame:
    rows = stage(fx.daily_sales(spark, d).select(*GRAIN, "qty"), "sales")
    return weather.add_weather(rows, fx.weather_sites(spark, d), _coded(spark, d, rows))


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    return _feature_table(spark, d)


# --- training sets and scores ---------------------------------------------------------


def train_test_split(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.daily_sales(spark, d).select(*GRAIN, "qty")
    train, test = dataset.split_by_date(rows, fx.TRAIN_START, fx.TRAIN_END, fx.TEST_END, closed=True)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def train_test_split_open(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.daily_sales(spark, d).select(*GRAIN, "qty")
    train, test = dataset.split_by_date(rows, fx.TRAIN_START, fx.TRAIN_END, fx.TEST_END)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def forecast_scores(spark: SparkSession, d: str) -> DataFrame:
    scored = metrics.add_scores(_predicted(spark, d).drop("predictions_b"), "new_qty")
    return _round(scored, "MAPE")


def forecast_metrics(spark: SparkSession, d: str) -> DataFrame:
    table = metrics.forecast_metrics(_predicted(spark, d), "new_qty")
    return _round(table, "MAPE_score", "Accuracy_score", "r2")


def forecast_r2(spark: SparkSession, d: str) -> DataFrame:
    return _round(metrics.forecast_r2(_predicted(spark, d), "new_qty", "predictions"), "r2")


def _compared(spark: SparkSession, d: str) -> DataFrame:
    return metrics.compare_models(_predicted(spark, d), {"first": "predictions", "second": "predictions_b"})


def compare_models(spark: SparkSession, d: str) -> DataFrame:
    return _round(_compared(spark, d), "first_MAPE", "second_MAPE")


def comparison_means(spark: SparkSession, d: str) -> DataFrame:
    means = metrics.comparison_means(_compared(spark, d), ["first", "second"])
    return _round(means, *means.columns)


def accuracy_by_group(spark: SparkSession, d: str) -> DataFrame:
    described = _compared(spark, d).join(fx.clusters(spark, d), "shop_id", "left")
    names = ["first_acc", "second_acc"]
    return _round(metrics.accuracy_by_group(described, "description", names), *names)


# --- models ---------------------------------------------------------------------------


def _split(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    return dataset.split_by_date(table, fx.TRAIN_START, fx.TRAIN_END, fx.TEST_END, closed=True)


def impute_features(spark: SparkSession, d: str) -> DataFrame:
    """Training rows with filled weather columns and their missing marks."""
    from pyspark.ml import Pipeline

    names = ["Weather_Code", "temp_code"]
    table = weather_features(spark, d).select(*GRAIN, *names)
    train = stage(_split(table)[0], "impute")
    stages, outputs = models.impute_stages(train, names)
    filled = Pipeline(stages=stages).fit(train).transform(train)
    return filled.select(*GRAIN, *[F.col(f"`{name}`").alias(name.removeprefix("_f_")) for name in outputs])


def train_model(spark: SparkSession, d: str) -> DataFrame:
    """Importance of each model input after fitting on all training rows."""
    table = _split(_training_table(spark, d, fx.TRAIN_END, INPUT_SOURCES))[0]
    # Without what the fit does not read, the rows are narrow in the shuffles of the windows and joins as well.
    table = stage(checks.project(table, [*CLUSTER_MODEL_COLUMNS, "new_qty"]), "train-model")
    return models.feature_importances(models.train(table, CLUSTER_MODEL_COLUMNS, "new_qty"), spark)


def fit_stump(spark: SparkSession, d: str) -> DataFrame:
    """One tree of depth one on one feature, by the usual training: its split, its leaves, and the predictions."""
    sold = stage(fx.daily_sales(spark, d).select(*GRAIN, "qty"), "stump")
    model = models.train(sold, ["product_id"], "qty", trees=1, depth=1)
    root, low, high = sorted(trees.model_nodes(model), key=lambda node: node.node)
    scored = models.predict(model, sold, "prediction")
    shown = {"threshold": root.threshold, "low_mean": low.value, "high_mean": high.value}
    return _round(scored.withColumns({name: F.lit(value) for name, value in shown.items()}), *shown, "prediction")


def _unfilled(spark: SparkSession, d: str) -> DataFrame:
    """Sales with their window features, missing where a series has just begun."""
    return features.rolling_features(_series(spark, d))


def score_trees(spark: SparkSession, d: str) -> DataFrame:
    """The fixed ensemble of cluster 0 on all sales, gaps included."""
    return trees.score_nodes(_unfilled(spark, d), [n for n in NODES if n.model == 0]).select(*GRAIN, "prediction")


def score_routed(spark: SparkSession, d: str) -> DataFrame:
    """Each row with the fixed ensemble of its cluster, in one pass; clusters without one get NULL."""
    rows = _unfilled(spark, d).join(fx.clusters(spark, d).select("shop_id", "cluster"), "shop_id", "left")
    return trees.score_nodes(rows, NODES, key="cluster").select(*GRAIN, "cluster", "prediction")


def score_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Order lines routed by their shop's cluster and put back into the order of the input's rows."""
    lines = with_position(fx.lines(spark, d), "position")
    rows = lines.join(fx.clusters(spark, d).select("shop_id", "cluster"), "shop_id", "left").withColumns(
        {name: F.col("qty") for name in ("rolling_week_sales", "week_old", "same_last_4_days", "same_last_6_days", "rolling_4_days", "rolling_6_max")}
        | {"weekly_trend": F.col("qty") / 25, "day_of_week": F.weekday("t_date") + 1, "weekend_flag": F.lit(0)}
    )
    scored = trees.score_nodes(rows, NODES, key="cluster")
    return scored.orderBy("position").select("position", *GRAIN, "qty", "cluster", "prediction")


def features_from_tail(spark: SparkSession, d: str) -> DataFrame:
    """The feature table of the last weeks, from the stored tail of each series and the new rows alone.

    The tail is first stored as of an earlier day and brought forward by the rows since, as daily runs do.
    """
    base = _base(spark, d)
    first, last = parse_ymd(fx.RECENT_TAIL), parse_ymd(fx.SCORING_AS_OF)
    tails = stage(pipeline.feature_tail(base, first).withColumn("as_of", F.lit(first)), "tails", ["as_of"])
    between = sales.drop_outliers(base).where((F.col("t_date") >= F.lit(first)) & (F.col("t_date") < F.lit(last)))
    moved = tail.advance_tail(tails.where(F.col("as_of") == F.lit(first)).drop("as_of"), between, last)
    tails = stage(moved.withColumn("as_of", F.lit(last)), "tails", ["as_of"])
    stored = tails.where(F.col("as_of") == F.lit(last)).drop("as_of")
    coded = _coded(spark, d, pipeline.kept_sales(base))
    return pipeline.daily_features(stored, base, last, _stored_sites(spark, d), coded)


def train_and_evaluate(spark: SparkSession, d: str) -> DataFrame:
    rows = pipeline.training_sales(
        fx.daily_sales(spark, d), _stored_clusters(spark, d), _stored_quarters(spark, d), fx.TRAIN_START, fx.TEST_END
    )
    flagged = outliers.flag_outliers(stage(rows, "training-sales"))
    # The rows carry their mean along; the other figures are in no column of the training table.
    flagged = stage(checks.project(flagged, [*INPUT_SOURCES, "in_range_mean"]), "flagged")
    options = {"start": fx.TRAIN_START, "train_end": fx.TRAIN_END, "test_end": fx.TEST_END, "closed": True}
    coded = _coded(spark, d, pipeline.kept_sales(flagged))
    return pipeline.train_cluster(flagged, _stored_sites(spark, d), coded, fx.holidays(spark, d), **options).scored


def _cluster_models(spark: SparkSession, d: str):
    """Scoring rows, and a model per cluster fitted on all its earlier rows.

    Features are worked out once, for history and scoring days together. History keeps its range flag;
    rows to score count as in range. A cluster without history has no model; its rows come back without
    a prediction.
    """
    table = _training_table(spark, d, columns=[*INPUT_SOURCES, "cluster"])
    # Without what neither fits nor scores read, the rows are narrow in all shuffles and on disk.
    table = checks.project(table, [*CLUSTER_MODEL_COLUMNS, "t_date", "new_qty", "cluster"])
    table = stage(table, "cluster-features", ["cluster"], rebalance=True)
    history = table.where((F.col("t_date") < F.lit(parse_ymd(fx.SCORING_AS_OF))) & F.col("cluster").isin(*scoring.CLUSTERS))
    present = {row["cluster"] for row in history.select("cluster").distinct().collect()}  # of six at most
    parts = {cluster: history.where(F.col("cluster") == cluster) for cluster in present}
    by_cluster = models.train_each(parts, CLUSTER_MODEL_COLUMNS, "new_qty")
    rows = dataset.scoring_input(
        table.drop("school_holiday"), fx.holidays(spark, d), fx.clusters(spark, d), fx.SCORING_AS_OF
    )
    return stage(rows, "scoring"), by_cluster


def score_by_cluster(spark: SparkSession, d: str) -> DataFrame:
    """A model per cluster; rows that no model takes have a NULL prediction."""
    rows, by_cluster = _cluster_models(spark, d)
    return pipeline.score_clusters(rows, by_cluster, keep_unrouted=True)


def score_by_cluster_rows(spark: SparkSession, d: str) -> DataFrame:
    """All of the scored rows but the predicted number: inputs, cluster and whether it is there."""
    scored = score_by_cluster(spark, d)
    return scored.withColumn("predicted", F.col("prediction").isNotNull().cast("int")).drop("prediction")


def score_single_rows(spark: SparkSession, d: str) -> DataFrame:
    scored = score_single(spark, d)
    return scored.withColumn("predicted", F.col("predictions").isNotNull().cast("int")).drop("predictions")


def train_and_evaluate_rows(spark: SparkSession, d: str) -> DataFrame:
    """Keys and target of the test rows, and whether their scores agree with their predictions."""
    scored = train_and_evaluate(spark, d)
    error = F.abs(F.col("new_qty") - F.col("predictions")) / F.col("new_qty")
    agrees = F.coalesce((F.abs(F.col("MAPE") - error) < 1e-9) & (F.col("predictions") == F.round("predictions")), F.lit(False))
    return scored.select(*GRAIN, "qty", "new_qty", agrees.cast("int").alias("agrees"))


def train_model_inputs(spark: SparkSession, d: str) -> DataFrame:
    """The inputs that a fitted model weighs, and their total importance in percent."""
    found = train_model(spark, d).where("feature NOT LIKE '%missing'")
    total = F.round(F.sum("importance").over(Window.partitionBy(F.lit(1))) * 100)
    return found.select("feature", F.when(total > 50, 1).otherwise(0).alias("weighed"))


def compare_fitted(spark: SparkSession, d: str) -> DataFrame:
    """Two fitted models, a shallow and a deeper one, on all rows of the feature table."""
    table = _training_table(spark, d, columns=[*INPUT_SOURCES, "description"])
    rows = stage(checks.project(table, pipeline.COMPARED_COLUMNS), "compared")
    history = rows.where(F.col("t_date") < F.lit(parse_ymd(fx.TRAIN_END)))
    fitted = models.train_depths(history, CLUSTER_MODEL_COLUMNS, "new_qty", (2, 3))
    return pipeline.compare_rows(rows, fitted[2], fitted[3])


def score_single(spark: SparkSession, d: str) -> DataFrame:
    table = stage(_lag_feature_table(spark, d), "lag-features")
    history = table.where(F.col("t_date") < F.lit(parse_ymd(fx.SCORING_AS_OF)))
    model = models.train(history, SINGLE_MODEL_COLUMNS, "qty")
    return scoring.score_single(table, model, fx.SCORING_AS_OF)


REGISTERED = [
    scan_sales, filter_recent_6m, filter_range_cluster, filter_from_as_of, drop_outliers, qty_floor,
    latest_rows, profile_sales, duplicate_keys, sales_enriched, launch_calendar, holiday_join,
    scoring_input, unrouted_rows, days_sold, trading_days, product_range, range_finder, outlier_means,
    outlier_flags, outlier_ratio, anomaly_table, rolling_7d_mean, rolling_7d_std, rolling_week_sales,
    weekly_trend, same_weekday_means, rolling_weekpart, feature_fill, daily_trend, sales_features,
    same_day_lags, fill_zero, fill_cascade, rolling_stats, lag_feature_table, weather_join,
    weather_codes, label_codes, weather_code, temp_bins, weather_features, feature_table,
    train_test_split, train_test_split_open, forecast_scores, forecast_metrics, forecast_r2,
    compare_models, comparison_means, accuracy_by_group, impute_features, train_model,
    train_and_evaluate, score_by_cluster, score_single, anomaly_table_recent, score_by_cluster_rows,
    score_single_rows, train_and_evaluate_rows, train_model_inputs, compare_fitted, score_trees,
    score_routed, score_in_order, fit_stump, features_from_tail,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in REGISTERED}
