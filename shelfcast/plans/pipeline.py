"""The pipeline's jobs as lazy plans over input frames. Sources, sinks and intermediate tables are the
caller's: what a plan reads several times, or what should be small and of known size when it is
joined, the caller stages first; each function names what that is."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import dataset, lags, metrics, models, outliers, sales, scoring, tail
from shelfcast.operators.checks import GRAIN, project
from shelfcast.operators.features import sales_features, spread_series
from shelfcast.operators.weather import add_weather
from shelfcast.sources.schemas import CLUSTER_MODEL_COLUMNS, NOT_MODELLED, SINGLE_MODEL_COLUMNS, TRAINING_COLUMNS

ANOMALY_COLUMNS = ["shop_id", "t_date", "product_id", "qty", "outlier"]

# What a comparison of models shows: keys, sales and the models' inputs.
COMPARED_COLUMNS = list(dict.fromkeys([*GRAIN, "description", "qty", "new_qty", *CLUSTER_MODEL_COLUMNS]))


def sales_extract(
    daily_sales: DataFrame, totals: DataFrame, clusters: DataFrame, quarters: DataFrame
) -> DataFrame:
    """Daily sales with shop-day totals, clusters and launch names."""
    return sales.enrich_sales(daily_sales, totals, clusters, quarters)


def anomaly_table(
    daily_sales: DataFrame,
    quarters: DataFrame,
    totals: DataFrame | None = None,
    clusters: DataFrame | None = None,
) -> DataFrame:
    """The five-column outlier table. Stage the sales and the quarters: both are read several times.

    With ``totals`` and ``clusters`` the extract's joins are made before the flags, so that a shop or
    shop-day listed twice multiplies its sales as in the original. Where both tables are known to
    be unique, as the job checks, leaving them out changes no row.
    """
    rows = sales.add_quarters(daily_sales, quarters)
    if totals is not None and clusters is not None:
        rows = sales.add_shop_data(rows, totals, clusters)
    return project(outliers.flag_outliers(rows), ANOMALY_COLUMNS)


def base_table(
    daily_sales: DataFrame, totals: DataFrame, clusters: DataFrame, quarters: DataFrame
) -> DataFrame:
    """The extract with range figures and outlier flag; shop data comes after the flags.

    Stage the sales and the quarters.
    """
    flagged = outliers.flag_outliers(sales.add_quarters(daily_sales, quarters))
    return sales.add_shop_data(flagged, totals, clusters)


def join_anomalies(extract: DataFrame, anomalies: DataFrame) -> DataFrame:
    """The extract with the outlier flag of a saved anomaly table.

    Rows that the anomaly table does not hold have no flag and drop out of the features.
    """
    flags = anomalies.select("shop_id", "product_id", "t_date", "outlier")
    return extract.join(flags, ["shop_id", "product_id", "t_date"], "left").select(*extract.columns, "outlier")


def kept_sales(flagged: DataFrame) -> DataFrame:
    """The rows that features are made of: no outliers, no missing key."""
    return sales.drop_outliers(flagged).dropna(subset=GRAIN)


def feature_table(base: DataFrame, sites: DataFrame, coded: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The feature table of a base table, with ``extra`` columns of it. Stage the coded forecasts (``weather.code_forecast``)."""
    return dataset.feature_table(base, sites, coded, extra=extra)


def feature_tail(base: DataFrame, before: str | dt.date) -> DataFrame:
    """The tail of a base table: the rows that features from a date on reach back to."""
    return tail.series_tail(sales.drop_outliers(base), before)


def daily_features(
    stored: DataFrame, new: DataFrame, start: str | dt.date, sites: DataFrame, coded: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """The feature table from ``start`` on, of the stored tail before it and the new rows of the base table.

    Equal to the last days of the whole table, without its history. Stage the coded forecasts.
    """
    rows = tail.with_tail(stored, sales.drop_outliers(new), start)
    return sales.from_date(dataset.feature_table(rows, sites, coded, extra=extra), start)


def training_sales(
    daily_sales: DataFrame,
    clusters: DataFrame,
    quarters: DataFrame,
    sales_from: str | dt.date,
    sales_to: str | dt.date,
    cluster: int | None = None,
) -> DataFrame:
    """Sales of a date range, of one cluster if given, with launch names: what the flags read three times.

    Shop-day totals are in no model input and are not joined.
    """
    rows = sales.add_clusters(daily_sales, clusters)
    return sales.add_quarters(sales.sales_between(rows, sales_from, sales_to, cluster), quarters)


def training_table(flagged: DataFrame, sites: DataFrame, coded: DataFrame, holidays: DataFrame) -> DataFrame:
    """Flagged sales of one cluster or all, as a table ready for ``train_and_evaluate``.

    Stage the coded forecasts.
    """
    kept = dataset.add_new_qty(kept_sales(flagged))
    return dataset.add_holidays(add_weather(sales_features(spread_series(kept), "new_qty"), sites, coded), holidays)


def train_cluster(
    flagged: DataFrame, sites: DataFrame, coded: DataFrame, holidays: DataFrame, **options
) -> models.Evaluation:
    """A training run on staged flagged sales: features, weather, holidays, model, evaluation.

    ``options`` go to ``train_and_evaluate`` (dates, number of trees and so on). Columns that
    the sales do not carry, such as product names, are left out of the training table.
    """
    table = training_table(flagged, sites, coded, holidays)
    features = [name for name in TRAINING_COLUMNS if name in table.columns]
    return models.train_and_evaluate(table, features, NOT_MODELLED, "new_qty", **options)


def score_clusters(
    rows: DataFrame, by_cluster: Mapping[int, PipelineModel], *, keep_unrouted: bool = False
) -> DataFrame:
    """Scores of all clusters, in one pass over the rows (``dataset.scoring_input``)."""
    return scoring.score_by_cluster(rows, by_cluster, keep_unrouted=keep_unrouted)


def lag_feature_table(daily_sales: DataFrame, totals: DataFrame, clusters: DataFrame) -> DataFrame:
    """Inputs of the single model; the financial month is taken to be the calendar month."""
    table = lags.lag_features(spread_series(daily_sales)).withColumns(
        {"week_no_year": F.weekofyear("t_date"), "financial_month_no": F.month("t_date")}
    )
    return project(sales.add_shop_data(table, totals, clusters), [*GRAIN, "qty", *SINGLE_MODEL_COLUMNS[2:]])


def compare_fitted(
    features: DataFrame, holidays: DataFrame, first: PipelineModel, second: PipelineModel
) -> DataFrame:
    """Two fitted models side by side on the rows of a feature table, errors and accuracy per row."""
    return compare_rows(dataset.add_holidays(features, holidays), first, second)


def compare_rows(rows: DataFrame, first: PipelineModel, second: PipelineModel) -> DataFrame:
    """``compare_fitted`` on rows that have their school holiday.

    As in scoring, no row counts as out of range and a missing school holiday as none.
    """
    rows = rows.withColumns(
        {"out_of_range": F.lit(0), "school_holiday": F.coalesce("school_holiday", F.lit(0))}
    )
    rows = models.predict(first, project(rows, COMPARED_COLUMNS), "first_prediction")
    rows = models.predict(second, rows, "second_prediction")
    return metrics.compare_models(rows, {"first": "first_prediction", "second": "second_prediction"})
