"""Modelling and scoring tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import parse_ymd
from shelfcast.functions.rules import floor_qty
from shelfcast.operators.checks import GRAIN, project
from shelfcast.operators.features import sales_features, spread_series
from shelfcast.operators.sales import drop_outliers, from_date
from shelfcast.operators.weather import add_weather, fit_weather_codes
from shelfcast.sources.schemas import CLUSTER_MODEL_COLUMNS, FEATURE_COLUMNS


def add_new_qty(df: DataFrame) -> DataFrame:
    """``new_qty``: the quantity with small values lifted."""
    return df.withColumn("new_qty", floor_qty("qty"))


def feature_table(
    base: DataFrame,
    sites: DataFrame,
    forecast: DataFrame,
    codes: DataFrame | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """The 38-column feature table of the rows that are not outliers, and the ``extra`` columns of the base.

    ``forecast`` may be coded already; else the codes are ``codes`` or fitted on these rows.
    """
    kept = drop_outliers(add_new_qty(base)).dropna(subset=GRAIN)
    if codes is None and "Weather_Code" not in forecast.columns:
        codes = fit_weather_codes(kept, sites, forecast)
    table = sales_features(spread_series(kept), "new_qty")
    return project(add_weather(table, sites, forecast, codes), [*FEATURE_COLUMNS, *extra])


def add_holidays(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Shop name and school holiday of the shop and date; all rows stay."""
    days = holidays.select(
        F.col("shop_id"), F.to_date("date").alias("t_date"), "shop_name", "school_holiday"
    )
    return df.withColumn("t_date", F.to_date("t_date")).join(days, ["shop_id", "t_date"], "left").select(
        *df.columns, "shop_name", "school_holiday"
    )


def mark_parts(
    df: DataFrame,
    start: str | dt.date,
    train_end: str | dt.date,
    test_end: str | dt.date,
    *,
    closed: bool = False,
) -> DataFrame:
    """Rows of the training and test ranges with their part, ``train`` or ``test``, in ``_part``.

    Training rows lie in [start, train_end), test rows from train_end to test_end, which belongs
    to them if ``closed``.
    """
    date = F.col("t_date")
    low, cut, high = (F.lit(parse_ymd(value)) for value in (start, train_end, test_end))
    part = F.when(date < cut, "train").when(date <= high if closed else date < high, "test")
    return df.where(date >= low).withColumn("_part", part).where(F.col("_part").isNotNull())


def split_by_date(
    df: DataFrame,
    start: str | dt.date,
    train_end: str | dt.date,
    test_end: str | dt.date,
    *,
    closed: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; see ``mark_parts``."""
    marked = mark_parts(df, start, train_end, test_end, closed=closed)
    train, test = (marked.where(F.col("_part") == part).drop("_part") for part in ("train", "test"))
    return train, test


def scoring_input(
    features: DataFrame,
    holidays: DataFrame,
    clusters: DataFrame,
    as_of: str | dt.date | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Model inputs from the run date on, with cluster; a missing school holiday counts as 0.

    ``extra`` columns of the features, such as an input position, follow.
    """
    days = holidays.select("shop_id", F.col("date").alias("t_date"), "school_holiday").distinct()
    shops = clusters.select("shop_id", "cluster")
    kept = from_date(features, as_of).drop("cluster", "school_holiday", "out_of_range")
    joined = kept.join(days, ["shop_id", "t_date"], "left").join(shops, "shop_id", "left")
    columns = [*CLUSTER_MODEL_COLUMNS[:2], "t_date", *CLUSTER_MODEL_COLUMNS[2:], "cluster", *extra]
    return project(
        joined.withColumns(
            {"out_of_range": F.lit(0), "school_holiday": F.coalesce("school_holiday", F.lit(0))}
        ),
        columns,
    )
