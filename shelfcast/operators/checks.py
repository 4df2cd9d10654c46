"""Guards and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAIN = ["shop_id", "product_id", "t_date"]


def duplicate_keys(df: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def assert_unique_key(df: DataFrame, keys: Sequence[str] = GRAIN) -> None:
    """Raise when a key occurs twice. Runs a job; counts are combined before the shuffle."""
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"duplicate key {found[0].asDict()}")


def guard_grain(df: DataFrame, series: Sequence[str] = GRAIN[:2], date: str = "t_date") -> DataFrame:
    """Rows unchanged; fails at run time when a series has two rows for a date.

    It shares the shuffle and sort of the series windows, so it costs no job of its own.
    With it a series is bounded by the number of calendar days it spans.
    """
    previous = F.lag(date).over(Window.partitionBy(*series).orderBy(date))
    message = F.concat(F.lit("two rows for one series and date: "), F.to_json(F.struct(*series, date)))
    return (
        df.withColumn("_previous", previous)
        .where(
            F.when(F.col("_previous") == F.col(date), F.raise_error(message).cast("boolean")).otherwise(True)
        )
        .drop("_previous")
    )


def profile_figures(df: DataFrame, date: str = "t_date") -> list[Column]:
    """First and last date, number of rows and of columns, as aggregates."""
    return [
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.lit(len(df.columns))).alias("n_columns"),
    ]


def profile(df: DataFrame, date: str = "t_date") -> DataFrame:
    """First and last date, number of rows and of columns, in one pass."""
    return df.agg(*profile_figures(df, date)).withColumn("n_columns", F.lit(len(df.columns)))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A fixed list of columns in order; names what is missing."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{name}`") for name in columns])


def modelling_columns(features: Sequence[str], remove: Sequence[str]) -> list[str]:
    """The features without the removed ones, order kept."""
    return [name for name in features if name not in set(remove)]
