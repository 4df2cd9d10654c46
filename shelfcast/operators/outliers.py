"""Outlying days per shop, product and weekday.

Counts and sums per (series, quarter, weekend flag, weekday) cell hold everything the rules need, at
about a thirteenth of the rows, so the wide detail rows are shuffled at most once, for the final
join, and not at all when the cells are small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.rules import outlier_flag
from shelfcast.operators.ranging import RANGE_KEYS, SHOP_KEYS, add_range, trading_days

MEAN_KEYS = ["shop_id", "product_id", "week_day_description"]
RANGE_FIGURES = ["no_days_sold", "shop_trading_days", "sales_vol_percent", "out_of_range"]
MEAN_COLUMNS = ["in_range_mean", "out_of_range_mean", "days_sold_range", "days_sold_out_of_range"]


def outlier_means(df: DataFrame) -> DataFrame:
    """Mean quantity and mean days sold per weekday, in and out of range side by side.

    A side without rows is NULL (an intended difference: the original needs both sides).
    """
    inside, outside = F.col("out_of_range") == 0, F.col("out_of_range") == 1
    return (
        df.dropna(subset=MEAN_KEYS)
        .groupBy(*MEAN_KEYS)
        .agg(
            F.avg(F.when(inside, F.col("qty"))).alias("in_range_mean"),
            F.avg(F.when(outside, F.col("qty"))).alias("out_of_range_mean"),
            F.avg(F.when(inside, F.col("no_days_sold"))).alias("days_sold_range"),
            F.avg(F.when(outside, F.col("no_days_sold"))).alias("days_sold_out_of_range"),
        )
    )


def find_outliers(df: DataFrame) -> DataFrame:
    """Rows of ``range_finder`` with their means and the 0/1 outlier flag.

    The figures that the rows carry come out of the same cells as the means; see ``flag_outliers``.
    """
    return flag_outliers(df.drop(*RANGE_FIGURES))


def outlier_cells(df: DataFrame) -> DataFrame:
    """Range figures and weekday means per (series, quarter, weekend flag, weekday).

    Detail rows are reduced to cells before they are keyed by series; a series has at most
    14 cells per quarter. One shuffle of the cells then serves both windows: days sold add
    up over the weekdays of a quarter, means over the quarters of a weekday.
    """
    cells = (
        df.dropna(subset=RANGE_KEYS)
        .groupBy(*RANGE_KEYS, "week_day_description")
        .agg(
            F.count("qty").alias("sold"),
            F.sum("qty").alias("qty_sum"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    counted = (
        cells.join(trading_days(df), SHOP_KEYS)
        .repartition("shop_id", "product_id")
        .withColumn("no_days_sold", F.sum("sold").over(Window.partitionBy(*RANGE_KEYS)))
    )
    ranged = add_range(counted)
    weekday = Window.partitionBy(*MEAN_KEYS)

    def mean(flag: int, total: str, count: str):
        side = F.col("out_of_range") == flag
        return F.try_divide(
            F.sum(F.when(side, F.col(total))).over(weekday).cast("double"),
            F.sum(F.when(side, F.col(count))).over(weekday),
        )

    return ranged.withColumn("days_weight", F.col("no_days_sold") * F.col("n_rows")).select(
        *RANGE_KEYS,
        "week_day_description",
        "no_days_sold",
        "shop_trading_days",
        "sales_vol_percent",
        "out_of_range",
        mean(0, "qty_sum", "sold").alias("in_range_mean"),
        mean(1, "qty_sum", "sold").alias("out_of_range_mean"),
        mean(0, "days_weight", "n_rows").alias("days_sold_range"),
        mean(1, "days_weight", "n_rows").alias("days_sold_out_of_range"),
    )


def flag_outliers(df: DataFrame) -> DataFrame:
    """Rows that have range figures, with the figures, the means and the 0/1 outlier flag.

    The input is read three times (cells, trading days, detail): pass a stored table rather
    than a long plan.
    """
    return (
        df.join(outlier_cells(df), [*RANGE_KEYS, "week_day_description"])
        .withColumn("outlier", outlier_flag())
        .select(*df.columns, *RANGE_FIGURES, *MEAN_COLUMNS, "outlier")
    )


def outlier_share() -> Column:
    """Share of outliers in percent, as an aggregate; NULL for no rows."""
    share = F.try_divide(F.count(F.when(F.col("outlier") == 1, 1)).cast("double"), F.count(F.lit(1)))
    return (share * 100.0).alias("outlier_ratio")


def outlier_ratio(df: DataFrame) -> DataFrame:
    """Share of outliers in percent; NULL for no rows. A job of its own; observed, the share comes with another."""
    return df.agg(outlier_share())
