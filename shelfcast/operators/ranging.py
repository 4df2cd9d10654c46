"""Which products a shop is selling: days sold against the shop's trading days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.rules import out_of_range_flag, percent_of

SHOP_KEYS = ["shop_id", "quarter_label", "weekend_flag"]
RANGE_KEYS = ["shop_id", "product_id", "quarter_label", "weekend_flag"]


def days_sold(df: DataFrame) -> DataFrame:
    """Rows with a quantity per shop, product, quarter and weekend flag (not distinct days)."""
    return df.dropna(subset=RANGE_KEYS).groupBy(*RANGE_KEYS).agg(F.count("qty").alias("no_days_sold"))


def trading_days(df: DataFrame) -> DataFrame:
    """Distinct dates per shop, quarter and weekend flag.

    The distinct count first reduces to (keys, date) on the map side and shuffles on all
    four, so a shop with most of the rows does not end up in one task.
    """
    return (
        df.dropna(subset=SHOP_KEYS)
        .groupBy(*SHOP_KEYS)
        .agg(F.countDistinct("t_date").alias("shop_trading_days"))
    )


def add_range(sold: DataFrame) -> DataFrame:
    """Percentage of trading days and out-of-range flag from the two counts."""
    return sold.withColumn("sales_vol_percent", percent_of("no_days_sold", "shop_trading_days")).withColumn(
        "out_of_range", out_of_range_flag("sales_vol_percent")
    )


def product_range(df: DataFrame) -> DataFrame:
    """One row per shop, product, quarter and weekend flag with its range figures."""
    return add_range(days_sold(df).join(trading_days(df), SHOP_KEYS)).select(
        *RANGE_KEYS, "no_days_sold", "shop_trading_days", "sales_vol_percent", "out_of_range"
    )


def range_finder(df: DataFrame) -> DataFrame:
    """Detail rows with their range figures; rows with a missing key leave."""
    figures = ["no_days_sold", "shop_trading_days", "sales_vol_percent", "out_of_range"]
    return df.join(product_range(df), RANGE_KEYS).select(*df.columns, *figures)
