"""The pipeline's input tables, derived by Spark from the given test tables.

Every row of ``lineitem`` and ``orders`` takes part. Shops come from dividing supplier keys, and sites
from dividing customer keys, by constants: their numbers, and with them the number of series, the
shop-days and the forecasts, grow with the data, while a series keeps its density. One product sells in
ones and twos, one tenfold, and one is rare, so that all outlier rules apply to some row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources import schemas
from shelfcast.sources.tables import conform

SUPPLIERS_PER_SHOP = 4
CUSTOMERS_PER_SHOP = 60
CUSTOMERS_PER_SITE = 300
SHOPS_PER_SITE = 5
PRODUCTS = 8
RARE = 64

# Fixed run dates in place of today.
RECENT_AS_OF = "20011105"
SCORING_AS_OF = "20011001"
# The day of the first stored tail, some weeks before scoring.
RECENT_TAIL = "20010901"
TRAIN_START, TRAIN_END, TEST_END = "19960101", "20000101", "20010101"


# Columns of the test tables that are read here; declared, so that no job infers them.
COLUMNS = {
    "lineitem": "l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
    "o_orderpriority STRING",
    "supplier": "s_suppkey BIGINT",
    "region": "r_regionkey INT, r_name STRING",
}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines as sales of a shop, before they are summed by day."""
    part, qty = F.col("l_partkey"), F.col("l_quantity")
    rare = part % RARE == PRODUCTS - 1
    return _read(spark, folder, "lineitem").select(
        F.expr(f"l_suppkey div {SUPPLIERS_PER_SHOP}").alias("shop_id"),
        F.when(rare, F.lit(PRODUCTS)).otherwise(part % PRODUCTS).cast("long").alias("product_id"),
        F.to_date("l_shipdate").alias("t_date"),
        F.when(part % PRODUCTS == 0, F.ceil(qty / 25))
        .when(part % PRODUCTS == 1, qty * 10)
        .otherwise(qty)
        .cast("double")
        .alias("qty"),
    )


def daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    iso_day = F.weekday("t_date") + 1
    sales = lines(spark, folder).groupBy("shop_id", "product_id", "t_date").agg(F.sum("qty").alias("qty"))
    return conform(
        sales.select(
            "*",
            iso_day.alias("day_of_week"),
            iso_day.alias("day_of_week_no"),
            F.when(iso_day >= 6, 1).otherwise(0).alias("weekend_flag"),
            iso_day.cast("string").alias("week_day_description"),
            F.when(F.date_format("t_date", "MMdd") == "1225", 1).otherwise(0).alias("bank_holiday_flag"),
        ),
        schemas.DAILY_SALES,
    )


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()


def launch_windows(spark: SparkSession, folder: str) -> DataFrame:
    year, quarter = F.year("date"), F.quarter("date")
    return (
        calendar(spark, folder)
        .groupBy(F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")).alias("launch_name"))
        .agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    )


def shop_day_totals(spark: SparkSession, folder: str) -> DataFrame:
    # Money is summed as decimals, so the total does not depend on the order of the rows.
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return (
        _read(spark, folder, "orders")
        .groupBy(F.expr(f"o_custkey div {CUSTOMERS_PER_SHOP}").alias("shop_id"), F.to_date("o_orderdate").alias("date"))
        .agg(total.alias("actual_retail_sales_net"))
    )


def _shops(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = _read(spark, folder, "supplier")
    return suppliers.select(F.expr(f"s_suppkey div {SUPPLIERS_PER_SHOP}").alias("shop_id")).distinct()


def clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters 0 to 6, of which the last has no model; one shop in 25 has none."""
    region = _read(spark, folder, "region")
    shops = _shops(spark, folder).where("shop_id % 25 <> 24")
    joined = shops.join(region, F.col("shop_id") % 5 == F.col("r_regionkey"))
    return conform(
        joined.select("shop_id", ((F.col("shop_id") * 3 + 3) % 7).alias("cluster"), F.col("r_name").alias("description")),
        schemas.CLUSTERS,
    )


def weather_sites(spark: SparkSession, folder: str) -> DataFrame:
    """The site of each shop; one shop in 25 has none."""
    shops = _shops(spark, folder).where("shop_id % 25 <> 23")
    return conform(
        shops.select(F.col("shop_id").alias("Shop_ID"), F.expr(f"shop_id div {SHOPS_PER_SITE}").alias("SiteUID")),
        schemas.WEATHER_SITES,
    )


def weather_forecast(spark: SparkSession, folder: str) -> DataFrame:
    days = (
        _read(spark, folder, "orders")
        .groupBy(
            F.expr(f"o_custkey div {CUSTOMERS_PER_SITE}").alias("ForecastSiteUID"),
            F.to_date("o_orderdate").alias("ForecastDate"),
        )
        .agg(
            (F.min("o_orderkey") % 50 - 17).cast("double").alias("felt"),
            F.count(F.lit(1)).alias("hours"),
            F.concat(F.min("o_orderpriority"), F.lit("\r")).alias("WeatherDescriptor"),
        )
    )
    # One forecast in force and an older one, a degree warmer, for each site and date.
    versions = days.withColumn("CurrentForecast", F.explode(F.array(F.lit(1), F.lit(0))))
    felt = F.col("felt") + 1 - F.col("CurrentForecast")
    return conform(
        versions.select(
            "ForecastSiteUID",
            "ForecastDate",
            "CurrentForecast",
            (felt + 3).alias("MaxTemperature"),
            (felt - 4).alias("MinTemperature"),
            felt.alias("FeelsLikeTemperature"),
            F.col("hours").alias("SunshineHours"),
            "WeatherDescriptor",
        ),
        schemas.WEATHER_FORECAST,
    )


def holidays(spark: SparkSession, folder: str) -> DataFrame:
    days = (
        _read(spark, folder, "lineitem")
        .select(F.expr(f"l_suppkey div {SUPPLIERS_PER_SHOP}").alias("shop_id"), F.to_date("l_shipdate").alias("date"))
        .distinct()
    )
    return conform(
        days.select(
            "*",
            F.concat(F.lit("shop "), F.col("shop_id").cast("string")).alias("shop_name"),
            F.when(F.month("date").isin(8, 12), 1).otherwise(0).alias("school_holiday"),
        ),
        schemas.HOLIDAYS,
    )
