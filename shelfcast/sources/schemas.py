"""Declared schemas of the input tables; every reader checks against them."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(text: str) -> StructType:
    types = {"long": LongType, "int": IntegerType, "double": DoubleType, "string": StringType, "date": DateType}
    fields = (field.rsplit(" ", 1) for field in text.split(", "))
    return StructType([StructField(name, types[kind]()) for name, kind in fields])


DAILY_SALES = _schema(
    "shop_id long, product_id long, t_date date, qty double, day_of_week int, day_of_week_no int, "
    "weekend_flag int, week_day_description string, bank_holiday_flag int"
)
SHOP_DAY_TOTALS = _schema("shop_id long, date date, actual_retail_sales_net double")
CLUSTERS = _schema("shop_id long, cluster int, description string")
CALENDAR = _schema("date date")
LAUNCH_WINDOWS = _schema("launch_name string, start_date date, end_date date")
WEATHER_SITES = _schema("Shop_ID long, SiteUID long")
WEATHER_FORECAST = _schema(
    "ForecastSiteUID long, ForecastDate date, CurrentForecast int, MaxTemperature double, "
    "MinTemperature double, FeelsLikeTemperature double, SunshineHours double, WeatherDescriptor string"
)
HOLIDAYS = _schema("shop_id long, date date, shop_name string, school_holiday int")
BASE_TABLE = StructType(
    DAILY_SALES.fields
    + _schema(
        "actual_retail_sales_net double, cluster int, description string, quarter_label string, outlier int"
    ).fields
)
FEATURE_TABLE = _schema(
    "shop_id long, t_date date, weekend_flag int, day_of_week_no int, day_of_week int, bank_holiday_flag int, "
    "week_day_description string, product_id long, qty double, actual_retail_sales_net double, cluster int, "
    "description string, quarter_label string, outlier int, new_qty double, rolling_week_sales double, "
    "week_old double, weekly_trend double, same_last_4_days double, same_last_6_days double, "
    "rolling_4_days double, rolling_6_days double, rolling_4_max double, rolling_6_max double, "
    "rolling_4_min double, rolling_6_min double, daily_trend double, SiteUID long, ForecastDate date, "
    "MaxTemperature double, MinTemperature double, FeelsLikeTemperature double, SunshineHours double, "
    "WeatherDescriptor string, ForecastSiteUID long, Weather_Code double, Temp Range string, temp_code double"
)
LAG_FEATURE_TABLE = _schema(
    "shop_id long, product_id long, t_date date, qty double, day_of_week_no int, week_no_year int, "
    "financial_month_no int, weekend_flag int, Same_day_1_week_ago double, Same_day_2_week_ago double, "
    "Same_day_3_week_ago double, Same_day_4_week_ago double, Same_day_5_week_ago double, "
    "Same_day_6_week_ago double, rolling_three_day_avg double, rolling_three_day_max double, "
    "rolling_three_day_min double, rolling_five_day_avg double, rolling_five_day_max double, "
    "rolling_five_day_min double, rolling_five_day_median double, rolling_seven_day_median double, "
    "actual_retail_sales_net double, cluster int"
)

TABLES: dict[str, StructType] = {
    "daily_sales": DAILY_SALES,
    "shop_day_totals": SHOP_DAY_TOTALS,
    "clusters": CLUSTERS,
    "calendar": CALENDAR,
    "launch_windows": LAUNCH_WINDOWS,
    "weather_sites": WEATHER_SITES,
    "weather_forecast": WEATHER_FORECAST,
    "holidays": HOLIDAYS,
    "base_table": BASE_TABLE,
    "feature_table": FEATURE_TABLE,
    "lag_feature_table": LAG_FEATURE_TABLE,
}

FEATURE_COLUMNS = FEATURE_TABLE.names

# The model inputs of the per-cluster models, in their order.
CLUSTER_MODEL_COLUMNS = [
    "shop_id", "product_id", "weekend_flag", "rolling_week_sales", "weekly_trend", "same_last_4_days",
    "same_last_6_days", "daily_trend", "out_of_range", "rolling_4_days", "rolling_6_days", "day_of_week_no",
    "rolling_4_max", "rolling_6_max", "rolling_4_min", "rolling_6_min", "bank_holiday_flag",
    "school_holiday", "Weather_Code", "temp_code",
]

# The model inputs of the single model on lagged features, in their order.
SINGLE_MODEL_COLUMNS = [
    "shop_id", "product_id", "day_of_week_no", "week_no_year", "financial_month_no", "weekend_flag",
    "Same_day_1_week_ago", "Same_day_2_week_ago", "Same_day_3_week_ago", "Same_day_4_week_ago",
    "Same_day_5_week_ago", "Same_day_6_week_ago", "rolling_three_day_avg", "rolling_three_day_max",
    "rolling_three_day_min", "rolling_five_day_avg", "rolling_five_day_max", "rolling_five_day_min",
    "rolling_five_day_median", "rolling_seven_day_median", "actual_retail_sales_net", "cluster",
]

# What a training run carries along beside the model's inputs.
NOT_MODELLED = [
    "t_date", "qty", "new_qty", "outlier", "in_range_mean", "shop_name", "product_name", "category_desc",
]
TRAINING_COLUMNS = [*CLUSTER_MODEL_COLUMNS, *NOT_MODELLED]
