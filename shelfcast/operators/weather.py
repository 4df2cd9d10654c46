"""Weather forecast columns, label codes and temperature bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.rules import clean_label, temp_code, temp_range
from shelfcast.sources.tables import stage

FORECAST_COLUMNS = [
    "ForecastDate", "MaxTemperature", "MinTemperature", "FeelsLikeTemperature", "SunshineHours",
    "WeatherDescriptor", "ForecastSiteUID",
]
WEATHER_FEATURES = ["Weather_Code", "Temp Range", "temp_code"]


def _sites(sites: DataFrame) -> DataFrame:
    # Renamed before the join: Spark does not tell shop_id and Shop_ID apart.
    return sites.select(F.col("Shop_ID").alias("_site_shop"), "SiteUID")


def current_forecast(forecast: DataFrame) -> DataFrame:
    """The forecasts in force, with cleaned labels; other columns are kept."""
    return forecast.where("CurrentForecast = 1").withColumn(
        "WeatherDescriptor", clean_label("WeatherDescriptor")
    )


def join_weather(
    df: DataFrame, sites: DataFrame, forecast: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """Site of the shop and the current forecast of the site and date; all rows stay.

    A shop without a site gets no forecast, even if some forecast has no site (an intended
    difference: a missing key matches nothing in SQL).
    """
    current = current_forecast(forecast).select(*FORECAST_COLUMNS, *[F.col(f"`{name}`") for name in extra])
    return (
        df.join(_sites(sites), F.col("shop_id") == F.col("_site_shop"), "left")
        .drop("_site_shop")
        .join(
            current,
            (F.col("SiteUID") == F.col("ForecastSiteUID")) & (F.col("t_date") == F.col("ForecastDate")),
            "left",
        )
    )


def rank_labels(counts: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Codes 0..n-1 by descending ``n_rows``; ties by label.

    The labels are sorted over a fixed number of ranges and numbered inside each; a range starts
    where the ranges before it end, by a table of one count per range. A wide vocabulary, or very
    many labels of one frequency, spread over all ranges. The bounds of the ranges are sampled, so the labels
    are stored with their range: the counts and the numbers then rest on the same ranges. Runs a job.
    """
    ranges = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("n_rows").desc(), F.col(label)]
    spread = stage(counts.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "label-ranges")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spread.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_labels"))
        .select("_range", F.coalesce(F.sum("_labels").over(before), F.lit(0)).alias("_start"))
    )
    return (
        spread.withColumn("_within", within)
        .join(starts, "_range")
        .select(label, "n_rows", (F.col("_start") + F.col("_within")).cast("double").alias(code))
    )


def extend_codes(saved: DataFrame, fitted: DataFrame, label: str = "WeatherDescriptor", code: str = "Weather_Code") -> DataFrame:
    """Rows to add to ``saved`` for labels it lacks; what is saved keeps its codes.

    New labels follow the highest saved code in the order of their fitted codes.
    """
    new = fitted.join(saved.select(label), label, "left_anti").select(label, "n_rows")
    top = saved.agg(F.coalesce(F.max(code) + 1, F.lit(0.0))).first()[0]
    return rank_labels(new, label, code).withColumn(code, F.col(code) + F.lit(top))


def extended_codes(saved: DataFrame | None, fitted: DataFrame) -> DataFrame | None:
    """The saved codes and those of labels that they lack; None where they lack none."""
    if saved is None:
        return fitted
    new = stage(extend_codes(saved, fitted), "new-codes")
    return saved.unionByName(new.select(*saved.columns)) if new.count() else None


def fit_label_codes(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Table of label, row count and code for the labels of ``df``; NULL has no code."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    return rank_labels(counts, label, code)


def fit_weather_codes(df: DataFrame, sites: DataFrame, forecast: DataFrame) -> DataFrame:
    """Label codes counted on the joined sales rows, without joining the sales rows.

    Sales are counted per shop and date first; the counts are then carried through the same
    two joins and summed per label. Save the result once and pass it to ``add_weather`` at
    training and at scoring, so that both use the same codes.
    """
    per_day = df.groupBy("shop_id", "t_date").agg(F.count(F.lit(1)).alias("_sales"))
    counts = (
        join_weather(per_day, sites, forecast)
        .where(F.col("WeatherDescriptor").isNotNull())
        .groupBy("WeatherDescriptor")
        .agg(F.sum("_sales").alias("n_rows"))
    )
    return rank_labels(counts, "WeatherDescriptor", "Weather_Code")


def apply_label_codes(df: DataFrame, codes: DataFrame, label: str, code: str = "code") -> DataFrame:
    """The code of each row's label; unknown and missing labels get NULL."""
    return df.join(codes.select(label, code), label, "left").select(*df.columns, code)


def add_temperature_bins(df: DataFrame, temperature: str = "FeelsLikeTemperature") -> DataFrame:
    """``Temp Range`` label and ``temp_code`` lower edge."""
    return df.withColumns({"Temp Range": temp_range(temperature), "temp_code": temp_code(temperature)})


def code_forecast(forecast: DataFrame, codes: DataFrame) -> DataFrame:
    """Current forecasts with ``Weather_Code``, ``Temp Range`` and ``temp_code``.

    All three depend on the forecast alone, so they are worked out once per site and date
    and not once per sales row; the label join never touches the sales rows.
    """
    return add_temperature_bins(
        apply_label_codes(current_forecast(forecast), codes, "WeatherDescriptor", "Weather_Code")
    )


def add_weather(
    df: DataFrame, sites: DataFrame, forecast: DataFrame, codes: DataFrame | None = None
) -> DataFrame:
    """Forecast columns, ``Weather_Code``, ``Temp Range`` and ``temp_code``.

    ``forecast`` may already be the result of ``code_forecast``. If it is not, and there are
    no saved ``codes``, they are fitted on these rows.
    """
    if not set(WEATHER_FEATURES) <= set(forecast.columns):
        codes = fit_weather_codes(df, sites, forecast) if codes is None else codes
        forecast = code_forecast(forecast, codes)
    return join_weather(df, sites, forecast, WEATHER_FEATURES)
