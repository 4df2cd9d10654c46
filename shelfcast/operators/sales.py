"""The enriched sales extract and its date and cluster filters.

No side of a join carries a broadcast hint. Spark broadcasts a side only when its size,
from table statistics or as measured by adaptive execution, is under
``spark.sql.autoBroadcastJoinThreshold``; larger sides are sort-merge joined, where
adaptive execution splits a hot (shop, date).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import as_of_date, parse_ymd


def launch_calendar(calendar: DataFrame, launches: DataFrame) -> DataFrame:
    """Distinct (date, launch_name) for calendar dates inside a launch window, ends included.

    Each window is expanded to its dates, so the range join becomes an equi-join instead of
    comparing every date with every window. Overlapping windows give several rows per date.
    """
    inside = (
        launches.select(
            "launch_name",
            F.col("start_date").cast("date").alias("start_date"),
            F.col("end_date").cast("date").alias("end_date"),
        )
        .where("start_date <= end_date")
        .select("launch_name", F.explode(F.sequence("start_date", "end_date")).alias("date"))
        .distinct()
    )
    dates = calendar.select(F.col("date").cast("date").alias("date")).distinct()
    return dates.join(inside, "date").select("date", "launch_name")


def add_quarters(sales: DataFrame, quarters: DataFrame) -> DataFrame:
    """Launch name of each sale's date as ``quarter_label``; NULL outside all launches.

    A date in two launches multiplies its sales rows, as in the original extract. Range figures and
    features need one row per series and date, so the jobs check the calendar first; see
    ``assert_one_launch``.
    """
    names = quarters.select(F.col("date").alias("t_date"), F.col("launch_name").alias("quarter_label"))
    return sales.join(names, "t_date", "left").select(*sales.columns, "quarter_label")


def assert_one_launch(quarters: DataFrame) -> None:
    """Raise, naming date and launches, where the launch calendar has two launches for a date."""
    found = (
        quarters.groupBy("date")
        .agg(F.sort_array(F.collect_set("launch_name")).alias("launches"))
        .where(F.size("launches") > 1)
        .orderBy("date")
        .first()
    )
    if found:
        raise ValueError(f"launches overlap on {found['date']}: {', '.join(found['launches'])}")


def add_clusters(sales: DataFrame, clusters: DataFrame) -> DataFrame:
    """Cluster of the shop and its description; all rows stay."""
    shops = clusters.select("shop_id", "cluster", "description")
    return sales.join(shops, "shop_id", "left").select(*sales.columns, "cluster", "description")


def add_shop_data(sales: DataFrame, totals: DataFrame, clusters: DataFrame) -> DataFrame:
    """Shop-day total, cluster and its description; both left joins."""
    days = totals.select("shop_id", F.col("date").alias("t_date"), "actual_retail_sales_net")
    return (
        add_clusters(sales, clusters)
        .join(days, ["shop_id", "t_date"], "left")
        .select(*sales.columns, "actual_retail_sales_net", "cluster", "description")
    )


def enrich_sales(
    sales: DataFrame, totals: DataFrame, clusters: DataFrame, quarters: DataFrame
) -> DataFrame:
    """All sales columns plus shop-day total, cluster, its description and the launch name."""
    return add_quarters(add_shop_data(sales, totals, clusters), quarters)


def recent_sales(df: DataFrame, as_of: str | dt.date | None = None, months: int = 6) -> DataFrame:
    """Rows from ``months`` before the run date up to the day before it."""
    today = as_of_date(as_of)
    return df.where(F.col("t_date").between(F.add_months(today, -months), F.date_sub(today, 1)))


def sales_between(
    df: DataFrame, start: str | dt.date, end: str | dt.date, cluster: int | None = None
) -> DataFrame:
    """Rows of an inclusive date range, of one cluster if given."""
    kept = df.where(F.col("t_date").between(F.lit(parse_ymd(start)), F.lit(parse_ymd(end))))
    return kept if cluster is None else kept.where(F.col("cluster") == cluster)


def from_date(df: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Rows of the run date and later."""
    return df.where(F.col("t_date") >= as_of_date(as_of))


def drop_outliers(df: DataFrame) -> DataFrame:
    """Rows that are not outliers; a missing flag is dropped too."""
    return df.where("outlier = 0")


def latest_rows(df: DataFrame, n: int = 5, keys: tuple[str, ...] = ("shop_id", "product_id")) -> DataFrame:
    """The last ``n`` rows by date, ties by key (a preview)."""
    return df.orderBy(F.col("t_date").desc(), *keys).limit(n)
