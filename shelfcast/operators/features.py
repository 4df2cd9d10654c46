"""Rolling, lagged and same-weekday sales features of a daily panel.

Every window is partitioned by (shop_id, product_id) or by more columns that include
these two, and the first one by exactly these two, so one shuffle serves all of them.
Shifts count rows, not days: a gap in a series stretches them.

A series is one window group and cannot be split, so its length must be bounded.
``guard_grain`` makes sure of that: at most one row per series and calendar day, a few
thousand rows in ten years however large the panel is. Rows with a missing key leave.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.functions.rules import safe_ratio
from shelfcast.operators.checks import GRAIN, guard_grain

# Rows skipped before the window of a weekday and of a weekend day.
WEEKDAY_SHIFT, WEEKEND_SHIFT = 4, 2

WEEK_COLUMNS = ["rolling_week_sales", "week_old", "weekly_trend"]
SAME_DAY_COLUMNS = ["same_last_4_days", "same_last_6_days"]
WEEKPART_COLUMNS = [
    f"rolling_{n}_{what}" for n, what in [(4, "days"), (6, "days"), (4, "max"), (6, "max"), (4, "min"), (6, "min")]
]


def by_series() -> WindowSpec:
    return Window.partitionBy("shop_id", "product_id").orderBy("t_date")


def by_weekday() -> WindowSpec:
    return Window.partitionBy("shop_id", "product_id", "day_of_week").orderBy("t_date")


def by_weekpart() -> WindowSpec:
    return Window.partitionBy("shop_id", "product_id", "weekend_flag").orderBy("t_date")


def spread_series(df: DataFrame) -> DataFrame:
    """Rows shuffled by series over all ``spark.sql.shuffle.partitions`` tasks; the windows then need no shuffle.

    Adaptive execution merges the partitions of a shuffle up to a size on disk, whatever the rows weigh when the
    sorts of the windows hold them; it leaves a number that was asked for alone. For a panel saved by
    ``save_series_table``, which needs no shuffle, do without.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shop_id", "product_id")


def rolling_days(value: str, days: int = 7, fn: str = "avg") -> Column:
    """Aggregate ``fn`` over the trailing calendar days of the series, today included.

    Written as SQL because only there a day range can be laid over a date column; the order
    is that of ``by_series``, so the lags on top of it need no second sort.
    """
    return F.expr(
        f"{fn}({value}) OVER (PARTITION BY shop_id, product_id ORDER BY t_date "
        f"RANGE BETWEEN {days - 1} PRECEDING AND CURRENT ROW)"
    )


def _panel(df: DataFrame, guard: bool) -> DataFrame:
    kept = df.dropna(subset=GRAIN)
    return guard_grain(kept) if guard else kept


def rolling_std(df: DataFrame, target: str = "qty", *, guard: bool = True) -> DataFrame:
    """Seven-day sample standard deviation, four rows back, as ``rolling_std``."""
    return (
        _panel(df, guard)
        .withColumn("_std", rolling_days(target, 7, "stddev_samp"))
        .withColumn("rolling_std", F.lag("_std", 4).over(by_series()))
        .drop("_std")
    )


def _add_week(df: DataFrame, target: str) -> DataFrame:
    """Seven-day mean four rows back, the same seven rows earlier, and their ratio.

    The two are chained: the first window is anchored at an earlier row's date, so it cannot
    be folded into a single frame. The trend uses the values before any filling.
    """
    return (
        df.withColumn("_week", rolling_days(target))
        .withColumn("rolling_week_sales", F.lag("_week", 4).over(by_series()))
        .withColumn("week_old", F.lag("rolling_week_sales", 7).over(by_series()))
        .withColumn("weekly_trend", safe_ratio("rolling_week_sales", "week_old"))
        .drop("_week")
    )


def _add_same_weekday(df: DataFrame, target: str) -> DataFrame:
    """Mean of the previous four and six rows of the same weekday."""
    known = F.col("day_of_week").isNotNull()
    return df.withColumns(
        {
            f"same_last_{n}_days": F.when(known, F.avg(target).over(by_weekday().rowsBetween(-n, -1)))
            for n in (4, 6)
        }
    )


def _add_weekpart(df: DataFrame, target: str) -> DataFrame:
    """Mean, max and min of four and six rows among weekdays or among weekend days.

    The window ends four rows back on weekdays and two rows back on weekend days. Rows of
    one (series, weekend flag) group share the flag, so each feature is one of two frames.
    """

    def frame(n: int, shift: int) -> WindowSpec:
        return by_weekpart().rowsBetween(-(n + shift - 1), -shift)

    def pick(fn: Callable[[str], Column], n: int) -> Column:
        return F.when(F.col("weekend_flag") == 0, fn(target).over(frame(n, WEEKDAY_SHIFT))).when(
            F.col("weekend_flag") == 1, fn(target).over(frame(n, WEEKEND_SHIFT))
        )

    functions = {"days": F.avg, "max": F.max, "min": F.min}
    return df.withColumns(
        {f"rolling_{n}_{what}": pick(fn, n) for what, fn in functions.items() for n in (4, 6)}
    )


def week_features(df: DataFrame, target: str = "qty", *, guard: bool = True) -> DataFrame:
    """``rolling_week_sales`` and ``week_old``, both unfilled, and ``weekly_trend``."""
    return _add_week(_panel(df, guard), target)


def same_weekday_features(df: DataFrame, target: str = "qty", *, guard: bool = True) -> DataFrame:
    """``same_last_4_days`` and ``same_last_6_days``, unfilled."""
    return _add_same_weekday(_panel(df, guard), target)


def weekpart_features(df: DataFrame, target: str = "qty", *, guard: bool = True) -> DataFrame:
    """The six ``rolling_4/6`` means, maxima and minima, unfilled."""
    return _add_weekpart(_panel(df, guard), target)


def rolling_features(df: DataFrame, target: str = "qty", *, guard: bool = True) -> DataFrame:
    """All window columns before filling."""
    panel = df.withColumn(target, F.col(target).cast("double"))
    panel = _add_week(_panel(panel, guard), target)
    return _add_weekpart(_add_same_weekday(panel, target), target)


def fill_features(df: DataFrame, target: str = "qty") -> DataFrame:
    """Fill missing means with the target, then missing extremes with the filled means."""
    means = ["rolling_week_sales", *SAME_DAY_COLUMNS, "rolling_4_days", "rolling_6_days"]
    fills = {name: F.coalesce(name, target) for name in means}
    for n in (4, 6):
        for what in ("max", "min"):
            name = f"rolling_{n}_{what}"
            fills[name] = F.coalesce(name, f"rolling_{n}_days", target)
    return df.withColumns(fills)


def daily_trend() -> Column:
    """Ratio of the two filled same-weekday means."""
    return safe_ratio("same_last_4_days", "same_last_6_days")


def sales_features(df: DataFrame, target: str = "qty", *, guard: bool = True) -> DataFrame:
    """Input columns plus the thirteen sales features, filled."""
    filled = fill_features(rolling_features(df, target, guard=guard), target)
    return filled.withColumn("daily_trend", daily_trend()).select(
        *df.columns, *WEEK_COLUMNS, *SAME_DAY_COLUMNS, *WEEKPART_COLUMNS, "daily_trend"
    )
