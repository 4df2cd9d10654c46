"""Daily features from a stored tail of each series instead of its whole history.

The features of a row look back over a fixed number of rows: of its series, of its weekday in the series and
of its weekday or weekend part. The tail before a date holds at least so many of each. Features of
later days, worked out on the tail and the new rows, equal those worked out on all history; and the next tail
follows from this one and the new rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.dates import parse_ymd
from shelfcast.operators.checks import GRAIN
from shelfcast.operators.features import WEEKDAY_SHIFT, WEEKEND_SHIFT

# Rows that a feature reaches back: four and seven lags, then the other rows of a seven-day mean.
SERIES_ROWS = 4 + 7 + 6
# Six rows of the same weekday; six rows of the same part of the week behind the longer shift.
WEEKDAY_ROWS = 6
WEEKPART_ROWS = 6 + max(WEEKDAY_SHIFT, WEEKEND_SHIFT) - 1


def series_tail(rows: DataFrame, before: str | dt.date) -> DataFrame:
    """The rows before a date that features of that day or later can reach.

    For each series the last ``SERIES_ROWS`` rows, the last ``WEEKDAY_ROWS`` of each weekday and the last
    ``WEEKPART_ROWS`` of each part of the week: a bounded number for any length of history. ``rows`` is what
    the features are made of: no outliers, no missing keys, one row for a series and date.
    """
    latest = lambda *more: Window.partitionBy("shop_id", "product_id", *more).orderBy(F.desc("t_date"))
    kept = rows.where(F.col("t_date") < F.lit(parse_ymd(before))).dropna(subset=GRAIN)
    ranked = kept.withColumns(
        {
            "_in_series": F.row_number().over(latest()),
            "_in_weekday": F.row_number().over(latest("day_of_week")),
            "_in_part": F.row_number().over(latest("weekend_flag")),
        }
    )
    near = (F.col("_in_series") <= SERIES_ROWS) | (F.col("_in_weekday") <= WEEKDAY_ROWS) | (F.col("_in_part") <= WEEKPART_ROWS)
    return ranked.where(near).select(*rows.columns)


def advance_tail(tail: DataFrame, new: DataFrame, before: str | dt.date) -> DataFrame:
    """The tail before a later date, from an earlier tail and the rows since."""
    return series_tail(tail.unionByName(new.select(*tail.columns)), before)


def with_tail(tail: DataFrame, new: DataFrame, start: str | dt.date) -> DataFrame:
    """The rows that features from ``start`` on are worked out on: the tail before it and the new rows."""
    return tail.unionByName(new.where(F.col("t_date") >= F.lit(parse_ymd(start))).select(*tail.columns))
