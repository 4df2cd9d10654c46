"""Date arguments.

Jobs take their dates as arguments, so a run can be repeated. Only a missing ``as_of``
falls back to the current date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ymd(value: str | dt.date) -> dt.date:
    """``'20190101'`` or ``'2019-01-01'`` or a date, as a date."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value.replace("-", ""), "%Y%m%d").date()


def as_of_date(as_of: str | dt.date | None) -> Column:
    """The run date as a column: a literal, so that filters on it reach the scan."""
    return F.current_date() if as_of is None else F.lit(parse_ymd(as_of))
