"""Business rules as column expressions.

Missing values are SQL NULL throughout; a comparison with NULL is not true, so every
rule below falls through to its ``otherwise`` branch on missing input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower edges of the right-closed temperature bins; each is 5 degrees wide.
TEMP_EDGES = (-15, -10, -5, 0, 5, 10, 15, 20, 25)
TEMP_WIDTH = 5


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def floor_qty(qty: Column | str, at_most: float = 3, floor: float = 4) -> Column:
    """Lift small quantities: ``at_most`` or less becomes ``floor``; NULL stays NULL."""
    qty = _col(qty)
    return F.when(qty <= at_most, F.lit(float(floor))).otherwise(qty)


def half_even(value: Column | str, digits: int = 0) -> Column:
    """Round half to even on the scaled double, as numeric Python does (6.25 -> 6.2)."""
    value = _col(value)
    if digits == 0:
        return F.rint(value)
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """Percentage with one decimal; NULL when the whole is zero."""
    return half_even(F.try_divide(_col(part).cast("double"), _col(whole)) * 100.0, 1)


def out_of_range_flag(percent: Column | str, limit: float = 15) -> Column:
    """1 when a product sold on at most ``limit`` percent of the trading days."""
    return F.when(_col(percent) <= limit, 1).otherwise(0)


def outlier_flag(
    out_of_range: Column | str = "out_of_range",
    in_range_mean: Column | str = "in_range_mean",
    qty: Column | str = "qty",
    *,
    busy_mean: float = 5,
    low_qty: float = 3,
    high_mean: float = 10,
    low_share: float = 0.3,
    single: float = 1,
    huge_qty: float = 300,
    out_share: float = 0.15,
) -> Column:
    """0/1 outlier flag; the first matching branch wins.

    The ratio of quantity to mean is NULL for a zero mean, so its conditions do not hold
    there (an intended difference: plain division would fail on such a row).
    """
    oor, mean, qty = _col(out_of_range), _col(in_range_mean), _col(qty)
    share = F.try_divide(qty, mean)
    far_below = (mean > high_mean) & (share < low_share)
    in_range = (
        F.when((mean > busy_mean) & (qty <= low_qty), 1)
        .when(far_below, 1)
        .when((mean <= busy_mean) & (qty == single), 1)
        .when(qty > huge_qty, 1)
        .otherwise(0)
    )
    off_range = (
        F.when(qty == single, 1)
        .when(mean.isNull(), 0)
        .when(far_below, 1)
        .when(share <= out_share, 1)
        .otherwise(0)
    )
    return F.when(oor == 0, in_range).otherwise(off_range)


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, and 1 where it is missing or the divisor is zero."""
    return F.coalesce(F.try_divide(_col(a), _col(b)), F.lit(1.0))


def clean_label(label: Column | str) -> Column:
    """Remove carriage returns; NULL stays NULL."""
    return F.replace(_col(label), F.lit("\r"), F.lit(""))


def _by_bin(temperature: Column, values: list) -> Column:
    chain = F
    for low, value in zip(TEMP_EDGES, values):
        chain = chain.when((temperature > low) & (temperature <= low + TEMP_WIDTH), value)
    return chain


def temp_range(temperature: Column | str) -> Column:
    """Bin label such as ``'0 to 5'``; NULL outside (-15, 30]."""
    return _by_bin(_col(temperature), [F.lit(f"{low} to {low + TEMP_WIDTH}") for low in TEMP_EDGES])


def temp_code(temperature: Column | str) -> Column:
    """Lower edge of the bin as a double; NULL outside (-15, 30]."""
    return _by_bin(_col(temperature), [F.lit(float(low)) for low in TEMP_EDGES])


def ape(actual: Column | str, predicted: Column | str) -> Column:
    """Absolute percentage error; NULL (not infinity) when the actual value is zero."""
    actual = _col(actual)
    return F.try_divide(F.abs(actual - _col(predicted)), actual)


def round_pred(predicted: Column | str) -> Column:
    """Whole-number prediction, half to even."""
    return half_even(predicted)


def accuracy_flag(
    actual: Column | str,
    predicted: Column | str,
    *,
    small: float = 20,
    units: float = 2,
    share: float = 0.1,
) -> Column:
    """1 when within ``units`` for small actual values, within ``share`` of larger ones."""
    actual, predicted = _col(actual), _col(predicted)
    error = F.abs(actual - predicted)
    return (
        F.when((actual <= small) & (error <= units), 1)
        .when((actual > small) & (F.try_divide(error, actual) <= share), 1)
        .otherwise(0)
    )
