from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import (
    accuracy_flag,
    ape,
    clean_label,
    floor_qty,
    half_even,
    out_of_range_flag,
    outlier_flag,
    parse_ymd,
    percent_of,
    round_pred,
    safe_ratio,
    temp_code,
    temp_range,
)


def evaluate(spark, schema, rows, column):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, " + schema)
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def test_outlier_rule(spark):
    cases = [
        (0, 6.0, 3.0, 1), (0, 5.0, 3.0, 0), (0, 20.0, 5.0, 1), (0, 20.0, 6.0, 0), (0, 5.0, 1.0, 1),
        (0, 500.0, 301.0, 1), (0, 500.0, 300.0, 0), (0, 400.0, 100.0, 1), (0, 4.0, None, 0),
        (0, 0.0, 5.0, 0), (0, None, 301.0, 1), (0, None, 3.0, 0), (1, 50.0, 1.0, 1), (1, None, 2.0, 0),
        (1, 20.0, 5.0, 1), (1, 10.0, 1.5, 1), (1, 10.0, 2.0, 0), (1, 8.0, 3.0, 0), (1, 0.0, 5.0, 0),
        (1, 10.0, None, 0),
    ]
    got = evaluate(
        spark, "out_of_range int, in_range_mean double, qty double", [c[:3] for c in cases], outlier_flag()
    )
    assert got == [c[3] for c in cases]


def test_outlier_thresholds_are_arguments(spark):
    rows = [(0, 4.0, 3.0), (0, 400.0, 290.0)]
    got = evaluate(
        spark, "out_of_range int, in_range_mean double, qty double", rows,
        outlier_flag(busy_mean=3, huge_qty=280),
    )
    assert got == [1, 1]


def test_temperature_bins(spark):
    cases = [(-15.0, None), (-14.9, -15.0), (-10.0, -15.0), (0.0, -5.0), (0.1, 0.0), (5.0, 0.0),
             (30.0, 25.0), (30.1, None), (None, None), (5e-324, 0.0)]
    rows = [(t,) for t, _ in cases]
    codes = evaluate(spark, "t double", rows, temp_code("t"))
    labels = evaluate(spark, "t double", rows, temp_range("t"))
    assert codes == [code for _, code in cases]
    assert labels == [None if c is None else f"{int(c)} to {int(c) + 5}" for _, c in cases]


def test_accuracy(spark):
    cases = [(20.0, 22.0, 1), (20.0, 23.0, 0), (21.0, 23.0, 1), (21.0, 24.0, 0), (100.0, 110.0, 1),
             (None, 5.0, 0), (5.0, None, 0)]
    assert evaluate(spark, "y double, p double", [c[:2] for c in cases], accuracy_flag("y", "p")) == [
        c[2] for c in cases
    ]


def test_rounding_and_ratios(spark):
    values = evaluate(spark, "x double", [(2.5,), (3.5,), (-0.5,), (None,)], round_pred("x"))
    assert values[:2] == [2.0, 4.0] and values[2] == 0 and values[3] is None
    assert evaluate(spark, "x double", [(6.25,), (6.35,), (15.05,)], half_even("x", 1)) == [6.2, 6.4, 15.0]
    rows = [(1, 16), (3, 20), (4, 20), (1, 0)]
    assert evaluate(spark, "n long, d long", rows, percent_of("n", "d")) == [6.2, 15.0, 20.0, None]
    assert evaluate(spark, "n long, d long", rows, out_of_range_flag(percent_of("n", "d"))) == [1, 1, 0, 0]
    ratios = [(1.0, 0.0), (0.0, 0.0), (None, 2.0), (2.0, None), (3.0, 2.0)]
    assert evaluate(spark, "a double, b double", ratios, safe_ratio("a", "b")) == [1.0, 1.0, 1.0, 1.0, 1.5]
    assert evaluate(spark, "y double, p double", [(0.0, 3.0), (4.0, 5.0), (None, 1.0)], ape("y", "p")) == [
        None, 0.25, None,
    ]


def test_percent_rounds_as_scaled_double(spark):
    """All small fractions against the scaled half-even rule in Python."""
    rows = [(n, d) for d in range(1, 93) for n in range(0, d + 1)]
    got = evaluate(spark, "n long, d long", rows, percent_of("n", "d"))
    assert got == [round(n / d * 100 * 10.0) / 10.0 for n, d in rows]


def test_floor_and_labels(spark):
    assert evaluate(spark, "q double", [(1.0,), (3.0,), (3.5,), (9.0,), (None,)], floor_qty("q")) == [
        4.0, 4.0, 3.5, 9.0, None,
    ]
    assert evaluate(spark, "s string", [("Rain\r",), ("\rSun",), (None,)], clean_label("s")) == [
        "Rain", "Sun", None,
    ]


@pytest.mark.parametrize("value", ["20190610", "2019-06-10", dt.date(2019, 6, 10), dt.datetime(2019, 6, 10, 5)])
def test_parse_ymd(value):
    assert parse_ymd(value) == dt.date(2019, 6, 10)


def test_parse_ymd_rejects_other_text():
    with pytest.raises(ValueError):
        parse_ymd("10/06/2019")


def test_rules_are_columns_without_python_workers(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("q"))
    plan = df.select(floor_qty("q"), temp_code("q"), round_pred("q"))._jdf.queryExecution().toString()
    assert "Python" not in plan
