from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException

from shelfcast.operators import features, lags

SCHEMA = "shop_id long, product_id long, t_date date, qty double, day_of_week int, weekend_flag int"


def row(shop, product, date, qty):
    return (shop, product, date, qty, date.isoweekday(), int(date.isoweekday() >= 6))


def collect(df, *keys):
    keys = keys or ("shop_id", "product_id", "t_date")
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def mean(values):
    present = [v for v in values if v is not None]
    return sum(present) / len(present) if present else None


def extreme(fn, values):
    present = [v for v in values if v is not None]
    return fn(present) if present else None


def brute(rows):
    """All unfilled features, series by series, straight from their definitions."""
    out = {}
    series = {}
    for r in rows:
        series.setdefault(r[:2], []).append(r)
    for key, members in series.items():
        members.sort(key=lambda r: r[2])
        week = [
            mean([o[3] for o in members[: i + 1] if o[2] > r[2] - dt.timedelta(days=7)])
            for i, r in enumerate(members)
        ]
        rolled = [week[i - 4] if i >= 4 else None for i in range(len(members))]
        for i, r in enumerate(members):
            same = [o[3] for o in members[:i] if o[4] == r[4]]
            part = [o[3] for o in members[:i] if o[5] == r[5]]
            shift = 4 if r[5] == 0 else 2
            part = part[: max(0, len(part) - (shift - 1))]
            old = rolled[i - 7] if i >= 7 else None
            ratio = 1.0 if rolled[i] is None or not old else rolled[i] / old
            out[(*key, r[2])] = {
                "rolling_week_sales": rolled[i],
                "week_old": old,
                "weekly_trend": ratio,
                "same_last_4_days": mean(same[-4:]),
                "same_last_6_days": mean(same[-6:]),
                "rolling_4_days": mean(part[-4:]),
                "rolling_6_days": mean(part[-6:]),
                "rolling_4_max": extreme(max, part[-4:]),
                "rolling_6_max": extreme(max, part[-6:]),
                "rolling_4_min": extreme(min, part[-4:]),
                "rolling_6_min": extreme(min, part[-6:]),
            }
    return out


@pytest.fixture(scope="module")
def panel():
    rng = random.Random(7)
    start = dt.date(2024, 1, 1)
    rows = [row(1, 1, start + dt.timedelta(days=i), float(i + 1)) for i in range(12)]
    for shop, product, share in [(1, 2, 0.9), (2, 1, 0.4), (2, 2, 0.15)]:
        for i in range(120):
            if rng.random() < share:
                qty = None if rng.random() < 0.15 else float(rng.randint(0, 40))
                rows.append(row(shop, product, start + dt.timedelta(days=i), qty))
    rng.shuffle(rows)
    return rows


def test_twelve_days(spark, panel, day):
    df = spark.createDataFrame(panel, SCHEMA)
    got = collect(features.rolling_features(df))
    names = ["rolling_week_sales", "week_old", "same_last_4_days", "rolling_4_days", "rolling_6_days",
             "rolling_4_max", "rolling_4_min", "weekly_trend"]
    expected = {
        4: [None, None, None, None, None, None, None, 1.0],
        5: [1.0, None, None, 1.0, 1.0, 1.0, 1.0, 1.0],
        6: [1.5, None, None, None, None, None, None, 1.0],
        8: [2.5, None, 1.0, 1.5, 1.5, 2.0, 1.0, 1.0],
        12: [5.0, 1.0, 5.0, 5.0, 23 / 6, 8.0, 3.0, 5.0],
    }
    for n, values in expected.items():
        assert [got[1, 1, day(n - 1)][name] for name in names] == pytest.approx(values), n
    filled = collect(features.sales_features(df))[1, 1, day(3)]
    assert (filled.rolling_4_days, filled.rolling_4_max, filled.rolling_4_min) == (4.0, 4.0, 4.0)


def test_against_definitions(spark, panel):
    df = spark.createDataFrame(panel, SCHEMA)
    got, expected = collect(features.rolling_features(df)), brute(panel)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        for name, value in values.items():
            assert got[key][name] == pytest.approx(value), (key, name)


def test_filling(spark, panel):
    df = spark.createDataFrame(panel, SCHEMA)
    got, raw = collect(features.sales_features(df)), brute(panel)
    for key, r in got.items():
        u = raw[key]
        first = lambda *v: next((x for x in v if x is not None), None)
        four, six = first(u["same_last_4_days"], r.qty), first(u["same_last_6_days"], r.qty)
        assert r.same_last_4_days == pytest.approx(four) and r.same_last_6_days == pytest.approx(six)
        assert r.rolling_week_sales == pytest.approx(first(u["rolling_week_sales"], r.qty))
        assert r.week_old == pytest.approx(u["week_old"])
        assert r.rolling_6_min == pytest.approx(first(u["rolling_6_min"], u["rolling_6_days"], r.qty))
        assert r.daily_trend == pytest.approx(four / six if four is not None and six else 1.0)


def test_leading_rows_are_missing_before_filling(spark, day):
    rows = [row(1, 1, day(i), 5.0) for i in range(30)]
    got = collect(features.rolling_features(spark.createDataFrame(rows, SCHEMA)))
    assert [got[1, 1, day(i)].rolling_week_sales is None for i in range(30)] == [i < 4 for i in range(30)]
    assert [got[1, 1, day(i)].week_old is None for i in range(30)] == [i < 11 for i in range(30)]


def test_duplicate_date_fails(spark, day):
    rows = [row(1, 1, day(0), 1.0), row(1, 1, day(0), 2.0), row(1, 1, day(1), 3.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(PySparkException, match="two rows for one series and date"):
        features.sales_features(df).collect()
    with pytest.raises(PySparkException, match="two rows"):
        features.sales_features(df).select("shop_id").collect()
    assert features.sales_features(df, guard=False).count() == 3


def test_missing_keys_leave_and_missing_weekday_is_filled(spark, day):
    rows = [row(1, 1, day(0), 1.0), row(1, 1, day(7), 2.0), (None, 1, day(0), 1.0, 1, 0), (1, 1, None, 1.0, 1, 0),
            (2, 1, day(0), 8.0, None, None), (2, 1, day(7), 9.0, None, None)]
    got = collect(features.sales_features(spark.createDataFrame(rows, SCHEMA)))
    assert len(got) == 4
    assert got[1, 1, day(7)].same_last_4_days == 1.0
    assert got[2, 1, day(7)].same_last_4_days == 9.0


def test_rolling_std(spark, day):
    rows = [row(1, 1, day(i), float(v)) for i, v in enumerate([2, 4, 9, 1, 5, 7])]
    got = collect(features.rolling_std(spark.createDataFrame(rows, SCHEMA)))
    assert got[1, 1, day(4)].rolling_std is None
    assert got[1, 1, day(5)].rolling_std == pytest.approx(2**0.5)


def test_lag_filling(spark):
    names = ", ".join(f"SameDay_{k}_weeks double" for k in range(1, 7))
    df = spark.createDataFrame([(7.0, None, None, 4.0, None, None, None)], "qty double, " + names)
    assert list(lags.fill_same_day(df).first())[1:] == [7.0, 7.0, 4.0, 4.0, 4.0, 4.0]
    assert list(lags.fill_same_day(df, zero=True).first())[1:] == [0.0, 0.0, 4.0, 0.0, 0.0, 0.0]


def test_lags_and_stats(spark, day):
    values = [3.0, None, 8.0, 1.0, 6.0, 6.0, 2.0, 5.0, 4.0]
    rows = [row(1, 1, day(i), v) for i, v in enumerate(values)]
    got = collect(lags.lag_features(spark.createDataFrame(rows, SCHEMA)))
    last, first = got[1, 1, day(8)], got[1, 1, day(0)]
    assert first.rolling_three_day_avg is None and first.rolling_seven_day_median is None
    assert last.rolling_three_day_avg == pytest.approx(13 / 3)
    assert (last.rolling_five_day_max, last.rolling_five_day_min) == (6.0, 1.0)
    assert last.rolling_five_day_median == 5.0 and last.rolling_seven_day_median == pytest.approx(5.5)
    assert got[1, 1, day(7)].Same_day_1_week_ago == 3.0 and last.Same_day_1_week_ago is None


def test_series_are_spread_over_the_tasks_asked_for(spark):
    """Adaptive execution would merge these few rows into one window task."""
    from shelfcast.catalog import queries

    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("sales_features", "feature_fill"):
        df = queries()[name](spark, "/root/testdata/sf0.001")
        assert df.rdd.getNumPartitions() == number > 1
        text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert text.count("Exchange hashpartitioning(shop_id") == 2 and "REPARTITION_BY_NUM" in text  # days, then series
