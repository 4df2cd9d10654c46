from __future__ import annotations

import datetime as dt
import random

import pytest

from shelfcast.operators import checks, outliers, ranging, sales

SCHEMA = (
    "shop_id long, product_id long, t_date date, qty double, weekend_flag int, "
    "week_day_description string, quarter_label string"
)


def make(seed=3):
    rng = random.Random(seed)
    rows = []
    for shop in (1, 2):
        for product, share in ((1, 0.9), (2, 0.5), (3, 0.1), (4, 0.05)):
            for i in range(200):
                date = dt.date(2024, 1, 1) + dt.timedelta(days=i)
                if rng.random() < share:
                    qty = None if rng.random() < 0.1 else float(rng.choice([1, 2, 3, 8, 20, 25, 310]))
                    label = None if i % 37 == 0 else f"Q{i // 100}"
                    name = None if i % 41 == 0 else str(date.isoweekday())
                    rows.append((shop, product, date, qty, int(date.isoweekday() >= 6), name, label))
    # Two rows for one date, as overlapping launches produce them.
    rows += [r[:6] + ("Q9",) for r in rows if r[0] == 1 and r[1] == 1][:30]
    rng.shuffle(rows)
    return rows


def brute(rows):
    keyed = [r for r in rows if r[6] is not None]
    sold, days = {}, {}
    for r in keyed:
        key = (r[0], r[1], r[6], r[4])
        sold[key] = sold.get(key, 0) + (r[3] is not None)
        days.setdefault((r[0], r[6], r[4]), set()).add(r[2])
    percent = {k: round(n / len(days[k[0], k[2], k[3]]) * 1000) / 10 for k, n in sold.items()}
    oor = {k: int(p <= 15) for k, p in percent.items()}
    groups = {}
    for r in keyed:
        if r[5] is not None:
            flag = oor[r[0], r[1], r[6], r[4]]
            groups.setdefault((r[0], r[1], r[5], flag), []).append(r)

    def mean(values):
        values = [v for v in values if v is not None]
        return sum(values) / len(values) if values else None

    result = []
    for r in keyed:
        if r[5] is None:
            continue
        key = (r[0], r[1], r[6], r[4])
        sides = [groups.get((r[0], r[1], r[5], flag), []) for flag in (0, 1)]
        m, q = mean([o[3] for o in sides[0]]), r[3]
        days_sold = [mean([sold[o[0], o[1], o[6], o[4]] for o in side]) for side in sides]
        if oor[key] == 0:
            flag = (m is not None and q is not None) and (
                (m > 5 and q <= 3) or (m > 10 and q / m < 0.3) or (m <= 5 and q == 1)
            ) or (q is not None and q > 300)
        else:
            flag = q == 1 or (m is not None and q is not None and ((m > 10 and q / m < 0.3) or q / m <= 0.15))
        result.append((*r, sold[key], percent[key], oor[key], m, mean([o[3] for o in sides[1]]), *days_sold, int(flag)))
    return result


def rounded(rows):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in map(_sortable, rows))


def _sortable(r):
    return tuple("~" if v is None else str(v) if isinstance(v, (str, dt.date)) else float(v) for v in r)


COLUMNS = [
    "shop_id", "product_id", "t_date", "qty", "weekend_flag", "week_day_description", "quarter_label",
    "no_days_sold", "sales_vol_percent", "out_of_range", "in_range_mean", "out_of_range_mean",
    "days_sold_range", "days_sold_out_of_range", "outlier",
]


def test_both_ways_match_the_definition(spark):
    rows = make()
    df = spark.createDataFrame(rows, SCHEMA)
    keyed = lambda frame: sorted(map(str, rounded(map(tuple, frame.select(*COLUMNS).collect()))))
    expected = sorted(map(str, rounded(brute(rows))))
    assert keyed(outliers.find_outliers(ranging.range_finder(df))) == expected
    assert keyed(outliers.flag_outliers(df)) == expected
    flags = {r[-1] for r in brute(rows)}
    assert flags == {0, 1}


def test_same_columns_both_ways(spark):
    df = spark.createDataFrame(make(), SCHEMA)
    assert outliers.flag_outliers(df).columns == outliers.find_outliers(ranging.range_finder(df)).columns


def test_only_in_range_rows(spark):
    rows = [(1, 1, dt.date(2024, 1, 1) + dt.timedelta(days=i), 5.0, 0, "x", "Q") for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    means = outliers.outlier_means(ranging.range_finder(df)).collect()
    assert len(means) == 1
    assert means[0].in_range_mean == 5.0 and means[0].days_sold_range == 10.0
    assert means[0].out_of_range_mean is None and means[0].days_sold_out_of_range is None
    assert outliers.flag_outliers(df).first().out_of_range_mean is None


def test_outlier_ratio(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (None,)], "outlier int")
    assert outliers.outlier_ratio(df).first()[0] == 25.0
    assert outliers.outlier_ratio(df.where("outlier = 7")).first()[0] is None


def test_launch_calendar(spark, day):
    calendar = spark.createDataFrame([(day(i),) for i in range(10)] + [(day(0),)], "date date")
    launches = spark.createDataFrame(
        [("A", day(1), day(3)), ("B", day(3), day(5)), ("C", day(9), day(8)), ("D", None, day(4))],
        "launch_name string, start_date date, end_date date",
    )
    got = sorted(map(tuple, sales.launch_calendar(calendar, launches).collect()))
    assert got == [(day(1), "A"), (day(2), "A"), (day(3), "A"), (day(3), "B"), (day(4), "B"), (day(5), "B")]


def test_enrich_keeps_and_multiplies_rows(spark, day):
    daily = spark.createDataFrame(
        [(1, 1, day(0), 2.0), (1, 1, day(3), 3.0), (9, 1, day(9), 4.0)],
        "shop_id long, product_id long, t_date date, qty double",
    )
    totals = spark.createDataFrame([(1, day(0), 10.5)], "shop_id long, date date, actual_retail_sales_net double")
    clusters = spark.createDataFrame([(1, 3, "City")], "shop_id long, cluster int, description string")
    quarters = spark.createDataFrame([(day(3), "A"), (day(3), "B")], "date date, launch_name string")
    got = sales.enrich_sales(daily, totals, clusters, quarters)
    assert got.columns == [*daily.columns, "actual_retail_sales_net", "cluster", "description", "quarter_label"]
    rows = sorted(map(str, (tuple(r)[3:] for r in got.collect())))
    assert rows == sorted(
        map(str, [(2.0, 10.5, 3, "City", None), (3.0, None, 3, "City", "A"), (3.0, None, 3, "City", "B"),
                  (4.0, None, None, None, None)])
    )
    assert [r.qty for r in sales.sales_between(got, "20240101", "2024-01-02", 3).collect()] == [2.0]


def test_date_filters(spark, day):
    df = spark.createDataFrame([(day(i),) for i in range(-200, 10)], "t_date date")
    recent = sales.recent_sales(df, day(0)).agg({"t_date": "min"}).first()[0], sales.recent_sales(df, day(0)).count()
    assert recent == (dt.date(2023, 7, 1), 184)
    assert sales.from_date(df, day(0)).count() == 10


def test_guards_and_profile(spark, day):
    df = spark.createDataFrame([(1, 1, day(0)), (1, 1, day(1)), (1, 1, day(1))], "shop_id long, product_id long, t_date date")
    assert [r.n_rows for r in checks.duplicate_keys(df).collect()] == [2]
    with pytest.raises(ValueError, match="duplicate key"):
        checks.assert_unique_key(df)
    checks.assert_unique_key(df.distinct())
    assert tuple(checks.profile(df).first()) == (day(0), day(1), 3, 3)
    with pytest.raises(ValueError, match="missing columns: nope"):
        checks.project(df, ["shop_id", "nope"])
    assert checks.modelling_columns(["a", "b", "c"], ["b"]) == ["a", "c"]
    flagged = spark.createDataFrame([(0,), (1,), (None,)], "outlier int")
    assert sales.drop_outliers(flagged).count() == 1
