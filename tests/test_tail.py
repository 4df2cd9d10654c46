"""Features from a stored tail equal those from all history."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from shelfcast.operators import features, lags, tail


def panel(spark, day, seed=4, days=400):
    rng = random.Random(seed)
    rows = []
    for shop in range(6):
        # Dense, sparse, and with weekdays that hardly ever occur.
        for offset in range(days):
            weekday = day(offset).isoweekday()
            if rng.random() < (0.95, 0.5, 0.1, 0.9, 0.7, 0.03)[shop] and not (shop == 3 and weekday == 3 and offset % 70):
                rows.append((shop, 1, day(offset), float(rng.randint(0, 50)), weekday, int(weekday >= 6)))
    return spark.createDataFrame(rows, "shop_id long, product_id long, t_date date, qty double, day_of_week int, weekend_flag int")


def test_all_features_from_the_tail(spark, day):
    whole = panel(spark, day).cache()
    start = day(350)
    since = F.col("t_date") >= F.lit(start)
    kept = tail.series_tail(whole, start)
    assert kept.columns == whole.columns and 0 < kept.count() < whole.where(~since).count()
    rows = tail.with_tail(kept, whole, start)
    for work in (lambda df: features.sales_features(df), lambda df: lags.lag_features(df), lambda df: features.rolling_std(df)):
        want = sorted(map(str, work(whole).where(since).collect()))
        assert sorted(map(str, work(rows).where(since).collect())) == want and len(want) > 100


def test_a_tail_is_bounded_and_can_be_brought_forward(spark, day):
    whole = panel(spark, day).cache()
    earlier = tail.series_tail(whole, day(200))
    for before in (210, 211, 300):
        between = whole.where((F.col("t_date") >= F.lit(day(200))) & (F.col("t_date") < F.lit(day(before))))
        moved = tail.advance_tail(earlier, between, day(before))
        assert sorted(map(str, moved.collect())) == sorted(map(str, tail.series_tail(whole, day(before)).collect()))
    most = tail.SERIES_ROWS + 7 * tail.WEEKDAY_ROWS + 2 * tail.WEEKPART_ROWS
    assert tail.series_tail(whole, day(400)).groupBy("shop_id").count().agg(F.max("count")).first()[0] <= most


def test_new_series_missing_keys_and_empty_tails(spark, day):
    whole = panel(spark, day, days=30)
    lost = whole.withColumn("product_id", F.lit(None).cast("long"))
    assert tail.series_tail(lost, day(20)).count() == 0
    none = tail.series_tail(whole, day(0))
    assert none.count() == 0
    rows = features.sales_features(tail.with_tail(none, whole, day(0)))
    assert rows.count() == whole.count()
