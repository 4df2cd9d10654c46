from __future__ import annotations

import pytest

from shelfcast.operators import dataset, weather

FORECAST = (
    "ForecastSiteUID long, ForecastDate date, CurrentForecast int, MaxTemperature double, MinTemperature double, "
    "FeelsLikeTemperature double, SunshineHours double, WeatherDescriptor string"
)


@pytest.fixture
def tables(spark, day):
    detail = spark.createDataFrame(
        [(1, p, day(i)) for p in range(3) for i in range(3)] + [(2, 1, day(0)), (3, 1, day(0))],
        "shop_id long, product_id long, t_date date",
    )
    sites = spark.createDataFrame([(1, 10), (3, None)], "Shop_ID long, SiteUID long")
    forecast = spark.createDataFrame(
        [(10, day(0), 1, 5.0, 1.0, 3.0, 2.0, "Sun\r"), (10, day(0), 0, 9.0, 9.0, 9.0, 9.0, "Old"),
         (10, day(1), 1, 40.0, 31.0, 30.5, 9.0, "Rain"), (None, day(0), 1, 1.0, 1.0, 1.0, 1.0, "Lost")],
        FORECAST,
    )
    return detail, sites, forecast


def test_join_keeps_rows_and_key_columns(tables):
    detail, sites, forecast = tables
    got = weather.join_weather(detail, sites, forecast)
    assert got.columns == [*detail.columns, "SiteUID", *weather.FORECAST_COLUMNS]
    rows = {(r.shop_id, r.product_id, r.t_date.day): r for r in got.collect()}
    assert len(rows) == got.count() == detail.count()
    assert rows[1, 0, 1].WeatherDescriptor == "Sun" and rows[1, 0, 1].ForecastSiteUID == 10
    assert rows[1, 0, 3].SiteUID == 10 and rows[1, 0, 3].ForecastSiteUID is None
    assert rows[2, 1, 1].SiteUID is None and rows[3, 1, 1].WeatherDescriptor is None


def test_label_codes(spark):
    labels = ["Sun"] * 3 + ["Rain\r"] * 2 + ["Rain", "Fog", None]
    df = spark.createDataFrame([(v,) for v in labels], "label string")
    cleaned = df.select(weather.clean_label("label").alias("label"))
    codes = weather.fit_label_codes(cleaned, "label")
    assert {r.label: (r.n_rows, r.code) for r in codes.collect()} == {"Rain": (3, 0.0), "Sun": (3, 1.0), "Fog": (1, 2.0)}
    got = weather.apply_label_codes(cleaned, codes, "label").collect()
    assert len(got) == 8 and sum(r.code is None for r in got) == 1


def test_codes_are_dense_and_ordered(spark):
    labels = [f"L{i:03d}" for i in range(60) for _ in range(i % 7 + 1)]
    df = spark.createDataFrame([(v,) for v in labels], "label string")
    codes = sorted(weather.fit_label_codes(df, "label").collect(), key=lambda r: r.code)
    assert [r.code for r in codes] == [float(i) for i in range(60)]
    assert [(r.n_rows, r.label) for r in codes] == sorted(
        {(labels.count(v), v) for v in labels}, key=lambda t: (-t[0], t[1])
    )


def test_weather_codes_count_sales_rows(tables):
    detail, sites, forecast = tables
    fast = {tuple(r) for r in weather.fit_weather_codes(detail, sites, forecast).collect()}
    joined = weather.join_weather(detail, sites, forecast)
    plain = weather.fit_label_codes(joined, "WeatherDescriptor", "Weather_Code")
    assert fast == {tuple(r) for r in plain.collect()} == {("Rain", 3, 0.0), ("Sun", 3, 1.0)}


def test_weather_columns(tables):
    detail, sites, forecast = tables
    got = weather.add_weather(detail, sites, forecast)
    assert got.columns[-3:] == ["Weather_Code", "Temp Range", "temp_code"]
    rows = {(r.shop_id, r.product_id, r.t_date.day): r for r in got.collect()}
    assert rows[1, 2, 1]["Temp Range"] == "0 to 5" and rows[1, 2, 1].temp_code == 0.0
    assert rows[1, 2, 2].temp_code is None and rows[1, 2, 2].Weather_Code == 0.0
    assert rows[2, 1, 1].Weather_Code is None


def test_saved_codes_are_reused(spark, tables):
    detail, sites, forecast = tables
    codes = spark.createDataFrame([("Sun", 7.0)], "WeatherDescriptor string, Weather_Code double")
    got = weather.add_weather(detail, sites, forecast, codes)
    assert {(r.WeatherDescriptor, r.Weather_Code) for r in got.collect()} == {("Sun", 7.0), ("Rain", None), (None, None)}


def test_holidays_and_scoring_input(spark, day):
    features = spark.createDataFrame(
        [(s, 1, day(i), 0, *[1.0] * 15) for s in (1, 2) for i in range(3)],
        "shop_id long, product_id long, t_date date, weekend_flag int, "
        + ", ".join(
            f"{n} double"
            for n in ("rolling_week_sales weekly_trend same_last_4_days same_last_6_days daily_trend rolling_4_days "
                      "rolling_6_days day_of_week_no rolling_4_max rolling_6_max rolling_4_min rolling_6_min "
                      "bank_holiday_flag Weather_Code temp_code").split()
        ),
    )
    holidays = spark.createDataFrame(
        [(1, day(1), "a", 1), (1, day(1), "b", 1)], "shop_id long, date date, shop_name string, school_holiday int"
    )
    clusters = spark.createDataFrame([(1, 3, "x")], "shop_id long, cluster int, description string")
    got = dataset.scoring_input(features, holidays, clusters, day(1))
    rows = {(r.shop_id, r.t_date): r for r in got.collect()}
    assert len(rows) == got.count() == 4
    assert rows[1, day(1)].school_holiday == 1 and rows[1, day(2)].school_holiday == 0
    assert rows[1, day(1)].cluster == 3 and rows[2, day(1)].cluster is None
    assert rows[1, day(1)].out_of_range == 0
    one = holidays.where("shop_name = 'a'")
    joined = dataset.add_holidays(features.select("shop_id", "t_date"), one)
    assert joined.count() == 6 and joined.where("shop_name = 'a'").count() == 1


def test_split(spark, day):
    df = spark.createDataFrame([(day(i),) for i in range(10)], "t_date date")
    train, test = dataset.split_by_date(df, day(1), day(4), day(7))
    assert (train.count(), test.count()) == (3, 3)
    assert dataset.split_by_date(df, day(1), day(4), day(7), closed=True)[1].count() == 4


def test_many_labels_of_one_frequency(spark, monkeypatch):
    """A wide vocabulary is numbered in many ranges, in the right order."""
    counts = spark.range(20_000).selectExpr("concat('l', lpad(id, 6, '0')) AS label", "IF(id % 1000 = 0, id + 2, 1) AS n_rows")
    plain, stored = weather.stage, []
    monkeypatch.setattr(weather, "stage", lambda df, name: stored.append(plain(df, name)) or stored[-1])
    ranked = weather.rank_labels(counts, "label")
    got = {r.label: r.code for r in ranked.collect()}
    rows = sorted((-r.n_rows, r.label) for r in counts.collect())
    assert got == {label: float(i) for i, (_, label) in enumerate(rows)}
    assert stored[0].select("_range").distinct().count() == 8


def test_saved_codes_keep_their_values(spark):
    saved = spark.createDataFrame([("sun", 9, 0.0), ("rain", 4, 3.0)], "WeatherDescriptor string, n_rows long, Weather_Code double")
    fitted = spark.createDataFrame([("fog", 8, 1.0), ("sun", 2, 2.0), ("hail", 8, 5.0)], saved.schema)
    got = {r.WeatherDescriptor: r.Weather_Code for r in weather.extend_codes(saved, fitted).collect()}
    assert got == {"fog": 4.0, "hail": 5.0}


def test_codes_do_not_hang_on_reused_exchanges(spark):
    """Ranks and counts rest on the same ranges, whatever the planner reuses."""
    counts = spark.range(300_000).selectExpr("concat('label', id) AS label", "1 + pmod(xxhash64(id), 5) AS n_rows").repartition(16)
    before = spark.conf.get("spark.sql.exchange.reuse", "true")
    try:
        spark.conf.set("spark.sql.exchange.reuse", "false")
        codes = weather.rank_labels(counts, "label")
        got = codes.selectExpr("count(DISTINCT code) AS codes", "min(code) AS low", "max(code) AS high", "count(*) AS n").first()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    assert tuple(got) == (300_000, 0.0, 299_999.0, 300_000)
