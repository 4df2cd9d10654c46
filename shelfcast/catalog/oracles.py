"""The registered queries in DuckDB SQL, over the same test tables.

``VIEWS`` are named building blocks; ``_sql`` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

from shelfcast.catalog.ensembles import FEATURES as TREE_FEATURES
from shelfcast.catalog.ensembles import NODES

VIEWS = {
    # --- stand-in tables
    "fx_sales": """
        SELECT shop_id, product_id, t_date, qty,
               CAST(isodow(t_date) AS INTEGER) AS day_of_week,
               CAST(isodow(t_date) AS INTEGER) AS day_of_week_no,
               CAST(CASE WHEN isodow(t_date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS weekend_flag,
               CAST(isodow(t_date) AS VARCHAR) AS week_day_description,
               CAST(CASE WHEN month(t_date) = 12 AND day(t_date) = 25 THEN 1 ELSE 0 END AS INTEGER)
                   AS bank_holiday_flag
        FROM (SELECT l_suppkey // 4 AS shop_id,
                     CASE WHEN l_partkey % 64 = 7 THEN 8 ELSE l_partkey % 8 END AS product_id,
                     CAST(l_shipdate AS DATE) AS t_date,
                     sum(CASE WHEN l_partkey % 8 = 0 THEN ceil(l_quantity / 25)
                              WHEN l_partkey % 8 = 1 THEN l_quantity * 10 ELSE l_quantity END) AS qty
              FROM lineitem GROUP BY 1, 2, 3)""",
    "fx_calendar": "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem",
    "fx_launch": """
        SELECT year(date) || 'Q' || quarter(date) AS launch_name,
               min(date) AS start_date, max(date) AS end_date
        FROM fx_calendar GROUP BY year(date), quarter(date)""",
    "fx_totals": """
        SELECT o_custkey // 60 AS shop_id, CAST(o_orderdate AS DATE) AS date,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS actual_retail_sales_net
        FROM orders GROUP BY 1, 2""",
    "fx_shops": "SELECT DISTINCT s_suppkey // 4 AS shop_id FROM supplier",
    "fx_clusters": """
        SELECT shop_id, CAST((shop_id * 3 + 3) % 7 AS INTEGER) AS cluster, r_name AS description
        FROM fx_shops JOIN region ON shop_id % 5 = r_regionkey WHERE shop_id % 25 <> 24""",
    "fx_sites": """
        SELECT shop_id AS site_shop, shop_id // 5 AS SiteUID FROM fx_shops WHERE shop_id % 25 <> 23""",
    "fx_forecast": """
        SELECT ForecastSiteUID, ForecastDate, v.flag AS CurrentForecast,
               felt + 1 - v.flag + 3 AS MaxTemperature, felt + 1 - v.flag - 4 AS MinTemperature,
               felt + 1 - v.flag AS FeelsLikeTemperature, CAST(hours AS DOUBLE) AS SunshineHours,
               WeatherDescriptor
        FROM (SELECT o_custkey // 300 AS ForecastSiteUID, CAST(o_orderdate AS DATE) AS ForecastDate,
                     CAST(min(o_orderkey) % 50 - 17 AS DOUBLE) AS felt, count(*) AS hours,
                     min(o_orderpriority) || chr(13) AS WeatherDescriptor
              FROM orders GROUP BY 1, 2), (VALUES (1), (0)) AS v(flag)""",
    "fx_holidays": """
        SELECT DISTINCT l_suppkey // 4 AS shop_id, CAST(l_shipdate AS DATE) AS date,
               'shop ' || CAST(l_suppkey // 4 AS VARCHAR) AS shop_name,
               CAST(CASE WHEN month(l_shipdate) IN (8, 12) THEN 1 ELSE 0 END AS INTEGER) AS school_holiday
        FROM lineitem""",
    # --- extract
    "quarters": """
        SELECT DISTINCT a.date, b.launch_name FROM fx_calendar a
        JOIN fx_launch b ON a.date BETWEEN b.start_date AND b.end_date""",
    "extract": """
        SELECT a.*, b.actual_retail_sales_net, d.cluster, d.description, e.launch_name AS quarter_label
        FROM fx_sales a
        LEFT JOIN fx_totals b ON a.shop_id = b.shop_id AND a.t_date = b.date
        LEFT JOIN fx_clusters d ON d.shop_id = a.shop_id
        LEFT JOIN quarters e ON e.date = a.t_date""",
    "labelled": """
        SELECT a.*, e.launch_name AS quarter_label
        FROM fx_sales a LEFT JOIN quarters e ON e.date = a.t_date""",
    # --- range and outliers, over a view named src
    "sold": """
        SELECT shop_id, product_id, quarter_label, weekend_flag, count(qty) AS no_days_sold
        FROM src WHERE quarter_label IS NOT NULL GROUP BY ALL""",
    "trading": """
        SELECT shop_id, quarter_label, weekend_flag, count(DISTINCT t_date) AS shop_trading_days
        FROM src WHERE quarter_label IS NOT NULL GROUP BY ALL""",
    "prange": """
        SELECT *, CAST(CASE WHEN sales_vol_percent <= 15 THEN 1 ELSE 0 END AS INTEGER) AS out_of_range
        FROM (SELECT sold.*, shop_trading_days,
                     round_even(CAST(no_days_sold AS DOUBLE) / shop_trading_days * 100 * 10, 0) / 10
                         AS sales_vol_percent
              FROM sold JOIN trading USING (shop_id, quarter_label, weekend_flag))""",
    "ranged": """
        SELECT src.*, no_days_sold, shop_trading_days, sales_vol_percent, out_of_range
        FROM src JOIN prange USING (shop_id, product_id, quarter_label, weekend_flag)""",
    "means": """
        SELECT shop_id, product_id, week_day_description,
               avg(qty) FILTER (out_of_range = 0) AS in_range_mean,
               avg(qty) FILTER (out_of_range = 1) AS out_of_range_mean,
               avg(no_days_sold) FILTER (out_of_range = 0) AS days_sold_range,
               avg(no_days_sold) FILTER (out_of_range = 1) AS days_sold_out_of_range
        FROM ranged GROUP BY ALL""",
    "flagged": """
        SELECT *, CAST(CASE
            WHEN out_of_range = 0 THEN CASE
                WHEN in_range_mean > 5 AND qty <= 3 THEN 1
                WHEN in_range_mean > 10 AND qty / nullif(in_range_mean, 0) < 0.3 THEN 1
                WHEN in_range_mean <= 5 AND qty = 1 THEN 1
                WHEN qty > 300 THEN 1 ELSE 0 END
            ELSE CASE
                WHEN qty = 1 THEN 1
                WHEN in_range_mean IS NULL THEN 0
                WHEN in_range_mean > 10 AND qty / nullif(in_range_mean, 0) < 0.3 THEN 1
                WHEN qty / nullif(in_range_mean, 0) <= 0.15 THEN 1 ELSE 0 END
            END AS INTEGER) AS outlier
        FROM ranged JOIN means USING (shop_id, product_id, week_day_description)""",
    "kept": """
        SELECT *, CASE WHEN qty <= 3 THEN 4.0 ELSE qty END AS new_qty FROM flagged WHERE outlier = 0""",
    # --- windows, over a view named panel with the target in column y
    "week0": """
        SELECT *, avg(y) OVER (PARTITION BY shop_id, product_id ORDER BY t_date
                               RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS mean_7d
        FROM panel""",
    "week1": """
        SELECT *, lag(mean_7d, 4) OVER (PARTITION BY shop_id, product_id ORDER BY t_date) AS rolling_week_sales
        FROM week0""",
    "week2": """
        SELECT *, lag(rolling_week_sales, 7) OVER (PARTITION BY shop_id, product_id ORDER BY t_date) AS week_old
        FROM week1""",
    "rolled": """
        SELECT * EXCLUDE (mean_7d),
            coalesce(rolling_week_sales / nullif(week_old, 0), 1.0) AS weekly_trend,
            avg(y) OVER (d ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS same_last_4_days,
            avg(y) OVER (d ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS same_last_6_days,
            CASE weekend_flag WHEN 0 THEN avg(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 4 PRECEDING)
                              WHEN 1 THEN avg(y) OVER (w ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING) END AS rolling_4_days,
            CASE weekend_flag WHEN 0 THEN avg(y) OVER (w ROWS BETWEEN 9 PRECEDING AND 4 PRECEDING)
                              WHEN 1 THEN avg(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 2 PRECEDING) END AS rolling_6_days,
            CASE weekend_flag WHEN 0 THEN max(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 4 PRECEDING)
                              WHEN 1 THEN max(y) OVER (w ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING) END AS rolling_4_max,
            CASE weekend_flag WHEN 0 THEN max(y) OVER (w ROWS BETWEEN 9 PRECEDING AND 4 PRECEDING)
                              WHEN 1 THEN max(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 2 PRECEDING) END AS rolling_6_max,
            CASE weekend_flag WHEN 0 THEN min(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 4 PRECEDING)
                              WHEN 1 THEN min(y) OVER (w ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING) END AS rolling_4_min,
            CASE weekend_flag WHEN 0 THEN min(y) OVER (w ROWS BETWEEN 9 PRECEDING AND 4 PRECEDING)
                              WHEN 1 THEN min(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 2 PRECEDING) END AS rolling_6_min
        FROM week2
        WINDOW d AS (PARTITION BY shop_id, product_id, day_of_week ORDER BY t_date),
               w AS (PARTITION BY shop_id, product_id, weekend_flag ORDER BY t_date)""",
    "means_filled": """
        SELECT * REPLACE (
            coalesce(rolling_week_sales, y) AS rolling_week_sales,
            coalesce(same_last_4_days, y) AS same_last_4_days,
            coalesce(same_last_6_days, y) AS same_last_6_days,
            coalesce(rolling_4_days, y) AS rolling_4_days,
            coalesce(rolling_6_days, y) AS rolling_6_days)
        FROM rolled""",
    "filled": """
        SELECT * REPLACE (
            coalesce(rolling_4_max, rolling_4_days) AS rolling_4_max,
            coalesce(rolling_4_min, rolling_4_days) AS rolling_4_min,
            coalesce(rolling_6_max, rolling_6_days) AS rolling_6_max,
            coalesce(rolling_6_min, rolling_6_days) AS rolling_6_min),
            coalesce(same_last_4_days / nullif(same_last_6_days, 0), 1.0) AS daily_trend
        FROM means_filled""",
    "day_lags": """
        SELECT shop_id, product_id, t_date, qty,
            lag(qty, 1) OVER d AS w1, lag(qty, 2) OVER d AS w2, lag(qty, 3) OVER d AS w3,
            lag(qty, 4) OVER d AS w4, lag(qty, 5) OVER d AS w5, lag(qty, 6) OVER d AS w6
        FROM fx_sales WINDOW d AS (PARTITION BY shop_id, product_id, day_of_week ORDER BY t_date)""",
    "row_stats": """
        SELECT shop_id, product_id, t_date,
            avg(qty) OVER (s ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_three_day_avg,
            max(qty) OVER (s ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_three_day_max,
            min(qty) OVER (s ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_three_day_min,
            avg(qty) OVER (s ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rolling_five_day_avg,
            max(qty) OVER (s ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rolling_five_day_max,
            min(qty) OVER (s ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rolling_five_day_min,
            median(qty) OVER (s ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rolling_five_day_median,
            median(qty) OVER (s ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_seven_day_median
        FROM fx_sales WINDOW s AS (PARTITION BY shop_id, product_id ORDER BY t_date)""",
    # --- weather, over a view named detail
    "weather": """
        SELECT detail.*, SiteUID, ForecastDate, MaxTemperature, MinTemperature, FeelsLikeTemperature,
               SunshineHours, replace(WeatherDescriptor, chr(13), '') AS WeatherDescriptor, ForecastSiteUID
        FROM detail LEFT JOIN fx_sites ON detail.shop_id = site_shop
        LEFT JOIN fx_forecast f
            ON SiteUID = ForecastSiteUID AND t_date = ForecastDate AND f.CurrentForecast = 1""",
    "codes": """
        SELECT WeatherDescriptor, n_rows,
               CAST(row_number() OVER (ORDER BY n_rows DESC, WeatherDescriptor) - 1 AS DOUBLE) AS Weather_Code
        FROM (SELECT WeatherDescriptor, count(*) AS n_rows FROM weather
              WHERE WeatherDescriptor IS NOT NULL GROUP BY 1)""",
    "coded": """
        SELECT weather.*, Weather_Code,
            CASE WHEN t > -15 AND t <= -10 THEN '-15 to -10' WHEN t > -10 AND t <= -5 THEN '-10 to -5'
                 WHEN t > -5 AND t <= 0 THEN '-5 to 0' WHEN t > 0 AND t <= 5 THEN '0 to 5'
                 WHEN t > 5 AND t <= 10 THEN '5 to 10' WHEN t > 10 AND t <= 15 THEN '10 to 15'
                 WHEN t > 15 AND t <= 20 THEN '15 to 20' WHEN t > 20 AND t <= 25 THEN '20 to 25'
                 WHEN t > 25 AND t <= 30 THEN '25 to 30' END AS "Temp Range",
            CASE WHEN t > -15 AND t <= 30 THEN CAST((ceil(t / 5) - 1) * 5 AS DOUBLE) END AS temp_code
        FROM (SELECT *, FeelsLikeTemperature AS t FROM weather) AS weather
        LEFT JOIN codes USING (WeatherDescriptor)""",
    "ftable": """
        SELECT shop_id, t_date, weekend_flag, day_of_week_no, day_of_week, bank_holiday_flag,
            week_day_description, product_id, qty, actual_retail_sales_net, cluster, description,
            quarter_label, outlier, new_qty, rolling_week_sales, week_old, weekly_trend,
            same_last_4_days, same_last_6_days, rolling_4_days, rolling_6_days, rolling_4_max,
            rolling_6_max, rolling_4_min, rolling_6_min, daily_trend, SiteUID, ForecastDate,
            MaxTemperature, MinTemperature, FeelsLikeTemperature, SunshineHours, WeatherDescriptor,
            ForecastSiteUID, Weather_Code, "Temp Range", temp_code
        FROM coded""",
    # --- scores of two deterministic stand-in predictions
    "predicted": """
        SELECT shop_id, product_id, t_date, qty, new_qty,
               rolling_4_days AS predictions, same_last_4_days AS predictions_b
        FROM filled""",
    "scored": """
        SELECT * REPLACE (round_even(predictions, 0) AS predictions,
                          round_even(predictions_b, 0) AS predictions_b) FROM predicted""",
    "errors": """
        SELECT *,
            abs(new_qty - predictions) / nullif(new_qty, 0) AS first_MAPE,
            abs(new_qty - predictions_b) / nullif(new_qty, 0) AS second_MAPE,
            CAST(CASE WHEN qty <= 20 THEN CASE WHEN abs(qty - predictions) <= 2 THEN 1 ELSE 0 END
                      WHEN abs(qty - predictions) / qty <= 0.1 THEN 1 ELSE 0 END AS INTEGER) AS first_acc,
            CAST(CASE WHEN qty <= 20 THEN CASE WHEN abs(qty - predictions_b) <= 2 THEN 1 ELSE 0 END
                      WHEN abs(qty - predictions_b) / qty <= 0.1 THEN 1 ELSE 0 END AS INTEGER) AS second_acc
        FROM scored""",
    "judged": """
        SELECT shop_id, product_id, t_date, qty, new_qty, predictions,
            abs(new_qty - predictions) / nullif(new_qty, 0) AS MAPE,
            CAST(CASE WHEN new_qty <= 20 THEN CASE WHEN abs(new_qty - predictions) <= 2 THEN 1 ELSE 0 END
                      WHEN abs(new_qty - predictions) / new_qty <= 0.1 THEN 1 ELSE 0 END AS INTEGER) AS Accuracy
        FROM scored""",
    "r2": """
        SELECT 1 - sum((new_qty - predictions) ** 2) / (var_pop(new_qty) * count(new_qty)) AS r2
        FROM predicted""",
}


def _value(value) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)


# The rows of the fixed ensemble, and the way of every row from the root of each tree to a leaf.
VIEWS["nodes"] = (
    "SELECT *, list_position(["
    + ", ".join(f"'{name}'" for name in TREE_FEATURES)
    + "], feature) AS f FROM (VALUES "
    + ", ".join("(" + ", ".join(map(_value, node)) + ")" for node in NODES)
    + ") AS v(model, tree, weight, node, feature, threshold, gap_left, l, r, value)"
)
VIEWS["walk"] = """
        SELECT i.place, i.f AS fs, n.model, n.tree, 0 AS node
        FROM inputs i JOIN nodes n ON n.node = 0 AND n.model = i.model
        UNION ALL
        SELECT w.place, w.fs, w.model, w.tree,
               CASE WHEN w.fs[n.f] <= n.threshold OR (w.fs[n.f] IS NULL AND n.gap_left) THEN n.l ELSE n.r END
        FROM walk w JOIN nodes n ON n.model = w.model AND n.tree = w.tree AND n.node = w.node
        WHERE n.feature IS NOT NULL"""
VIEWS["tree_scores"] = """
        SELECT w.place, sum(n.weight * n.value) AS prediction
        FROM walk w JOIN nodes n ON n.model = w.model AND n.tree = w.tree AND n.node = w.node
        WHERE n.feature IS NULL GROUP BY w.place"""
TREE_INPUTS = "[" + ", ".join(f"CAST({name} AS DOUBLE)" for name in TREE_FEATURES) + "] AS f"


# Inputs that the generic views read under a fixed name.
SRC_EXTRACT = {"src": "SELECT * FROM extract"}
SRC_LABELLED = {"src": "SELECT * FROM labelled"}
PANEL_SALES = {"panel": "SELECT *, qty AS y FROM fx_sales"}
PANEL_KEPT = {"panel": "SELECT *, new_qty AS y FROM kept"}
PANEL_NEW_QTY = {
    "panel": """SELECT *, new_qty AS y
                FROM (SELECT *, CASE WHEN qty <= 3 THEN 4.0 ELSE qty END AS new_qty FROM fx_sales)"""
}
DETAIL_SALES = {"detail": "SELECT shop_id, product_id, t_date, qty FROM fx_sales"}
DETAIL_FEATURES = {"detail": "SELECT * EXCLUDE (y) FROM filled"}
FEATURES = {**SRC_EXTRACT, **PANEL_KEPT, **DETAIL_FEATURES}


def _sql(body: str, **inputs: str) -> str:
    """``WITH`` the views that ``body`` needs, in order of use, then ``body``."""
    views = {**VIEWS, **inputs}
    names = re.compile(r"\b(" + "|".join(sorted(views, key=len, reverse=True)) + r")\b")
    ordered: list[str] = []

    def need(text: str, own: str = "") -> None:
        for name in names.findall(re.sub(r"'[^']*'", "", text)):
            if name not in ordered and name != own and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(views[name], name)
                if name not in ordered:
                    ordered.append(name)

    need(body)
    clauses = ",\n".join(f"{name} AS ({views[name]})" for name in ordered)
    return f"WITH {clauses}\n{body}"


def _walked(body: str, **inputs: str) -> str:
    return _sql(body, **inputs).replace("WITH ", "WITH RECURSIVE ", 1)


GRAIN = "shop_id, product_id, t_date"
WEEK = "rolling_week_sales, week_old, weekly_trend"
SAME_DAY = "same_last_4_days, same_last_6_days"
WEEKPART = "rolling_4_days, rolling_6_days, rolling_4_max, rolling_6_max, rolling_4_min, rolling_6_min"
SCORING_COLUMNS = (
    "shop_id, product_id, t_date, weekend_flag, rolling_week_sales, weekly_trend, same_last_4_days, "
    "same_last_6_days, daily_trend, CAST(0 AS INTEGER) AS out_of_range, rolling_4_days, rolling_6_days, "
    "day_of_week_no, rolling_4_max, rolling_6_max, rolling_4_min, rolling_6_min, bank_holiday_flag, "
    "coalesce(h.school_holiday, 0) AS school_holiday, Weather_Code, temp_code, c.cluster"
)


LAG_TABLE = (
    "SELECT shop_id, product_id, t_date, qty, day_of_week_no, "
    "CAST(weekofyear(t_date) AS INTEGER) AS week_no_year, "
    "CAST(month(t_date) AS INTEGER) AS financial_month_no, weekend_flag, "
    "w1 AS Same_day_1_week_ago, w2 AS Same_day_2_week_ago, w3 AS Same_day_3_week_ago, "
    "w4 AS Same_day_4_week_ago, w5 AS Same_day_5_week_ago, w6 AS Same_day_6_week_ago, "
    "rolling_three_day_avg, rolling_three_day_max, rolling_three_day_min, rolling_five_day_avg, "
    "rolling_five_day_max, rolling_five_day_min, rolling_five_day_median, rolling_seven_day_median, "
    "actual_retail_sales_net, cluster "
    f"FROM extract JOIN day_lags USING ({GRAIN}, qty) JOIN row_stats USING ({GRAIN})"
)


def oracle_sql() -> dict[str, str]:
    return {
        "scan_sales": _sql("SELECT * FROM fx_sales ORDER BY t_date, shop_id, product_id"),
        "filter_recent_6m": _sql(
            "SELECT * FROM fx_sales WHERE t_date BETWEEN DATE '2001-11-05' - INTERVAL 6 MONTH "
            "AND DATE '2001-11-05' - INTERVAL 1 DAY"
        ),
        "filter_range_cluster": _sql(
            "SELECT * FROM extract WHERE t_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND cluster = 3"
        ),
        "filter_from_as_of": _sql("SELECT * FROM fx_sales WHERE t_date >= DATE '2001-10-01'"),
        "drop_outliers": _sql(
            "SELECT shop_id, t_date, product_id, qty, outlier FROM flagged WHERE outlier = 0", **SRC_LABELLED
        ),
        "qty_floor": _sql(
            f"SELECT {GRAIN}, qty, CASE WHEN qty <= 3 THEN 4.0 ELSE qty END AS new_qty FROM fx_sales"
        ),
        "latest_rows": _sql("SELECT * FROM fx_sales ORDER BY t_date DESC, shop_id, product_id LIMIT 20"),
        "profile_sales": _sql(
            "SELECT min(t_date) AS min_date, max(t_date) AS max_date, count(*) AS n_rows, "
            "CAST(9 AS INTEGER) AS n_columns FROM fx_sales"
        ),
        "duplicate_keys": _sql(
            "SELECT product_id, t_date, count(*) AS n_rows FROM fx_sales GROUP BY ALL HAVING count(*) > 1"
        ),
        "sales_enriched": _sql("SELECT * FROM extract"),
        "launch_calendar": _sql("SELECT * FROM quarters"),
        "holiday_join": _sql(
            "SELECT s.shop_id, s.product_id, s.t_date, s.qty, h.shop_name, h.school_holiday "
            "FROM fx_sales s LEFT JOIN fx_holidays h ON s.shop_id = h.shop_id AND s.t_date = h.date"
        ),
        "scoring_input": _sql(
            f"SELECT {SCORING_COLUMNS} FROM (SELECT * EXCLUDE (cluster) FROM ftable) a "
            "LEFT JOIN (SELECT DISTINCT shop_id AS hs, date, school_holiday FROM fx_holidays) h "
            "ON a.shop_id = h.hs AND a.t_date = h.date "
            "LEFT JOIN (SELECT shop_id AS cs, cluster FROM fx_clusters) c ON c.cs = a.shop_id "
            "WHERE t_date >= DATE '2001-10-01'",
            **FEATURES,
        ),
        "unrouted_rows": _sql(
            "SELECT cluster, count(*) AS n_rows FROM fx_sales s LEFT JOIN fx_clusters c "
            "ON s.shop_id = c.shop_id WHERE cluster IS NULL OR cluster NOT IN (0, 1, 2, 3, 4, 5) GROUP BY 1"
        ),
        "days_sold": _sql("SELECT * FROM sold", **SRC_LABELLED),
        "trading_days": _sql("SELECT * FROM trading", **SRC_LABELLED),
        "product_range": _sql("SELECT * FROM prange", **SRC_LABELLED),
        "range_finder": _sql("SELECT * FROM ranged", **SRC_LABELLED),
        "outlier_means": _sql("SELECT * FROM means", **SRC_LABELLED),
        "outlier_flags": _sql("SELECT * FROM flagged", **SRC_LABELLED),
        "outlier_ratio": _sql(
            "SELECT round(avg(outlier) * 100, 6) AS outlier_ratio FROM flagged", **SRC_LABELLED
        ),
        "anomaly_table": _sql("SELECT shop_id, t_date, product_id, qty, outlier FROM flagged", **SRC_EXTRACT),
        "anomaly_table_recent": _sql(
            "SELECT shop_id, t_date, product_id, qty, outlier FROM flagged",
            src="SELECT * FROM extract WHERE t_date BETWEEN DATE '2001-11-05' - INTERVAL 6 MONTH "
            "AND DATE '2001-11-05' - INTERVAL 1 DAY",
        ),
        "score_by_cluster_rows": _sql(
            f"SELECT {SCORING_COLUMNS}, CAST(coalesce(c.cluster IN (SELECT cluster FROM ftable "
            "WHERE t_date < DATE '2001-10-01' AND cluster BETWEEN 0 AND 5), false) AS INTEGER) AS predicted "
            "FROM (SELECT * EXCLUDE (cluster) FROM ftable) a "
            "LEFT JOIN (SELECT DISTINCT shop_id AS hs, date, school_holiday FROM fx_holidays) h "
            "ON a.shop_id = h.hs AND a.t_date = h.date "
            "LEFT JOIN (SELECT shop_id AS cs, cluster FROM fx_clusters) c ON c.cs = a.shop_id "
            "WHERE t_date >= DATE '2001-10-01'",
            **FEATURES,
        ),
        "score_single_rows": _sql(
            f"SELECT *, CAST(1 AS INTEGER) AS predicted FROM ({LAG_TABLE}) WHERE t_date >= DATE '2001-10-01'"
        ),
        "train_and_evaluate_rows": _sql(
            f"SELECT {GRAIN}, qty, CASE WHEN qty <= 3 THEN 4.0 ELSE qty END AS new_qty, "
            "CAST(1 AS INTEGER) AS agrees FROM flagged "
            "WHERE outlier = 0 AND t_date BETWEEN DATE '2000-01-01' AND DATE '2001-01-01'",
            src="SELECT * FROM labelled WHERE t_date BETWEEN DATE '1996-01-01' AND DATE '2001-01-01'",
        ),
        "train_model_inputs": (
            "SELECT unnest(['shop_id', 'product_id', 'weekend_flag', 'rolling_week_sales', 'weekly_trend', "
            "'same_last_4_days', 'same_last_6_days', 'daily_trend', 'out_of_range', 'rolling_4_days', "
            "'rolling_6_days', 'day_of_week_no', 'rolling_4_max', 'rolling_6_max', 'rolling_4_min', "
            "'rolling_6_min', 'bank_holiday_flag', 'school_holiday', 'Weather_Code', 'temp_code']) AS feature, "
            "CAST(1 AS INTEGER) AS weighed"
        ),
        "score_trees": _walked(
            "SELECT i.place.shop_id AS shop_id, i.place.product_id AS product_id, i.place.t_date AS t_date, prediction "
            "FROM inputs i JOIN tree_scores s ON s.place = i.place",
            inputs="SELECT {'shop_id': shop_id, 'product_id': product_id, 't_date': t_date} AS place, 0 AS model, "
            f"{TREE_INPUTS} FROM rolled",
            **PANEL_SALES,
        ),
        "score_routed": _walked(
            "SELECT i.place.shop_id AS shop_id, i.place.product_id AS product_id, i.place.t_date AS t_date, "
            "i.model AS cluster, prediction FROM inputs i LEFT JOIN tree_scores s ON s.place = i.place",
            inputs="SELECT {'shop_id': a.shop_id, 'product_id': product_id, 't_date': t_date} AS place, "
            f"c.cluster AS model, {TREE_INPUTS} FROM rolled a LEFT JOIN fx_clusters c ON c.shop_id = a.shop_id",
            **PANEL_SALES,
        ),
        "score_in_order": _walked(
            "SELECT i.place AS position, i.shop_id, i.product_id, i.t_date, i.qty, i.model AS cluster, prediction "
            "FROM inputs i LEFT JOIN tree_scores s ON s.place = i.place ORDER BY position",
            inputs=f"SELECT place, l.shop_id, product_id, t_date, qty, c.cluster AS model, {TREE_INPUTS} FROM ("
            "SELECT *, qty AS rolling_week_sales, qty AS week_old, qty AS same_last_4_days, qty AS same_last_6_days, "
            "qty AS rolling_4_days, qty AS rolling_6_max, qty / 25 AS weekly_trend, isodow(t_date) AS day_of_week, "
            "0 AS weekend_flag FROM (SELECT row_number() OVER () - 1 AS place, l_suppkey // 4 AS shop_id, "
            "CASE WHEN l_partkey % 64 = 7 THEN 8 ELSE l_partkey % 8 END AS product_id, "
            "CAST(l_shipdate AS DATE) AS t_date, CAST(CASE WHEN l_partkey % 8 = 0 THEN ceil(l_quantity / 25) "
            "WHEN l_partkey % 8 = 1 THEN l_quantity * 10 ELSE l_quantity END AS DOUBLE) AS qty FROM lineitem)) l "
            "LEFT JOIN fx_clusters c ON c.shop_id = l.shop_id",
        ),
        "fit_stump": _sql(
            f"SELECT {GRAIN}, qty, round(cut, 6) AS threshold, round(low, 6) AS low_mean, round(high, 6) AS high_mean, "
            "round(CASE WHEN product_id <= cut THEN low ELSE high END, 6) AS prediction FROM fx_sales, ("
            "SELECT cut, low, high FROM (SELECT (product_id + following) / 2 AS cut, s / n AS low, "
            "(s_all - s) / (n_all - n) AS high, q_all - s * s / n - (s_all - s) * (s_all - s) / (n_all - n) AS loss "
            "FROM (SELECT product_id, lead(product_id) OVER w AS following, sum(n) OVER w AS n, sum(s) OVER w AS s, "
            "sum(n) OVER () AS n_all, sum(s) OVER () AS s_all, sum(q) OVER () AS q_all FROM ("
            "SELECT product_id, count(*) AS n, sum(qty) AS s, sum(qty * qty) AS q FROM fx_sales GROUP BY 1) "
            "WINDOW w AS (ORDER BY product_id)) WHERE following IS NOT NULL) ORDER BY loss, cut LIMIT 1)"
        ),
        "features_from_tail": _sql("SELECT * FROM ftable WHERE t_date >= DATE '2001-10-01'", **FEATURES),
        "rolling_7d_mean": _sql(f"SELECT {GRAIN}, mean_7d FROM week0", **PANEL_SALES),
        "rolling_7d_std": _sql(
            f"SELECT {GRAIN}, round(lag(s, 4) OVER (PARTITION BY shop_id, product_id ORDER BY t_date), 6) "
            "AS rolling_std FROM (SELECT *, stddev_samp(qty) OVER (PARTITION BY shop_id, product_id "
            "ORDER BY t_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS s FROM fx_sales)"
        ),
        "rolling_week_sales": _sql(f"SELECT {GRAIN}, rolling_week_sales FROM week1", **PANEL_SALES),
        "weekly_trend": _sql(f"SELECT {GRAIN}, {WEEK} FROM rolled", **PANEL_SALES),
        "same_weekday_means": _sql(f"SELECT {GRAIN}, {SAME_DAY} FROM rolled", **PANEL_SALES),
        "rolling_weekpart": _sql(f"SELECT {GRAIN}, {WEEKPART} FROM rolled", **PANEL_SALES),
        "feature_fill": _sql(f"SELECT {GRAIN}, qty, {WEEK}, {SAME_DAY}, {WEEKPART} FROM filled", **PANEL_SALES),
        "daily_trend": _sql(f"SELECT {GRAIN}, {SAME_DAY}, daily_trend FROM filled", **PANEL_SALES),
        "sales_features": _sql("SELECT * EXCLUDE (y) FROM filled", **PANEL_SALES),
        "same_day_lags": _sql(
            f"SELECT {GRAIN}, qty, w1 AS SameDay_1_weeks, w2 AS SameDay_2_weeks, w3 AS SameDay_3_weeks, "
            "w4 AS SameDay_4_weeks, w5 AS SameDay_5_weeks, w6 AS SameDay_6_weeks FROM day_lags"
        ),
        "fill_zero": _sql(
            f"SELECT {GRAIN}, qty, coalesce(w1, 0) AS SameDay_1_weeks, coalesce(w2, 0) AS SameDay_2_weeks, "
            "coalesce(w3, 0) AS SameDay_3_weeks, coalesce(w4, 0) AS SameDay_4_weeks, "
            "coalesce(w5, 0) AS SameDay_5_weeks, coalesce(w6, 0) AS SameDay_6_weeks FROM day_lags"
        ),
        "fill_cascade": _sql(
            f"SELECT {GRAIN}, qty, coalesce(w1, qty) AS SameDay_1_weeks, coalesce(w2, w1, qty) AS SameDay_2_weeks, "
            "coalesce(w3, w2, w1, qty) AS SameDay_3_weeks, coalesce(w4, w3, w2, w1, qty) AS SameDay_4_weeks, "
            "coalesce(w5, w4, w3, w2, w1, qty) AS SameDay_5_weeks, "
            "coalesce(w6, w5, w4, w3, w2, w1, qty) AS SameDay_6_weeks FROM day_lags"
        ),
        "rolling_stats": _sql("SELECT * FROM row_stats"),
        "lag_feature_table": _sql(LAG_TABLE),
        "weather_join": _sql("SELECT * FROM weather", **DETAIL_SALES),
        "weather_codes": _sql("SELECT * FROM codes", **DETAIL_SALES),
        "label_codes": _sql("SELECT * FROM codes", **DETAIL_SALES),
        "weather_code": _sql(f"SELECT {GRAIN}, WeatherDescriptor, Weather_Code FROM coded", **DETAIL_SALES),
        "temp_bins": _sql(
            f'SELECT {GRAIN}, FeelsLikeTemperature, "Temp Range", temp_code FROM coded', **DETAIL_SALES
        ),
        "weather_features": _sql("SELECT * EXCLUDE (t) FROM coded", **DETAIL_SALES),
        "feature_table": _sql("SELECT * FROM ftable", **FEATURES),
        "train_test_split": _sql(
            f"SELECT {GRAIN}, qty, CASE WHEN t_date < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS part "
            "FROM fx_sales WHERE t_date >= DATE '1996-01-01' AND t_date <= DATE '2001-01-01'"
        ),
        "train_test_split_open": _sql(
            f"SELECT {GRAIN}, qty, CASE WHEN t_date < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS part "
            "FROM fx_sales WHERE t_date >= DATE '1996-01-01' AND t_date < DATE '2001-01-01'"
        ),
        "forecast_scores": _sql("SELECT * REPLACE (round(MAPE, 6) AS MAPE) FROM judged", **PANEL_NEW_QTY),
        "forecast_metrics": _sql(
            'SELECT round(avg(MAPE) FILTER (qty >= 3), 6) AS "MAPE_score", '
            'round(avg(Accuracy) FILTER (qty >= 3), 6) AS "Accuracy_score", '
            "(SELECT round(r2, 6) FROM r2) AS r2 FROM judged",
            **PANEL_NEW_QTY,
        ),
        "forecast_r2": _sql("SELECT round(r2, 6) AS r2 FROM r2", **PANEL_NEW_QTY),
        "compare_models": _sql(
            "SELECT * REPLACE (round(first_MAPE, 6) AS first_MAPE, round(second_MAPE, 6) AS second_MAPE) "
            "FROM errors",
            **PANEL_NEW_QTY,
        ),
        "comparison_means": _sql(
            "SELECT round(avg(first_MAPE), 6) AS first_MAPE, round(avg(second_MAPE), 6) AS second_MAPE, "
            "round(avg(first_acc), 6) AS first_acc, round(avg(second_acc), 6) AS second_acc FROM errors",
            **PANEL_NEW_QTY,
        ),
        "impute_features": _sql(
            f"SELECT {GRAIN}, coalesce(Weather_Code, m.code) AS \"Weather_Code_num\", "
            "coalesce(temp_code, m.temp) AS temp_code_num, "
            "CAST(Weather_Code IS NULL AS DOUBLE) AS \"Weather_Code_missing\", "
            "CAST(temp_code IS NULL AS DOUBLE) AS temp_code_missing "
            "FROM coded, (SELECT quantile_disc(Weather_Code, 0.5) AS code, quantile_disc(temp_code, 0.5) AS temp "
            "FROM coded WHERE t_date >= DATE '1996-01-01' AND t_date < DATE '2000-01-01') m "
            "WHERE t_date >= DATE '1996-01-01' AND t_date < DATE '2000-01-01'",
            **DETAIL_SALES,
        ),
        "accuracy_by_group": _sql(
            "SELECT description, round(avg(first_acc), 6) AS first_acc, round(avg(second_acc), 6) AS second_acc "
            "FROM errors JOIN fx_clusters USING (shop_id) WHERE qty > 2 GROUP BY 1",
            **PANEL_NEW_QTY,
        ),
    }
