"""Command line: ``python -m shelfcast.plans.jobs <job> --config tables.json --out path``.

The config holds ``tables`` (see ``sources.tables``), and where a job needs them ``models``
(folder of the cluster models), ``clusters`` (their ids, 0 to 5 by default), ``model`` (path of the
single model), ``compare`` (paths of two models), ``codes`` (folder of the saved weather codes) and ``tails`` (folder
of the stored tails). ``--as-of`` fixes the run date; without it, it is the current date.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.dates import as_of_date
from shelfcast.operators import checks, dataset, metrics, outliers, sales, scoring, tail, weather
from shelfcast.operators.checks import assert_unique_key
from shelfcast.plans import pipeline
from shelfcast.session import build_session
from shelfcast.sources import (
    cluster_path,
    drop_staged,
    load_config,
    load_model,
    load_models,
    read_table,
    save_model,
    stage,
    update_versioned,
    write_csv,
    write_parquet,
)

POSITION = "_position"


def _quarters(spark: SparkSession, tables: dict):
    """The launch calendar, staged: joined onto stored sales, its exact size is known to the planner."""
    quarters = stage(
        sales.launch_calendar(read_table(spark, "calendar", tables), read_table(spark, "launch_windows", tables)),
        "quarters",
    )
    sales.assert_one_launch(quarters)
    return quarters


def _shop_tables(spark: SparkSession, tables: dict):
    """Shop-day totals and clusters, both checked to hold a key once: a second one would multiply sales."""
    totals, clusters = (read_table(spark, name, tables) for name in ("shop_day_totals", "clusters"))
    assert_unique_key(totals, ["shop_id", "date"])
    assert_unique_key(clusters, ["shop_id"])
    return totals, clusters


def _stored(df, tables: dict, name: str):
    """Staged unless it is read from columnar files: the flags read their input three times."""
    return df if tables[name].get("format", "parquet") in ("parquet", "orc", "table") else stage(df, name)


def _write(df: DataFrame, args, figures: list[Column] = ()) -> dict:
    """Write a result, and return ``figures`` of its rows, gathered by the tasks that write them.

    With ``--by-run-date`` the run date is a partition of the output, and other dates' partitions stay.
    """
    partition_by = list(args.partition_by)
    if args.by_run_date:
        df, partition_by = df.withColumn("run_date", as_of_date(args.as_of)), ["run_date", *partition_by]
    order_by = [POSITION] if POSITION in df.columns else args.order_by
    seen = Observation()
    if args.format == "csv" and order_by:
        # Above the sort: below it, the job that samples the ranges would be counted as well.
        df = df.orderBy(*order_by)
    if figures:
        df = df.observe(seen, *figures)
    df = df.drop(POSITION)
    if args.format == "csv":
        write_csv(df, args.out, args.sep, partition_by=partition_by, keep_others=args.by_run_date)
    else:
        write_parquet(df, args.out, partition_by, rebalance=bool(args.partition_by), keep_others=args.by_run_date)
    return seen.get if figures else {}


def run_anomaly(spark: SparkSession, conf: dict, args) -> None:
    tables = conf["tables"]
    _shop_tables(spark, tables)
    daily = sales.recent_sales(read_table(spark, "daily_sales", tables), args.as_of)
    table = pipeline.anomaly_table(_stored(daily, tables, "daily_sales"), _quarters(spark, tables))
    figures = [outliers.outlier_share(), *checks.profile_figures(table)] if args.report else []
    if found := _write(table, args, figures):
        print(f"outlier ratio: {found.pop('outlier_ratio')} percent; {found}")


def run_base(spark: SparkSession, conf: dict, args) -> None:
    """The base table that ``features`` reads: all sales with shop data, launches and flags."""
    tables = conf["tables"]
    totals, clusters = _shop_tables(spark, tables)
    daily = _stored(read_table(spark, "daily_sales", tables, keep_extra=True), tables, "daily_sales")
    _write(pipeline.base_table(daily, totals, clusters, _quarters(spark, tables)), args)


def run_lag_features(spark: SparkSession, conf: dict, args) -> None:
    """The lag feature table that ``score-single`` reads."""
    tables = conf["tables"]
    totals, clusters = _shop_tables(spark, tables)
    _write(pipeline.lag_feature_table(read_table(spark, "daily_sales", tables), totals, clusters), args)


def _coded_forecast(spark: SparkSession, conf: dict):
    """Sites and the forecasts with codes and bins, staged to be joined onto stored sales.

    Codes are counted on the sales of all shops, whichever job or cluster asks. Codes that the config
    saves keep their values; labels they lack are appended.
    """
    tables = conf["tables"]
    sites, forecast = (read_table(spark, name, tables) for name in ("weather_sites", "weather_forecast"))
    fitted = stage(weather.fit_weather_codes(read_table(spark, "daily_sales", tables), sites, forecast), "codes")
    if path := conf.get("codes"):
        fitted = update_versioned(spark, path, lambda saved: weather.extended_codes(saved, fitted))
    return sites, stage(weather.code_forecast(forecast, fitted), "forecast")


def run_features(spark: SparkSession, conf: dict, args) -> None:
    """The whole feature table; with ``--report`` the rows that come in and go out are counted on the way."""
    base = sales.drop_outliers(read_table(spark, "base_table", conf["tables"]).dropna(subset=checks.GRAIN))
    entered = Observation()
    if args.report:
        base = base.observe(entered, F.count(F.lit(1)).alias("n_rows"))
    table = pipeline.feature_table(base, *_coded_forecast(spark, conf))
    found = _write(table, args, checks.profile_figures(table) if args.report else [])
    if args.report:
        if entered.get["n_rows"] != found["n_rows"]:
            raise ValueError(f"{entered.get['n_rows']} rows became {found['n_rows']}: a joined table lists a key twice")
        print(found)


def run_tail(spark: SparkSession, conf: dict, args) -> None:
    """The tail of the whole base table before the run date, stored as that date's partition of the tails."""
    day = args.as_of or dt.date.today().isoformat()
    _write_tail(pipeline.feature_tail(read_table(spark, "base_table", conf["tables"]), day), conf, day)


def _write_tail(rows: DataFrame, conf: dict, before: str) -> None:
    rows = rows.withColumn("as_of", as_of_date(before))
    write_parquet(rows, conf["tails"], ["as_of"], rebalance=True, keep_others=True)


def run_daily_features(spark: SparkSession, conf: dict, args) -> None:
    """Features from the run date on, of the tail before it and the new rows of the base table.

    With ``--next`` the tail before that later date is stored too, for the next run.
    """
    day = args.as_of or dt.date.today().isoformat()
    base = read_table(spark, "base_table", conf["tables"]).where(F.col("t_date") >= as_of_date(day))
    stored = spark.read.parquet(conf["tails"]).where(F.col("as_of") == as_of_date(day)).drop("as_of")
    if not stored.take(1):
        raise ValueError(f"no tail is stored for {day}")
    _write(pipeline.daily_features(stored, base, day, *_coded_forecast(spark, conf)), args)
    if args.next:
        _write_tail(tail.advance_tail(stored, sales.drop_outliers(base), args.next), conf, args.next)


def run_train(spark: SparkSession, conf: dict, args) -> None:
    tables = conf["tables"]
    _, clusters = _shop_tables(spark, tables)
    options = dict(conf.get("training", {}))
    # Names and categories of products, where the sales table has them, are carried along.
    daily = read_table(spark, "daily_sales", tables, keep_extra=True)
    rows = pipeline.training_sales(
        daily, clusters, _quarters(spark, tables), options.pop("from"), options.pop("to"), args.cluster
    )
    flagged = stage(outliers.flag_outliers(stage(rows, "training-sales")), "flagged")
    sites, coded = _coded_forecast(spark, conf)
    result = pipeline.train_cluster(flagged, sites, coded, read_table(spark, "holidays", tables), **options)
    save_model(result.model, cluster_path(conf["models"], args.cluster))
    print(result.metrics.first().asDict())
    _write(result.scored, args)


def run_score_clusters(spark: SparkSession, conf: dict, args) -> None:
    """Scores by cluster; rows that no model takes are counted, and leave unless they are to be kept.

    With ``--input-order`` a CSV holds the rows in the order of the feature table's files.
    """
    tables, position = conf["tables"], POSITION if args.input_order else None
    features = read_table(spark, "feature_table", tables, position=position)
    holidays, clusters = (read_table(spark, name, tables) for name in ("holidays", "clusters"))
    rows = dataset.scoring_input(features, holidays, clusters, args.as_of, [position] if position else [])
    rows = stage(rows, "scoring")
    by_cluster = load_models(conf["models"], conf.get("clusters", scoring.CLUSTERS))
    for row in scoring.unrouted(rows, by_cluster).orderBy("cluster").toLocalIterator():
        print(f"no model for cluster {row['cluster']}: {row['n_rows']} rows")
    _write(pipeline.score_clusters(rows, by_cluster, keep_unrouted=args.keep_unrouted), args)


def run_score_single(spark: SparkSession, conf: dict, args) -> None:
    features = read_table(spark, "lag_feature_table", conf["tables"])
    _write(scoring.score_single(features, load_model(conf["model"]), args.as_of), args)


def run_compare(spark: SparkSession, conf: dict, args) -> None:
    """The two models that the config names under ``compare`` on the feature table."""
    tables = conf["tables"]
    features, holidays = (read_table(spark, name, tables) for name in ("feature_table", "holidays"))
    first, second = (load_model(path) for path in conf["compare"])
    compared = pipeline.compare_fitted(features, holidays, first, second)
    if args.report:
        compared = stage(compared, "compared")
        print(metrics.comparison_means(compared, ["first", "second"]).first().asDict())
        groups = metrics.accuracy_by_group(compared, "description", ["first_acc", "second_acc"])
        for row in groups.orderBy("description").toLocalIterator():
            print(row.asDict())
    _write(compared, args)


JOBS = {
    "anomaly": run_anomaly,
    "base": run_base,
    "lag-features": run_lag_features,
    "compare": run_compare,
    "features": run_features,
    "tail": run_tail,
    "daily-features": run_daily_features,
    "train": run_train,
    "score-clusters": run_score_clusters,
    "score-single": run_score_single,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfcast")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--config", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    parser.add_argument("--sep", default=",")
    parser.add_argument("--order-by", nargs="*", default=[], help="columns that order a CSV output")
    parser.add_argument("--input-order", action="store_true", help="write scores in the order of the feature table")
    parser.add_argument("--by-run-date", action="store_true", help="replace the run date's partition of the output only")
    parser.add_argument("--next", help="with daily-features: also store the tail before this date")
    parser.add_argument("--keep-unrouted", action="store_true", help="also write rows that no model takes")
    parser.add_argument("--partition-by", nargs="*", default=[])
    parser.add_argument("--as-of")
    parser.add_argument("--cluster", type=int, default=3)
    parser.add_argument("--report", action="store_true", help="also print figures of the result, gathered while it is written")
    args = parser.parse_args(argv)
    args.sep = args.sep.replace("\\t", "\t")
    spark = build_session()
    try:
        JOBS[args.job](spark, load_config(args.config), args)
    finally:
        drop_staged(spark)


if __name__ == "__main__":
    main()
