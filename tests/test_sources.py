from __future__ import annotations

import datetime as dt
import gc
import os
import time

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import (
    conform,
    read_delimited,
    read_table,
    save_series_table,
    shared_dir,
    stage,
    write_csv,
    write_parquet,
)
from shelfcast.sources import schemas
from shelfcast.sources.tables import REMOVE_SHUFFLES


def test_conform_types_nan_and_missing(spark):
    df = spark.sql(
        "SELECT 1 AS shop_id, timestamp '2024-01-02 03:00:00' AS date, double('NaN') AS actual_retail_sales_net, 5 AS x"
    )
    got = conform(df, schemas.SHOP_DAY_TOTALS)
    assert got.dtypes == [("shop_id", "bigint"), ("date", "date"), ("actual_retail_sales_net", "double")]
    assert tuple(got.first()) == (1, dt.date(2024, 1, 2), None)
    assert conform(df, schemas.SHOP_DAY_TOTALS, keep_extra=True).columns[-1] == "x"
    with pytest.raises(ValueError, match="missing columns: cluster"):
        conform(df, schemas.CLUSTERS)


def test_read_table_formats(spark, tmp_path, day):
    rows = spark.createDataFrame([(1, day(0), 2.5), (2, day(1), None)], schemas.SHOP_DAY_TOTALS)
    write_parquet(rows, f"{tmp_path}/p")
    write_csv(rows, f"{tmp_path}/c", "\t")
    rows.write.mode("overwrite").saveAsTable("totals_for_test")
    conf = {
        "shop_day_totals": {"path": f"{tmp_path}/p"},
        "tabs": {"format": "csv", "path": f"{tmp_path}/c", "sep": "\t"},
        "catalog": {"format": "table", "name": "spark_catalog.default.totals_for_test"},
    }
    expected = sorted(map(str, rows.collect()))
    assert sorted(map(str, read_table(spark, "shop_day_totals", conf).collect())) == expected
    for name in ("tabs", "catalog"):
        got = read_table(spark, name, conf, schemas.SHOP_DAY_TOTALS)
        assert got.schema.names == rows.schema.names
        assert sorted(map(str, got.collect())) == expected
    with pytest.raises(KeyError, match="no location"):
        read_table(spark, "clusters", conf)
    spark.sql("DROP TABLE totals_for_test")


def test_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 2.0), (2, None, 3.5)], "id long, text string, x double")
    write_csv(df, f"{tmp_path}/out")
    lines = {line for file in (tmp_path / "out").glob("*.csv") for line in file.read_text().splitlines()}
    assert lines == {"id,text,x", '1,"a,b",2.0', "2,,3.5"}
    back = read_delimited(spark, f"{tmp_path}/out", df.schema, ",")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    write_csv(df, f"{tmp_path}/tab", "\t")
    assert sorted(map(str, read_delimited(spark, f"{tmp_path}/tab", df.schema).collect())) == sorted(
        map(str, df.collect())
    )


def test_csv_in_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("pmod(xxhash64(id), 10000) AS id", "id AS x").repartition(7)
    write_csv(df, f"{tmp_path}/out", order_by=["id", "x"])
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    ids = [int(line.split(",")[0]) for file in files for line in file.read_text().splitlines()[1:]]
    assert len(ids) == 1000 and ids == sorted(ids)


@pytest.mark.parametrize("line", ["2,oops,y", "bad,3,z"])
def test_malformed_csv_fails(spark, tmp_path, line):
    (tmp_path / "in.csv").write_text(f"id,x,text\n1,2.5,a\n{line}\n")
    schema = spark.createDataFrame([], "id long, x double, text string").schema
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|[Mm]alformed"):
        read_delimited(spark, f"{tmp_path}/in.csv", schema, ",").collect()


def test_stage_uses_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    df = spark.range(100).selectExpr("id", "IF(id % 3 = 0, NULL, id % 3) AS cluster")
    staged = stage(df, "t", ["cluster"], rebalance=True)
    assert all(folder in path for path in staged.inputFiles())
    assert staged.count() == 100 and staged.where("cluster IS NULL").count() == 34
    assert "PartitionFilters: [isnotnull(cluster" in staged.where("cluster = 1")._jdf.queryExecution().toString()


def test_staged_files_are_removed(spark, tmp_path):
    from shelfcast.sources import drop_staged

    spark.sparkContext.setCheckpointDir(shared_dir(spark))  # as a fit does
    files = []
    for label in ("first", "second"):
        staged = stage(spark.range(5).toDF("id"), label)
        files += [path.removeprefix("file://") for path in staged.inputFiles()]
    assert files and all(os.path.exists(path) for path in files)
    drop_staged(spark)
    assert not any(os.path.exists(path) for path in files)


def test_bucketed_panel_needs_no_shuffle(spark, day):
    from shelfcast.operators.features import sales_features

    rows = [(s, p, day(i), float(i), (i % 7) + 1, int(i % 7 >= 5)) for s in range(3) for p in range(4) for i in range(20)]
    df = spark.createDataFrame(rows, "shop_id long, product_id long, t_date date, qty double, day_of_week int, weekend_flag int")
    save_series_table(df, "panel_for_test", 4)
    got = sales_features(spark.table("panel_for_test"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, got.collect())) == sorted(map(str, sales_features(df).collect()))
    spark.sql("DROP TABLE panel_for_test")


def test_positions_shuffle_no_rows(spark, tmp_path):
    """The rows of a file stay in the tasks that read them, whatever the sizes known to the planner."""
    from shelfcast.sources import with_position

    spark.range(1000).repartitionByRange(3, "id").write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = with_position(spark.read.parquet(f"{tmp_path}/in"))
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
        assert sorted(r.position for r in df.collect()) == list(range(1000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_staging_leaves_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    gc.collect()
    before = shuffles()
    rows = spark.range(10_000).repartition(4, "id").groupBy((F.col("id") % 100).alias("k")).count()
    assert rows.count() == 100
    own = shuffles() - before  # a caller's own execution is left alone
    assert own
    staged = stage(rows, "swept")
    ended = time.monotonic() + 20
    while shuffles() - before - own and time.monotonic() < ended:
        time.sleep(0.1)
    assert not shuffles() - before - own
    assert staged.count() == rows.count() == 100
    assert spark.conf.get(REMOVE_SHUFFLES) == "false"
