"""Ensembles as tables of nodes and as expressions; routing; input order."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import models, scoring, trees
from shelfcast.operators.trees import Node
from shelfcast.sources import save_model, load_model, with_position, write_csv
from shelfcast.sources.schemas import CLUSTER_MODEL_COLUMNS
from tests.test_models import table


@pytest.fixture(scope="module")
def rows(spark):
    gaps = F.when(F.col("shop_id") == 2, F.lit(float("nan"))).when(F.col("shop_id") == 3, None).otherwise(F.col("temp_code"))
    return table(spark, CLUSTER_MODEL_COLUMNS).withColumn("temp_code", gaps).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    """Two models on different rows: one with gaps on either side, one with medians and marks."""
    parts = {0: ("shop_id % 2 = 0", "sides"), 3: ("shop_id % 2 = 1", "median")}
    return {
        cluster: models.train(rows.where(part), CLUSTER_MODEL_COLUMNS, "new_qty", trees=12, depth=3, gaps=gaps)
        for cluster, (part, gaps) in parts.items()
    }


def test_compiled_trees_equal_predict(spark, rows, fitted, tmp_path):
    save_model(fitted[0], f"{tmp_path}/model")
    for model in (*fitted.values(), load_model(f"{tmp_path}/model")):
        both = trees.predict_compiled(models.predict(model, rows, "by_model"), model, "compiled")
        assert both.count() == rows.count() and both.where("compiled IS NULL").count() == 0
        assert both.where(F.abs(F.col("compiled") - F.col("by_model")) > 1e-9 * F.abs("by_model")).count() == 0
    assert both.select("compiled").distinct().count() > 5


def test_routing_is_one_pass_and_equals_the_single_models(spark, rows, fitted, tmp_path):
    rows.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    got = scoring.score_by_cluster(stored, fitted)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Union" not in text and "Python" not in text
    want = {}
    for cluster, model in fitted.items():
        for r in models.predict(model, rows.where(F.col("cluster") == cluster), "prediction").collect():
            want[r.shop_id, r.t_date] = r.prediction
    assert {(r.shop_id, r.t_date): r.prediction for r in got.collect()} == pytest.approx(want)


def test_node_tables(spark, fitted):
    nodes = trees.model_nodes(fitted[0], 7)
    stored = trees.nodes_frame(spark, nodes)
    assert sorted(trees.read_nodes(stored)) == sorted(nodes) and {n.model for n in nodes} == {7}
    assert trees.compile_trees(trees.read_nodes(stored)) == trees.compile_trees(nodes)
    leaf = Node(0, 0, 1.0, 0, value=2.5)
    df = spark.createDataFrame([(1.0, 0), (None, 1), (float("nan"), None)], "x double, k int")
    assert [r.prediction for r in trees.score_nodes(df, [leaf]).collect()] == [2.5] * 3
    split = [Node(1, 0, 2.0, 0, "x", 1.0, True, 1, 2), Node(1, 0, 2.0, 1, value=1.0), Node(1, 0, 2.0, 2, value=3.0)]
    assert [r.prediction for r in trees.score_nodes(df, [leaf, *split], key="k").collect()] == [2.5, 2.0, None]
    right = [split[0]._replace(gap_left=False), *split[1:]]
    assert [r.prediction for r in trees.score_nodes(df, right).collect()] == [2.0, 6.0, 6.0]
    with pytest.raises(ValueError, match="missing"):
        trees.compile_trees(split[:2])
    with pytest.raises(ValueError, match="twice"):
        trees.compile_trees([leaf, leaf])
    with pytest.raises(ValueError, match="missing or lies below itself"):
        trees.compile_trees([split[0]._replace(left=0), *split[1:]])
    with pytest.raises(ValueError, match="2 models"):
        trees.score_nodes(df, [leaf, *split])
    with pytest.raises(ValueError, match="no models"):
        trees.predict_routed(df, {}, "k")


def test_positions_follow_the_files(spark, tmp_path):
    spark.range(5000).selectExpr("id", "pmod(xxhash64(id), 1000) AS x").repartition(7).write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # files in several tasks
        df = with_position(spark.read.parquet(f"{tmp_path}/in").where("x >= 0"))
        assert df.columns == ["id", "x", "position"]
        shuffled = df.repartition(11, "x").join(spark.range(1000).withColumnRenamed("id", "x"), "x")
        write_csv(shuffled.select("id", "position"), f"{tmp_path}/out", order_by=["position"], drop=["position"])
        places = [r.position for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    import glob

    import pyarrow.parquet as pq

    inputs = [i for f in sorted(glob.glob(f"{tmp_path}/in/*.parquet")) for i in pq.read_table(f)["id"].to_pylist()]
    written = [int(line) for f in sorted(glob.glob(f"{tmp_path}/out/part-*.csv")) for line in open(f).read().splitlines()[1:]]
    assert written == inputs and sorted(places) == list(range(5000))
