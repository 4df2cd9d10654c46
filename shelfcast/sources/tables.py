"""Readers and sinks.

A table config maps a logical table name to where it lives::

    {"daily_sales":    {"format": "parquet", "path": "s3://.../daily_sales"},
     "launch_windows": {"format": "table", "name": "planning.assortment.launch_windows"},
     "clusters":       {"format": "jdbc", "options": {"url": ..., "dbtable": ..., ...}},
     "holidays":       {"format": "csv", "path": ..., "sep": "\\t"}}

A second catalog or linked database is just another ``name`` or another JDBC url. For a
large JDBC table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
``numPartitions`` in its options, else one task reads it all. Credentials belong in the
cluster's own configuration, never in this file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, StructType

from shelfcast.sources.schemas import TABLES


def conform(df: DataFrame, schema: StructType, *, keep_extra: bool = False) -> DataFrame:
    """Check the columns of ``schema`` and bring them to their declared types.

    A column that already has its type passes untouched, so filters on it still reach the
    scan. NaN becomes NULL once here, since Spark orders NaN above every number and lets
    it spread through averages. Timestamps become dates.
    """
    actual = {field.name: field.dataType for field in df.schema.fields}
    missing = [name for name in schema.names if name not in actual]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; found: {', '.join(actual)}")
    columns = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType) and actual[field.name] != field.dataType:
            column = F.to_date(column)
        elif actual[field.name] != field.dataType:
            column = column.cast(field.dataType)
        if isinstance(field.dataType, DoubleType) and isinstance(actual[field.name], (DoubleType, FloatType)):
            column = F.nanvl(column, F.lit(None).cast("double"))
        columns.append(column.alias(field.name))
    if keep_extra:
        columns += [F.col(f"`{name}`") for name in actual if name not in schema.names]
    return df.select(*columns)


def read_table(
    spark: SparkSession,
    name: str,
    conf: Mapping[str, Mapping[str, Any]],
    schema: StructType | None = None,
    *,
    keep_extra: bool = False,
    position: str | None = None,
) -> DataFrame:
    """Read a configured table with its declared schema; ``position`` names a column for each row's place in its files."""
    if name not in conf:
        raise KeyError(f"no location configured for table {name!r}")
    entry = conf[name]
    schema = schema or TABLES[name]
    kind = entry.get("format", "parquet")
    if kind == "csv":
        return read_delimited(spark, entry["path"], schema, entry.get("sep", ","))
    if kind == "table":
        df = spark.table(entry["name"])
    elif kind == "jdbc":
        df = spark.read.format("jdbc").options(**entry["options"]).load()
    else:
        df = spark.read.format(kind).options(**entry.get("options", {})).load(entry["path"])
    if position is None:
        return conform(df, schema, keep_extra=keep_extra)
    df = with_position(df, position)
    places = StructType([*schema.fields, df.schema[position]])
    return conform(df, places, keep_extra=keep_extra)


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Add the place of each row in the input: files in the order of their paths, rows in the order of the file.

    For frames read straight from parquet files, or a table of them. The place does not depend on how the
    files are cut into tasks, so it survives joins, routing and retries, and a sort by it restores the input.
    The starts of the files, a path and a number for each, go to all tasks: shuffled by file, the rows of a large file
    would meet in one task.
    """
    marked = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = marked.groupBy("_file").agg((F.max("_row") + 1).alias("_rows"))
    starts = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    placed = marked.join(F.broadcast(starts), "_file").withColumn(name, F.col("_start") + F.col("_row"))
    return placed.select(*[F.col(f"`{column}`") for column in df.columns], name)


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = "\t") -> DataFrame:
    """Read a delimited file with a header; the schema is declared, never inferred.

    A value that does not fit its type fails the read: as a NULL it would later drop its row.
    """
    df = spark.read.csv(path, header=True, sep=sep, schema=schema, enforceSchema=False, mode="FAILFAST")
    return conform(df, schema)


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    order_by: Iterable[str] = (),
    drop: Iterable[str] = (),
    *,
    partition_by: Iterable[str] = (),
    keep_others: bool = False,
) -> None:
    """Write delimited part files with a header.

    With ``order_by`` the rows are in order within the files and from one file to the next: a range
    sort, so no task holds more than its share. Columns to ``drop``, such as an input position, order the
    rows and are not written. ``keep_others`` is as in ``write_parquet``.
    """
    order_by = list(order_by)
    out = (df.orderBy(*order_by) if order_by else df).drop(*drop)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if keep_others else "static")
    if partition_by := list(partition_by):
        writer = writer.partitionBy(*partition_by)
    writer.csv(path, header=True, sep=sep)


def write_parquet(
    df: DataFrame, path: str, partition_by: Iterable[str] = (), *, rebalance: bool = False, keep_others: bool = False
) -> None:
    """Write a stage's result for the next one.

    ``rebalance`` groups rows by the partition columns first, so that few, well-sized files
    result; adaptive execution splits a value that holds many rows over several tasks. With ``keep_others``
    only the partitions that have rows are replaced, and the table's other partitions stay as they are.
    """
    partition_by = list(partition_by)
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if keep_others else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_series_table(df: DataFrame, table: str, buckets: int) -> None:
    """Save a panel bucketed by series; window features on it then need no shuffle."""
    (
        df.repartition(buckets, "shop_id", "product_id")
        .write.mode("overwrite")
        .bucketBy(buckets, "shop_id", "product_id")
        .sortBy("shop_id", "product_id", "t_date")
        .format("parquet")
        .saveAsTable(table)
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``: storage that all executors share.

    Where none is named, a local session takes a folder in its warehouse; on a cluster that folder may be one of the
    driver's own disk, so the job stops.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def _staging_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


# With it Spark removes an execution's shuffle files at its end, not when the driver next collects its garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files; other executions keep the caller's setting."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def stage(
    df: DataFrame, label: str = "stage", partition_by: Iterable[str] = (), *, rebalance: bool = False
) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    For results that several jobs read: the work is done once, a lost executor costs no
    recomputation, and the planner knows the exact size of what it reads. The files stay in
    a subfolder named after the application until ``drop_staged`` removes them.
    """
    spark = df.sparkSession
    path = f"{_staging_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        write_parquet(df, path, partition_by, rebalance=rebalance)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Remove this application's staged files; frames read from them are unusable afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def load_config(path: str) -> dict[str, Any]:
    """A JSON job config from the driver's own file system."""
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)
