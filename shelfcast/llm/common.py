"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.tables import stage

__all__ = ["bounded", "lower_ascii", "read", "stage", "text_batches"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, everything else untouched."""
    return F.translate(column, UPPER, UPPER.lower())


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound what one Arrow batch of whole texts holds; a batch is bounded in rows only."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def bounded(table: DataFrame, max_rows: int) -> DataFrame:
    """Mark a table for broadcast if it has at most ``max_rows`` rows; else leave the join to Spark.

    Meant for staged tables of narrow rows: the count is a read of their footers.
    """
    return F.broadcast(table) if table.count() <= max_rows else table
