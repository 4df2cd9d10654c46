"""Tables kept in versions that are published whole and never changed.

A version is a folder ``v<number>`` below the table's folder. It is written under another name and renamed, which
fails if that number is taken: of two writers that start from the same version one publishes, and the other reads
what was published, works its change out again and tries the next number. Readers take the highest number.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources.tables import write_parquet

VERSION = re.compile(r"v(\d{8})")


def _context(spark: SparkSession, folder: str):
    """The folder's file context, and how to make a path in it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = lambda *parts: hadoop.Path("/".join([folder.rstrip("/"), *parts]))
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    qualified = path().getFileSystem(configuration).makeQualified(path())
    return hadoop.FileContext.getFileContext(qualified.toUri(), configuration), path


def latest_version(spark: SparkSession, folder: str) -> int:
    """Number of the latest version, 0 if there is none."""
    context, path = _context(spark, folder)
    if not context.util().exists(path()):
        return 0
    found = [VERSION.fullmatch(status.getPath().getName()) for status in context.util().listStatus(path())]
    return max((int(match[1]) for match in found if match), default=0)


def read_version(spark: SparkSession, folder: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/v{number:08d}")


def publish_version(df: DataFrame, folder: str, number: int) -> bool:
    """Publish a version under a number; False if another writer has published it first."""
    spark = df.sparkSession
    context, path = _context(spark, folder)
    written = f"writing-{uuid.uuid4().hex}"
    write_parquet(df, f"{folder.rstrip('/')}/{written}")
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(path(written), path(f"v{number:08d}"), options)
    except Py4JJavaError as error:
        if latest_version(spark, folder) < number:
            raise error
        context.delete(path(written), True)
        return False
    return True


def update_versioned(
    spark: SparkSession, folder: str, change: Callable[[DataFrame | None], DataFrame | None], attempts: int = 20
) -> DataFrame:
    """Replace the latest version by what ``change`` makes of it, or leave it where that is None; the table then.

    ``change`` gets None where there is no version yet. It is called again when another writer was faster.
    """
    for _ in range(attempts):
        number = latest_version(spark, folder)
        changed = change(read_version(spark, folder, number) if number else None)
        if changed is None:
            return read_version(spark, folder, number)
        if publish_version(changed, folder, number + 1):
            return read_version(spark, folder, number + 1)
    raise RuntimeError(f"{attempts} other writers were faster at {folder}")
