"""A session with the settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    name: str = "shelfcast",
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Adaptive execution with skew handling, UTC, and no web page.

    Everything here is a Spark default or a per-run choice; on a cluster, sizes come from
    its own configuration. ``shuffle_partitions`` is the number before adaptive execution
    coalesces: for a large panel set it so that a partition holds 100 to 200 MB.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
