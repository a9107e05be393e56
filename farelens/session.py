"""Spark session settings for the fare engine.

Only settings a Spark user would set for this workload: AQE (runtime
coalescing, skew-join splitting, broadcast decided on measured sizes), UTC
session time, and shuffle width. They are defaults: whatever the cluster, the
submit command or an already running session has set stays as it is.
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A side is broadcast only when its measured size is under this bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # The rule set compiles to large generated methods; above HotSpot's 8000-byte
    # JIT limit they would run interpreted, so fall back to split codegen instead.
    METHOD_LIMIT: "8000",
    # Staging is partitioned by a boolean: two open writers per task replace
    # the per-task sort that a partitioned write otherwise needs.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}
# Fixed when the context starts, so only a new one gets them.
CONTEXT_DEFAULTS = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def set_defaults(spark: SparkSession, *names: str) -> None:
    """Some of ``DEFAULTS`` (all without names) in a running session, each only
    where nothing else was set."""
    already = set(spark.conf.getAll)
    for k in names or DEFAULTS:
        if k not in already:
            spark.conf.set(k, DEFAULTS[k])


def build_session(master: str | None = None, app: str = "farelens",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the defaults filled in where nothing else was set.

    ``shuffle_partitions`` and ``extra`` are the caller's own wishes and always
    apply.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if SparkContext._active_spark_context is None:
        for k, v in CONTEXT_DEFAULTS.items():
            builder = builder.config(k, v)
    wishes = dict(extra or {})
    if shuffle_partitions:
        wishes["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in wishes.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    set_defaults(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark
