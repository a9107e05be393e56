"""Table sinks: versioned replace, load checks, constraint checks, JSON report.

A plain ``overwrite`` deletes the old files before writing the new ones, so a
failed run leaves a table empty or half-written. Here every write goes to a new
version folder ``<table>/v=<run_id>``; only after its row count and constraints
check out is the version recorded in the append-only ``<table>/_versions`` log.
Readers take the latest recorded version, so until the record lands they keep
reading the previous one. Nothing is deleted by a publish: a folder that isn't
recorded may be one that another run is still writing. ``prune_versions`` drops
old recorded versions when it is asked to.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSIONS = "_versions"
_VERSION_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("published_at", T.TimestampNTZType()),
])


class LoadCheckError(RuntimeError):
    """A written table does not match what was meant to be written."""


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def scratch_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see. Only a
    single-process session that names none (tests) gets a temporary folder."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="farelens-checkpoint-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def version_path(root: str, table: str, version: str) -> str:
    return f"{table_path(root, table)}/v={version}"


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared layout, in its column order (extra columns kept after)."""
    declared = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*declared, *extra)


def check_constraints(df: DataFrame, not_null: tuple[str, ...] = (),
                      key: tuple[str, ...] = ()) -> None:
    """NOT NULL and primary-key checks as aggregates (no row reaches the driver).

    One pass counts NULLs; the key check is a grouped count, pre-aggregated in
    each task, reduced to the number of duplicated keys.
    """
    if not_null:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null]).first()
        bad = {c: row[c] for c in not_null if row[c]}
        if bad:
            raise LoadCheckError(f"NULL values in NOT NULL column(s): {bad}")
    if key:
        dupes = df.groupBy(*key).count().where(F.col("count") > 1).count()
        if dupes:
            raise LoadCheckError(f"{dupes} duplicated key value(s) on {list(key)}")


def write_version(df: DataFrame, root: str, table: str, version: str,
                  partition_by: tuple[str, ...] = (), observe: list | None = None,
                  drop: tuple[str, ...] = ()) -> dict:
    """Write ``df`` as a new version folder; returns observed metrics.

    ``observe`` holds aggregate expressions evaluated during the write itself
    (no second scan); ``drop`` lists helper columns the metrics read but the
    table does not keep. The row count is always observed and checked against
    a read-back count of the written files, which are read with the declared
    schema, so a table without rows counts as zero.
    """
    obs = Observation(f"{table}_{version}")
    metrics = [F.count(F.lit(1)).alias("_rows"), *(observe or [])]
    kept = df.observe(obs, *metrics).drop(*drop)
    writer = kept.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    path = version_path(root, table, version)
    writer.parquet(path)
    observed = dict(obs.get)
    written = df.sparkSession.read.schema(kept.schema).parquet(path).count()
    if written != observed["_rows"]:
        raise LoadCheckError(f"{table}: {observed['_rows']} rows went out, {written} are stored.")
    return observed


def record_version(spark: SparkSession, root: str, table: str, version: str, rows: int) -> None:
    """Append the version record; this is the publish step."""
    record = spark.createDataFrame([(version, rows, _now())], _VERSION_SCHEMA)
    record.coalesce(1).write.mode("append").json(f"{table_path(root, table)}/{_VERSIONS}")


def _version_log(spark: SparkSession, root: str, table: str) -> DataFrame:
    try:
        return spark.read.schema(_VERSION_SCHEMA).json(f"{table_path(root, table)}/{_VERSIONS}")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"No published version of {table} under {root}") from exc
        raise


def current_version(spark: SparkSession, root: str, table: str) -> str:
    log = _version_log(spark, root, table)
    row = log.orderBy(F.desc("published_at"), F.desc("version")).select("version").first()
    if row is None:
        raise FileNotFoundError(f"No published version of {table} under {root}")
    return row["version"]


def current_path(spark: SparkSession, root: str, table: str) -> str:
    return version_path(root, table, current_version(spark, root, table))


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, root, table))


def prune_versions(spark: SparkSession, root: str, table: str, older_than: timedelta,
                   keep: int = 2) -> list[str]:
    """Delete recorded versions published more than ``older_than`` ago.

    The ``keep`` newest recorded versions stay whatever their age, and folders
    that aren't recorded are never touched. Only called explicitly; it needs the
    session's Hadoop FileSystem, so a classic (not a Connect) session.
    """
    log = _version_log(spark, root, table).orderBy(F.desc("published_at"), F.desc("version"))
    newest = {r["version"] for r in log.limit(max(1, keep)).collect()}
    old = log.where(F.col("published_at") < F.lit(_now() - older_than)).select("version").distinct()
    removed = []
    for r in old.toLocalIterator():
        if r["version"] not in newest:
            path = _hadoop_path(spark, version_path(root, table, r["version"]))
            if path.getFileSystem(_hadoop_conf(spark)).delete(path, True):
                removed.append(r["version"])
    return removed


def publish(df: DataFrame, root: str, table: str, version: str, *,
            schema: T.StructType | None = None, not_null: tuple[str, ...] = (),
            key: tuple[str, ...] = (), partition_by: tuple[str, ...] = (),
            observe: list | None = None, drop: tuple[str, ...] = (),
            allow_empty: bool = True, lengths: dict[str, int] | None = None) -> dict:
    """Write, check, then publish ``df`` as the current version of ``table``.

    NOT NULL counts, and the values over their declared ``lengths``, are observed
    during the write itself; only the key check (meant for small tables such as
    the KPIs) reads the written data again.
    Without ``allow_empty`` a table of no rows is written but not published.
    """
    if schema is not None:
        df = conform_schema(df, schema)
    null_metrics = [F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in not_null]
    limits = {c: n for c, n in (lengths or {}).items() if c in df.columns}
    null_metrics += [F.count_if(F.length(c) > n).alias(f"_long_{c}") for c, n in limits.items()]
    metrics = write_version(df, root, table, version, partition_by, [*(observe or []), *null_metrics], drop)
    long = {c: metrics[f"_long_{c}"] for c in limits if metrics[f"_long_{c}"]}
    if long:
        raise LoadCheckError(f"Values longer than declared in column(s) of {table}: {long}")
    bad = {c: metrics[f"_nulls_{c}"] for c in not_null if metrics[f"_nulls_{c}"]}
    if bad:
        raise LoadCheckError(f"NULL values in NOT NULL column(s) of {table}: {bad}")
    if key:
        check_constraints(df.sparkSession.read.parquet(version_path(root, table, version)), key=key)
    if metrics["_rows"] or allow_empty:
        record_version(df.sparkSession, root, table, version, metrics["_rows"])
    return metrics


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_size: int = 1000) -> None:
    """Replace a database table's rows, keeping its declared schema.

    ``truncate`` empties the table instead of dropping it, so column types,
    defaults and constraints stay; the database driver is the user's.
    """
    (df.write.mode("overwrite").option("truncate", True).option("batchsize", batch_size)
       .jdbc(url, table, properties=properties or {}))


def _hadoop_conf(spark: SparkSession):
    return spark.sparkContext._jsc.hadoopConfiguration()


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def write_report_json(spark: SparkSession, report: dict, path: str) -> None:
    """The quality report as one JSON file at ``path``.

    Written beside it under another name first and then renamed over it, so a
    reader finds the old report or the new one, never half of one.
    """
    jvm = spark.sparkContext._jvm
    target, fresh = _hadoop_path(spark, path), _hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    fs = target.getFileSystem(_hadoop_conf(spark))
    out = fs.create(fresh, False)
    try:
        out.write(bytearray(json.dumps(report, default=str).encode()))
    finally:
        out.close()
    fs_jvm = jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(fs_jvm.Options.Rename, 1)
    options[0] = fs_jvm.Options.Rename.OVERWRITE
    context = fs_jvm.FileContext.getFileContext(fs.getUri(), _hadoop_conf(spark))
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), options)
