"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

TIME_TYPE_FLAG = "spark.sql.timeType.enabled"


def build_session(app: str = "cadencia", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; ``conf`` keys use ``__`` for dots.

    Partition counts and memory are left to the cluster. AQE is Spark's default, but the two switches
    the skew handling needs are pinned so that a cluster default cannot turn them off silently.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        TIME_TYPE_FLAG: "true",
        # The JVM never compiles methods over 8000 bytes. A wide projection that generates one is
        # better run outside the fused stage, where Spark splits it into small methods.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_time_type(spark: SparkSession) -> None:
    """The trip table stores time-of-day columns as TIME, which this Spark version keeps behind a flag."""
    if spark.conf.get(TIME_TYPE_FLAG, "false") != "true":
        spark.conf.set(TIME_TYPE_FLAG, "true")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Where it is unset (tests, single-machine use) it becomes a folder next to the tables of the warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


_used: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder; removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/cadencia/{spark.sparkContext.applicationId}"
    if path not in _used:
        _used.add(path)
        atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have been stopped already; then the files stay
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def materialize(df: DataFrame, label: str, partition_by: str | tuple[str, ...] | None = None) -> DataFrame:
    """Write an intermediate result as Parquet in the shared folder and read it back.

    Used where a result feeds several jobs: it is computed once, lost executors cannot take it away,
    and later readers prune columns and partitions.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)
    # The schema is given, so reading back needs no footer scan and keeps partition value types.
    return spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
