"""Session settings, shared work folders and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TIME_ZONE = "UTC"

_local_roots: dict[str, str] = {}


def build_session(app: str = "logtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs count on.

    Shuffle width and executor sizing stay with the cluster's own defaults;
    AQE merges small shuffle partitions and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: every epoch <-> text conversion here means UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def work_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by the cluster.

    A folder of this machine is used only in local mode, where the driver is
    the only executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="logtide-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context the shared folder unless it already has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_root(spark))


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Have the driver remove an intermediate folder when it ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove an intermediate folder that no reader needs any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_through(df: DataFrame, label: str = "rows", folder: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and continue from the table.

    For rows that several later steps read: they are computed once, columns
    not needed are not read back, and their size is known to the planner.
    """
    spark = df.sparkSession
    folder = folder or new_folder(spark, label)
    df.write.parquet(folder)
    remove_at_exit(spark, folder)
    return spark.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows over all cores when the scan has fewer splits than there are cores.

    For heavy per-row work (tokenising, model training) on a table that comes
    as a few files.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)
