"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A side is broadcast only when its counted rows stay at or below this many narrow rows.
BROADCAST_ROWS = 1_000_000


def build_session(app: str = "cardwarden", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; keyword ``a__b`` sets ``a.b``."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be invisible to the other executors, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.gettempdir()


def work_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, in the application's own subfolder.

    Nothing is reused or overwritten; the subfolder can be dropped once the application is over.
    """
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/cardwarden-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> bool:
    """Delete the application's work tables once its results are written; false when there were none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Give the context a reliable checkpoint folder (iterative fits cut their lineage there)."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_path(spark, "checkpoints"))


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as plain Python sees it, where it lies in a mounted folder and not in a store that only Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    local = place.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"
    return place.toUri().getPath() if local else None


def tasks_at_once(spark: SparkSession) -> int:
    """How many tasks surely run at the same time, as a barrier stage asks for; 0 where that is not known."""
    conf = spark.sparkContext.getConf()
    if conf.contains("spark.default.parallelism") or conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    return spark.sparkContext.defaultParallelism // int(conf.get("spark.task.cpus", "1"))


def fill_cores(df: DataFrame) -> DataFrame:
    """Rows spread over every core when a stored table has fewer partitions than that.

    For work repeated over the same rows, such as a fit; big tables have more partitions and stay
    as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Cut lineage with a table in the shared folder; unlike a cache it outlives executors."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
