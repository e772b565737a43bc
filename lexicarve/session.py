"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "lexicarve", driver_memory: str | None = None) -> SparkSession:
    """Session with AQE on and the web UI off.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; the
    cluster's own ``spark.checkpoint.dir`` is used when it is set.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without one gets a fresh folder under the system
    temp dir, registered as the checkpoint dir. On a cluster each machine
    would write to its own disk there, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="lexicarve-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lexicarve/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: evaluated once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver's JVM notice which jobs have ended, so that Spark deletes their shuffle files."""
    spark._jvm.System.gc()


def discard(table: DataFrame) -> None:
    """Delete a table of ``shared`` that no later step reads."""
    jvm = table.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


__all__ = ["get_session", "checkpoint_dir", "scratch_path", "shuffle_partitions", "shared", "free_shuffles", "discard"]
