"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. Sizes (shuffle partitions, memory) belong to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; `conf` keys use `__` for the dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster in spark.checkpoint.dir.

    Only a local master may go without the setting; a folder named after the application, in the home folder of its
    file system, then takes its place.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.FileSystem.get(spark._jsc.hadoopConfiguration())
    return f"{fs.getHomeDirectory()}/.tidemill/{context.applicationId}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call gets. It goes when the application ends."""
    home = f"{scratch_root(spark)}/scratch-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(home)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.mkdirs(path):
        files.deleteOnExit(path)
    return f"{home}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_table(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The frame as a written table, which is removed at the end."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
