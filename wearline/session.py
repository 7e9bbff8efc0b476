"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Generated methods above this many bytes are never compiled by the JVM; beyond it Spark evaluates
# expressions in smaller methods instead, which matters for rows of 229 columns.
COMPILED_METHOD_BYTES = 8000


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the operators assume; a cluster sets its own master and sizes."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.codegen.hugeMethodLimit", str(COMPILED_METHOD_BYTES)))
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from `spark.checkpoint.dir`.

    Only a session that names none (a local test run) gets a temporary folder, which is then set on it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wearline-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For small tables that several later passes use: they are computed once, survive the loss of
    executors, and keep the plans that use them short.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
