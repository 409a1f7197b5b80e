"""Session building and the shared folder for data that cuts lineage."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("penprint")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_folder(application: str) -> str:
    """A temporary folder of this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="penprint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local-mode session that names none gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/penprint/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs read one costly result: columns stay prunable and
    a lost executor costs a re-read, not a recomputation.
    """
    path = new_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
