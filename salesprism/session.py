"""Session helpers: a local test session and the reliable checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("salesprism")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and context.getCheckpointDir() is not None:
        folder = context.getCheckpointDir()
    if folder is None:
        # the executors of local-cluster are processes of their own, as on any cluster
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="salesprism-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_RUN = "salesprism.run.folder"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables stored inside the block, which is removed after it.

    Results must be written or collected inside, since they read these tables.
    """
    path = f"{shared_folder(spark).rstrip('/')}/salesprism-run-{uuid.uuid4().hex}"
    before = spark.conf.get(_RUN, None)
    spark.conf.set(_RUN, path)
    try:
        yield path
    finally:
        if before is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, before)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def table_folder(spark: SparkSession) -> str:
    """Where stored tables go: the run's folder, or the shared one outside of a run."""
    return spark.conf.get(_RUN, None) or shared_folder(spark).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so a lost executor loses no rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def materialised(df: DataFrame, *by: str) -> DataFrame:
    """Write the rows as a Parquet table in the shared folder, with a folder for each value of the
    columns in ``by``, and read it back.

    For tables that several later passes read: each pass scans only its own columns,
    and a lost executor loses no work. The files stay until the ``run_folder`` is left, or
    until the shared folder is cleared.
    """
    spark = df.sparkSession
    path = f"{table_folder(spark)}/salesprism-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
