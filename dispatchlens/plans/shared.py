"""Intermediate tables that several results of one run read.

They are written as Parquet to the checkpoint folder of the session, which on a
cluster is shared storage: a lost executor costs a re-read, not a recomputation,
and each reader takes only the columns it needs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a local session without one gets a temporary folder; a cluster must
    name a folder that all its executors reach.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir() or ""
    if not folder and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="dispatchlens-"))
        folder = context.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    run = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    return f"{shared_folder(spark)}/dispatchlens/{name}/{run}"


def materialise(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once under a fresh path, and read back."""
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    frame.write.mode("errorifexists").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done.

    It does so once the driver's JVM has collected what refers to them, which a driver with
    memory to spare puts off while the files of one job after the other fill the disks.
    """
    spark._jvm.System.gc()


class Steps:
    """Tables made one after the other; each frees the shuffle files of those before."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        self.paths.append(path)
        frame.write.mode("errorifexists").parquet(path)
        free_shuffles(self.spark)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self) -> None:
        """Delete all tables, which nothing will read again."""
        configuration = self.spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            place.getFileSystem(configuration).delete(place, True)
