"""Scratch tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir()


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path, on the JVM side."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


class Workspace:
    """A private folder below the shared one, removed when the driver exits."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/celltide-{uuid.uuid4().hex}"
        fs, path = hadoop_path(spark, self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def clear(self) -> None:
        """Drop what has been staged, once nothing will read it again."""
        fs, path = hadoop_path(self.spark, self.root)
        for status in fs.listStatus(path):
            fs.delete(status.getPath(), True)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame once and read it back.

        The copy ends the lineage, survives lost executors, and gives the
        planner the true size of what it is about to join.
        """
        target = self.path(f"{name}-{uuid.uuid4().hex[:8]}")
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)
