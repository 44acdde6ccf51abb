"""Tables written between two stages of a job, in the folder the cluster shares.

A written table cuts the lineage, survives a lost executor, keeps Parquet's column
pruning, and gives Catalyst a real size to choose a join by.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_open: set[Staging] = set()


@functools.cache
def _temporary_folder() -> str:
    folder = tempfile.mkdtemp(prefix="viewstar-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _temporary_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


class Staging:
    """One job's own subfolder of the shared folder.

    It is deleted by ``close``, or, where a returned frame still reads it, when the program
    ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/viewstar/{uuid.uuid4().hex}"
        self._folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        self._filesystem = self._folder.getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())
        _open.add(self)

    def path(self, label: str) -> str:
        return f"{self.root}/{label}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return a frame over what was written."""
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def split(self, df: DataFrame, label: str, column: str, values) -> dict[str, DataFrame]:
        """Write ``df`` once, one folder per value of ``column``, and open each folder.

        Each returned frame knows its own size, not that of all values together.
        """
        path = self.path(label)
        df.write.partitionBy(column).parquet(path)
        schema = df.drop(column).schema
        empty = self.spark.createDataFrame([], schema)
        present = subfolders(self.spark, path)
        return {
            value: self.spark.read.schema(schema).parquet(f"{path}/{column}={value}")
            if f"{column}={value}" in present else empty
            for value in values
        }

    def close(self) -> None:
        """Delete this job's staged tables; frames over them end here."""
        _open.discard(self)
        self._filesystem.delete(self._folder, True)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_) -> None:
        self.close()


@atexit.register
def _close_all() -> None:
    for staging in list(_open):
        # The session's process may be gone by now, and its folders with it.
        with contextlib.suppress(Exception):
            staging.close()


def subfolders(spark: SparkSession, path: str) -> set[str]:
    """Names in a folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in filesystem.listStatus(hadoop)}


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
