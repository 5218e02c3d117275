"""Where written intermediate tables go, and when they go away."""

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="obsmill-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in `spark.checkpoint.dir`.

    Unset is accepted only where driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def written(frame: DataFrame, name: str) -> DataFrame:
    """`frame`, computed once, as a table in the shared folder.

    Later readers neither repeat its work nor lose it with an executor.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    table = frame.sparkSession.read.schema(frame.schema).parquet(path)
    table._scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes written tables. To be called once the last job that reads them has run."""
    for table in tables:
        system, place = _located(table.sparkSession, table._scratch)
        system.delete(place, True)
