"""Making and deleting a folder, on whatever file system Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _found(spark: SparkSession, directory: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def make_folder(spark: SparkSession, directory: str) -> None:
    system, path = _found(spark, directory)
    system.mkdirs(path)


def delete_tree(spark: SparkSession, directory: str) -> None:
    system, path = _found(spark, directory)
    system.delete(path, True)
