"""File system helpers for whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _located(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds, if it exists."""
    system, place = _located(spark, path)
    system.delete(place, True)


def streamed(path: str, name: str) -> str:
    """Where a stream finds the table `name` (or those of a pattern) below `path`: a file, or a folder of files.

    A pattern with one choice: of any other path a stream wants a folder, and a filter on file names
    finds nothing in a folder of that name.
    """
    return f"{path.rstrip('/')}/{{{name}}}"


def spread(df: DataFrame) -> DataFrame:
    """Spread a small scan over all cores ahead of CPU-heavy work.

    A scan with at least as many splits as there are cores, so any large one, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
