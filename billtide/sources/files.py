"""Paths and folders on any Hadoop file system."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _at(spark, path)
    return fs.exists(where)


def matching(spark: SparkSession, base_dir: str, pattern: str) -> list[str]:
    """Paths below ``base_dir`` that match a glob such as ``dt=*`` or ``dt=*/*.parquet``, sorted.

    A listing of names only: one entry per partition or file, no data is read.
    """
    where, fs = _at(spark, f"{base_dir}/{pattern}")
    found = fs.globStatus(where)
    return sorted(status.getPath().toString() for status in found) if found else []


def partition_dates(spark: SparkSession, base_dir: str) -> list[str]:
    """The dates of the ``dt=`` folders of a table."""
    return [p.rsplit("dt=", 1)[1] for p in matching(spark, base_dir, "dt=*")]


def delete(spark: SparkSession, path: str) -> None:
    where, fs = _at(spark, path)
    fs.delete(where, True)
