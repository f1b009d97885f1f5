"""Session settings and the shared scratch folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from billtide.sources import files


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC: event dates and text times depend on it.

    Times are stored as microseconds, not as the twelve bytes that Spark keeps for old readers: these cost a third more
    processor time to write, and have no minimum and maximum.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session without the setting gets a temporary folder of its own; on a cluster a
    machine-local folder would not be seen by the other executors, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="billtide-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and go on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read it from there.

    Unlike a checkpoint the table is columnar, so its readers open only the columns they need.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str):
    """``df`` written below the shared folder for as long as the block lasts."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        files.delete(df.sparkSession, path)
