"""Which folder of a table is in force, part by part, as an append-only table beside it.

Data is written below a folder of its own first; naming that folder here, in one small file, puts it in
force. A job that dies before leaves the table as it was, one that dies after has published all of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billtide.sources import files

POINTER = T.StructType(
    [
        T.StructField("sequence", T.LongType()),
        T.StructField("part", T.StringType()),
        T.StructField("folder", T.StringType()),
    ]
)


def new_folder() -> str:
    return f"publish=p{uuid.uuid4().hex}"


def _all(spark: SparkSession, table: str) -> DataFrame:
    path = f"{table}-pointers"
    if not files.exists(spark, path):
        return spark.createDataFrame([], POINTER)
    return spark.read.schema(POINTER).parquet(path)


def in_force(spark: SparkSession, table: str) -> dict[str, str]:
    """Part -> folder: one entry per part, that is per calendar date or one for the whole table."""
    last = _all(spark, table).groupBy("part").agg(F.max_by("folder", "sequence").alias("folder"))
    return {r.part: r.folder for r in last.where("folder IS NOT NULL").collect()}


def publish(spark: SparkSession, table: str, folders: dict[str, str | None]) -> None:
    """Puts folders in force; None takes a part away.

    What the publish before this one has replaced is deleted: a reader may still have open what this one
    replaces, but nothing older.
    """
    if not folders:
        return
    known = _all(spark, table)
    last = known.agg(F.max("sequence")).first()[0] or 0
    by_part = Window.partitionBy("part").orderBy("sequence")
    replaced = known.withColumn("until", F.lead("sequence").over(by_part)).where(F.col("until") == last)
    gone = [(r.part, r.folder) for r in replaced.where("folder IS NOT NULL").collect()]
    rows = [(last + 1, part, folder) for part, folder in folders.items()]
    spark.createDataFrame(rows, POINTER).coalesce(1).write.mode("append").parquet(f"{table}-pointers")
    for part, folder in gone:
        files.delete(spark, f"{table}/{folder}/{part}".rstrip("/"))
