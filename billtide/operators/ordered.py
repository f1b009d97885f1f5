"""Look back along an order within a key, also when one key holds much of the table.

A window over a key would put all rows of the key into one task. Rows are therefore always range-partitioned
by the order; every partition is a chunk, in which each key is a window of its own, and one summary row per
key and chunk carries on into the next chunk. The chunks are written out once, because both the
rows and the summaries need the same ones. Results do not depend on where keys are cut.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billtide.session import written


def in_chunks(df: DataFrame, order: list[str], chunks: int | None = None) -> DataFrame:
    """``df`` with ``chunk``, the number of its range of ``order``; as many as the session shuffles into, if
    not said otherwise."""
    ranged = df.repartitionByRange(*([chunks] if chunks else []), *order)
    return written(ranged.withColumn("chunk", F.spark_partition_id()), "chunks")


def with_previous(
    df: DataFrame, key: str, order: list[str], columns: list[str], chunks: int | None = None
) -> DataFrame:
    """Adds ``previous``, a struct of ``columns`` of the row before; null on the first row of a key."""
    row = F.struct(*columns)
    # the key first: few keys lie in more than one chunk
    cut = in_chunks(df, [key, *order], chunks)
    ends = cut.groupBy(key, "chunk").agg(F.max_by(row, F.struct(*order)).alias("end"))
    by_chunk = Window.partitionBy(key).orderBy("chunk")
    carried = ends.select(key, "chunk", F.lag("end").over(by_chunk).alias("carried"))
    within = Window.partitionBy(key, "chunk").orderBy(*order)
    return (
        cut.withColumn("previous", F.lag(row).over(within))
        .join(carried.where("carried IS NOT NULL"), [key, "chunk"], "left")
        .withColumn("previous", F.coalesce("previous", "carried"))
        .drop("chunk", "carried")
    )


def with_max_before(chunked: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``max_before``, the largest ``value`` of all rows before with the same ``keys`` (of all rows
    without any); null on the first. ``chunked`` is cut by ``order`` alone, see ``in_chunks``."""

    def before(*parts, by):
        window = Window.partitionBy(*parts).orderBy(*by)
        return window.rowsBetween(Window.unboundedPreceding, -1)

    tops = chunked.groupBy(*keys, "chunk").agg(F.max(value).alias("top"))
    # without keys one row per chunk, else at most one row per key and chunk
    carried = tops.select(*keys, "chunk", F.max("top").over(before(*keys, by=["chunk"])).alias("carried"))
    return (
        chunked.withColumn("max_before", F.max(value).over(before(*keys, "chunk", by=order)))
        .join(carried, [*keys, "chunk"], "left")
        .withColumn("max_before", F.greatest("max_before", "carried"))
        .drop("carried")
    )


def with_last(df: DataFrame, key: str, order: list[str], value: str, chunks: int | None = None) -> DataFrame:
    """Adds ``last``, the last ``value`` that is not null of the key's rows up to and with this one."""
    cut = in_chunks(df, [key, *order], chunks)
    place = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = cut.groupBy(key, "chunk").agg(F.max_by(value, place).alias("end"))
    earlier = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(key, "chunk", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    so_far = Window.partitionBy(key, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("last", F.last(value, ignorenulls=True).over(so_far))
        .join(carried.where("carried IS NOT NULL"), [key, "chunk"], "left")
        .withColumn("last", F.coalesce("last", "carried"))
        .drop("chunk", "carried")
    )
