"""Comparison of two tables by digests: rows move only where something differs.

Rows fall into a fixed number of buckets by a hash of their key. A bucket's digest is its number of rows and the
sum of their 64-bit hashes, so it depends on no order and is added up before the shuffle: of equal tables only
digests move. A difference goes unseen where the sums of a bucket agree by chance, once in some 2^64.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# also the bound of what is broadcast
BUCKETS = 4096


def bucket(key: str, buckets: int = BUCKETS) -> Column:
    """The bucket of a key; rows without one share a bucket."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucket_digests(rows: DataFrame, key: str, columns: list[str], side: int, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, row_count, digest), one row per bucket that isn't empty.

    Rows with a null in ``columns`` carry ``side`` in their hash: null counts as different from everything.
    """
    nulls = F.lit(False)
    for c in columns:
        nulls = nulls | F.col(c).isNull()
    hashed = F.xxhash64(key, *columns, F.when(nulls, F.lit(side)))
    return rows.groupBy(bucket(key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(hashed.cast("decimal(20,0)")).alias("digest"),
    )


def differing_buckets(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """The buckets whose digests differ or that only one side has, at most as many as there are."""
    others = theirs.select("bucket", F.col("row_count").alias("row_count_"), F.col("digest").alias("digest_"))
    same = F.col("row_count").eqNullSafe(F.col("row_count_")) & F.col("digest").eqNullSafe(F.col("digest_"))
    return ours.join(others, "bucket", "full_outer").where(~same).select("bucket")


def within(rows: DataFrame, key: str, buckets: DataFrame, count: int = BUCKETS) -> DataFrame:
    """The rows in ``buckets``, of which there are ``count`` at most, so they are broadcast."""
    marked = rows.withColumn("bucket", bucket(key, count))
    return marked.join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")
