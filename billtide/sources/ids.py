"""On which dates each event id has been stored: a table bucketed and sorted by id.

A batch looks up where the history holds its events. Here only the batch moves: it is shuffled into the table's buckets (or
broadcast, if it is small), and the stored side is read where it lies, without an exchange and without a look at the history.

Rows are only added, before the history that they speak of goes into force. So the table may name dates that don't hold an
id any more, or that a lost run never published, but never lacks one; a date too many is merged with nothing and stays
as it was. The number of buckets is that of the session's shuffle partitions when the table is begun and part of its
folder's name, for it can't change later; a session with more partitions than that shuffles both sides after all.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billtide.sources import files


def _begun(spark: SparkSession, path: str) -> list[str]:
    return files.matching(spark, path, "buckets-*")


def _defined(spark: SparkSession, path: str, buckets: int | None = None) -> tuple[str, int]:
    """The table's name in this session and the number of its buckets."""
    begun = _begun(spark, path)
    buckets = int(begun[0].rsplit("-", 1)[1]) if begun else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"event_ids_{hashlib.md5(path.encode()).hexdigest()}_{buckets}"
    place = f"{path}/buckets-{buckets}".replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (event_id STRING, dt DATE) USING parquet "
        f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return name, buckets


def append_ids(events: DataFrame, path: str, buckets: int | None = None) -> None:
    """Adds where events are stored (``event_id``, ``dt``), one file per bucket; ``buckets`` counts for a new table."""
    name, buckets = _defined(events.sparkSession, path, buckets)
    # once dealt by id, equal rows lie together and no second shuffle is needed
    dealt = events.select("event_id", "dt").repartition(buckets, "event_id").distinct()
    dealt.sortWithinPartitions("event_id").write.insertInto(name)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``event_id`` and ``dt``, as often as an event was delivered; other sessions' rows included."""
    name, _ = _defined(spark, path)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_begun(spark, path))


def dates_of(stored: DataFrame, events: DataFrame) -> DataFrame:
    """The dates on which the events of a batch have been stored, one row each."""
    wanted = events.select("event_id").distinct()
    return stored.join(wanted, "event_id", "left_semi").select(F.col("dt")).distinct()
