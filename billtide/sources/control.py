"""What each pipeline has begun and committed, as an append-only table.

Rows carry a number that grows with each row of the pipeline, whatever any clock says. The mark in force
is that of the commit with the largest number. Nothing is read, changed and written back, so pipelines cannot
lose each other's marks.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.times import moment
from billtide.sources.tables import read_or_empty

INTENT, COMMIT = "intent", "commit"


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """The mark in force of every pipeline."""
    commits = read_or_empty(spark, path, schema.CONTROL).where(F.col("kind") == COMMIT)
    row = F.struct(*[c for c in schema.CONTROL.fieldNames() if c != "pipeline"])
    last = commits.groupBy("pipeline").agg(F.max_by(row, "sequence").alias("last"))
    return last.select("pipeline", "last.*")


def load_mark(spark: SparkSession, path: str, pipeline: str):
    """The row in force of one pipeline with the mark in microseconds, None before its first commit."""
    marks = read_marks(spark, path).where(F.col("pipeline") == pipeline)
    return marks.withColumn("mark", F.unix_micros("last_processed_ingested_at")).first()


def save_mark(spark: SparkSession, path: str, pipeline: str, mark, **more) -> None:
    """Commits a mark; ``more`` as for ``_append``."""
    _append(spark, path, pipeline, COMMIT, mark, **more)


def save_intent(spark: SparkSession, path: str, pipeline: str, **more) -> None:
    """Says what is about to change, before it changes: who reads the table later need not ask whether the
    job came to its end."""
    _append(spark, path, pipeline, INTENT, None, **more)


def _append(
    spark, path, pipeline, kind, mark, committed_at, affected_start=None, affected_dates=None, upstream_sequence=None
):
    own = read_or_empty(spark, path, schema.CONTROL).where(F.col("pipeline") == pipeline)
    sequence = (own.agg(F.max("sequence")).first()[0] or 0) + 1
    values = {
        "pipeline": F.lit(pipeline), "sequence": F.lit(sequence), "kind": F.lit(kind),
        "last_processed_ingested_at": moment(mark), "affected_start": F.lit(affected_start),
        "affected_dates": F.lit(None) if affected_dates is None else F.array(*map(F.lit, affected_dates)),
        "upstream_sequence": F.lit(upstream_sequence), "committed_at": moment(committed_at),
    }
    row = spark.range(1).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in schema.CONTROL]
    )
    row.coalesce(1).write.mode("append").parquet(path)


def changes_since(spark: SparkSession, path: str, upstream: str, since: int | None):
    """What ``upstream`` began or committed after number ``since``: the earliest event date, the dates it listed, the
    earliest date of rows that list none, the mark in microseconds and the number of the last commit.

    What was begun and not committed comes again until it is: at the time of reading, it may be done or not.
    """
    rows = read_or_empty(spark, path, schema.CONTROL).where(F.col("pipeline") == upstream)
    commit = F.when(F.col("kind") == COMMIT, F.col("sequence"))
    new = F.col("sequence") > F.lit(since or 0)
    return rows.agg(
        F.min(F.when(new, F.col("affected_start"))).alias("affected_start"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(new, F.col("affected_dates")))))).alias("affected_dates"),
        F.min(F.when(new & F.col("affected_dates").isNull(), F.col("affected_start"))).alias("unlisted_start"),
        F.unix_micros(F.max_by("last_processed_ingested_at", commit)).alias("mark"),
        F.max(commit).alias("sequence"),
    ).first()
