"""Readers and writers of the stored tables.

Layouts: bronze is line-delimited JSON by ingest date, history is Parquet by event date and the current
snapshot one Parquet folder, both published through pointers; KPIs are Parquet by date. Any Hadoop path
works.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billtide import schema
from billtide.functions.ordering import sort_columns
from billtide.functions.times import ISO_MICROS, event_date, moment, parsed
from billtide.sources import file_order, files, pointers

PARTITION = T.StructField("dt", T.DateType())


@dataclass(frozen=True)
class Lake:
    """Where the tables live."""

    root: str

    @property
    def bronze(self):
        return f"{self.root}/bronze/subscription_events"

    @property
    def rejects(self):
        return f"{self.root}/bronze/rejected_lines"

    @property
    def history(self):
        return f"{self.root}/silver/subscription_state_history"

    @property
    def current(self):
        return f"{self.root}/silver/subscription_state_current"

    @property
    def gold(self):
        return f"{self.root}/gold/tables"

    @property
    def kpi(self):
        return f"{self.gold}/table=kpi_daily"

    @property
    def day_states(self):
        return f"{self.gold}/table=day_states"

    @property
    def ids(self):
        return f"{self.root}/silver/event_ids"

    @property
    def checks(self):
        return f"{self.root}/state/checks"

    @property
    def control(self):
        return f"{self.root}/state/control"


def read_or_empty(spark: SparkSession, path: str, columns: T.StructType, fmt="parquet", **options):
    """The table at ``path``, or an empty one of the same schema when nothing is there yet."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).options(**options).format(fmt).load(path)


# ---- bronze ----


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Parsed events with their ``dt``; a malformed line raises."""
    return read_or_empty(
        spark, path, T.StructType([*schema.EVENT, PARTITION]), "json", mode="FAILFAST"
    )


def read_bronze_with_rejects(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_bronze``, but a malformed line becomes a row with its text in ``_corrupt_record``."""
    columns = T.StructType(
        [*schema.EVENT, T.StructField("_corrupt_record", T.StringType()), PARTITION]
    )
    return read_or_empty(
        spark, path, columns, "json",
        mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record",
    )


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Events as the text their producer wrote, for the checks that run before parsing."""
    return read_or_empty(spark, path, schema.EVENT_TEXT, "json", mode="FAILFAST")


def split_lines(lines: DataFrame) -> DataFrame:
    """Landed lines (``value``) as ``event``, the record as text, and ``rejected``: the line where it is no JSON
    object, else null. Blank lines are left out."""
    columns = T.StructType([*schema.EVENT_TEXT, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    read = lines.where("trim(value) <> ''").select(
        F.col("value"), F.from_json("value", columns, options).alias("read")
    )
    # null, true, 1 and the like are JSON, but no events
    bad = F.col("read").isNull() | F.col("read._corrupt_record").isNotNull() | ~F.ltrim("value").startswith("{")
    return read.select(
        F.struct(*[F.col(f"read.{c}").alias(c) for c in schema.EVENT_COLUMNS]).alias("event"),
        F.when(bad, F.col("value")).alias("rejected"),
    )


def append_rejects(lines: DataFrame, path: str, now) -> None:
    """Adds rejected lines (``line``) with the time of the run."""
    lines.select("line", moment(now).alias("rejected_at")).write.mode("append").parquet(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    columns = [T.StructField("line", T.StringType()), T.StructField("rejected_at", T.TimestampType())]
    return read_or_empty(spark, path, T.StructType(columns))


def parse_landing(events: DataFrame) -> DataFrame:
    """Checked text to typed columns; a value that does not parse raises."""
    return events.selectExpr(
        *[
            f"{parsed(f.name)} AS {f.name}"
            if isinstance(f.dataType, T.TimestampType)
            else f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.EVENT
        ]
    )


def append_bronze(events: DataFrame, path: str) -> None:
    """Adds events below the date of their ingestion, times with microseconds.

    Rebalancing gathers a date's rows into few files and splits a date that is too big for one task.
    """
    dated = events.select(*schema.EVENT_COLUMNS, F.to_date("ingested_at").alias("dt"))
    (
        dated.hint("rebalance", "dt")
        .write.mode("append")
        .option("timestampFormat", ISO_MICROS)
        .partitionBy("dt")
        .json(path)
    )


# ---- history ----


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The rows in force, with ``dt``; a filter on ``dt`` opens no other date's files."""
    return _published(spark, path, pointers.in_force(spark, path)).drop("publish")


def history_dates(spark: SparkSession, path: str) -> list[str]:
    """The event dates in force."""
    return sorted(part.rsplit("dt=", 1)[1] for part in pointers.in_force(spark, path))


def _published(spark, path, in_force):
    columns = T.StructType([*schema.EVENT, PARTITION])
    if not in_force:
        return spark.createDataFrame([], columns)
    # one path per calendar date
    paths = [f"{path}/{folder}/{part}" for part, folder in sorted(in_force.items())]
    return spark.read.schema(columns).option("basePath", path).parquet(*paths)


def stage_history(history: DataFrame, path: str) -> str:
    """Writes event dates beside the table and returns their folder; nothing is in force yet."""
    folder = pointers.new_folder()
    dated = history.select(*schema.EVENT_COLUMNS, event_date().alias("dt"))
    (
        dated.hint("rebalance", "dt")
        .sortWithinPartitions("dt", *sort_columns())
        .write.partitionBy("dt")
        .parquet(f"{path}/{folder}")
    )
    return folder


def staged_parts(spark: SparkSession, path: str, folder: str) -> dict[str, str]:
    """The dates that a folder holds, as pointers to it."""
    return {f"dt={d}": folder for d in files.partition_dates(spark, f"{path}/{folder}")}


def read_staged(spark: SparkSession, path: str, folder: str) -> DataFrame:
    return _published(spark, path, staged_parts(spark, path, folder)).drop("publish")


def publish_history(spark: SparkSession, path: str, folder: str, touched=()) -> None:
    """Puts a staged folder in force for its dates; touched dates that it lacks are emptied."""
    gone = {f"dt={d}": None for d in touched}
    pointers.publish(spark, path, gone | staged_parts(spark, path, folder))


def overwrite_history(history: DataFrame, path: str, touched=()) -> None:
    """Replaces the event dates that occur in ``history``, empties other ``touched`` ones and leaves the
    rest alone."""
    publish_history(history.sparkSession, path, stage_history(history, path), touched)


def stored_order_violations(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """One row: stored rows that come before the row they should follow in their file, of what is in force or of
    a staged folder."""
    parts = staged_parts(spark, path, folder) if folder else pointers.in_force(spark, path)
    rows = _published(spark, path, parts)
    return file_order.out_of_place(rows) if parts else spark.sql("SELECT 0L AS out_of_place")


# ---- current snapshot ----


def read_current(spark: SparkSession, path: str, columns=schema.CURRENT) -> DataFrame:
    """The snapshot in force, empty before the first."""
    folder = pointers.in_force(spark, path).get("")
    if folder is None:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(f"{path}/{folder}")


def stage_current(current: DataFrame, path: str) -> str:
    """Writes a snapshot beside the one in force and returns its folder."""
    folder = pointers.new_folder()
    current.write.parquet(f"{path}/{folder}")
    return folder


def publish_current(spark: SparkSession, path: str, folder: str) -> None:
    pointers.publish(spark, path, {"": folder})


def overwrite_current(current: DataFrame, path: str) -> None:
    """A new snapshot in the place of the old one; readers never see half of it."""
    publish_current(current.sparkSession, path, stage_current(current, path))


# ---- check results ----


def append_checks(spark: SparkSession, results: list, path: str, job: str, now) -> None:
    """Adds a run's check rows, some twenty, with the job and the time of the run."""
    if not results:
        return
    rows = spark.createDataFrame([tuple(r) for r in results], schema.CHECK)
    stamped = rows.select(F.lit(job).alias("job"), moment(now).alias("run_time"), "*")
    stamped.coalesce(1).write.mode("append").parquet(path)


def read_checks(spark: SparkSession, path: str) -> DataFrame:
    stamp = [T.StructField("job", T.StringType()), T.StructField("run_time", T.TimestampType())]
    return read_or_empty(spark, path, T.StructType([*stamp, *schema.CHECK]))


# ---- gold: KPIs and end-of-day states, put in force together ----


def gold_dates(spark: SparkSession, path: str) -> dict[str, str]:
    """Date -> folder of one gold table, given by its path below the common folder: ``.../table=name``."""
    base, table = path.rsplit("/", 1)
    in_force = pointers.in_force(spark, base)
    return {part.rsplit("dt=", 1)[1]: folder for part, folder in in_force.items() if part.startswith(f"{table}/")}


def _read_gold(spark, path, columns, folders):
    base, table = path.rsplit("/", 1)
    if not folders:
        return spark.createDataFrame([], T.StructType([*columns, PARTITION]))
    paths = [f"{base}/{folder}/{table}/dt={date}" for date, folder in sorted(folders.items())]
    rows = spark.read.schema(T.StructType([*columns, PARTITION])).option("basePath", base).parquet(*paths)
    return rows.drop("publish", "table")


def read_kpis(spark: SparkSession, path: str) -> DataFrame:
    return _read_gold(spark, path, schema.KPI, gold_dates(spark, path))


def read_day_states(spark: SparkSession, path: str) -> DataFrame:
    """The stored states; ``date`` is the partition's, so a filter on it opens no other date's files."""
    rows = _read_gold(spark, path, schema.DAY_STATE, gold_dates(spark, path))
    return rows.withColumn("date", F.col("dt")).drop("dt")


def stage_gold(rows: DataFrame, path: str, folder: str) -> None:
    """Writes rows of a gold table by their ``date`` beside what is in force."""
    base, table = path.rsplit("/", 1)
    dated = rows.withColumn("dt", F.col("date")).hint("rebalance", "dt")
    dated.write.partitionBy("dt").parquet(f"{base}/{folder}/{table}")


def read_staged_gold(spark: SparkSession, path: str, folder: str, columns: T.StructType) -> DataFrame:
    return _read_gold(spark, path, columns, {d: folder for d in staged_gold_dates(spark, path, folder)}).drop("dt")


def staged_gold_dates(spark: SparkSession, path: str, folder: str) -> list[str]:
    base, table = path.rsplit("/", 1)
    return files.partition_dates(spark, f"{base}/{folder}/{table}")


def publish_gold(spark: SparkSession, folder: str, gone: dict[str, list]) -> None:
    """Puts what is staged of all gold tables in force in one step; ``gone`` has the dates that each path loses."""
    folders = {}
    for path, dates in gone.items():
        base, table = path.rsplit("/", 1)
        made = staged_gold_dates(spark, path, folder)
        folders |= {f"{table}/dt={d}": None for d in dates} | {f"{table}/dt={d}": folder for d in made}
    pointers.publish(spark, base, folders)


def overwrite_kpis(kpis: DataFrame, path: str, gone=()) -> None:
    """Replaces the KPI rows of the dates in ``kpis`` and takes those of ``gone`` away, in one step."""
    folder = pointers.new_folder()
    stage_gold(kpis, path, folder)
    publish_gold(kpis.sparkSession, folder, {path: list(gone)})
