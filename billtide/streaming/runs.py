"""The same jobs driven by Structured Streaming.

The file source remembers in its checkpoint which files it has taken, so an event counts as new
because its file is new, whatever its times say. No event-time watermark is set anywhere: it would
drop late events, and here every late event reopens its date.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from billtide import schema
from billtide.plans import jobs
from billtide.session import utc
from billtide.sources.tables import PARTITION, Lake


def stream_ingest(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    now,
    files_per_batch: int | None = None,
    keep_rejects: bool = False,
) -> StreamingQuery:
    """Landed files to bronze; a batch that fails its checks stops the stream before it is written.

    All files that are there are one batch; ``files_per_batch`` cuts it, for a first run on a long log. A broken
    line stops the stream too, unless ``keep_rejects`` puts it aside.
    """
    if keep_rejects:
        reader = utc(spark).readStream
        lines = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).text(landing)
        return _run(lines, lambda batch, _: jobs.ingest_lines(batch, lake, now) and None, checkpoint)
    source = _lines(utc(spark), schema.EVENT_TEXT, files_per_batch).json(landing)
    return _run(source, lambda batch, _: jobs.ingest(batch, lake, now) and None, checkpoint)


def stream_silver(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    now,
    files_per_batch: int | None = None,
    with_gold: bool = False,
) -> StreamingQuery:
    """New bronze files to history and current snapshot, and on to the KPIs if asked."""
    columns = T.StructType([*schema.EVENT, PARTITION])
    source = _lines(utc(spark), columns, files_per_batch).json(lake.bronze)

    def process(batch: DataFrame, _: int) -> None:
        jobs.apply_to_silver(batch, lake, now)
        if with_gold:
            jobs.update_gold(batch.sparkSession, lake, now)

    return _run(source, process, checkpoint)


def _lines(spark, columns, files_per_batch):
    reader = spark.readStream.schema(columns).option("mode", "FAILFAST")
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def _run(source, process, checkpoint):
    """Takes all files that are there now and stops; running it again takes only newer ones."""
    return (
        source.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
