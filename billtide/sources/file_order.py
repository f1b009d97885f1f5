"""Whether rows lie in their files in the event order, judged as they are read.

A scan yields a file's rows in their order, so neighbours are compared inside each batch. What is left is one
row per stretch of a batch, its first and last event; only these are shuffled, to compare the ends of
stretches of one file.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRETCH = """file string, position bigint, out_of_place bigint, first_t bigint, first_i bigint, first_e string,
    last_t bigint, last_i bigint, last_e string"""
# what is missing comes last, as it is stored
NEVER, NO_ID = 2**63 - 1, "\U0010ffff"


def out_of_place(rows: DataFrame) -> DataFrame:
    """One row ``out_of_place``: stored events that come before the event they should follow in their file.

    ``rows`` are read from files as they are. Missing times and ids come last.
    """
    micros = lambda c: F.coalesce(F.unix_micros(c), F.lit(NEVER))
    placed = rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("position"),
        micros("event_time").alias("t"), micros("ingested_at").alias("i"),
        F.coalesce("event_id", F.lit(NO_ID)).alias("e"),
    )
    stretches = placed.mapInArrow(_stretches, STRETCH)
    last = F.lag(F.struct("last_t", "last_i", "last_e")).over(Window.partitionBy("file").orderBy("position"))
    first = F.struct(F.col("first_t").alias("last_t"), F.col("first_i").alias("last_i"), F.col("first_e").alias("last_e"))
    joined = stretches.select("out_of_place", F.coalesce(last > first, F.lit(False)).cast("bigint").alias("at_start"))
    return joined.agg(F.coalesce(F.sum(F.col("out_of_place") + F.col("at_start")), F.lit(0)).alias("out_of_place"))


def _stretches(batches):
    """A row for each run of consecutive rows of one file in a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, event = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "e"))
        position, time, arrival = (batch.column(c).to_numpy() for c in ("position", "t", "i"))
        cut = (file[1:] != file[:-1]) | (position[1:] != position[:-1] + 1)
        tie = time[1:] == time[:-1]
        wrong = (time[1:] < time[:-1]) | (tie & (arrival[1:] < arrival[:-1]))
        # ids are compared where the times say nothing
        equal = np.flatnonzero(tie & (arrival[1:] == arrival[:-1]))
        wrong[equal] = (event[equal + 1] < event[equal]).astype(bool)
        counted = np.append(0, (wrong & ~cut).astype("int64"))
        starts = np.append(0, np.flatnonzero(cut) + 1)
        ends = np.append(starts[1:], len(file)) - 1
        columns = [
            file[starts], position[starts], np.add.reduceat(counted, starts),
            time[starts], arrival[starts], event[starts], time[ends], arrival[ends], event[ends],
        ]
        names = [field.split()[0] for field in STRETCH.split(",")]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
