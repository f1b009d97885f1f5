"""Columns computed from whole texts, one Arrow batch at a time, and the tables' readers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of rows after which an Arrow batch ends; texts may be long.
BATCH_BYTES = 2 * 2**20


def small_batches(spark: SparkSession) -> SparkSession:
    """Bounds the bytes per Arrow batch, so that many long texts don't meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def quoted(name: str) -> str:
    """A column's name as it stands, with dots and spaces; Spark can't refer to names with backquotes."""
    return f"`{name}`"


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any case."""
    gone = {n.lower() for n in names}
    return df.select(*[df[quoted(c)] for c in df.columns if c.lower() not in gone])


def add_columns(
    df: DataFrame,
    start: Callable[[], Callable[..., list[list]]],
    fields: list[tuple[str, str, pa.DataType]],
    *inputs: str,
    as_arrow: bool = False,
) -> DataFrame:
    """``df`` and one more column for each of ``fields`` (name, Spark type, Arrow type).

    ``start`` is called once per task and returns what turns lists of the ``inputs`` columns into a
    list of values per field; with ``as_arrow`` it gets Arrow arrays. It may return Arrow arrays. Columns that
    have a field's name, in any case, are replaced.
    """
    taken = [n for n in inputs if n.lower() in {f[0].lower() for f in fields}]
    if taken:
        raise ValueError(f"columns {taken} are inputs and can't be results too")
    gone = {f[0].lower() for f in fields}
    at = [[c.lower() for c in df.columns].index(n.lower()) for n in inputs]
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in gone]
    at = [kept.index(i) for i in at]
    made_fields = T.DataType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind, _ in fields))
    schema = T.StructType([*[df.schema.fields[i] for i in kept], *made_fields.fields])
    # by number, so that any name will do
    df = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(*[f"c{i}" for i in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            columns = [batch.column(i) for i in at]
            made = work(*(columns if as_arrow else [c.to_pylist() for c in columns]))
            arrays = [
                v if isinstance(v, pa.Array) else pa.array(v, kind)
                for v, (_, _, kind) in zip(made, fields, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], schema.names)

    return df.mapInArrow(run, schema)
