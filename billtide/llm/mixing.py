"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billtide.llm.rows import quoted

#: One draw inverts a Poisson distribution with at most this mean; larger means are sums of draws.
MOST_MEAN = 32.0


def cumulative(mean: float) -> list[float]:
    """Distribution function of Poisson(mean) at 0, 1, 2, ... up to where doubles end."""
    steps, p, total = [], math.exp(-mean), 0.0
    k = 0
    while k <= mean or p > 1e-18:
        total += p
        steps.append(total)
        k += 1
        p *= mean / k
    return steps


def part_of(source: str, weights: dict[str, float]) -> F.Column:
    """The source where it is named, else null."""
    return F.when(F.col(source).isin(*weights), F.col(source)) if weights else F.lit(None).cast("string")


def rates(docs: DataFrame, weights: dict[str, float], other: float, epochs: float = 1.0) -> DataFrame:
    """A row for each named source and one (null) for all others: size, mean repetitions, draws, steps.

    Sizes are bytes of text. A source's mean is weight / sum of weights of sources that have bytes x
    total bytes x epochs / own bytes, so the expected share of the output is the weight. A source without
    bytes gets mean 0. The table has one row per entry of ``weights`` and one more, whatever the data.
    """
    sizes = docs.select(part_of("source", weights).alias("part"), F.octet_length("text").cast("bigint").alias("n"))
    found = {r.part: r.n or 0 for r in sizes.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    wanted = {**weights, None: other}
    if any(w < 0 for w in wanted.values()):
        raise ValueError("weights can't be negative")
    present = sum(w for part, w in wanted.items() if found.get(part))
    total = sum(found.values())
    rows = []
    for part, weight in wanted.items():
        size = found.get(part, 0)
        mean = weight / present * total * epochs / size if size and present else 0.0
        draws = max(1, math.ceil(mean / MOST_MEAN))
        rows.append((part, size, mean, draws, cumulative(mean / draws)))
    schema = "part string, bytes bigint, mean double, draws int, steps array<double>"
    return docs.sparkSession.createDataFrame(rows, schema)


def uniform(*parts) -> F.Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def replicated(
    docs: DataFrame,
    weights: dict[str, float],
    other: float = 0.0,
    epochs: float = 1.0,
    seed: str = "mix",
    key: str = "doc_id",
) -> DataFrame:
    """``docs`` repeated so that sources reach their weights, each copy with ``copy`` (from 1).

    A document's count inverts the Poisson distribution function of its source's mean at a number hashed
    from seed and key, so it never depends on partitions, order or retries. Sources not named, and null
    ones, share the weight ``other`` in proportion to their bytes. Repeated rows have equal counts; a row
    without a key is known by its text. Null texts have no bytes but are repeated like others of their
    source. A column named ``copy`` is replaced. The joined table is as long as ``weights``, so it is
    broadcast; a source with a third of the rows is not gathered anywhere.
    """
    columns = [c for c in docs.columns if c.lower() != "copy"]
    held = docs.select(F.struct(*[F.col(quoted(c)) for c in columns]).alias("d"))
    table = rates(docs, weights, other, epochs).select("part", "draws", "steps")
    joined = held.join(F.broadcast(table), part_of("d.source", weights).eqNullSafe(F.col("part")))
    name = name_of(F.col(f"d.{quoted(key)}"), F.col("d.text"))
    numbers = F.transform(
        F.sequence(F.lit(1), "draws"), lambda j: uniform(F.lit(seed), name, j.cast("string"))
    )
    count = F.aggregate(
        numbers, F.lit(0), lambda total, u: total + F.size(F.filter("steps", lambda step: step <= u))
    )
    counted = joined.select("d", count.alias("n")).where("n > 0")
    return counted.select("d.*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))


def name_of(key: Column, text: Column) -> Column:
    """What a document is hashed by: its key, or its text where it has none."""
    unnamed = F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit(""))))
    return F.coalesce(key.cast("string"), unnamed)


def shuffled(df: DataFrame, seed: str = "mix", key: str = "doc_id", copy: str = "copy") -> DataFrame:
    """``df`` in one hash-ordered global order; ``place`` is the number sorted by, equal for equal copies of a document.

    Rows without a key are known by their text, so they spread over the order like all others.
    """
    name = name_of(F.col(quoted(key)), F.col("text"))
    place = uniform(F.lit(seed), F.lit("place"), name, F.col(quoted(copy)).cast("string"))
    return df.withColumn("place", place.cast(T.DoubleType())).orderBy("place", key, copy)
