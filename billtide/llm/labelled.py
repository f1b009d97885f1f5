"""A bounded sample of labelled texts to learn from, and the folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of what a classifier learns from; everything is scored, whatever its length.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 16_384


def remainder(key: str, folds: int) -> F.Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    held_out: int,
    rows: int = SAMPLE_ROWS,
    most_bytes: int = SAMPLE_BYTES,
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``rows`` documents outside the held-out fold, in order of a hash of
    their id, which is the same in every run.

    Null labels and ids, and documents without a text, are left out before anything is chosen. Half of the
    rows at most go to each label: texts of up to ``most_bytes`` first, as the label is sure to speak of all that is
    learned from; where there are too few, longer texts fill up with a passage at a place given by the hash. What
    comes to the driver is at most rows x most_bytes.
    """
    known = labels.where(
        F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", folds) != held_out)
    ).select("doc_id", F.col(label).cast("int").alias("y"))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    too_long = F.octet_length("text") > most_bytes
    usable = known.join(texts.select("doc_id", too_long.alias("too_long")), "doc_id")
    usable = usable.groupBy("doc_id", "y").agg(F.min("too_long").alias("too_long"))
    order = [F.xxhash64("doc_id"), "doc_id", "y"]
    chosen = usable.where("y = 0").orderBy("too_long", *order).limit(rows // 2)
    chosen = chosen.union(usable.where("y = 1").orderBy("too_long", *order).limit(rows // 2))
    # at most ``rows`` ids are broadcast
    found = texts.join(F.broadcast(chosen), "doc_id").where(F.col("too_long") | ~too_long)
    # a character has four bytes at most
    size = most_bytes // 4
    at = F.pmod(F.xxhash64("doc_id"), F.length("text") - size + 1).cast("int") + 1
    found = found.withColumn("text", F.when(too_long, F.col("text").substr(at, F.lit(size))).otherwise(F.col("text")))
    found = found.orderBy(*order, "text").limit(rows).collect()
    return [r.text for r in found], [r.y for r in found]


def descend(values: list, gradient, steps: int, rate: float, shrink=None) -> list:
    """Adam over a list of arrays; ``gradient`` returns their gradients, ``shrink`` may change them after a step."""
    first = [v * 0.0 for v in values]
    second = [v * 0.0 for v in values]
    for t in range(1, steps + 1):
        slopes = gradient(values)
        for i, g in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            ahead = first[i] / (1 - 0.9**t)
            values[i] = values[i] - rate * ahead / ((second[i] / (1 - 0.999**t)) ** 0.5 + 1e-8)
        if shrink:
            values = shrink(values)
    return values
