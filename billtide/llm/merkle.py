"""Merkle manifest: a digest per row, per run of two nodes, per language, and a proof for every row.

Every node carries the interval ``[lo, hi)`` of leaf ranks it covers. Trees are built a band of levels at a time: one
shuffle brings the at most ``2**BAND`` nodes below a common ancestor together. A node's way to the root is found by
joins on (tree, level, bucket of ranks): the parent at the next level is the interval that holds the node, the sibling
is the child of the same parent that doesn't hold it. Nodes of a band's lowest level attach the ancestors of the band
only, and take the rest from the one ancestor on top of it, so no key of a join has more than ``2**BAND`` rows.

Null columns count as ``-``; an empty text is ``0:``; a text of any length is read whole, as one value. Leaves come by
id, nulls first; rows that share an id come by digest, so that any order of the input gives the same roots, and repeated
rows are leaves of their own. Other columns are ignored, whatever their names. An empty table has no rows and no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billtide.session import written

#: Levels of a tree built from one shuffle.
BAND = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<at: int, digest: binary, left: boolean>>"


def row_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each as its length in UTF-8 bytes, a colon and the value, or ``-`` if null."""
    as_text = [f.cast("string") for f in fields]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in as_text]
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]), 256)


def leaves(docs: DataFrame, **shown: Column) -> DataFrame:
    """``doc_id``, ``tree`` (one per language, null first in byte order), ``leaf`` and ``shown``.

    ``shown`` is the digest of the row as it is presented for checking, with the given columns in place of its own.
    """
    own = [docs[f] for f in FIELDS]
    presented = [shown.get(f, docs[f]) for f in FIELDS]
    return docs.select(
        docs["doc_id"],
        F.when(docs["lang"].isNull(), "").otherwise(F.concat(F.lit("="), docs["lang"])).alias("tree"),
        row_digest(*own).alias("leaf"),
        (row_digest(*presented) if shown else row_digest(*own)).alias("shown"),
    )


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``rank``, the row's place (from 0) in its ``tree`` by ``order``, and ``size``, the tree's rows.

    Rows are cut into ranges of the order and counted per range, so a tree may be spread over any number of tasks.
    """
    keys = ["tree", *order, "tie"]
    by = [F.col(k).asc_nulls_first() for k in keys]
    # equal rows can be cut apart, too; the ranges are written, so no task can see other cuts than the others
    tied = df.withColumn("tie", F.monotonically_increasing_id())
    ranges = written(tied.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "ranges")
    here = Window.partitionBy("tree", "part")
    counts = ranges.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(whole).alias("size"),
    )
    return (
        ranges.withColumn("rank", F.row_number().over(here.orderBy(*by)) - 1)
        .join(starts, ["tree", "part"])
        .withColumn("rank", F.col("rank") + F.col("start"))
        .drop("part", "tie", "start")
    )


def paired(digests: Column) -> Column:
    """The next level: each two consecutive digests as one, a lone last one by itself."""

    def run(i: Column) -> Column:
        return F.sha2(F.concat(F.get(digests, 2 * i), F.coalesce(F.get(digests, 2 * i + 1), F.lit(""))), 256)

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / 2).cast("int")), run)


def band(entries: DataFrame, level: int) -> DataFrame:
    """The nodes from ``level`` up to ``BAND`` levels higher above ``entries`` (tree, size, number, digest).

    ``number`` counts a level's nodes from the left. ``top`` marks the band's highest level, ``last`` bands that end
    in the tree's root.
    """
    depth = F.when(F.col("size") > 1, F.length(F.bin(F.col("size") - 1))).otherwise(0)
    blocks = (
        entries.groupBy("tree", "size", F.shiftright("number", BAND).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("number", "digest"))).alias("pairs"))
        .withColumn("steps", F.least(F.lit(BAND), depth - level))
        .withColumn("last", depth <= level + BAND)
        .withColumn("l0", F.col("pairs")["digest"])
    )
    for t in range(BAND):
        blocks = blocks.withColumn(f"l{t + 1}", F.when(F.col("steps") > t, paired(F.col(f"l{t}"))))
    levels = F.array(*[F.struct(F.lit(t).alias("t"), F.col(f"l{t}").alias("digests")) for t in range(BAND + 1)])
    span = F.expr("shiftleft(1L, level)")
    return (
        blocks.select("tree", "size", "block", "steps", "last", F.explode(levels).alias("l"))
        .where("l.t <= steps")
        .select(
            "tree", "size", "last", "steps", (F.col("l.t") + level).alias("level"),
            (F.col("l.t") == F.col("steps")).alias("top"),
            F.expr(f"shiftleft(block, {BAND} - l.t)").alias("first"), F.posexplode("l.digests").alias("at", "digest"),
        )
        .withColumn("number", F.col("first") + F.col("at"))
        .withColumn("lo", F.col("number") * span)
        .withColumn("hi", F.least(F.col("lo") + span, "size"))
        .select("tree", "size", "last", "steps", "level", "top", "number", "lo", "hi", "digest")
    )


def forest(entries: DataFrame) -> list[DataFrame]:
    """The written bands of all trees over ``entries`` (tree, size, number, digest), from the leaves up."""
    largest = entries.agg(F.max("size")).first()[0] or 0
    bands = [written(band(entries, 0), "band")]
    while largest > 2 ** (BAND * len(bands)):
        level = BAND * len(bands)
        tops = bands[-1].where((F.col("level") == level) & ~F.col("last"))
        bands.append(written(band(tops.select("tree", "size", "number", "digest"), level), "band"))
    return bands


def roots(bands: list[DataFrame]) -> DataFrame:
    """``tree`` and ``digest`` of each tree's root."""
    found = [b.where("last AND top").select("tree", "digest") for b in bands]
    for more in found[1:]:
        found[0] = found[0].union(more)
    return found[0]


def siblings(nodes: DataFrame, level: int) -> DataFrame:
    """For each node of a band's lowest level its ``steps`` (level, sibling's digest or null, is it left) in the band."""
    children = nodes.where("NOT top").select(
        F.col("tree").alias("s_tree"), F.col("level").alias("s_level"), F.col("lo").alias("s_lo"),
        F.col("hi").alias("s_hi"), F.unhex("digest").alias("s_digest"),
        F.expr("shiftright(lo, level + 1)").alias("s_parent"),
    )
    entries = nodes.where(F.col("level") == level)
    asked = entries.select(
        "tree", "number", "lo", F.explode(F.expr(f"filter(sequence(0, {BAND - 1}), t -> t < steps)")).alias("t")
    ).withColumn("at", F.col("t") + level)
    holds = (F.col("s_lo") <= F.col("lo")) & (F.col("lo") < F.col("s_hi"))
    met = asked.join(
        children,
        (F.col("tree") == F.col("s_tree"))
        & (F.col("at") == F.col("s_level"))
        & (F.expr("shiftright(lo, at + 1)") == F.col("s_parent"))
        & ~holds,
        "left",
    )
    step = F.struct("at", F.col("s_digest").alias("digest"), (F.col("s_lo") < F.col("lo")).alias("left"))
    found = met.groupBy("tree", "number").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    none = F.expr("array()").cast(found.schema["steps"].dataType)
    return (
        entries.select("tree", "number", "last")
        .join(found, ["tree", "number"], "left")
        .withColumn("steps", F.coalesce("steps", none))
    )


def ways(bands: list[DataFrame], above: DataFrame, carried: DataFrame) -> DataFrame:
    """For every leaf (tree, number) its ``steps`` up to its root and on by ``above`` (tree, steps and more columns).

    ``carried`` holds columns of the leaves, by tree and number.
    """
    more = [c for c in above.columns if c not in ("tree", "steps")]
    upper = above.select(
        "tree", F.lit(0).cast("bigint").alias("block"), F.lit(True).alias("last"), F.col("steps").alias("upper"), *more
    )
    at_root = upper
    for depth in reversed(range(len(bands))):
        own = siblings(bands[depth], BAND * depth).withColumn("block", F.shiftright("number", BAND))
        if not depth:
            own = own.join(carried, ["tree", "number"])
        found = own.join(upper, ["tree", "block", "last"]).withColumn("steps", F.concat("steps", "upper"))
        if depth:
            found = written(found.select("tree", "number", "steps", *more), "ways")
            upper = at_root.unionByName(
                found.select("tree", F.col("number").alias("block"), F.lit(False).alias("last"), F.col("steps").alias("upper"), *more)
            )
    return found


def folded(start: Column, steps: Column) -> Column:
    """The root that follows from a leaf's digest and the siblings on its way."""

    def up(below: Column, step: Column) -> Column:
        other = F.coalesce(F.lower(F.hex(step["digest"])), F.lit(""))
        return F.sha2(F.when(step["left"], F.concat(other, below)).otherwise(F.concat(below, other)), 256)

    return F.aggregate(steps, start, up)


def manifest(rows: DataFrame) -> DataFrame:
    """For each of the ``leaves`` its subroot, the root, its siblings and the root its ``shown`` digest folds to."""
    placed = written(ranked(written(rows, "leaves"), "doc_id", "leaf").withColumnRenamed("rank", "number"), "ranked")
    bands = forest(placed.select("tree", "size", "number", F.col("leaf").alias("digest")))
    names = roots(bands).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = written(ranked(names, "name").withColumnRenamed("rank", "number"), "subroots")
    top = forest(subroots.select("tree", "size", "number", "digest"))
    root = roots(top).select("tree", F.expr("array()").cast(STEPS).alias("steps"), F.col("digest").alias("root"))
    to_root = ways(top, root, subroots.select("tree", "number", "name", F.col("digest").alias("subroot")))
    above = written(to_root.select(F.col("name").alias("tree"), "steps", "subroot", "root"), "above")
    found = ways(bands, above, placed.select("tree", "number", "doc_id", "leaf", "shown"))
    digests = F.filter(F.transform("steps", lambda s: F.lower(F.hex(s["digest"]))), lambda d: d.isNotNull())
    return found.select(
        "doc_id", "leaf", "subroot", "root", "number", digests.alias("siblings"),
        folded(F.col("shown"), F.col("steps")).alias("folded_root"),
    )
