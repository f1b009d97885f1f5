"""Near-duplicate vectors by a subspace pigeonhole join."""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide.llm.components import connected
from billtide.llm.rows import small_batches
from billtide.session import written

#: Blocks a rotated vector is cut into, where it has that many components.
BLOCKS = 4
#: Width of a grid cell, in radii of a block's range join.
CELL_RADII = 2.5
#: Vectors of one label that a cell should hold; the number of gridded components follows from it.
CELL_ROWS = 2_000
#: Vectors of one cell that are compared as one task, guests included; larger cells are cut into tiles of this size.
TILE_ROWS = 4_000
SLACK = 1e-9

VECTOR = "rep bigint, n bigint, label int, embedding array<float>"
CELL = "dim int, block int, cell string"
UNIT = ["label", "dim", "block", "cell", "low", "high"]


def blocks_of(dim: int) -> list[tuple[int, int]]:
    k = min(BLOCKS, dim)
    return [(dim * i // k, dim * (i + 1) // k) for i in range(k)]


def rotation(dim: int) -> np.ndarray:
    """A fixed orthogonal matrix, so that no block is poor or rich in variance."""
    q, r = np.linalg.qr(np.random.default_rng(20 + dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def turned(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated; lengths are taken after scaling, so they neither vanish nor overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return unit @ rotation(vectors.shape[1])


def budget(threshold: float, dim: int, a: int, b: int) -> float:
    """The share of a block in the squared distance of unit vectors with this cosine."""
    return (2 - 2 * threshold) * (b - a) / dim * (1 + SLACK) + SLACK


def cells(points: np.ndarray, threshold: float, grid: int):
    """(row, block, cell, home) of every cell of a block's grid that a vector must meet.

    The grid is over a block's first ``grid`` components. Each vector has its home cell; to cells that come
    after it in the order of their numbers it goes as a guest if they begin within the block's radius.
    """
    dim = points.shape[1]
    for block, (a, b) in enumerate(blocks_of(dim)):
        radius = math.sqrt(budget(threshold, dim, a, b))
        width = max(CELL_RADII * radius, 1e-6)
        x = points[:, a : a + min(grid, b - a)]
        at = np.floor(x / width).astype(np.int64)
        below, above = x - at * width <= radius, (at + 1) * width - x <= radius
        for step in product((0, 1, -1), repeat=x.shape[1]):
            lead = next((s for s in step if s), 0)
            if lead < 0:
                continue
            rows = np.ones(len(x), bool)
            for i, s in enumerate(step):
                if s:
                    rows &= above[:, i] if s > 0 else below[:, i]
            rows = np.flatnonzero(rows)
            yield rows, block, at[rows] + np.array(step), lead == 0


def pairs_in(points, raw, home, tiles, unit, block, threshold):
    """Index pairs (home, other) of one cell whose cosine reaches the threshold.

    A pair is taken in the first block in which it is within the budget, and nowhere else. ``unit`` names the
    two tiles, of homes or of homes and of guests, whose vectors are paired here.
    """
    dim = points.shape[1]
    cuts = blocks_of(dim)
    a, b = cuts[block]
    low, high = unit
    squares = (points[:, a:b] ** 2).sum(axis=1)
    members = np.flatnonzero(home)
    step = max(1, 4_000_000 // max(1, len(points)))
    for i in range(0, len(members), step):
        mine = members[i : i + step]
        far = squares[mine, None] + squares[None, :] - 2 * points[mine, a:b] @ points[:, a:b].T
        p, q = np.nonzero(far <= budget(threshold, dim, a, b) + 1e-7)
        p = mine[p]
        # two members meet once; a member and a guest, too
        keep = np.where(home[q], p < q, True) & (
            ((tiles[p] == low) & (tiles[q] == high)) | ((tiles[p] == high) & (tiles[q] == low))
        )
        p, q = p[keep], q[keep]
        for j in range(0, len(p), 100_000):
            u, v = p[j : j + 100_000], q[j : j + 100_000]
            share = (points[u] - points[v]) ** 2
            first = np.ones(len(u), bool)
            for other, (c, d) in enumerate(cuts[: block + 1]):
                within = share[:, c:d].sum(axis=1) <= budget(threshold, dim, c, d)
                first &= within if other == block else ~within
            u, v = u[first], v[first]
            x, y = raw[u], raw[v]
            cosine = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((y * y).sum(axis=1))
            yield u[cosine >= threshold], v[cosine >= threshold]


def found_in(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """For each vector of a cell that has links here: how many vectors it is linked with, counting copies,
    and the smallest vector it hangs together with in this cell."""
    if not frame["home"].any():
        return pd.DataFrame({"rep": [], "linked": [], "root": []}, dtype=np.int64)
    frame = frame.sort_values("rep", kind="stable").reset_index(drop=True)
    raw = np.array(frame["embedding"].tolist(), np.float64)
    points = turned(raw)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    home, tiles = frame["home"].to_numpy(bool), frame["tile"].to_numpy(np.int64)
    copies = frame["n"].to_numpy(np.int64)
    unit = (int(frame["low"].iloc[0]), int(frame["high"].iloc[0]))
    count, root = np.zeros(len(frame), np.int64), np.arange(len(frame))
    for p, q in pairs_in(points, raw, home, tiles, unit, int(frame["block"].iloc[0]), threshold):
        np.add.at(count, p, copies[q])
        np.add.at(count, q, copies[p])
        while True:  # each root takes the smallest root it meets, until all agree
            rp, rq = root[p], root[q]
            if (rp == rq).all():
                break
            np.minimum.at(root, np.maximum(rp, rq), np.minimum(rp, rq))
            while (root[root] != root).any():
                root = root[root]
    has = count > 0
    rep = frame["rep"].to_numpy(np.int64)
    return pd.DataFrame({"rep": rep[has], "linked": count[has], "root": rep[root[has]]})


#: Rows with an id, a label and a vector of finite components that aren't all zero.
USABLE = (
    "coalesce(vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0"
    " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    " AND exists(embedding, x -> x <> 0), false)"
)


def in_units(points: DataFrame, threshold: float, grid: int) -> DataFrame:
    """The vectors of ``points`` in each cell they must meet, once for each unit of work they take part in.

    A cell of up to TILE_ROWS vectors is one unit. The homes and the guests of a larger one are each dealt into
    tiles, and its units are the pairs of tiles with a home tile among them, so a unit has about two tiles of rows
    at most, whatever the crowd. A larger cell without a home has no units. Smaller ones aren't sought out, as that
    takes another shuffle of all vectors; ``found_in`` returns from them at once.
    """

    def to_cells(frames, with_vectors):
        for frame in frames:
            frame = frame.assign(dim=frame["embedding"].map(len))
            for dim, own in frame.groupby("dim"):
                placed = cells(turned(np.array(own["embedding"].tolist(), np.float64)), threshold, grid)
                for at, block, cell, home in placed:
                    if not len(at):
                        continue
                    columns = ["rep", "n", "label", "embedding"] if with_vectors else ["label"]
                    names = [",".join(map(str, c)) for c in cell.tolist()]
                    out = own.iloc[at][columns].assign(dim=np.int32(dim), block=np.int32(block), cell=names)
                    yield out.assign(home=home)

    keys = ["label", "dim", "block", "cell"]
    placed = points.mapInPandas(lambda f: to_cells(f, True), f"{VECTOR}, {CELL}, home boolean")
    counted = points.mapInPandas(lambda f: to_cells(f, False), f"label int, {CELL}, home boolean")
    tiles = lambda n: F.ceil(F.count_if(n) / TILE_ROWS).cast("int")
    hot = counted.groupBy(*keys).agg(
        F.count("*").alias("rows"), tiles(F.col("home")).alias("homes"), tiles(~F.col("home")).alias("guests")
    )
    # one row for more than TILE_ROWS rows of cells; as a table its size is known, so Spark broadcasts it only where it is
    # small, and otherwise shuffles and splits the crowded cells
    hot = written(hot.where(F.col("rows") > TILE_ROWS).drop("rows"), "crowded")
    tiled = placed.join(hot, keys, "left").withColumns(
        {"homes": F.coalesce("homes", F.lit(1)), "guests": F.coalesce("guests", F.lit(0))}
    )
    # home tiles are numbered first, then those of guests; in a cell of one unit all rows are in tile 0
    apart = ~F.col("home") & (F.col("guests") > 0)
    dealt = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    tiled = tiled.where("homes > 0").withColumns({
        "tile": F.when(apart, F.col("homes") + dealt("guests")).otherwise(dealt("homes")),
        "other": F.explode(F.sequence(F.lit(0), F.col("homes") - 1 + F.when(apart, 0).otherwise(F.col("guests")))),
    })
    return tiled.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}).drop(
        "other", "homes", "guests"
    )


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors`` (vec_id, embedding,
    label).

    Rows are linked if their labels are equal and the cosine of their vectors, in double precision, is at
    least ``threshold``. Vectors that are null, empty, zero or hold a null or non-finite component, and rows
    without label or id, link with nothing. Vectors of different lengths don't link. Equal vectors are one
    point of the join, counted as often as they are there; repeated rows are such copies. An empty table
    gives an empty one.

    A pair of unit vectors within a squared distance is within its share of it in at least one block of the
    rotated components, so the range joins of the blocks miss no pair.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<float>"), F.col("label").cast("int")
    )
    good = rows.where(USABLE)
    points = written(
        good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
        .select("rep", "n", "label", "embedding"),
        "vectors",
    )
    sizes = points.groupBy("label", F.size("embedding").alias("d")).count()
    most = sizes.agg(F.max("count")).first()[0] or 0
    grid = max(1, min(8, math.ceil(math.log(max(1, most) / CELL_ROWS, 3))))

    found = in_units(points, threshold, grid).groupBy(*UNIT).applyInPandas(
        lambda frame: found_in(frame, threshold), "rep bigint, linked bigint, root bigint"
    )
    found = written(found.groupBy("rep", "root").agg(F.sum("linked").alias("linked")), "vector-links")
    linked = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    labels = connected(found.select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    classes = (
        points.join(linked, "rep", "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("label").alias("l"), F.col("embedding").alias("e"),
            (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    own = good.join(classes, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")))
    own = own.select("vec_id", "n_links", "component_id")
    alone = rows.where(f"NOT {USABLE}").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return own.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
