"""SimHash near-duplicates found with vantage-point trees over the fingerprints."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide.llm.components import connected
from billtide.llm.rows import add_columns, without
from billtide.session import written

#: Fingerprints that a shard should hold; the number of shards follows from the count of all.
SHARD_ROWS = 20_000
#: Fingerprints, at most, from which the tree of shards is laid out (balance only, not the result).
SAMPLE_ROWS = 32_768
#: Fingerprints that a leaf inside a shard compares directly.
LEAF_ROWS = 256


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits of a text; zero without words."""
    words = (text or "").encode().lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, 42) for p in parts), np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        octets = hashes[i : i + 4096].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with the column ``fp``: the text's SimHash as a signed 64-bit integer.

    A null or empty text has fingerprint zero; texts with fewer words than a shingle have that of
    their whole sequence of words. A column named ``fp`` is replaced.
    """

    def start():
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]

    return add_columns(docs, start, [("fp", "bigint", pa.int64())], text)


# ---- the tree ----


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int64)


def layout(sample: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Vantage point and radius of each inner node, in heap order (children of i: 2i+1, 2i+2).

    Each node takes as vantage point, of a few of its own fingerprints, the one whose distances
    spread most, and the middle distance as radius; the inner child holds distances up to it.
    """
    nodes = []
    groups = [sample]
    for _ in range(depth):
        below = []
        for own in groups:
            if len(own) == 0:
                own = np.zeros(1, np.uint64)
            tries = own[:: max(1, len(own) // 8)][:8]
            vantage = max(tries, key=lambda v: distance(own, v).std())
            far = distance(own, vantage)
            radius = int(np.median(far))
            if (far <= radius).all() and radius:
                radius -= 1
            nodes.append((int(vantage), radius))
            below += [own[far <= radius], own[far > radius]]
        groups = below
    return nodes


def places(points: np.ndarray, nodes: list, depth: int, reach: int):
    """(row, shard, home) of every shard that a fingerprint must meet.

    Its home is where the tree puts it. A pair is looked for where its members part: the member in
    the outer child comes as a guest to the inner one if its distance exceeds the radius by no more
    than ``reach``, for otherwise the triangle inequality rules the pair out. Below that, a guest
    goes wherever a member within ``reach`` can be.
    """
    row = np.arange(len(points))
    node = np.zeros(len(points), np.int64)
    home = np.ones(len(points), bool)
    vantage = np.array([v for v, _ in nodes], np.uint64)
    radius = np.array([r for _, r in nodes], np.int64)
    for _ in range(depth):
        far = np.bitwise_count(points[row] ^ vantage[node]).astype(np.int64)
        edge = radius[node]
        inner = np.where(home, far <= edge + reach, far - reach <= edge)
        outer = np.where(home, far > edge, far + reach > edge)
        stays = home & (far <= edge)
        row, node, home = (
            np.concatenate([row[inner], row[outer]]),
            np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2]),
            np.concatenate([stays[inner], home[outer]]),
        )
    return row, node - (2**depth - 1), home


def linked(points: np.ndarray, home: np.ndarray, reach: int):
    """Index pairs within ``reach``: members with members, guests with members.

    Goes down a tree as ``places`` does, to leaves that are compared directly. What no radius can
    part is compared in blocks.
    """
    todo = [(np.flatnonzero(home), np.flatnonzero(~home), 0)]
    while todo:
        own, guests, stuck = todo.pop()
        if not len(own):
            continue
        if len(own) > LEAF_ROWS and stuck < 3:
            tries = points[own[:: max(1, len(own) // 8)][:8]]
            vantage = tries[stuck] if stuck else max(tries, key=lambda v: distance(points[own], v).std())
            far, guest_far = distance(points[own], vantage), distance(points[guests], vantage)
            radius = int(np.median(far))
            if (far <= radius).all():
                radius -= 1
            inner = far <= radius
            near = own[~inner & (far <= radius + reach)]
            if inner.sum() + len(near) < 0.95 * len(own):
                todo.append((own[inner], np.concatenate([near, guests[guest_far - reach <= radius]]), 0))
                todo.append((own[~inner], guests[guest_far + reach > radius], 0))
            else:
                todo.append((own, guests, stuck + 1))
            continue
        other = np.concatenate([own, guests])
        step = max(1, 4_000_000 // len(other))
        for i in range(0, len(own), step):
            block = points[own[i : i + step]]
            a, b = np.nonzero(np.bitwise_count(block[:, None] ^ points[other][None, :]) <= reach)
            a += i
            different = own[a] != other[b]
            yield own[a[different]], other[b[different]]


def forest(points: np.ndarray, home: np.ndarray, reach: int) -> np.ndarray:
    """For each fingerprint the index of the smallest one it hangs together with in this shard."""
    root = np.arange(len(points))
    for a, b in linked(points, home, reach):
        while True:  # each root takes the smallest root it meets, until all agree
            ra, rb = root[a], root[b]
            if (ra == rb).all():
                break
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
    return root


def links(fps: DataFrame, reach: int = 2) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints that connect all pairs within ``reach`` bits.

    ``fps`` has one distinct non-null ``fp`` per row. Shards send a forest of their pairs, not the pairs.
    """
    spark = fps.sparkSession
    n = fps.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / SHARD_ROWS)))
    mixed = F.xxhash64("fp")
    bound = min(SAMPLE_ROWS, 64 * 2**depth)
    rows = fps.orderBy(mixed).limit(bound).collect() if depth else []
    nodes = layout(np.array([r.fp for r in rows], np.int64).view(np.uint64), depth)
    sent = spark.sparkContext.broadcast(nodes)

    def to_shards(frames):
        for frame in frames:
            points = frame["fp"].to_numpy(np.int64)
            row, shard, home = places(points.view(np.uint64), sent.value, depth, reach)
            yield pd.DataFrame({"shard": shard, "fp": points[row], "home": home})

    def in_shard(frame):
        points = frame["fp"].to_numpy(np.int64)
        order = np.argsort(points, kind="stable")
        points, home = points[order], frame["home"].to_numpy(bool)[order]
        root = forest(points.view(np.uint64), home, reach)
        hangs = root != np.arange(len(root))
        return pd.DataFrame({"src": points[hangs], "dst": points[root[hangs]]})

    placed = fps.mapInPandas(to_shards, "shard bigint, fp bigint, home boolean")
    return placed.groupBy("shard").applyInPandas(in_shard, "src bigint, dst bigint")


def near_groups(fingerprinted: DataFrame, key: str = "doc_id", reach: int = 2) -> DataFrame:
    """The rows with ``group_fp``, the smallest fingerprint that links of at most ``reach`` bits lead to,
    and ``component_id``, the smallest key of that group.

    Rows with equal fingerprints are linked, whatever their texts; they are one point of the tree, so a
    group of copies costs one row. A null key belongs to its group but never names it; a group of null keys
    only has a null ``component_id``. An empty table gives an empty one. ``fingerprinted`` is read twice,
    so it should be stored. Columns named like a result are replaced.
    """
    rows = without(fingerprinted, "group_fp", "component_id")
    points = written(rows.groupBy("fp").agg(F.min(key).alias("first_key")), "fingerprints")
    labels = connected(links(points.select("fp"), reach))
    joined = points.join(labels, points.fp == labels.node, "left").select(
        "fp", "first_key", F.coalesce("component", "fp").alias("group_fp")
    )
    named = joined.groupBy("group_fp").agg(F.min("first_key").alias("component_id"))
    return rows.join(joined.select("fp", "group_fp").join(named, "group_fp"), "fp")
