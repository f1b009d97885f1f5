"""Removal of long repeated strings by distributed prefix doubling.

A string of ``length`` bytes is known by where it starts. Positions are ranked by a prefix of their string;
Spark sorts the (rank, position) pairs; positions whose rank nobody shares are unique and leave; the others
are ranked anew by longer prefixes, until they are unique or the prefix reaches ``length``. Ranks are hashes,
so that a longer prefix's rank needs no join on positions.

Positions are ranked in groups that share the bytes ranked. The string's anchor is its smallest hashed gram,
so equal strings have equal anchors at equal offsets. The first ranks are those of the anchors' grams, for
all strings around an anchor at once (a span); the next ones of the bytes that all strings in a cell of a
span have in common, with cells getting smaller until each is one string. Spans that are equal as a whole are
settled without going further: all but the first are repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide.llm.rows import add_columns, small_batches, without
from billtide.session import written

U = np.uint64
NO_ID = -(2**63)


# ---- hashes of any stretch of a batch of texts ----


class Stretches:
    """Polynomial hashes of 64 bits, of the bytes from start to end, whatever lies around them."""

    def __init__(self, octets: np.ndarray, seed: int):
        values = np.random.default_rng(seed).integers(0, 2**63, 258, dtype=U) * U(2) + U(1)
        base = int(values[256])
        n = len(octets)
        self.back = self.powers(pow(base, -1, 2**64), n)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values[octets] * self.powers(base, n)[:n], out=self.sums[1:])

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        out = np.full(n + 1, base, U)
        out[0] = 1
        return np.cumprod(out, out=out)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, k: int) -> np.ndarray:
        return mixed((self.sums[k:] - self.sums[:-k]) * self.back[: len(self.back) - k])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def tagged(x: np.ndarray, *small: np.ndarray) -> np.ndarray:
    for s in small:
        x = mixed(x + s.astype(U) * U(0x9E3779B97F4A7C15) + U(1))
    return x


# ---- a span in one integer: start, size, distance to the anchor ----


def packed(start, size, offset):
    return (start << 16) | (size << 8) | offset


def unpacked(spans):
    return spans >> 16, (spans >> 8) & 0xFF, spans & 0xFF


def text_tags(texts: list[bytes]) -> np.ndarray:
    """What tells texts of one id apart: a hash of 64 bits."""
    return np.array([xxhash.xxh3_64_intdigest(t) for t in texts], U).view(np.int64)


# ---- ranks ----


def first_ranks(octets: np.ndarray, begins: np.ndarray, sizes: np.ndarray, length: int, gram: int):
    """(text, start, size, offset, rank, content) of every span of a batch of texts.

    For each string the anchor is the leftmost smallest gram; a span is a run of strings with one anchor.
    """
    window = length - gram + 1
    none = np.zeros(0, np.int64)
    if len(octets) < length:
        return none, none, none, none, none.view(U), none.view(U)
    ranks, contents = Stretches(octets, 11), Stretches(octets, 12)
    grams = ranks.grams(gram)
    least, offset, width = grams, np.zeros(len(grams), np.uint8), 1
    while width < window:
        step = min(width, window - width)
        right = least[step:] < least[:-step]
        offset = np.where(right, offset[step:] + np.uint8(step), offset[:-step])
        least = np.where(right, least[step:], least[:-step])
        width += step
    counts = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    within = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = begins[text] + within
    anchor = start + offset[start]
    head = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (within == 0))
    size = np.diff([*head, len(anchor)])
    start, anchor, text = start[head], anchor[head], text[head]
    away = anchor - start
    content = tagged(contents.of(start, start + size - 1 + length), size, away)
    return text, start - begins[text], size, away, grams[anchor], content


def cell_ranks(octets, begins, text, start, size, offset, length: int, cell: int):
    """The same for the cells of known spans: strings whose distances to the anchor fall in one cell.

    The rank is that of the bytes which every string of the whole cell has.
    """
    ranks, contents = Stretches(octets, 11), Stretches(octets, 12)
    span = np.repeat(np.arange(len(size)), size)
    within = np.arange(len(span)) - np.repeat(np.cumsum(size) - size, size)
    away = offset[span] - within
    number = away // cell
    head = np.flatnonzero((within == 0) | (np.diff(number, prepend=-1) != 0))
    size = np.diff([*head, len(span)])
    span, within, away, number = span[head], within[head], away[head], number[head]
    text = text[span]
    at = begins[text] + start[span] + within
    anchor = at + away
    rank = tagged(ranks.of(anchor - number * cell, anchor - number * cell - (cell - 1) + length), number)
    content = tagged(contents.of(at, at + size - 1 + length), size, away)
    return text, start[span] + within, size, away, rank, content


PLACE = ["doc", "tag", "span"]
RANKED = "rank bigint, content bigint, doc bigint, tag bigint, span bigint, repeated boolean"
RANKED_ARROW = pa.schema([*[(n, pa.int64()) for n in ("rank", "content", *PLACE)], ("repeated", pa.bool_())])


def joined(texts: list[bytes]):
    octets = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return octets, np.cumsum(sizes) - sizes, sizes


def ranked_rows(doc, tag, found):
    """The spans of a batch as rows. Of equal spans in the batch only the first keeps its rank; the others are
    repeats already and get ranks of their own, so that no rank brings more than one copy per batch along."""
    text, start, size, offset, rank, content = found
    rows = np.stack([rank.view(np.int64), content.view(np.int64), doc[text], tag[text], packed(start, size, offset)])
    rows = rows[:, np.lexsort(rows[::-1])]
    same = rows[:, 1:] == rows[:, :-1]
    rows = rows[:, np.append(True, ~same.all(axis=0))[: rows.shape[1]]]
    same = rows[:2, 1:] == rows[:2, :-1]
    repeated = np.append(False, same.all(axis=0))[: rows.shape[1]]
    rows[0, repeated] = tagged(rows[4, repeated].view(U), rows[2, repeated], rows[3, repeated]).view(np.int64)
    rows[1, repeated] = 0
    return pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(repeated)], schema=RANKED_ARROW)


def rank_texts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """First ranks of all strings of ``docs`` (doc, text as binary)."""

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            doc = batch.column(0).to_numpy()
            yield ranked_rows(doc, text_tags(texts), first_ranks(*joined(texts), length, gram))

    return docs.mapInArrow(run, RANKED)


def rank_cells(texts: DataFrame, spans: DataFrame, length: int, cell: int) -> DataFrame:
    """Ranks of the cells of ``spans``; a document's spans meet its text by a join."""
    per_text = gathered(spans)

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            own = [unpack.decompress(z) for z in batch.column(0).to_pylist()]
            octets, begins, _ = joined(own)
            lists = batch.column(2)
            flat = lists.flatten().to_numpy().astype(np.int64)
            text = np.repeat(np.arange(len(own)), np.diff(lists.offsets.to_numpy()))
            found = cell_ranks(octets, begins, text, *unpacked(flat), length, cell)
            yield ranked_rows(batch.column(1).to_numpy(), batch.column(3).to_numpy(), found)

    return texts.join(per_text, ["doc", "tag"]).select("packed_text", "doc", "spans", "tag").mapInArrow(run, RANKED)


def gathered(spans: DataFrame) -> DataFrame:
    """All spans of a text in a row; there are at most as many as the text has strings."""
    return spans.groupBy("doc", "tag").agg(F.collect_list("span").alias("spans"))


# ---- verdicts ----


def settled(ranked: DataFrame) -> DataFrame:
    """(doc, span, repeated): spans that repeat an earlier one as a whole, and spans still open.

    Sorted by rank, content and position, each row is judged by its neighbours, so a rank shared by many rows
    passes as a stream. Of equal spans the first stays. It is open if others share its rank with
    different contents, and unique otherwise.
    """
    pairs = ranked.repartition("rank").sortWithinPartitions("rank", "content", *PLACE)

    def run(batches):
        last = np.array([[0], [0], [0], [0], [-1]])  # the previous row; no span is negative
        held = None  # the previous first span (rank, place) and whether it is open already
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(5)])
            known = batch.column(5).to_numpy(zero_copy_only=False)
            out = [(rows[2:, known], True)]
            rows = rows[:, ~known]
            before = np.concatenate([last, rows[:, :-1]], axis=1)
            same = rows == before
            again = same.all(axis=0)  # the same position twice: a repeated row of the table
            first = ~(same[0] & same[1] & (before[4] >= 0))
            out.append((rows[2:, ~first & ~again], True))
            rank, place = rows[0, first], rows[2:, first]
            opened = np.zeros(len(rank), bool)
            opened[1:] |= rank[1:] == rank[:-1]
            opened[:-1] |= rank[1:] == rank[:-1]
            if len(rank):
                if held is not None:
                    joins = held[0] == rank[0]
                    opened[0] |= joins
                    if held[2] or joins:
                        out.append((held[1], False))
                held = (rank[-1], place[:, -1:], bool(opened[-1]))
                out.append((place[:, np.flatnonzero(opened[:-1])], False))
            if rows.shape[1]:
                last = rows[:, -1:]
            yield verdict_rows(out)
        if held is not None and held[2]:
            yield verdict_rows([(held[1], False)])

    return pairs.mapInArrow(run, "doc bigint, tag bigint, span bigint, repeated boolean")


def verdict_rows(parts):
    places = np.concatenate([p for p, _ in parts], axis=1)
    repeated = np.repeat([r for _, r in parts], [p.shape[1] for p, _ in parts])
    return pa.RecordBatch.from_arrays([*map(pa.array, places), pa.array(repeated)], [*PLACE, "repeated"])


# ---- removal ----


def removed_runs(spans: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under repeated strings."""
    start, size, _ = unpacked(spans)
    order = np.argsort(start, kind="stable")
    start, end = start[order], (start + size - 1 + length)[order]
    if not len(start):
        return []
    reach = np.maximum.accumulate(end)
    head = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return list(zip(start[head].tolist(), reach[np.append(head[1:], len(start)) - 1].tolist()))


def cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, end in runs:
        parts.append(text[at:start])
        at = end
    return b"".join([*parts, text[at:]])


REMOVED = "array<struct<start: bigint, end: bigint>>"
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """For each row of ``docs``: the key, ``n_bytes``, ``removed`` (runs of bytes) and ``kept`` (the other bytes).

    A byte is removed if a string of ``length`` bytes covers it that also starts earlier: in a text with a
    smaller key, or in the same text. Strings don't cross texts. A null text counts as empty. A null key
    comes before all others (and -2**63 is taken for one). Repeated rows are one document and get equal results; rows that share a key but
    not the text are told apart by a hash of the text of 64 bits, which orders them (as a signed number). An empty
    table gives an empty one. Equality of strings is equality of two 64-bit hashes.
    """
    gram = max(1, length // 4)
    if not 2 <= length - gram + 1 <= 255:
        raise ValueError("length must be from 2 to 338")
    small_batches(docs.sparkSession)
    plain = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("octets"),
    )
    # the same columns and filter wherever it is joined, so that one shuffle of the texts serves all rounds
    texts = packed_texts(plain).where("doc IS NOT NULL AND tag IS NOT NULL")
    ranked = rank_texts(plain, length, gram)
    window = length - gram + 1
    cells = sorted({-(-window // 4), -(-window // 16), 1}, reverse=True)
    verdicts = written(settled(ranked), "spans")
    repeats = verdicts.where("repeated").select(*PLACE)
    for cell in cells:
        still = verdicts.where("NOT repeated").select(*PLACE)
        verdicts = settled(rank_cells(texts, still, length, cell))
        repeats = repeats.union(verdicts.where("repeated").select(*PLACE))

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            own = [unpack.decompress(z) for z in batch.column(1).to_pylist()]
            spans = [np.array(s or [], np.int64) for s in batch.column(2).to_pylist()]
            runs = [removed_runs(s, length) for s in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column(0).to_numpy(), mask=batch.column(0).to_numpy() == NO_ID),
                    pa.array([len(t) for t in own], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], RUNS),
                    pa.array([cut(t, r) for t, r in zip(own, runs)], pa.binary()),
                ],
                [key, "n_bytes", "removed", "kept"],
            )

    found = texts.join(gathered(repeats), ["doc", "tag"], "left").select("doc", "packed_text", "spans")
    return found.mapInArrow(run, f"`{key}` bigint, n_bytes bigint, removed {REMOVED}, kept binary")


def packed_texts(docs: DataFrame) -> DataFrame:
    """Texts compressed for their way to their spans, with the tag that tells texts of one id apart."""

    def start():
        pack = zstandard.ZstdCompressor(level=3)
        return lambda texts: [pa.array(text_tags(texts)), [pack.compress(t) for t in texts]]

    fields = [("tag", "bigint", pa.int64()), ("packed_text", "binary", pa.binary())]
    return without(add_columns(docs, start, fields, "octets"), "octets")
