"""Collocations by Toivonen's mining: a sample proposes phrases, passes over everything count them and their border.

A sample, mined at a lowered threshold, proposes phrases. One pass over all documents then counts exactly the proposed
phrases and the negative border: phrases that were not proposed though both phrases one word shorter were (and all
single words). A phrase of the border that turns out frequent is a failure: the phrases around it were never counted. Every
frequent phrase that was not counted holds a failure, so a further pass counts all phrases that hold one and whose
other parts are known to be frequent or hold one, too. What it finds anew holds a failure and so does what is around that, which
it has counted as well: the border is closed. No frequent phrase can be missed, whatever the sample was.

A pass looks proposals up in a bit table of fixed size (a Bloom filter), built by an aggregate; that is all that is
broadcast. A false hit makes a pass count a phrase too many, exactly like the others, and changes no result. Phrases are
counted within Arrow batches first, then by Spark's partial aggregates, so a phrase in every document sends one row per
task.

Null texts are empty and null languages are ``und``. Empty texts have no words; a text of any length is one value and
its phrases are counted whole; repeated rows count as often as they come. Other columns are ignored. An empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billtide.session import written

MOST_WORDS = 5
LEAST_COUNT = 100
#: One in so many documents is in the sample, chosen by hash.
SAMPLE = 10
#: The share of the threshold that a phrase needs in the sample, of what its size would lead to expect.
LOWERED = 0.5
#: Bits of the table of proposed phrases, as a power of two (8 MB), and bits set by a phrase.
TABLE_BITS = 26
PROBES = 3

# classes of bytes: 0 in words, 1 between words, 2 at the end of a piece
BYTES = np.zeros(256, np.uint8)
BYTES[[0x20, 0x09]] = 1
BYTES[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
UNEVEN = re.compile(rb"[ \t]{2,}|\t")
MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all words but the last, and the last."""
    return scrambled(prefix * MIX[0] + word)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    start = lang.encode() + b"\0"
    return np.array([xxhash.xxh3_64_intdigest(start + w) for w in words], np.uint64)


def probes(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The places in the bit table that stand for a phrase."""
    step = scrambled(hashes + MIX[0]) | np.uint64(1)
    for _ in range(PROBES):
        yield hashes & np.uint64(2**TABLE_BITS - 1)
        hashes = hashes + step


def held(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which phrases the table holds; now and then it claims one too many."""
    found = np.ones(len(hashes), bool)
    for at in probes(hashes):
        found &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings from ``starts`` to ``ends`` of ``data``, which may overlap."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bytes_ = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(bytes_)]
    return pa.StringArray.from_buffers(len(sizes), buffers[1], buffers[2])


def batch_counts(
    lang: str, texts: list[str], known: np.ndarray | None, fresh: np.ndarray | None
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Phrases of one language's texts and their counts; first the number of all words, as the empty phrase.

    Without ``known`` all phrases count, otherwise those whose parts without the last and without the first word are
    ``known``. With ``fresh``, longer phrases that hold a fresh one count, and parts need not be known that hold one.
    """
    data = UNEVEN.sub(b" ", "\n".join(texts).encode("utf-8", "replace").translate(LOWER))
    data = np.frombuffer(b"\n" + data + b"\n", np.uint8)
    kinds = BYTES[data]
    edges = np.flatnonzero(np.diff(kinds == 0)) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return
    piece = np.cumsum(kinds == 2)[starts]
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]
    )
    words = runs.take(pa.array(np.arange(0, len(edges), 2))).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int64)
    if fresh is None:
        yield pa.array([""]), np.array([len(starts)])
        first = first_places(codes, np.arange(len(codes)), len(words.dictionary))
        yield cut(data, starts[first], ends[first]), np.bincount(codes)
    hashes = of_words = word_hashes(lang, words.dictionary.to_pylist()) if known is not None else None
    places, ids = np.arange(len(codes)), codes
    around = None  # of each phrase: does it hold a fresh one besides being fresh itself
    for n in range(2, MOST_WORDS + 1):
        # ``places`` hold a phrase of n - 1 words each, ``ids`` say which
        goes_on = np.ones(len(places), bool)
        if known is not None:
            known_part = held(known, hashes)
            if fresh is not None:
                around = np.zeros(len(hashes), bool) if around is None else around
                known_part |= around
                marked = (around | held(fresh, hashes))[ids]
            goes_on = known_part[ids]
        both = np.flatnonzero(goes_on[:-1] & goes_on[1:] & (places[1:] == places[:-1] + 1))
        both = both[(n > 2) | (piece[places[both]] == piece[places[both] + 1])]
        if not len(both):
            return
        after = codes[places[both] + n - 1]
        new_ids, pairs = pd.factorize(ids[both] * np.int64(len(words.dictionary)) + after)
        counts = np.bincount(new_ids, minlength=len(pairs))
        if known is not None:
            hashes = extended(hashes[pairs // len(words.dictionary)], of_words[pairs % len(words.dictionary)])
        places, ids = places[both], new_ids
        first = first_places(ids, places, len(pairs))
        if fresh is None:
            yield cut(data, starts[first], ends[first + n - 1]), counts
        else:
            around = np.zeros(len(pairs), bool)
            around[ids[marked[both] | marked[both + 1]]] = True
            wanted = np.flatnonzero(around)
            yield cut(data, starts[first[wanted]], ends[first[wanted] + n - 1]), counts[wanted]


def first_places(ids: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """For each id a place where it stands."""
    found = np.empty(n, np.int64)
    found[ids] = places
    return found


COUNTS = "lang string, phrase string, count bigint"
#: Texts are counted so many characters at a time before their phrases go to Spark's aggregate.
COUNTED_AT_ONCE = 4 * 2**20
#: Words of a phrase; the empty one stands for all words of its language.
WORDS = "IF(phrase = '', 0, length(phrase) - length(replace(phrase, ' ', '')) + 1)"


def counted(docs: DataFrame, known=None, fresh=None) -> DataFrame:
    """``lang, phrase, words, count`` over all of ``docs`` (lang, text); ``known`` and ``fresh`` are broadcast tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b if b is None else np.frombuffer(b.value, np.uint64) for b in (known, fresh)]
        for by_lang in gathered(batches):
            for lang, texts in by_lang.items():
                for phrases, counts in batch_counts(lang, texts, *tables):
                    columns = [pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(counts.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "count"])

    found = docs.select("lang", "text").mapInArrow(run, COUNTS)
    return found.groupBy("lang", "phrase").agg(F.sum("count").alias("count")).withColumn("words", F.expr(WORDS))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[str]]]:
    """Texts by language, of several batches until they have ``COUNTED_AT_ONCE`` characters."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
        if size >= COUNTED_AT_ONCE:
            yield held
            held, size = {}, 0
    yield held


def bit_table(phrases: DataFrame):
    """A broadcast bit table of ``phrases`` (lang, phrase), of ``2**TABLE_BITS`` bits whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for lang, texts in frame.groupby("lang", sort=False)["phrase"]:
                split = [t.encode().split(b" ") for t in texts]
                vocabulary = list({w for s in split for w in s})
                hashed = dict(zip(vocabulary, word_hashes(lang, vocabulary), strict=True))
                for n in {len(s) for s in split}:
                    same = [s for s in split if len(s) == n]
                    hashes = np.array([hashed[s[0]] for s in same], np.uint64)
                    for i in range(1, n):
                        hashes = extended(hashes, np.array([hashed[s[i]] for s in same], np.uint64))
                    at = np.concatenate(list(probes(hashes)))
                    frame = pd.DataFrame({"slot": (at >> np.uint64(6)).astype(np.int64), "bits": np.uint64(1) << (at & np.uint64(63))})
                    made = frame.groupby("slot")["bits"].agg(np.bitwise_or.reduce)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(made.index.to_numpy()), pa.array(made.to_numpy().astype(np.uint64).view(np.int64))],
                        ["slot", "bits"],
                    )

    slots = phrases.select("lang", "phrase").mapInArrow(run, "slot bigint, bits bigint")
    found = slots.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most 2**20 rows
    table = np.zeros(2 ** (TABLE_BITS - 6), np.int64)
    table[found["slot"].to_numpy()] = found["bits"].to_numpy()
    return phrases.sparkSession.sparkContext.broadcast(table.tobytes())


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, sample: int = SAMPLE) -> DataFrame:
    """``lang, phrase, words, count`` of all phrases of up to ``MOST_WORDS`` words found ``least`` times or more.

    ``words`` is 0 in one row per language, which counts all its words.
    """
    texts = docs.select(
        F.coalesce(docs["lang"], F.lit("und")).alias("lang"),
        docs["text"],
        (F.pmod(F.xxhash64(docs["doc_id"], docs["text"]), F.lit(sample)) == 0).alias("sampled"),
    ).where("text IS NOT NULL")
    enough = max(2, int(LOWERED * least / sample))
    proposed = written(counted(texts.where("sampled")).where((F.col("count") >= enough) & (F.col("words") > 0)), "proposed")
    table = bit_table(proposed)
    first = counted(texts, table).where((F.col("count") >= least) | (F.col("words") == 0))
    frequent = written(first, "frequent")
    keys = ["lang", "phrase"]
    failed = written(frequent.where("words > 0").join(proposed, keys, "left_anti"), "failed")
    if not failed.where(F.col("words") < MOST_WORDS).isEmpty():
        known, fresh = bit_table(frequent.where("words > 0")), bit_table(failed)
        more = counted(texts, known, fresh).where(F.col("count") >= least)
        frequent = frequent.unionByName(written(more.join(frequent, keys, "left_anti"), "around"))
        known.unpersist()
        fresh.unpersist()
    table.unpersist()
    return frequent


def collocations(docs: DataFrame, top: int = 2000, least: int = LEAST_COUNT, sample: int = SAMPLE) -> DataFrame:
    """Each language's ``top`` phrases of two words or more by how much oftener they stand together than by chance.

    A phrase's score is that of its weakest cut into two parts. Phrases that never stand outside one longer phrase
    are left out for it; as counts can't grow with the words, phrases longer by one word decide that.
    """
    frequent = frequent_phrases(docs, least, sample)
    totals = frequent.where("words = 0").select("lang", F.col("count").alias("n"))
    parts = frequent.where("words > 0").select("lang", F.col("phrase").alias("part"), F.col("count").alias("part_count"))
    cuts = (
        frequent.where("words > 1")
        .withColumnRenamed("count", "a")
        .withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
        .withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
        .join(parts.toDF("lang", "first", "l"), ["lang", "first"])
        .join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
        .join(totals, "lang")
    )
    cuts = written(cuts, "cuts")
    # products of counts pass 64 bits
    score = F.expr("(1000 * CAST(a AS DECIMAL(38, 0)) * n) DIV (CAST(l AS DECIMAL(38, 0)) * r)")
    weakest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inside = cuts.where("k = words - 1 AND l = a").select("lang", F.col("first").alias("phrase"))
    inside = inside.union(cuts.where("k = 1 AND r = a").select("lang", "rest"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        weakest.join(inside, ["lang", "phrase"], "left_anti")
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
