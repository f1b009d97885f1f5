"""Toxicity by multiple-instance learning: sentences are scored, a noisy-or joins them to a document."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from billtide.llm import labelled
from billtide.llm.rows import add_columns

SENTENCE_END = re.compile(r"[.!?\n]+")
TOKEN = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence that has a letter."""
    found, at = [], 0
    for m in SENTENCE_END.finditer(text):
        found.append((at, m.end()))
        at = m.end()
    found.append((at, len(text)))
    return [(a, b) for a, b in found if TOKEN.search(text, a, b)]


def parts(word: str) -> list[str]:
    """What a word can be known by: its beginnings of 4 to 8 letters and, with an end mark, itself."""
    return [*[word[:n] for n in range(4, min(9, len(word) + 1))], word + "$"]


@dataclass
class Model:
    """Evidence of words by their parts, and the level a sentence's evidence has to rise above.

    A word has the evidence of its strongest part. A sentence's score is how far sigmoid(level + evidence)
    rises above sigmoid(level): a sentence without evidence scores 0, so a text of many clean sentences
    stays clean.
    """

    evidence: dict[str, float]
    level: float

    def __post_init__(self):
        self.heads = {p[:4] for p in self.evidence} | {p for p in self.evidence if len(p) <= 4}

    def word(self, word: str) -> float:
        if word[:4] not in self.heads and word + "$" not in self.heads:
            return 0.0
        return max([0.0, *[self.evidence[p] for p in parts(word) if p in self.evidence]])

    def sentence(self, evidence: float) -> float:
        floor = 1 / (1 + math.exp(-self.level))
        return (1 / (1 + math.exp(-self.level - min(evidence, 60.0))) - floor) / (1 - floor)


def surprise(k1: int, k0: int, n1: int, n0: int) -> float:
    """The G statistic of a part found in k1 of n1 and k0 of n0 texts."""
    total = 0.0
    for k, n in ((k1, n1), (k0, n0)):
        for have, rate in ((k, (k1 + k0) / (n1 + n0)), (n - k, 1 - (k1 + k0) / (n1 + n0))):
            if have and rate:
                total += have * math.log(have / (n * rate))
    return 2 * total


def train(texts: list[str], labels: list[int], level: float = -5.0, least: float = 25.0) -> Model:
    """Learns the evidence of parts of words from documents' labels by the noisy-or's likelihood.

    P(toxic) = 1 - product of (1 - sentence score). Parts enter that are more frequent in toxic texts, if
    chance explains it badly (a G statistic of ``least``). Without both labels there is no evidence at all.
    """
    if len(set(labels)) < 2:
        return Model({}, level)
    bags = [
        [{w.lower() for w in TOKEN.findall(t, a, b)} for a, b in sentences(t)] for t in texts
    ]
    known: dict[str, list[str]] = {}
    seen = (Counter(), Counter())
    for bag, label in zip(bags, labels):
        own = set().union(*bag)
        for w in own:
            if w not in known:
                known[w] = parts(w)
        seen[label].update({p for w in own for p in known[w]})
    n1, n0 = sum(labels), len(labels) - sum(labels)
    odds = {p: math.log((k + 0.5) / n1 / ((seen[0][p] + 1.5) / n0)) for p, k in seen[1].items() if k >= 3}
    sure = {p for p, x in odds.items() if x > 0 and surprise(seen[1][p], seen[0][p], n1, n0) >= least}
    place = {p: i for i, p in enumerate(sorted(sure))}
    if not place:
        return Model({}, level)
    # the last value is the evidence of words without a known part
    rows = {w: own for w, ps in known.items() if (own := [place[p] for p in ps if p in place])}
    number = {w: i for i, w in enumerate(rows)}
    table = np.full((len(rows), 6), len(place))
    for w, own in rows.items():
        table[number[w], : len(own)] = own
    doc, sentence, word = [], [], []
    for d, bag in enumerate(bags):
        for own in bag:
            if found := [number[w] for w in own if w in number]:
                sentence += [len(doc)] * len(found)
                word += found
                doc.append(d)
    doc, sentence, word = (np.array(x, np.int64) for x in (doc, sentence, word))
    y = np.array(labels, float)
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    floor = 1 / (1 + math.exp(-level))

    def gradient(values):
        strength = np.append(values[0], 0.0)[table]
        best = strength.argmax(axis=1)
        evidence = strength[np.arange(len(table)), best]
        p = 1 / (1 + np.exp(-level - np.bincount(sentence, evidence[word], len(doc))))
        s = np.clip((p - floor) / (1 - floor), 0, 1 - 1e-9)
        clean = np.clip(np.exp(np.bincount(doc, np.log1p(-s), len(y))), 1e-9, 1 - 1e-3)
        # of the negative log likelihood by log P(no toxic sentence), then by each sentence's evidence
        by_log = weight * np.where(y == 1, clean / (1 - clean), -1.0)
        by_z = by_log[doc] * (-1 / (1 - s)) * p * (1 - p) / (1 - floor)
        by_word = np.bincount(word, by_z[sentence], len(table)) * (evidence > 0)
        slopes = np.bincount(table[np.arange(len(table)), best], by_word, len(place) + 1)[:-1]
        return [slopes + 1e-5 * values[0]]

    start = np.array([odds[p] for p in place])
    values = labelled.descend([start], gradient, 200, 0.03)
    return Model({p: float(values[0][i]) for p, i in place.items() if values[0][i] > 0.5}, level)


FIELDS = [
    ("score", "double", pa.float64()),
    ("offending", "array<struct<start: bigint, end: bigint, score: double>>", pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )),
]


def judged(text: str, model: Model, least: float) -> tuple:
    """Score of a text, and its sentences that score at least ``least``."""
    known = {w: e for w in set(TOKEN.findall(text.lower())) if (e := model.word(w))}
    clean, offending = 1.0, []
    for a, b in sentences(text) if known else ():
        own = known.keys() & TOKEN.findall(text[a:b].lower())
        if own:
            s = model.sentence(sum(map(known.__getitem__, own)))
            clean *= 1 - s
            if s >= least:
                offending.append({"start": a, "end": b, "score": s})
    return 1 - clean, offending


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", least: float = 0.3) -> DataFrame:
    """``docs`` with each whole text's ``score`` (0 to 1) and its ``offending`` sentences in code points.

    A null or empty text scores 0. Each text is scored alone; repeated rows score alike, an empty table stays
    empty, columns named like a result are replaced.
    """

    def start():
        def work(texts):
            rows = [judged(t or "", model, least) for t in texts]
            return [[r[0] for r in rows], [r[1] for r in rows]]

        return work

    return add_columns(docs, start, FIELDS, text)
