"""Document quality by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from billtide.llm import labelled
from billtide.llm.rows import add_columns

PASSAGE_WORDS = 100
HIDDEN, GATE = 16, 8
#: Byte classes whose shares describe a passage; the rest of ASCII marks count as one more class.
CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b"!?", b"|", b"#*$%&", b"<>{}[]=/\\", b"@:;",
    b"-_'\"",
]
LOOKUP = np.zeros(256, np.int64)
for _i, _c in enumerate(CLASSES):
    LOOKUP[list(_c)] = _i + 1
LOOKUP[[c for c in range(33, 127) if not chr(c).isalnum() and LOOKUP[c] == 0]] = len(CLASSES) + 1
LOOKUP[128:] = len(CLASSES) + 2
N_CLASSES = len(CLASSES) + 3
N_FEATURES = N_CLASSES + 8


def measured(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage of each text, and where each text's rows start.

    A passage is a run of words; a text without words is one passage of zeros. What is measured: shares of
    byte classes, of distinct, repeated, one-byte and long words, of words that end a sentence or in another
    mark, the mean length of words, and the length of the text.
    """
    raw = [t.encode() for t in texts]
    whole = b"\n".join(raw) + b"\n"
    octets = np.frombuffer(whole, np.uint8)
    blank = (octets == 32) | ((octets >= 9) & (octets <= 13))
    edges = np.diff(np.concatenate([[1], blank.view(np.int8)]))
    first, last = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1) - 1
    size = last - first + 1
    begins = np.cumsum([0, *[len(r) + 1 for r in raw]])
    words = np.diff(np.searchsorted(first, begins))
    rows = np.maximum(1, -(-words // PASSAGE_WORDS))
    starts = np.cumsum([0, *rows[:-1]])
    out = np.zeros((int(rows.sum()), N_FEATURES))
    if not len(first):
        return out, starts
    doc = np.repeat(np.arange(len(raw)), words)
    within = np.arange(len(first)) - np.repeat(np.cumsum([0, *words[:-1]]), words)
    row = starts[doc] + within // PASSAGE_WORDS
    cut = np.flatnonzero(np.diff(row, prepend=-1))
    used = row[cut]
    n = np.diff([*cut, len(row)]).astype(float)
    long = np.add.reduceat(size, cut).astype(float)
    kinds = np.repeat(row, size) * N_CLASSES + LOOKUP[octets[~blank]]
    out[:, :N_CLASSES] = np.bincount(kinds, minlength=len(out) * N_CLASSES).reshape(-1, N_CLASSES)
    out[used, :N_CLASSES] /= long[:, None]
    lower = whole.lower().split()
    ends = [*cut.tolist(), len(lower)]
    distinct = np.array([len(set(lower[i:j])) for i, j in zip(ends, ends[1:])])
    same = np.fromiter(map(bytes.__eq__, lower, [b"", *lower[:-1]]), bool, len(lower))
    end_kind = LOOKUP[octets[last]]
    counted = (same, size == 1, size > 20, np.isin(end_kind, (3, 5)), end_kind > 2)
    out[used, N_CLASSES] = distinct / n
    for i, flag in enumerate(counted):
        out[used, N_CLASSES + 1 + i] = np.add.reduceat(flag.astype(float), cut) / n
    out[used, N_CLASSES + 6] = long / n / 10
    out[used, N_CLASSES + 7] = np.log1p(words[doc[cut]]) / 10
    return out, starts


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Scaling of the features and the weights: encoder, the two gates, attention, output."""

    middle: np.ndarray
    spread: np.ndarray
    weights: list[np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray, weights=None):
        """Scores of bags; rows ``starts[i]`` up to the next start are the passages of bag i."""
        enc, enc0, v, u, w, out, out0 = self.weights if weights is None else weights
        bag = np.repeat(np.arange(len(starts)), np.diff([*starts, len(x)]))
        h = np.tanh(x @ enc + enc0)
        t, g = np.tanh(h @ v), sigmoid(h @ u)
        e = (t * g) @ w
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return sigmoid(z @ out + out0[0]), (bag, h, t, g, a, z)

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.middle) / self.spread, -8, 8)

    def score(self, texts: list[str]) -> np.ndarray:
        rows, starts = measured(texts)
        return self.forward(self.scaled(rows), starts)[0]


def train(texts: list[str], labels: list[int], steps: int = 400, seed: int = 7) -> Model:
    """Learns all weights together from document labels by the log loss, both labels weighing the same.

    Without both labels the model returns 0.5 everywhere.
    """
    rng = np.random.default_rng(seed)
    sizes = [(N_FEATURES, HIDDEN), (HIDDEN,), (HIDDEN, GATE), (HIDDEN, GATE), (GATE,), (HIDDEN,), (1,)]
    start = [rng.normal(0, 0.3, s) if len(s) > 1 or s == (GATE,) else np.zeros(s) for s in sizes]
    if len(set(labels)) < 2:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), start)
    rows, starts = measured(texts)
    model = Model(rows.mean(axis=0), rows.std(axis=0) + 0.01, start)
    x, y = model.scaled(rows), np.array(labels, float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())

    def gradient(values):
        enc, enc0, v, u, w, out, out0 = values
        p, (bag, h, t, g, a, z) = model.forward(x, starts, values)
        d = weight * (p - y)
        dz = d[:, None] * out
        da = (h * dz[bag]).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, starts)[bag])
        gated = de[:, None] * w
        dt, dg = gated * g * (1 - t * t), gated * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ v.T + dg @ u.T) * (1 - h * h)
        slopes = [x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ dg, (t * g).T @ de, z.T @ d, np.array([d.sum()])]
        return [s + 1e-5 * value for s, value in zip(slopes, values)]

    model.weights = labelled.descend(start, gradient, steps, 0.02)
    return model


def score_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, from 0 to 1: how likely a whole text is of quality 1.

    All passages of a text go into its score. A null or empty text is one passage of zeros and is scored, too.
    Each text is scored alone; repeated rows score alike, an empty table stays empty, a column named ``score``
    is replaced.
    """

    def start():
        def work(texts):
            return [model.score([t or "" for t in texts]).tolist() if texts else []]

        return work

    return add_columns(docs, start, [("score", "double", pa.float64())], text)
