"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages; only the bag has a label. Every passage is encoded (hashed
words, hashed character-class n-grams and a few shape measures, through one tanh layer),
gated attention weighs the passages of a bag, and a logistic unit scores the weighted
mean. Encoder, attention and unit are learned together from the labels of documents.

Encoding and scoring run in tasks over whole texts. The fit uses a bounded sample of
labelled documents, encoded by tasks in the same way.

Defined cases: a text without words, or null, is a bag of one empty passage and gets a
score; rows with a null label are not learned from; without two classes in the labels
every score is the base rate; repeated rows get equal scores; extra columns pass through.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .store import aside
from .words import Words, again, mix, pieces, prefix

PASSAGE = 200
WORD_SLOTS, SHAPE_SLOTS, SHAPES = 512, 256, 6
WIDTH = WORD_SLOTS + SHAPE_SLOTS + SHAPES
HIDDEN, GATE = 32, 16

CLASS = np.full(256, 3, np.uint64)  # letters outside ASCII count as small ones
CLASS[:128] = np.arange(128) + 16
CLASS[0x61:0x7B], CLASS[0x41:0x5B], CLASS[0x30:0x3A] = 3, 4, 5


class Net(NamedTuple):
    w1: np.ndarray
    b1: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    b: np.ndarray


def encode(data: np.ndarray, at: np.ndarray, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Passage features (passages, WIDTH) of each text and the row of each passage."""
    w = Words(data, at, lower=False)
    bags = np.maximum(1, -(-w.count // passage))
    first = np.cumsum(bags) - bags
    row = np.repeat(np.arange(len(bags)), bags)
    n = int(bags.sum())
    own = first[w.row] + (np.arange(len(w.row)) - w.first[w.row]) // passage
    words = np.bincount(own, minlength=n).astype(float)
    slots = np.bincount(own * WORD_SLOTS + (w.hash % np.uint64(WORD_SLOTS)).astype(np.int64), minlength=n * WORD_SLOTS).reshape(n, -1)
    length = (w.end - w.start).astype(float)
    # character classes, counted by the passage of the word that they belong to or follow
    c = CLASS[data]
    two = (c[:-1] * np.uint64(131) + c[1:]) * np.uint64(0x9E3779B97F4A7C15)
    two = ((two[:-1] ^ (two[:-1] >> np.uint64(32))) + c[2:]) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(56)
    if len(w.start) and len(two):
        inside = np.ones(len(two), bool)
        late = np.concatenate([at[1:] - 1, at[1:] - 2])
        inside[late[(late >= 0) & (late < len(two))]] = False  # these would reach into the next text
        inside[: w.start[0]] = False
        spot = np.flatnonzero(inside)
        place = np.repeat(own, np.diff(np.append(w.start, len(data))))[spot - w.start[0]]
        grams = np.bincount(place * SHAPE_SLOTS + two[spot].astype(np.int64), minlength=n * SHAPE_SLOTS).reshape(n, -1)
    else:
        grams = np.zeros((n, SHAPE_SLOTS))
    mean = np.bincount(own, length, minlength=n) / np.maximum(words, 1)
    key = w.hash ^ mix(own.astype(np.uint64))
    distinct = np.bincount(own[np.unique(key, return_index=True)[1]], minlength=n) / np.maximum(words, 1)
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    begin, pair = w.grams(2, prefix(w.hash))
    twice = np.bincount(own[begin[again(pair ^ mix(own[begin].astype(np.uint64)))]], minlength=n) / np.maximum(words, 1)
    shapes = np.stack([np.log1p(words) / 6, mean / 10, distinct, np.bincount(own[same], minlength=n) / np.maximum(words, 1), twice, words == 0], 1)
    scale = lambda x: np.sqrt(x / np.maximum(x.sum(1, keepdims=True), 1))
    return np.concatenate([scale(slots), scale(grams), shapes], 1).astype(np.float32), row


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(net: Net, x: np.ndarray, row: np.ndarray, rows: int):
    """Logit of each bag, and what a backward step needs."""
    h = np.tanh(x @ net.w1 + net.b1)
    t, g = np.tanh(h @ net.v), sigmoid(h @ net.u)
    e = np.exp(np.clip((t * g) @ net.a, -30, 30))
    weight = e / np.bincount(row, e, minlength=rows)[row]
    z = np.zeros((rows, h.shape[1]))
    np.add.at(z, row, weight[:, None] * h)
    return z @ net.c + net.b[0], (h, t, g, weight, z)


def gradients(net: Net, x, row, rows, error) -> Net:
    _, (h, t, g, weight, z) = forward(net, x, row, rows)
    dz = error[:, None] * net.c
    dh = weight[:, None] * dz[row]
    # through the softmax of the attention
    ds = weight * ((h - z[row]) * dz[row]).sum(1)
    da = (t * g).T @ ds
    dt, dg = ds[:, None] * net.a * g * (1 - t * t), ds[:, None] * net.a * t * g * (1 - g)
    dh = dh + dt @ net.v.T + dg @ net.u.T
    dp = dh * (1 - h * h)
    return Net(x.T @ dp, dp.sum(0), h.T @ dt, h.T @ dg, da, z.T @ error, np.array([error.sum()]))


def train(x: np.ndarray, row: np.ndarray, y: np.ndarray, epochs: int, seed: int, rate: float = 0.004, decay: float = 1e-4) -> Net:
    """Adam on the class-balanced logistic loss of bags."""
    rng = np.random.default_rng(seed)
    init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    net = Net(init(x.shape[1], HIDDEN) * 3, np.zeros(HIDDEN), init(HIDDEN, GATE), init(HIDDEN, GATE), init(GATE), init(HIDDEN), np.zeros(1))
    m, s, step = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net], 0
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    start = np.searchsorted(row, np.arange(len(y) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), 64):
            bags = order[k : k + 64]
            take = np.concatenate([np.arange(start[b], start[b + 1]) for b in bags])
            local = np.repeat(np.arange(len(bags)), start[bags + 1] - start[bags])
            score, _ = forward(net, x[take], local, len(bags))
            grad = gradients(net, x[take], local, len(bags), (sigmoid(score) - y[bags]) * balance[bags] / len(bags))
            step += 1
            new = []
            for i, (p, d) in enumerate(zip(net, grad)):
                m[i], s[i] = 0.9 * m[i] + 0.1 * d, 0.999 * s[i] + 0.001 * d * d
                new.append(p - rate * (m[i] / (1 - 0.9**step) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8) + decay * p))
            net = Net(*new)
    return net


def fit(labelled: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", sample: int = 3000, max_chars: int = 50_000, epochs: int = 12, seed: int = 0, border: float = 0.5, labels: DataFrame | None = None) -> Net:
    """Learn from documents with a label 0 or 1, in a column or in a table `labels` by key. With a table,
    keys and lengths meet the labels first, and only the drawn documents' texts move.

    About `sample` documents, shared equally by the two classes and drawn by a hash of `key`,
    of up to `max_chars` characters: this bound holds for the fit alone. Where a label 1 is as
    likely as a label 0, for classes of equal size, the score is `border`.
    """
    short = F.coalesce(F.length(text), F.lit(0)) <= max_chars
    rows = labelled if labels is None else labelled.where(short).select(key).join(labels.select(key, label), key)
    known = rows.where(F.col(label).isin(0, 1))
    known = known.where(short) if labels is None else known
    sizes = {r[label]: r["n"] for r in known.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    shift = np.log(border / (1 - border))
    if len(sizes) < 2:
        rate = float(max(sizes, default=1))
        return Net(np.zeros((WIDTH, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, GATE)), np.zeros((HIDDEN, GATE)), np.zeros(GATE), np.zeros(HIDDEN), np.array([(rate - 0.5) * 20]))
    rate = F.coalesce(*[F.when(F.col(label) == k, F.lit(sample / 2 / c)) for k, c in sizes.items()])
    spot = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / F.lit(1 << 30)
    if labels is None:
        picked = known.where(spot < rate).select(text, label, key).limit(2 * sample)
    else:
        drawn = known.where(spot < rate).select(key, label).distinct().limit(2 * sample)
        picked = labelled.where(short).join(F.broadcast(drawn), key).select(text, label, key)  # at most 2 * sample keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in pieces(batch, text):
                x, row = encode(data, at)
                cut = np.searchsorted(row, np.arange(rows.num_rows + 1))
                each = [x[cut[i] : cut[i + 1]].astype(np.float16).tobytes() for i in range(rows.num_rows)]
                yield pa.RecordBatch.from_arrays([rows.column(2), rows.column(1).cast(pa.int32()), pa.array(each, pa.binary())], ["key", "y", "x"])

    kind = labelled.schema[key].dataType.simpleString()
    got = picked.mapInArrow(run, f"key {kind}, y int, x binary").toArrow().to_pylist()
    got.sort(key=lambda r: (str(r["key"]), r["x"]))
    bags = [np.frombuffer(r["x"], np.float16).reshape(-1, WIDTH) for r in got]
    y = np.array([r["y"] for r in got], float)
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    net = train(np.concatenate(bags).astype(np.float32), row, y, epochs, seed)
    return net._replace(b=net.b + shift)


def score(docs: DataFrame, net: Net, text: str = "text", name: str = "score") -> DataFrame:
    """The rows of `docs` with the probability of label 1."""
    docs = aside(docs, [name])
    shared = docs.sparkSession.sparkContext.broadcast(Net(*[p.astype(np.float32) for p in net]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in pieces(batch, text):
                logit, _ = forward(shared.value, *encode(data, at), rows.num_rows)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sigmoid(logit), pa.float64())], [*rows.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(name, DoubleType())]))
