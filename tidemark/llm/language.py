"""Language identification: sparse multinomial logistic regression on TF-IDF n-grams.

Characters of a text (lower case) give hashed 1-, 2- and 3-grams; a term weighs
log(1 + count) x idf, and the vector has length 1. Document frequencies come from all
training rows in a distributed count. The weights are fitted on a bounded sample, with
follow-the-regularised-leader steps and elastic-net penalties, which leave most of them
at zero; a part of the sample that the fit does not see sets the temperature.

Defined cases: null texts and texts without a letter are `und` with score 0; rows with a
null label are not learned from; without any labelled row everything is `und`; texts of
any length are used whole; extra columns pass through.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .store import aside
from .words import PIECE, pieces

RESULTS = ("lang_pred", "score")
BITS = 15
UNKNOWN = "und"


class Model(NamedTuple):
    labels: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float


def term_counts(texts: Sequence[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms, counts) of each text."""
    low = [t.lower() for t in texts]
    ends = np.cumsum([0, *map(len, low)])
    c = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    shift = np.uint64(64 - bits)
    a, b, d = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    one = (c + np.uint64(1)) * a
    two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * b + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * d + one[2:]
    grams = [((g ^ (g >> np.uint64(32))) * b >> shift).astype(np.int64) for g in (one, two, three)]
    for i in range(len(low)):
        s, e = ends[i], ends[i + 1]
        count = np.bincount(np.concatenate([g[s : max(s, e - k)] for k, g in enumerate(grams)]), minlength=1 << bits)
        terms = np.flatnonzero(count)
        yield terms, count[terms]


def vector(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf[terms]
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def document_frequencies(docs: DataFrame, text: str, bits: int) -> tuple[np.ndarray, int]:
    """In how many texts each term occurs: summed per task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros((1 << bits) + 1, np.int64), 0
        for batch in batches:
            for rows, _, _ in pieces(batch, text):
                for terms, _ in term_counts([t or "" for t in rows.column(0).to_pylist()], bits):
                    df[terms] += 1
                    n += 1
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["term", "df"])

    total = docs.select(text).mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros((1 << bits) + 1, np.int64)
    for r in total.toLocalIterator():
        out[r["term"]] = r["df"]
    return out[:-1], int(out[-1])


def sparse_rows(docs: DataFrame, text: str, label: str, bits: int) -> DataFrame:
    """Terms (int32) and log(1 + count) (float32) of each text, packed in the tasks: the
    driver gets a few kilobytes of numbers per sampled row, never its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _ in pieces(batch, text):
                terms, logs = [], []
                for t, c in term_counts([x or "" for x in rows.column(0).to_pylist()], bits):
                    terms.append(t.astype(np.int32).tobytes())
                    logs.append(np.log1p(c).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(1).cast(pa.string()), pa.array(terms, pa.binary()), pa.array(logs, pa.binary())], ["label", "terms", "logs"]
                )

    return docs.select(text, label).mapInArrow(run, "label string, terms binary, logs binary")


def unit_row(terms: bytes, logs: bytes, idf: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights) of length 1 with the bias term at the end."""
    at = np.frombuffer(terms, np.int32)
    v = np.frombuffer(logs, np.float32) * idf[at]
    v = v / max(float(np.sqrt(v @ v)), 1e-12)
    return np.append(at, np.int32(1 << bits)), np.append(v, 1.0).astype(np.float32)


def ftrl(rows: list, y: np.ndarray, classes: int, bits: int, alpha: float, beta: float, l1: float, l2: float, epochs: int, seed: int) -> np.ndarray:
    """Weights (terms + 1 bias, classes) after FTRL-proximal steps over the rows."""
    z, n = np.zeros(((1 << bits) + 1, classes)), np.zeros(((1 << bits) + 1, classes))

    def current(at):
        zz = z[at]
        return -np.sign(zz) * np.maximum(np.abs(zz) - l1, 0) / ((beta + np.sqrt(n[at])) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            w = current(at)
            s = v @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = v[:, None] * p
            g2 = n[at] + g * g
            z[at] += g - (np.sqrt(g2) - np.sqrt(n[at])) / alpha * w
            n[at] = g2
    return current(np.arange((1 << bits) + 1))


def nll(scores: np.ndarray, y: np.ndarray, t: float) -> float:
    s = scores / t
    s = s - s.max(1, keepdims=True)
    return float(np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]))


def fit(
    train: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", bits: int = BITS, sample: int = 3000, max_chars: int = 50_000,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.001, epochs: int = 4, seed: int = 0,
) -> Model:
    """Fit on rows of `train`; rows with a null label or text are not used.

    Document frequencies cover all of them. The weights are fitted on about `sample` rows,
    shared equally among the labels and drawn by a hash of `key` and text, from texts of up
    to `max_chars` characters; this bound holds for the fit alone.
    """
    known = train.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    df, n = document_frequencies(known, text, bits)
    idf = np.log((1 + n) / (1 + df)) + 1
    short = known.where(F.length(text) <= max_chars)
    sizes = {r[label]: r["n"] for r in short.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = tuple(sorted(sizes))
    if not labels:
        return Model((), idf, np.zeros(((1 << bits) + 1, 0)), 1.0)
    each = sample / len(labels)
    rate = F.coalesce(*[F.when(F.col(label) == k, F.lit(each / c)) for k, c in sizes.items()])
    spot = F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text)), F.lit(1 << 30)) / F.lit(1 << 30)
    picked = sparse_rows(short.where(spot < rate).select(text, label).limit(2 * sample), text, label, bits).toArrow().to_pylist()
    picked.sort(key=lambda r: (r["terms"], r["logs"], r["label"]))  # whatever order the tasks ended in
    y = np.array([labels.index(r["label"]) for r in picked])
    rows = [unit_row(r["terms"], r["logs"], idf, bits) for r in picked]
    del picked
    order = np.random.default_rng(seed).permutation(len(rows))
    fold, held = order[len(order) // 5 :], order[: len(order) // 5]
    w = ftrl([rows[i] for i in fold], y[fold], len(labels), bits, alpha, beta, l1, l2, epochs, seed)
    temperature = 1.0
    if len(held):
        scores = np.stack([rows[i][1] @ w[rows[i][0]] for i in held])
        temperature = min(np.geomspace(0.05, 10, 80), key=lambda t: nll(scores, y[held], t))
    return Model(labels, idf, w, float(temperature))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs` with `lang_pred` and `score`, the calibrated probability of it."""
    docs = aside(docs, RESULTS)
    if not model.labels:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    bits, shared = (len(model.weights) - 1).bit_length() - 1, docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for rows, _, _ in pieces(batch, text, PIECE):
                scores = [
                    vector(t, c, m.idf) @ m.weights[t] + m.weights[-1] if len(t) else m.weights[-1]
                    for t, c in term_counts([x or "" for x in rows.column(at).to_pylist()], bits)
                ]
                s = np.array(scores) / m.temperature
                p = np.exp(s - s.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                got = [pa.array([m.labels[i] for i in p.argmax(1)], pa.string()), pa.array(p.max(1), pa.float64())]
                yield pa.RecordBatch.from_arrays([*rows.columns, *got], [*rows.schema.names, "lang_pred", "score"])

    out = docs.mapInArrow(run, StructType([*docs.schema, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
    lettered = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    return out.withColumns({"lang_pred": F.when(lettered, F.col("lang_pred")).otherwise(UNKNOWN), "score": F.when(lettered, F.col("score")).otherwise(0.0)})


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n: the folds of the contract."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(n))
