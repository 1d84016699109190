"""Hard-negative mining over exact integer scores, multiplied in residue numbers.

Vectors are quantised to integers. Every row is scored against every anchor by matrix
products of residues modulo several small primes: residues are centred, so that a float32
product over a chunk of columns stays under 2^24 and is exact, and the signed score comes back by
Chinese remaindering (mixed radix, modulo 2^64). How many primes are needed follows from
the largest components and the length of the vectors.

Anchors are a stated part of the rows. They pass in blocks of bounded size, one broadcast a
block, over all rows; a task keeps the best few rows of each anchor and nothing else. The
first pass scores rows of an anchor's own label and finds its positives; the second scores
the others and keeps, for each positive, the best rows inside the window that its score sets.

Defined cases: rows with a null label, a null vector or a component that is null or not
finite take no part, an empty vector scores 0; shorter vectors are filled up with zeros; a
row is never a partner of an anchor with its id; repeated rows count one by one, anchors
with one id are one anchor (the first in order of label and vector); scores that may pass
56 bits are an error; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import Scratch, free_name

EXACT = 1 << 24
COLUMNS = 256
ANCHOR_BYTES = 8 << 20
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 512, 4096


def primes_for(columns: int, bound: int) -> list[int]:
    """The largest primes whose centred residues multiply exactly over that many columns,
    until their product holds every score from -bound to bound."""
    top = 2 * math.isqrt(EXACT // max(1, min(columns, COLUMNS))) + 1
    found, product, p = [], 1, top
    while product <= 2 * bound:
        if p < 3:
            raise ValueError("scores beyond the product of all usable primes")
        if p % 2 and all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            found.append(p)
            product *= p
        p -= 1
    return found or [top]


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    out = []
    for p in primes:
        r = x % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact a @ b.T from the residues of both, as signed 64-bit numbers."""
    digits: list[np.ndarray] = []
    value, weight, half = None, 1, np.zeros(0)
    for x, y, p in zip(a, b, primes):
        r = np.zeros((len(x), len(y)), np.int32)
        for lo in range(0, x.shape[1], COLUMNS):
            r += (x[:, lo : lo + COLUMNS] @ y[:, lo : lo + COLUMNS].T).astype(np.int32) % np.int32(p)
        r %= np.int32(p)
        # mixed radix: what is left of r once the digits before are taken off
        radix = 1
        for d, q in zip(digits, primes):
            r = (r - d * np.int32(radix % p)) % np.int32(p)
            radix *= q
        r = r * np.int32(pow(radix, -1, p)) % np.int32(p)
        digits.append(r)
        part = r.astype(np.uint64) * np.uint64(weight & (2**64 - 1))
        value = part if value is None else value + part
        weight *= p
    # the upper half of all numbers stands for the negative ones: compare digit by digit
    middle, upper, tied = [], np.zeros(value.shape, bool), np.ones(value.shape, bool)
    rest = weight // 2
    for q in primes:
        middle.append(rest % q)
        rest //= q
    for d, m in zip(reversed(digits), reversed(middle)):
        upper |= tied & (d > m)
        tied &= d == m
    return np.where(upper, value - np.uint64(weight & (2**64 - 1)), value).view(np.int64)


def prepared(rows: DataFrame, key: str, vector: str, label: Column, scale: int, asked: str) -> DataFrame:
    """(id, label, v, asked): the rows that take part, components quantised to whole numbers."""
    v = F.col(f"`{vector}`")
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    sound = label.isNotNull() & v.isNotNull() & F.col(f"`{key}`").isNotNull() & F.coalesce(F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))), F.lit(False))
    return rows.where(sound).select(F.col(f"`{key}`").cast("long").alias("id"), label.alias("label"), whole.alias("v"), F.col(f"`{asked}`").alias("asked"))


def matrix(column: pa.Array, columns: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.asarray(column.offsets)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(at)
    if columns and (size == columns).all():
        return flat.reshape(-1, columns)
    out = np.zeros((len(size), columns), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(at[:-1] - at[0], size)] = flat
    return out


def first_by(group: np.ndarray, score: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Places of the n first entries of each group, by falling score and rising key."""
    order = np.lexsort((key, -score, group))
    g = group[order]
    start = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[rank < n]


class Best:
    """The best rows of many groups so far, and the score that a new one must reach."""

    def __init__(self, groups: int, n: int):
        self.n = n
        self.floor = np.full(groups, np.iinfo(np.int64).min)
        self.group, self.key, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, key: np.ndarray, score: np.ndarray) -> None:
        group, key, score = np.append(self.group, group), np.append(self.key, key), np.append(self.score, score)
        at = first_by(group, score, key, self.n)
        self.group, self.key, self.score = group[at], key[at], score[at]
        full = np.flatnonzero(np.append(self.group[1:] != self.group[:-1], True)) if len(at) else at
        size = np.diff(np.append(-1, full))
        self.floor[self.group[full[size == self.n]]] = self.score[full[size == self.n]]


def rows_of(batches: Iterator[pa.RecordBatch], columns: int, primes: list[int]):
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(lo, ROWS_AT_ONCE)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(zero_copy_only=False), residues(matrix(part.column(2), columns), primes)


def positives(rows: DataFrame, anchors, columns: int, primes: list[int], n: int) -> DataFrame:
    """Of each task the first n rows of an anchor's own label. `anchors`: broadcast of (ids, labels, vectors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = anchors.value
        own = residues(vectors, primes)
        best = Best(len(ids), n)
        for key, label, r in rows_of(batches, columns, primes):
            for name in np.intersect1d(labels, label):
                mine, theirs = np.flatnonzero(labels == name), np.flatnonzero(label == name)
                b = [x[theirs] for x in r]
                for lo in range(0, len(mine), ANCHORS_AT_ONCE):
                    a = mine[lo : lo + ANCHORS_AT_ONCE]
                    s = products([x[a] for x in own], b, primes)
                    i, j = np.nonzero((s >= best.floor[a][:, None]) & (ids[a][:, None] != key[theirs]))
                    best.add(a[i], key[theirs[j]], s[i, j])
        yield pa.RecordBatch.from_arrays([pa.array(ids[best.group]), pa.array(best.key), pa.array(best.score)], ["anchor_id", "id", "score"])

    return rows.mapInArrow(run, "anchor_id long, id long, score long")


def negatives(rows: DataFrame, anchors, columns: int, primes: list[int], n: int, low: int, high: int) -> DataFrame:
    """Of each task the first n rows of other labels inside the window of each positive.
    `anchors`: broadcast of (ids, labels, vectors, which positives there are, their scores)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, there, score = anchors.value
        own = residues(vectors, primes)
        wide = there.shape[1]
        best = Best(len(ids) * wide, n)
        # 100 * s >= low * p and 100 * s <= high * p, as bounds on whole numbers
        least, most = -((-low * score) // 100), (high * score) // 100
        for key, label, r in rows_of(batches, columns, primes):
            for lo in range(0, len(ids), ANCHORS_AT_ONCE):
                a = np.arange(lo, min(lo + ANCHORS_AT_ONCE, len(ids)))
                s = products([x[a] for x in own], r, primes)
                other = (labels[a][:, None] != label) & (ids[a][:, None] != key)
                for k in range(wide):
                    group = a * wide + k
                    i, j = np.nonzero(other & (s >= np.maximum(least[a, k], best.floor[group])[:, None]) & (s <= most[a, k][:, None]) & there[a, k][:, None])
                    best.add(group[i], key[j], s[i, j])
        g = best.group
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[g // wide]), pa.array((g % wide).astype(np.int32)), pa.array(best.key), pa.array(best.score)], ["anchor_id", "at", "id", "score"]
        )

    return rows.mapInArrow(run, "anchor_id long, at int, id long, score long")


def first_rows(found: DataFrame, group: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    scale: int = 256, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each row where `anchor` holds and each of its first `n_positives` rows of the same label, the
    first `n_negatives` rows of another label that score from `low` to `high` % of the positive.
    """
    scratch = Scratch(rows.sparkSession)
    context = rows.sparkSession.sparkContext
    marked = free_name(rows.columns, "asked")
    own = F.col(f"`{label}`") if isinstance(label, str) else label
    ready = prepared(rows.withColumn(marked, F.coalesce(anchor, F.lit(False))), key, vector, own, scale, marked)
    ready = scratch.keep(ready)
    widest = F.max(F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0)))
    asked = ready.where("asked").groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
    size = ready.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(widest, F.lit(0)), F.count_if("asked")).first()
    columns, largest, n = size
    bound = columns * largest * largest
    if bound * 100 >= 1 << 63:
        raise ValueError(f"scores up to {bound} do not fit")
    primes = primes_for(columns, bound)
    blocks = max(1, -(-n * max(1, columns) * 8 // ANCHOR_BYTES))
    asked = scratch.keep(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))))
    rows = ready.select("id", "label", "v")
    out = None
    for b in range(blocks):
        got = asked.where(F.col("block") == b).toArrow().sort_by("id")
        ids, labels = got.column("id").to_numpy(), got.column("label").to_numpy()
        vectors = matrix(got.column("v").combine_chunks(), columns)
        one = context.broadcast((ids, labels, vectors))
        pos = scratch.keep(first_rows(positives(rows, one, columns, primes, n_positives), ["anchor_id"], n_positives))
        near = pos.toArrow()
        at, rank = np.searchsorted(ids, near.column("anchor_id").to_numpy()), near.column("rank").to_numpy() - 1
        has, score = np.zeros((len(ids), n_positives), bool), np.zeros((len(ids), n_positives), np.int64)
        has[at, rank], score[at, rank] = True, near.column("score").to_numpy()
        two = context.broadcast((ids, labels, vectors, has, score))
        found = first_rows(negatives(rows, two, columns, primes, n_negatives, low, high), ["anchor_id", "at"], n_negatives)
        pos = pos.select("anchor_id", (F.col("rank") - 1).alias("at"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        done = scratch.keep(found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(pos, ["anchor_id", "at"]))
        out = done if out is None else out.unionByName(done)
        one.unpersist()
        two.unpersist()
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
