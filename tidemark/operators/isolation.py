"""Isolation forest: many small random trees, mean path length as an anomaly score.

Trees are grown from fixed-size samples (256 rows each), one Pandas group per
tree; the forest is at most trees x 511 nodes, so it can be shipped to every task.
"""

from __future__ import annotations

import math
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import hash_fraction
from . import prep

EULER = 0.5772156649015329
NODES = "tree int, node int, feature int, cut double, lo int, hi int, size int, depth int"


def path_constant(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def _grow(tree: int, x: np.ndarray, seed: int) -> list[tuple]:
    rng = np.random.default_rng([seed, tree])
    limit = max(1, math.ceil(math.log2(max(2, len(x)))))
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(x)), 0)]
    used = 1
    while todo:
        node, rows, depth = todo.pop()
        part = x[rows]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 and depth < limit else []
        if len(spread) == 0:
            nodes.append((tree, node, -1, 0.0, -1, -1, len(rows), depth))
            continue
        f = int(rng.choice(spread))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        left = part[:, f] < cut
        nodes.append((tree, node, f, cut, used, used + 1, len(rows), depth))
        todo += [(used, rows[left], depth + 1), (used + 1, rows[~left], depth + 1)]
        used += 2
    return nodes


def isolation_fit(
    df: DataFrame, features: Sequence[str], key: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 0
) -> DataFrame:
    """Nodes of the forest. Rows are drawn by hash, by one rule for any number of them: a row goes to
    `trees * sample / rows` neighbouring trees on average (to all of them at most), the first one
    by its hash, so a tree holds about `sample` rows."""
    each = min(float(trees), trees * sample / max(df.count(), 1))
    names = [F.col(k) for k in key]
    u, first = hash_fraction(F.lit(f"iso{seed}"), *names), hash_fraction(F.lit(f"tree{seed}"), *names)
    drawn = df.select(*[F.col(f).cast("double").alias(f) for f in features], u.alias("u__"), F.floor(first * trees).alias("at__"), F.floor(F.lit(each) + u).cast("int").alias("n__"))
    drawn = drawn.where("n__ > 0").withColumn("i__", F.explode(F.sequence(F.lit(0), F.least("n__", F.lit(trees)) - 1)))
    dealt = drawn.withColumn("tree", F.pmod(F.col("at__") + F.col("i__"), F.lit(trees)).cast("int"))
    cols = list(features)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("u__")[cols].to_numpy(dtype=float)
        return pd.DataFrame(
            _grow(int(pdf["tree"].iloc[0]), x, seed), columns=["tree", "node", "feature", "cut", "lo", "hi", "size", "depth"]
        )

    return dealt.groupBy("tree").applyInPandas(build, NODES)


def isolation_score(df: DataFrame, forest: DataFrame, features: Sequence[str], name: str = "anomaly_score") -> DataFrame:
    """Score in (0, 1): near 1 is isolated early. Trees walk whole Arrow batches at once."""
    nodes = forest.toPandas()  # bounded: trees x (2 * sample - 1) rows
    arrays, sizes = [], []
    for _, t in nodes.groupby("tree"):
        t = t.sort_values("node")
        ends = t["depth"].to_numpy() + np.array([path_constant(s) for s in t["size"]])
        arrays.append((t["feature"].to_numpy(), t["cut"].to_numpy(), t["lo"].to_numpy(), t["hi"].to_numpy(), ends))
        sizes.append(int(t["size"].max()))
    c = path_constant(float(np.mean(sizes))) or 1.0
    shared = df.sparkSession.sparkContext.broadcast(arrays)
    cols = list(features)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            total = np.zeros(len(pdf))
            at_row = np.arange(len(pdf))
            for feature, cut, lo, hi, ends in shared.value:
                at = np.zeros(len(pdf), dtype=np.int64)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    value = x[at_row, np.maximum(f, 0)]
                    step = np.where(value < cut[at], lo[at], hi[at])
                    at = np.where(inner, step, at)
                total += ends[at]
            yield pdf.assign(**{name: np.power(2.0, -total / (len(shared.value) * c))})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(score, f"{fields}, `{name}` double")


def anomaly_score(
    train: DataFrame, test: DataFrame, features: Sequence[str], key: Sequence[str], trees: int = 100, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Score both frames with a forest grown on train; gaps filled with train means."""
    means = prep.training_means(train, features)
    full = [d.select(*key, *[F.coalesce(F.col(f).cast("double"), F.lit(means.get(f, 0.0))).alias(f) for f in features]) for d in (train, test)]
    forest = isolation_fit(full[0], features, key, trees, seed=seed)
    scored = [isolation_score(d, forest, features).select(*key, "anomaly_score") for d in full]
    return train.join(scored[0], list(key)), test.join(scored[1], list(key))
