"""Density clusters against brute force, in few and many dimensions, with trees cut in Spark and in tasks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import clusters, density


def brute(points, eps, least):
    near = {a: [b for b in points if sum((x - y) * (x - y) for x, y in zip(points[a], points[b])) <= eps * eps] for a in points}
    core = {a for a in points if len(near[a]) >= least}
    name = {}
    for a in sorted(core):
        todo = [] if a in name else [a]
        while todo:
            at = todo.pop()
            if at not in name:
                name[at] = a
                todo += [b for b in near[at] if b in core]
    return {a: name.get(a, min((name[b] for b in near[a] if b in core), default=-1)) for a in points}


def clouds(dims, seed, n=240):
    """Three clouds, a third of all rows on one point, values shared by many in one dimension, strays."""
    rng, points = random.Random(seed), {}
    for i in range(n):
        c = rng.choice([0.0, 5.0, 9.0])
        points[i] = [round(c + rng.gauss(0, 0.8 / math.sqrt(dims)), 3) for _ in range(dims)]
        if i % 3 == 0:
            points[i] = [5.0] * dims
        elif i % 5 == 0:
            points[i][0] = 5.0
        elif i % 17 == 0:
            points[i] = [rng.uniform(-20, 30) for _ in range(dims)]
    return points


def frame(spark, points):
    return spark.createDataFrame([(k, [float(v) for v in p]) for k, p in points.items()], "k long, x array<double>").repartition(5)


@pytest.mark.parametrize("dims,leaf,part,eps", [(1, 4, 20, 0.7), (2, 64, 10**6, 0.7), (2, 4, 30, 0.7), (3, 8, 50, 0.7), (8, 8, 40, 0.7), (32, 16, 60, 1.05)])
def test_clusters_equal_brute_force(spark, dims, leaf, part, eps):
    points = clouds(dims, dims + leaf)
    want = brute(points, eps, 5)
    assert len(set(want.values())) > 2 and -1 in want.values()
    got = density.dbscan(frame(spark, points), "x", "k", eps, 5, leaf=leaf, part_bytes=part * 8 * dims)
    assert {r["k"]: r["group"] for r in got.collect()} == want


def test_thin_chain_and_border_between_two_clusters(spark):
    points = {i: [i * 0.5, 0.0] for i in range(60)}  # one long chain
    points |= {100 + i: [100.0, i * 0.01] for i in range(5)} | {200 + i: [102.0, i * 0.01] for i in range(5)}
    points[300] = [101.0, 0.0]  # reachable from both, core of none
    got = {r["k"]: r["group"] for r in density.dbscan(frame(spark, points), "x", "k", 1.0, 6, leaf=3, part_bytes=160).collect()}
    assert got == brute(points, 1.0, 6) and got[300] in (-1, 100)
    got = {r["k"]: r["group"] for r in density.dbscan(frame(spark, points), "x", "k", 1.0, 3, leaf=3, part_bytes=160).collect()}
    assert got == brute(points, 1.0, 3) and {got[i] for i in range(60)} == {0}


def test_odd_rows_are_noise_and_nothing_is_lost(spark):
    rows = [(i, [0.0, i * 0.1]) for i in range(6)]
    rows += [(10, None), (11, [0.0, None]), (12, [0.0, float("nan")]), (13, [float("inf"), 0.0]), (14, [0.0]), (15, []), (16, [-0.0, 0.0])]
    df = spark.createDataFrame(rows, "k int, x array<double>").withColumn("group", F.lit("old")).withColumn("path", F.lit("p"))
    got = density.dbscan(df, "x", "k", 1.0, 3)
    assert got.columns == ["k", "x", "path", "group"] and dict(got.dtypes)["group"] == "int"
    assert {r["k"]: r["group"] for r in got.collect()} == {**{i: 0 for i in range(6)}, **{i: -1 for i in range(10, 16)}, 16: 0}
    assert density.dbscan(df.limit(0), "x", "k").count() == 0
    assert clusters.dbscan is density.dbscan


def test_dense_region_is_settled_by_boxes(spark):
    """Points that all lie within reach of each other are never compared one by one."""
    df = spark.range(4000).select(F.col("id").alias("k"), F.array(F.rand(1), F.rand(2)).alias("x"))
    tree = density._leaves(df.select("x", F.lit(1).cast("long").alias("w"), "k"), 2, 16, 1000)
    assert tree.agg(F.sum("n"), F.max("n")).first()[:] == (4000, tree.agg(F.max("n")).first()[0]) and tree.agg(F.max("n")).first()[0] <= 16
    sure, left = density._node_pairs(density._nodes(tree, 2), tree, 2.0)
    assert left.count() == 0 and sure.count() == 1
    sure, left = density._node_pairs(density._nodes(tree, 2), tree, 0.01)
    leaves = tree.count()
    assert 0 < left.count() < leaves * leaves / 8


def test_points_travel_once_per_pair_of_blocks(spark, monkeypatch):
    """Not once per pair of leaves: with two blocks a leaf is sent to two pairs of blocks at most."""
    points = clouds(16, 5)
    monkeypatch.setattr(density, "BLOCKS", 2)
    sent, pairs = [], []
    kernel = density._kernel

    def spied(p, leaves, columns, work, schema, fold=None):
        def counting(r):
            yield from work(r)

        pairs.append(p.count())
        sent.append(p.select("block_a", "block_b", F.explode(F.array("a", "b")).alias("path")).distinct().count() / leaves.count())
        return kernel(p, leaves, columns, counting, schema, fold)

    monkeypatch.setattr(density, "_kernel", spied)
    got = density.dbscan(frame(spark, points), "x", "k", 0.9, 5, leaf=4, part_bytes=10**6)
    assert {r["k"]: r["group"] for r in got.collect()} == brute(points, 0.9, 5)
    assert len(sent) == 3 and max(sent) <= 2 and min(pairs) > 100


@pytest.mark.parametrize("d,scale,shift", [(16, 1.0, 0.0), (64, 1.0, 0.0), (64, 1e-25, 0.0), (64, 1e25, 0.0), (20, 0.25, 4096.0), (3, 1.0, 0.0)])
def test_products_decide_as_exact_sums(d, scale, shift):
    """On a coarse grid many pairs lie exactly at the limit, where a product's rounding must not decide."""
    rng = np.random.default_rng(d)
    a, b = (rng.integers(-2, 3, (n, d)) * scale + shift for n in (230, 190))
    square = ((a[:, None] - b[None]) ** 2).sum(-1)
    for limit in (np.median(square), np.quantile(square, 0.01), square.max() * 2, 0.0):
        near = density._near(a, b, float(limit))
        assert (near == density._exactly(a[:, None], b[None], float(limit))).all() and near.any() >= (limit > 0)
    assert density._near(a[:0], b, 1.0).shape == (0, 190) and density._near(a, b[:0], 1.0).shape == (230, 0)


def test_many_dimensions_make_few_pairs_of_leaves(spark, monkeypatch):
    """5,000 vectors: a hundred leaves of 64 points would have been thousands of pairs that no box excludes."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in (0, 300):
        x[i : i + 300] = x[i] + rng.normal(size=(300, 24)) * 0.02
    square = np.zeros((5000, 5000))
    for i in range(24):
        square += (x[:, None, i] - x[None, :, i]) ** 2
    near = square <= 0.6 * 0.6
    core = np.flatnonzero(near.sum(1) >= 4)
    want = np.where(np.isin(np.arange(5000), core), np.arange(5000), 5000)
    while True:  # the smallest core key reachable over core points
        least = np.where(near[np.ix_(core, core)], want[core][None], 5000).min(1)
        if (least == want[core]).all():
            break
        want[core] = least
    edge = np.where(near[:, core], want[core][None], 5000).min(1)
    want = np.where(want < 5000, want, np.where(edge < 5000, edge, -1))
    pairs, kernel = [], density._kernel
    monkeypatch.setattr(density, "_kernel", lambda p, *rest: pairs.append(p.count()) or kernel(p, *rest))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "k long, x array<double>").repartition(4)
    got = {r["k"]: r["group"] for r in density.dbscan(df, "x", "k", 0.6, 4).collect()}
    assert got == dict(enumerate(want.tolist())) and len({*got.values()}) > 2 and -1 in got.values()
    assert len(pairs) == 3 and max(pairs) <= 100


def test_settled_points_are_not_compared_again(monkeypatch):
    """16 leaves of one dense cloud: once a point has enough neighbours, or is joined, it is left alone."""
    rng = np.random.default_rng(5)
    leaves = {f"p{i:02d}": rng.normal(size=(100, 20)) * 0.1 for i in range(16)}
    held = {"xs": {p: x.tobytes() for p, x in leaves.items()}, "ws": {p: np.ones(100, int) for p in leaves}, "core": {p: np.ones(100, bool) for p in leaves}}
    held["ks"] = {p: np.arange(100) + 100 * i for i, p in enumerate(leaves)}
    compared, near = [], density._near
    monkeypatch.setattr(density, "_near", lambda a, b, limit: compared.append(len(a) * len(b)) or near(a, b, limit))
    for work in (density._counts(20, 1.0, 5), density._links(20, 1.0)):
        compared.clear()
        state = {"held": held}
        out = [c for a in leaves for b in leaves if a <= b for c in work({"a": a, "b": b, "state": state})]
        out += work({"a": None, "b": None, "state": state})
        assert 0 < sum(compared) < 1600 * 1600 / 2 / 4
        assert sum(len(c[0]) for c in out) >= 1599
