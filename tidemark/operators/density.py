"""Density clusters in any number of dimensions, by two walks over a tree of boxes.

Equal points are one weighted point. A tree is grown over the points: while a node holds
more than a task should, Spark cuts it at quantiles of its widest dimension; the rest of
each subtree is cut in the node's own task, down to leaves of a few points. Leaves are
rows of a table with their points packed, and every node has its exact box.

Pairs of nodes are then followed from the root down, a level at a time. Two boxes may lie
further apart than eps (the pair is dropped), or wholly within eps (all points of one are
neighbours of all points of the other, with nothing opened); only the others are replaced
by their children, and only pairs of leaves that stay open are compared point by point.
A region denser than eps is thus settled by its boxes. In many dimensions boxes tell less, and
the leaf pairs that stay open approach the square of the leaves, as with any exact method. The
points of a leaf do not travel with each of its pairs: leaves near each other in the tree form a block,
and a pair of blocks gets each of its leaves once, with the list of the pairs among them. From many
dimensions on leaves are larger, and distances are matrix products with a bound on their error: what the bound
leaves open is added up exactly. A pair of blocks keeps what it has found: points with enough neighbours are
not counted further, points already joined are not compared again.
"""

from __future__ import annotations

import functools
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

LEAF = 64
#: Points of a leaf from so many dimensions on, where boxes exclude little and the pairs of leaves become many.
MANY_DIMENSIONS, LARGE_LEAF = 16, 2048
PART_BYTES = 1 << 25
FAN = 16
#: Blocks of leaves: as many as keep a cluster busy with their pairs, more where a block would pass this many points.
BLOCKS = 16
BLOCK_POINTS = 1 << 16
#: Results of a pair of blocks are folded whenever so many rows have come together.
FOLD_ROWS = 1 << 18


def dbscan(
    df: DataFrame, features: Sequence[str] | str, key: str, eps: float = 1.9, min_points: int = 5, leaf: int | None = None, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Every row with its density cluster as `group`: the smallest key among the cluster's core
    points, -1 for noise.

    `features` are number columns, or the name of one array column. A border point joins the
    reachable cluster of the smallest name. Rows with a null, NaN or infinite coordinate, or with
    an array shorter or longer than the longest, are noise and nobody's neighbours. `leaf` is the
    number of points compared as one block (by the dimensions, if not given), `part_bytes` what one task may hold of them.
    """
    raw = F.col(f"`{features}`").cast("array<double>") if isinstance(features, str) else F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    d = df.agg(F.max(F.size(raw))).first()[0] if isinstance(features, str) else len(features)
    if not d or d < 1:
        return df.withColumn("group", F.lit(-1).cast(df.schema[key].dataType))
    whole = (F.size(raw) == d) & F.forall(raw, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    points = df.select(F.col(f"`{key}`").cast("long").alias("k"), F.when(whole, raw).alias("x")).where("x is not null")
    points = cut_lineage(points.groupBy("x").agg(F.count(F.lit(1)).alias("w"), F.min("k").alias("k")))

    leaf = leaf or (LEAF if d < MANY_DIMENSIONS else LARGE_LEAF)
    leaves = _leaves(points, d, leaf, max(leaf, part_bytes // (8 * d)))
    nodes = _nodes(leaves, d)
    sure, pairs = _node_pairs(nodes, leaves, eps * eps)

    # neighbours of each point, itself and its copies included, as far as they matter
    both = sure.select(F.col("a").alias("path"), F.col("b").alias("of")).unionByName(sure.where("a <> b").select(F.col("b").alias("path"), F.col("a").alias("of")))
    both = cut_lineage(both)
    whole_nodes = both.join(nodes.select(F.col("path").alias("of"), "w"), "of").groupBy("path").agg(F.sum("w").alias("v"))
    counted = _kernel(pairs, leaves, ["xs", "ws"], _counts(d, eps * eps, min_points), "path string, i int, v long", "sum").groupBy("path", "i").agg(F.sum("v").alias("v"))
    found = _per_leaf(leaves, counted, _pushed(leaves, whole_nodes, F.sum("v")), lambda one, all_: F.coalesce(one, F.lit(0)) + F.coalesce(all_, F.lit(0)))
    leaves = cut_lineage(found.withColumn("core", F.transform("vs", lambda v: v >= min_points)).drop("vs"))

    labels = _core_labels(leaves, both, pairs, d, eps * eps)
    core = _members(leaves).where("core").join(labels, "k")
    by_leaf = core.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("i", "label"))).alias("m"))
    named = leaves.join(by_leaf, "path", "left").withColumn("labels", F.transform(_places(), lambda i: F.try_element_at("m", i))).drop("m")
    leaves = cut_lineage(named)

    # border points: the smallest name among core neighbours
    least = _ancestors(leaves.select("path", F.array_min("labels").alias("label"))).groupBy("path").agg(F.min("label").alias("label"))
    offered = both.join(least.select(F.col("path").alias("of"), F.col("label").alias("v")), "of").groupBy("path").agg(F.min("v").alias("v"))
    touched = _kernel(pairs, leaves, ["xs", "labels"], _border(d, eps * eps), "path string, i int, v long", "min").groupBy("path", "i").agg(F.min("v").alias("v"))
    near = _per_leaf(leaves, touched, _pushed(leaves, offered, F.min("v")), lambda one, all_: F.least(one, all_))
    groups = near.select(F.explode(F.arrays_zip("ks", "labels", "vs")).alias("p")).select(F.col("p.ks").alias("k"), F.coalesce("p.labels", "p.vs").alias("g"))
    at = points.join(groups.where("g is not null"), "k").select(F.col("x").alias("x__"), F.col("g").alias("g__"))
    joined = df.join(at, F.when(whole, raw) == F.col("x__"), "left")
    out = F.coalesce("g__", F.lit(-1)).cast(df.schema[key].dataType)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != "group"], out.alias("group"))


# ---------------------------------------------------------------- the tree


def _leaves(points: DataFrame, d: int, leaf: int, part: int) -> DataFrame:
    """One row per leaf: its path from the root, box, and points (coordinates packed)."""
    x = [F.get("x", F.lit(i)) for i in range(d)]
    grown = points.withColumn("path", F.lit(""))
    while True:
        boxes = grown.groupBy("path").agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.min(v) for v in x]).alias("lo"), F.array(*[F.max(v) for v in x]).alias("hi")
        )
        width = F.zip_with("hi", "lo", lambda h, l: h - l)
        boxes = boxes.where(F.col("n") > part).withColumn("dim", F.array_position(width, F.array_max(width)).cast("int"))
        boxes = cut_lineage(boxes.select("path", "dim"))
        if boxes.isEmpty():
            break
        value = F.element_at("x", F.col("dim"))
        marks = F.percentile_approx(value, [i / FAN for i in range(1, FAN)], 1000)
        cuts = grown.join(boxes, "path").groupBy("path", "dim").agg(F.array_distinct(marks).alias("cuts"))
        # below, at and between the marks: a value shared by many gets a child of its own, flat in this dimension
        side = F.size(F.filter("cuts", lambda c: c < value)) + F.size(F.filter("cuts", lambda c: c <= value))
        moved = F.concat("path", F.coalesce(F.char(F.lit(65) + side), F.lit("")))
        grown = cut_lineage(grown.join(cut_lineage(cuts), "path", "left").select("x", "w", "k", F.when(F.col("cuts").isNull(), F.col("path")).otherwise(moved).alias("path")))

    def cut(table: pa.Table) -> pa.Table:
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        w, k = table["w"].to_numpy(), table["k"].to_numpy()
        todo, out = [(table["path"][0].as_py(), np.arange(len(x)))], []
        while todo:
            path, at = todo.pop()
            lo, hi = x[at].min(0), x[at].max(0)
            if len(at) <= leaf:
                out.append((path, len(at), x[at].tobytes(), w[at], k[at], lo, hi))
                continue
            v = x[at, (hi - lo).argmax()]
            middle = np.partition(v, len(v) // 2)[len(v) // 2]
            todo += [(path + name, at[side]) for name, side in zip("abc", (v < middle, v == middle, v > middle)) if side.any()]
        kinds = (pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(("path", "n", "xs", "ws", "ks", "lo", "hi"), kinds))})

    schema = "path string, n int, xs binary, ws array<long>, ks array<long>, lo array<double>, hi array<double>"
    return cut_lineage(grown.select("path", "x", "w", "k").groupBy("path").applyInArrow(cut, schema))


def _ancestors(df: DataFrame) -> DataFrame:
    """Each row once for its own path and each path above it."""
    up = F.transform(F.sequence(F.lit(0), F.length("path")), lambda i: F.substring(F.col("path"), F.lit(1), i))
    return df.withColumn("path", F.explode(up))


def _nodes(leaves: DataFrame, d: int) -> DataFrame:
    """Every node of the tree with its weight and box; `leaf` tells the leaves."""
    up = _ancestors(leaves.select("path", F.aggregate("ws", F.lit(0).cast("long"), lambda a, v: a + v).alias("w"), "lo", "hi", F.col("path").alias("own")))
    return cut_lineage(
        up.groupBy("path").agg(
            F.sum("w").alias("w"),
            F.array(*[F.min(F.get("lo", F.lit(i))) for i in range(d)]).alias("lo"),
            F.array(*[F.max(F.get("hi", F.lit(i))) for i in range(d)]).alias("hi"),
            F.max(F.col("own") == F.col("path")).alias("leaf"),
        )
    )


def _node_pairs(nodes: DataFrame, leaves: DataFrame, limit: float) -> tuple[DataFrame, DataFrame]:
    """Pairs a <= b of nodes wholly within reach, and pairs of leaves that only points can decide."""
    kids = nodes.where("path <> ''").select(F.expr("left(path, length(path) - 1)").alias("path"), F.col("path").alias("kid"))
    kids = cut_lineage(kids.unionByName(nodes.where("leaf").select("path", F.col("path").alias("kid"))))
    side = lambda s: nodes.select(F.col("path").alias(s), F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}"), F.col("leaf").alias(f"leaf_{s}"))
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda s, t: s + t * t)
    ab = F.zip_with("lo_b", "hi_a", lambda p, q: p - q)  # from a's upper border up to b's lower
    ba = F.zip_with("lo_a", "hi_b", lambda p, q: p - q)
    gap = F.zip_with(ab, ba, lambda p, q: F.greatest(F.lit(0.0), p, q))
    span = F.zip_with(ab, ba, lambda p, q: F.greatest(-p, -q))
    at = nodes.where("path = ''").select(F.col("path").alias("a"), F.col("path").alias("b"))
    settled = []
    while True:
        met = at.join(side("a"), "a").join(side("b"), "b").where(square(gap) <= limit)
        met = cut_lineage(met.select("a", "b", (square(span) <= limit).alias("sure"), (F.col("leaf_a") & F.col("leaf_b")).alias("last")))
        settled.append(met.where("sure or last"))
        open_ = met.where("not sure and not last")
        if open_.isEmpty():
            break
        down = open_.join(kids.select(F.col("path").alias("a"), F.col("kid").alias("ka")), "a").join(kids.select(F.col("path").alias("b"), F.col("kid").alias("kb")), "b")
        at = down.where("a <> b or ka <= kb").select(F.col("ka").alias("a"), F.col("kb").alias("b"))
    done = functools.reduce(DataFrame.unionByName, settled)
    return done.where("sure").select("a", "b"), _in_blocks(done.where("not sure").select("a", "b"), leaves)


def _in_blocks(pairs: DataFrame, leaves: DataFrame) -> DataFrame:
    """Pairs of leaves with the blocks of both (block_a, block_b); a block is a stretch of the tree."""
    held = leaves.agg(F.sum("n")).first()[0] or 0
    many = max(BLOCKS, -(-held // BLOCK_POINTS))
    block = cut_lineage(leaves.select("path").repartitionByRange(many, "path").select("path", F.spark_partition_id().alias("block")))
    side = lambda s: block.select(F.col("path").alias(s), F.col("block").alias(f"block_{s}"))
    return cut_lineage(pairs.join(side("a"), "a").join(side("b"), "b"))


# ---------------------------------------------------------------- points of leaf pairs


def _kernel(pairs: DataFrame, leaves: DataFrame, columns: Sequence[str], work: Callable, schema: str, fold: str | None = None) -> DataFrame:
    """`work` on every open pair of leaves, then once without a pair; it yields rows of `schema`, whose last
    column is folded inside a pair of blocks (`sum` or `min`; None: rows are only made distinct). Each call gets as
    `state` one dict of the pair of blocks, with the columns of all its leaves as `held`."""
    names = [f.strip().split()[0] for f in schema.split(",")]
    cell, at = ["block_a", "block_b"], ["at_a", "at_b"]
    needed = pairs.select(*[F.col(c).alias(n) for c, n in zip(cell, at)], F.explode(F.array("a", "b")).alias("path")).distinct()
    # each leaf is copied here to all its pairs of blocks: by a fixed number of tasks, however little comes in
    needed = needed.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    points = needed.join(leaves.select("path", *columns), "path")

    def folded(parts: list[pa.Table]) -> list[pa.Table]:
        if not parts:
            return parts
        by, of = (names[:-1], [(names[-1], fold)]) if fold else (names, [])
        done = pa.concat_tables(parts).group_by(by).aggregate(of)
        return [done.rename_columns([*[c for c in done.column_names if c in by], *names[len(by):]]).select(names)]

    def run(pairs: pa.Table, points: pa.Table) -> pa.Table:
        path = points["path"].to_pylist()
        held = {c: dict(zip(path, points[c].to_pylist() if c == "xs" else map(np.array, points[c].to_pylist()))) for c in columns}
        parts, rows, state = [], 0, {"held": held}
        for a, b in [*zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()), (None, None)]:
            for cols in work({"a": a, "b": b, "state": state}):
                parts.append(pa.table([pa.array(c.tolist() if c.dtype == object else c) for c in cols], names))
                rows += len(cols[0])
            if rows > FOLD_ROWS:
                parts = folded(parts)
                rows = 0
        return folded(parts)[0] if parts else empty

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    empty = pa.table({n: pa.array([], kinds[f.strip().split()[1]]) for n, f in zip(names, schema.split(","))})
    return pairs.select(*cell, "a", "b").groupBy(*cell).cogroup(points.groupBy(*at)).applyInArrow(run, schema)


def _points(state: dict, path: str, d: int) -> np.ndarray:
    return np.frombuffer(state["held"]["xs"][path], np.float64).reshape(-1, d)


def _exactly(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Squares are added up a dimension at a time, as for boxes, so that rounding never contradicts a box."""
    total = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]))
    for i in range(a.shape[-1]):
        gap = a[..., i] - b[..., i]
        total += gap * gap
    return total <= limit


def _near(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Which of the first points are neighbours of which of the second.

    In many dimensions |p|^2 + |q|^2 - 2pq comes from one matrix product, in single precision and, where that tells
    too little, in double; pairs closer to the limit than the product's error can be are added up exactly.
    """
    d = a.shape[1]
    if d >= MANY_DIMENSIONS and len(a) and len(b):
        with np.errstate(over="ignore", invalid="ignore"):
            centre = (a.mean(0) + b.mean(0)) / 2
            p, q = a - centre, b - centre
            pp, qq = (p * p).sum(1), (q * q).sum(1)
            most = pp.max() + qq.max()
            for kind in (np.float32, np.float64):
                slack = 2 * (d + 16) * float(np.finfo(kind).eps) * most + d * float(np.finfo(kind).tiny)
                if not most < float(np.finfo(kind).max) / 16 or limit > float(np.finfo(kind).max) / 16:
                    continue
                left, right = np.ones((len(a), d + 2), kind), np.ones((len(b), d + 2), kind)
                left[:, :d], left[:, d], right[:, :d], right[:, d + 1] = p, pp, -2 * q, qq
                square = left @ right.T
                near, wide = square <= kind(limit - slack), square <= kind(limit + slack)
                if np.count_nonzero(wide) - np.count_nonzero(near) <= max(1024, square.size // 16):
                    i, j = np.nonzero(wide & ~near)
                    near[i, j] = _exactly(a[i], b[j], limit)
                    return near
    rows = max(1, (1 << 22) // max(1, len(b)))
    return np.concatenate([_exactly(a[i : i + rows, None], b[None], limit) for i in range(0, len(a), rows)] or [np.zeros((0, len(b)), bool)])


def _hits(path: str, values: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.flatnonzero(kept)
    return np.full(len(at), path, object), at.astype(np.int32), values[at].astype(np.int64)


def _counts(d: int, limit: float, enough: int) -> Callable:
    """Neighbours of each point inside the pair of blocks; a point that has `enough` may get fewer than all."""

    def weighed(near: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.count_nonzero(near, axis=1) if (w == 1).all() else near @ w

    def work(r: dict):
        a, b, state = r["a"], r["b"], r["state"]
        w = state["held"]["ws"]
        seen = state.setdefault("seen", {p: np.zeros(len(v), np.int64) for p, v in w.items()})
        if a is None:
            yield from (_hits(p, n, n > 0) for p, n in seen.items() if n.any())
            return
        want = {p: seen[p] < enough for p in (a, b)}
        if not want[a].any() and not want[b].any():
            return
        xa, xb, few = _points(state, a, d), _points(state, b, d), want[a]
        near = _near(xa[few], xb, limit)
        seen[a][few] += weighed(near, w[b])
        if a != b:
            seen[b] += weighed(near.T, w[a][few])
            seen[b][want[b]] += weighed(_near(xa[~few], xb[want[b]], limit).T, w[a][~few])

    return work


def _border(d: int, limit: float) -> Callable:
    """The smallest label that each point without one reaches inside the pair of blocks."""
    far = np.iinfo(np.int64).max

    def work(r: dict):
        a, b, state = r["a"], r["b"], r["state"]
        if "known" not in state:
            state["known"] = {p: np.array([far if v is None else v for v in x], np.int64) for p, x in state["held"]["labels"].items()}
            state["best"] = {p: np.full(len(x), far) for p, x in state["known"].items()}
        known, best = state["known"], state["best"]
        if a is None:
            yield from (_hits(p, v, v != far) for p, v in best.items() if (v != far).any())
            return
        for one, other in [(a, b)] + ([(b, a)] if a != b else []):
            # those that could find a smaller label here than they have
            core = known[other] != far
            asks = (known[one] == far) & (best[one] > known[other].min())
            if asks.any() and core.any():
                near = _near(_points(state, one, d)[asks], _points(state, other, d)[core], limit)
                best[one][asks] = np.minimum(best[one][asks], np.where(near, known[other][core][None, :], far).min(1))

    return work


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    root = parent[at]
    while (parent[root] != root).any():
        root = parent[root]
    parent[at] = root
    return root


def _join(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Puts the groups of u[i] and v[i] together; a root is never above its members."""
    while True:
        ru, rv = _roots(parent, u), _roots(parent, v)
        apart = ru != rv
        if not apart.any():
            return
        np.minimum.at(parent, np.maximum(ru, rv)[apart], np.minimum(ru, rv)[apart])


def _links(d: int, limit: float) -> Callable:
    """Edges that join the core points of a pair of blocks as their neighbourhoods do: each
    point with the smallest key of its group."""

    def start(state: dict) -> None:
        held = state["held"]
        core = {p: np.flatnonzero(np.array(c, bool)) for p, c in held["core"].items()}
        state["keys"] = keys = np.concatenate([held["ks"][p][at] for p, at in core.items()]).astype(np.int64)
        ends = np.cumsum([len(at) for at in core.values()])
        state["core"], state["at"] = core, {p: np.arange(e - len(at), e) for e, (p, at) in zip(ends, core.items())}
        state["parent"] = np.arange(len(keys))

    def meet(state: dict, u: np.ndarray, v: np.ndarray, xu: np.ndarray, xv: np.ndarray) -> None:
        if not len(u) or not len(v):
            return
        parent, near = state["parent"], _near(xu, xv, limit)
        while True:
            near &= _roots(parent, u)[:, None] != _roots(parent, v)[None, :]
            rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if not len(rows):
                return
            _join(parent, np.concatenate([u[rows], u[near[:, columns].argmax(0)]]), np.concatenate([v[near[rows].argmax(1)], v[columns]]))

    def work(r: dict):
        a, b, state = r["a"], r["b"], r["state"]
        if "parent" not in state:
            start(state)
        parent, keys = state["parent"], state["keys"]
        if a is None:
            root = _roots(parent, np.arange(len(keys)))
            least = keys.copy()
            np.minimum.at(least, root, keys)
            if (least[root] != keys).any():
                yield keys[least[root] != keys], least[root][least[root] != keys]
            return
        u, v = state["at"][a], state["at"][b]
        if not len(u) or not len(v):
            return
        xu, xv = _points(state, a, d)[state["core"][a]], _points(state, b, d)[state["core"][b]]
        # pairs inside the largest group are joined already: only what lies outside it is compared
        roots, many = np.unique(np.concatenate([_roots(parent, u), _roots(parent, v)]), return_counts=True)
        largest = roots[many.argmax()]
        out_u, out_v = parent[u] != largest, parent[v] != largest
        meet(state, u[out_u], v, xu[out_u], xv)
        if a != b:
            meet(state, u[~out_u], v[out_v], xu[~out_u], xv[out_v])

    return work


def _places() -> Column:
    return F.sequence(F.lit(0), F.col("n") - 1)


def _members(leaves: DataFrame) -> DataFrame:
    """One row per point of the leaves: path, place, key, core or not."""
    return leaves.select("path", F.posexplode(F.arrays_zip("ks", "core")).alias("i", "p")).select("path", "i", F.col("p.ks").alias("k"), F.col("p.core").alias("core"))


def _pushed(leaves: DataFrame, at_nodes: DataFrame, total: Column) -> DataFrame:
    """Values of nodes (path, v) brought down to the leaves below them."""
    own = _ancestors(leaves.select("path", F.col("path").alias("own")))
    return own.join(at_nodes, "path").groupBy(F.col("own").alias("path")).agg(total.alias("all"))


def _per_leaf(leaves: DataFrame, points: DataFrame, pushed: DataFrame, join: Callable[[Column, Column], Column]) -> DataFrame:
    """Leaves with `vs`: for each point what was found for it joined with what holds for its leaf."""
    ones = points.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m"))
    met = leaves.join(ones, "path", "left").join(pushed, "path", "left")
    return met.withColumn("vs", F.transform(_places(), lambda i: join(F.try_element_at("m", i), F.col("all")))).drop("m", "all")


# ---------------------------------------------------------------- components


def _core_labels(leaves: DataFrame, both: DataFrame, pairs: DataFrame, d: int, limit: float) -> DataFrame:
    """Smallest key of each core point's cluster (k, label).

    Where two nodes lie wholly within reach and both hold core points, all of these are one
    cluster: the nodes become vertices, joined with each other, with the next such node
    above, and with the core points below that have no nearer one.
    """
    has = _ancestors(leaves.where(F.exists("core", lambda c: c)).select("path")).distinct()
    united = both.join(has, "path").join(has.select(F.col("path").alias("of")), "of")
    united = cut_lineage(united)
    vertex = cut_lineage(united.select("path").distinct())
    name = lambda c: F.concat(F.lit("#"), F.col(c))
    lowest = lambda rows, strict: (
        _ancestors(rows.select("path", F.col("path").alias("own"))).where("path <> own" if strict else "true").join(vertex, "path").groupBy("own").agg(F.max("path").alias("over"))
    )
    points = _members(leaves).where("core").select("path", "k")
    edges = united.where("path <> of").select(name("path").alias("u"), name("of").alias("v"))
    edges = edges.unionByName(lowest(vertex, True).select(name("own").alias("u"), name("over").alias("v")))
    under = points.join(lowest(leaves, False), points["path"] == F.col("own")).select(F.col("k").cast("string").alias("u"), name("over").alias("v"))
    inside = _kernel(pairs, leaves, ["xs", "ks", "core"], _links(d, limit), "u long, v long").distinct()
    edges = edges.unionByName(under).unionByName(inside.select(F.col("u").cast("string").alias("u"), F.col("v").cast("string").alias("v")))
    edges = cut_lineage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())

    none = F.lit(None).cast("long")
    labels = points.select(F.col("k").cast("string").alias("u"), F.col("k").alias("label")).unionByName(vertex.select(name("path").alias("u"), none.alias("label")))
    while True:
        # smallest label among neighbours, then the label that one's own group got
        best = edges.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("n"))
        step = labels.join(best, "u", "left").select("u", "label", F.least("label", "n").alias("next"))
        jump = step.groupBy(F.col("label").alias("next")).agg(F.min("next").alias("far"))
        new = cut_lineage(step.join(jump, "next", "left").select("u", "label", F.least("next", "far").alias("next")))
        moved = not new.where("NOT next <=> label").isEmpty()
        labels = new.select("u", F.col("next").alias("label"))
        if not moved:
            break
    return labels.where("NOT startswith(u, '#')").select(F.col("u").cast("long").alias("k"), "label")
