"""Near-duplicate detection by a chosen-path set similarity join.

A document is its set of word shingles. Equal sets become one class first. In each of
several independent trees, classes branch on minwise tokens: at each level a node's
documents go to the child of the token that a fresh hash of their set selects, so that
similar sets stay together with a probability equal to their similarity. Nodes small
enough are compared exhaustively; larger ones branch again, down to a fixed depth. Trees
are repeated until the chance to part a pair at the threshold in all of them is small.

Two rounds keep copies of one text from being expanded into all pairs. The first links
each node's documents with one of them; the second compares those pairs of a node that are
not connected yet, and in nodes that stayed large does so in blocks of bounded size. Every
link is confirmed on the full sets. Outside those blocks, sets that agree in under 56 % of the
minwise tokens (for sets at 0.8 the chance is below 1e-4) are not fetched for that.

Defined cases: a document with fewer words than a shingle has its whole sequence as the
only shingle; one without words, or null, has an empty set and is linked with nothing; rows
with a null key, or a string that is no whole number, are not linked and are kept; rows with one key are one document; extra
columns pass through.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .store import Scratch, aside, free_name
from .words import Words, mix, pieces, powers, prefix, run_hash

RESULTS = ("n_shingles", "component_id", "kept")
WORDS = 4
THRESHOLD = 80
TREES, LEVELS = 10, 5
SMALL = 16
AGREE = 56
BLOCK = 256
SEEDS = mix(powers(0xA24BAED4963EE407, TREES * LEVELS + 64))


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = Words(data, at, lower=True)
    sums = prefix(w.hash)
    first, gram = w.grams(k, sums)
    cut = np.searchsorted(first, w.first)
    out = [np.unique(gram[cut[i] : cut[i + 1]]) for i in range(len(at) - 1)]
    few = np.flatnonzero((w.count > 0) & (w.count < k))
    for i, h in zip(few, run_hash(sums, w.first[few], w.first[few + 1])):
        out[i] = np.array([h])
    return out


def signatures(docs: DataFrame, key: str, text: str, k: int, trees: int, levels: int) -> DataFrame:
    """(key, n, s1, s2, nodes, sketch): set size, two independent digests of the set, the
    tree nodes that the set goes through and its minwise tokens, cut to 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in pieces(batch, "text"):
                sets = shingle_sets(data, at, k)
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                joined = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
                start = (np.cumsum(n) - n)[full]
                nodes = np.zeros((len(full), trees * levels), np.uint64)
                sketch = np.zeros((len(full), trees * levels), np.uint64)
                digests = np.zeros((2, len(sets)), np.uint64)
                if len(full):
                    digests[0, full] = np.add.reduceat(joined, start)
                    digests[1, full] = np.add.reduceat(mix(joined ^ SEEDS[-1]), start)
                    for i in range(trees * levels):
                        token = np.minimum.reduceat((joined ^ SEEDS[i]) * (SEEDS[i + 1] | np.uint64(1)), start)
                        sketch[:, i] = token
                        above = nodes[:, i - 1] if i % levels else np.full(len(full), i + 1, np.uint64)
                        nodes[:, i] = mix(token + above * np.uint64(0xA24BAED4963EE407))
                per = lambda x, kind: pa.array(_spread(x, full, len(sets)), pa.list_(kind))
                cols = [pa.array(n, pa.int64()), *(pa.array(d.view(np.int64)) for d in digests), per(nodes.view(np.int64), pa.int64())]
                cols.append(per((sketch >> np.uint64(32)).astype(np.uint32).view(np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column(0), *cols], ["key", "n", "s1", "s2", "nodes", "sketch"])

    kind = docs.schema[key].dataType.simpleString()
    shape = f"key {kind}, n long, s1 long, s2 long, nodes array<long>, sketch array<int>"
    return docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(run, shape)


def _spread(rows: np.ndarray, at: np.ndarray, n: int) -> list:
    out: list = [[] for _ in range(n)]
    for i, r in zip(at, rows):
        out[i] = r
    return out


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. `texts`: (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                rows = batch.slice(lo, 128)
                sides = []
                for name in ("text_a", "text_b"):
                    code = rows.column(rows.schema.get_field_index(name)).dictionary_encode()
                    sets = [s for _, data, at in pieces(pa.RecordBatch.from_arrays([code.dictionary], ["t"]), "t") for s in shingle_sets(data, at, k)]
                    sides.append((code.indices.to_numpy(), sets))
                (ia, sa), (ib, sb) = sides
                hit = []
                for i, j in zip(ia, ib):
                    both = len(np.intersect1d(sa[i], sb[j], assume_unique=True))
                    hit.append(100 * both >= percent * (len(sa[i]) + len(sb[j]) - both))
                yield rows.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, pairs.select("a", "b").schema)


def alike(a, b, percent: int):
    """The length bound of a similarity: no larger set can reach it with a smaller one."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each left with each right set: products of 0/1 matrices
    over `width` elements at a time."""
    side = np.repeat([0, 1], [sum(map(len, left)), sum(map(len, right))])
    row = np.concatenate([np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)])
    value, order = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    by = np.argsort(order, kind="stable")
    order, row, side = order[by], row[by], side[by]
    out = np.zeros((len(left), len(right)))
    for lo in range(0, len(value), width):
        at = slice(*np.searchsorted(order, [lo, lo + width]))
        ones = [np.zeros((len(x), width), np.float32) for x in (left, right)]
        for k in (0, 1):
            mine = side[at] == k
            ones[k][row[at][mine], order[at][mine] - lo] = 1
        out += ones[0] @ ones[1].T
    return out


def block_links(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between members (node, cid, comp, size) of large nodes that are not connected.

    Most of such a node is one component already. Its other members, dealt into blocks, are
    compared with all members, dealt into blocks, a task holding two blocks; of the links
    between the same components one is returned.
    """
    main = members.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("node").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), (F.sum("c") - F.max("c")).alias("rest")
    )
    deal = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "cid"), n)
    count = lambda n: F.ceil(F.col(n) / BLOCK)
    m = members.join(main, "node").withColumns({"rows": count("rest"), "cols": count("size")})
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = m.where("comp != main").select("node", deal(F.col("rows"), 1).alias("i"), every("cols").alias("j"), "cid", "comp", F.lit(True).alias("own"))
    right = m.select("node", every("rows").alias("i"), deal(F.col("cols"), 2).alias("j"), "cid", "comp", F.lit(False).alias("own"))
    spread = left.unionByName(right).join(texts.withColumnRenamed("id", "cid"), "cid").select("node", "i", "j", "cid", "comp", "own", "text")

    def run(t: pa.Table) -> pa.Table:
        cid, comp, own = (t.column(c).to_numpy() for c in ("cid", "comp", "own"))
        one = pa.RecordBatch.from_arrays([t.column("text").combine_chunks()], ["t"])
        sets = [s for _, data, at in pieces(one, "t") for s in shingle_sets(data, at, k)]
        n = np.array([len(s) for s in sets])
        x, y = np.flatnonzero(own), np.flatnonzero(~own)
        both = overlaps([sets[i] for i in x], [sets[i] for i in y])
        hit = (100 * both >= percent * (n[x][:, None] + n[y] - both)) & (comp[x][:, None] != comp[y])
        i, j = np.nonzero(hit)
        lo, hi = np.minimum(comp[x[i]], comp[y[j]]), np.maximum(comp[x[i]], comp[y[j]])
        first = np.unique(np.stack([lo, hi]), axis=1, return_index=True)[1] if len(lo) else np.zeros(0, int)
        return pa.table({"a": cid[x[i[first]]], "b": cid[y[j[first]]]})

    return spread.groupBy("node", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = THRESHOLD, trees: int = TREES, levels: int = LEVELS, small: int = SMALL
) -> DataFrame:
    """The rows of `docs` with `n_shingles`, `component_id` (the smallest integer key reachable
    by links of at least `percent` % similarity) and `kept` (the row that stays)."""
    docs = aside(docs, RESULTS)
    scratch = Scratch(docs.sparkSession)
    all_sigs = scratch.keep(signatures(docs, key, text, k, trees, levels).withColumn("key", F.col("key").try_cast("long")))
    sigs = all_sigs.where("n > 0 AND key IS NOT NULL")
    classes = scratch.keep(sigs.groupBy("s1", "s2", "n").agg(F.min("key").alias("cid")))
    reps = sigs.join(classes.withColumnRenamed("cid", "key"), ["s1", "s2", "n", "key"]).dropDuplicates(["key", "s1", "s2"])
    tree = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.slice("nodes", t * levels + 1, F.lit(levels)))).alias("t", "path")
    active = scratch.keep(reps.select(F.col("key").alias("cid"), "n", tree).drop("t"))

    # branch: nodes of 2 to `small` end here, larger ones go one level down
    ends, node = None, lambda i: F.get("path", F.lit(i)).alias("node")
    for level in range(levels):
        sizes = active.groupBy(node(level)).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        split = scratch.keep(active.select("*", node(level)).join(sizes, "node"))
        scratch.drop(active)
        done = split.where(F.col("size") <= small) if level < levels - 1 else split
        done = done.select("node", "cid", "n", "size")
        ends = done if ends is None else ends.unionByName(done)
        active = split.where(F.col("size") > small).select("cid", "n", "path")
        if level < levels - 1:
            active = scratch.keep(active)
    ends = scratch.keep(ends)
    near = scratch.keep(ends.select(F.col("cid").alias("id")).distinct())
    sketches = scratch.keep(reps.select(F.col("key").alias("id"), "sketch").join(near, "id").dropDuplicates(["id"]))
    own_texts = docs.select(F.col(f"`{key}`").try_cast("long").alias("id"), F.col(f"`{text}`").alias("text"))

    def texts(ids: DataFrame) -> DataFrame:
        return own_texts.join(scratch.keep(ids.distinct()), "id", "left_semi").dropDuplicates(["id"])

    def linked(pairs: DataFrame) -> DataFrame:
        """Of the pairs those that agree in enough tokens and then on the full sets."""
        pairs = pairs.distinct().join(sketches.toDF("b", "sb"), "b").join(sketches.toDF("a", "sa"), "a")
        same = F.aggregate(F.zip_with("sa", "sb", lambda p, q: (p == q).cast("int")), F.lit(0), lambda n, v: n + v)
        pairs = scratch.keep(pairs.where(100 * same >= AGREE * trees * levels).select("a", "b"))
        used = texts(pairs.select(F.explode(F.array("a", "b")).alias("id")))
        return scratch.keep(confirmed(pairs, used, k, percent))

    # round one: each node's members against one of them
    heads = ends.groupBy("node").agg(F.min(F.struct("cid", "n")).alias("head"))
    star = ends.join(heads, "node").where((F.col("cid") != F.col("head.cid")) & alike(F.col("n"), F.col("head.n"), percent))
    links = linked(star.select(F.col("head.cid").alias("a"), F.col("cid").alias("b")))
    comps = components(links, scratch)

    # round two: what is in a node with something that it is not connected with
    marked = ends.join(comps.withColumnRenamed("id", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    mixed = marked.groupBy("node").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("node")
    marked = scratch.keep(marked.join(mixed, "node"))
    groups = marked.where(F.col("size") <= small).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("cid", "n", "comp"))).alias("g"))
    one = groups.select("g", F.posexplode("g").alias("i", "x"))
    two = one.select("x", F.explode(F.slice("g", F.col("i") + 2, F.lit(small))).alias("y"))
    two = two.where((F.col("x.comp") != F.col("y.comp")) & alike(F.col("x.n"), F.col("y.n"), percent))
    more = linked(two.select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")).join(links, ["a", "b"], "left_anti"))
    links = links.unionByName(more)
    large = marked.where(F.col("size") > small).drop("comp")
    comps = components(links, scratch)
    large = large.join(comps.withColumnRenamed("id", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    mixed = large.groupBy("node").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("node")
    large = scratch.keep(large.join(mixed, "node"))
    most = scratch.keep(block_links(large, texts(large.select(F.col("cid").alias("id"))), k, percent))
    comps = components(links.unionByName(most), scratch)

    named = classes.join(comps.withColumnRenamed("id", "cid"), "cid", "left").select("s1", "s2", "n", F.coalesce("comp", "cid").alias("component"))
    per_row = all_sigs.select("key", "n", "s1", "s2").where("key IS NOT NULL").join(named, ["s1", "s2", "n"], "left")
    per_key = per_row.groupBy("key").agg(F.max("n").alias("n"), F.min("component").alias("component"))
    own = free_name(docs.columns, "own__")
    per_key = scratch.keep(per_key.toDF("key__", "n__", "component__"))
    out = docs.withColumn(own, F.col(f"`{key}`").try_cast("long")).join(per_key, F.col(own) == F.col("key__"), "left")
    component = F.when(F.col(own).isNotNull(), F.coalesce("component__", own))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.coalesce("n__", F.lit(0)).cast("long").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col(own) == component, F.lit(True)).alias("kept"),
    )
