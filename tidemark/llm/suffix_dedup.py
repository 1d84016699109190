"""Removal of repeated passages by a depth-limited radix sort of suffixes.

Every byte of every text that begins a full window of `depth` bytes is a suffix. Suffixes
are ordered only through those bytes, from the most significant digit on, and a group
whose digits all agree is a set of equal windows. A suffix alone in its group is dropped
at once, so each pass handles only what may still repeat:

1. The first digit is sampled: of the k-grams in a window, the one with the smallest hash.
   Neighbouring suffixes mostly share it, so they travel as one run (about one row for 80
   bytes). Grouping runs by this digit is a shuffle with map-side counts.
2. The second digit is the whole run's bytes. Runs that occur twice are repeated throughout;
   this settles the inside of copies.
3. What is left, at the borders of copies, moves to the task of its first digit as bytes, each
   kind of run once, and its suffixes go through passes of eight bytes there. A first digit
   with many kinds of runs is spread over tasks; there, and where a digit's runs fall into two
   batches, what is still alone is counted over all tasks by its digest.

No pass collects a group: counts are summed before they move, and only the runs or digests
that repeat are joined back. Digests of two passes, 128 bits, stand for bytes between tasks.
Texts travel packed, as they move twice.

Defined cases: a null text is empty; texts shorter than a window have no suffixes; matches
do not cross texts; equal texts are told apart from others by two digests, 96 bits, so repeated
rows repeat each other; extra columns pass through.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .store import Scratch, aside, free_name, parts
from .words import pieces, prefix, run_hash, sampling_hash

RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
DEPTH = 200
GRAM = 40
MANY = 2048
SEGMENT = 1 << 22
PLACE = np.uint64((1 << 23) - 1)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, from running minima inside blocks of w."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    full = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[: len(x)] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def runs_of(data: np.ndarray, at: np.ndarray, depth: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring suffixes with one sampled digit: row, first suffix (from the
    row's start), length, digit h, digest e of the run's bytes, and whether the digit
    stands in more than one place of the run."""
    parts: list[dict] = []
    # rows are cut into segments so that a very long text needs no more memory than others
    bounds = [np.arange(at[i], max(at[i] + 1, at[i + 1] - depth + 1), SEGMENT) for i in np.flatnonzero(np.diff(at) > SEGMENT + depth)]
    cuts = np.unique(np.concatenate([[0, len(data)], *bounds])) if bounds else np.array([0, len(data)])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        end = min(len(data), hi + depth - 1) if hi < len(data) else hi
        part = data[lo:end]
        if len(part) < depth:
            continue
        sums = prefix(part.astype(np.uint64) + np.uint64(1))
        place = np.arange(len(part) - gram + 1)
        grams = sampling_hash(part, gram)
        best = (sliding_min(grams & ~PLACE | place.astype(np.uint64), depth - gram + 1) & PLACE).astype(np.int64)
        start = np.arange(len(best)) + lo
        row = np.searchsorted(at, start, "right") - 1
        ok = (start + depth <= at[row + 1]) & (start < hi)
        best, start, row = best[ok], start[ok], row[ok]
        if not len(start):
            continue
        h = grams[best]
        new = np.ones(len(start), bool)
        new[1:] = (h[1:] != h[:-1]) | (start[1:] != start[:-1] + 1) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        parts.append({
            "row": row[first], "pos": start[first] - at[row[first]], "len": last - first + 1, "h": h[first],
            "e": run_hash(sums, start[first] - lo, start[last] - lo + depth), "tied": best[first] != best[last],
        })
    names = ("row", "pos", "len", "h", "e", "tied")
    return {n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, np.int64) for n in names}


def radix_groups(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Group numbers of the suffixes by their first `depth` bytes, -1 for one that is alone.

    Passes of eight bytes from the most significant digit on; each orders the suffixes of
    the groups that are left and drops those alone in theirs.
    """
    group = np.full(len(starts), -1, np.int64)
    left, own = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for digit in range(0, depth, 8):
        if not len(left):
            return group
        value = np.zeros(len(left), np.uint64)
        for b in range(min(8, depth - digit)):
            value = value << np.uint64(8) | padded[starts[left] + digit + b].astype(np.uint64)
        order = np.lexsort((value, own))
        left, own, value = left[order], own[order], value[order]
        new = np.ones(len(left), bool)
        new[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
        own = np.cumsum(new) - 1
        many = np.bincount(own)[own] > 1
        left, own = left[many], own[many]
    group[left] = own
    return group


def text_key(text):
    """Two independent digests of a text, 96 bits in all."""
    return F.xxhash64(text).alias("k1"), F.hash(text).alias("k2")


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the last column, a text or bytes."""
    tool = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        got = [tool.compress(x.as_buffer()) if x.is_valid else None for x in batch.columns[-1].cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.binary())], batch.schema.names)


def unpack(column: pa.Array, kind: pa.DataType) -> pa.Array:
    tool = zstandard.ZstdDecompressor()
    return pa.array([tool.decompress(x.as_buffer()) if x.is_valid else None for x in column], pa.binary()).cast(kind)


def packed(df: DataFrame, column: str) -> DataFrame:
    """`df` with the column compressed and moved to the end."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    last = df.select(*rest, F.col(f"`{column}`"))
    return last.mapInArrow(pack, StructType([*last.schema[:-1], StructField(column, BinaryType())]))


def unpacked(df: DataFrame, column: str) -> DataFrame:
    """`df` with the column that `packed` compressed as a text again."""
    last = df.select(*[F.col(f"`{c}`") for c in df.columns if c != column], F.col(f"`{column}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], unpack(batch.columns[-1], pa.string())], batch.schema.names)

    return last.mapInArrow(run, StructType([*last.schema[:-1], StructField(column, StringType())])).select(*[F.col(f"`{c}`") for c in df.columns])


def repeated_spans(docs: DataFrame, text: str, depth: int, gram: int) -> DataFrame:
    """(k1, k2, spans): for each text with repeated windows the first bytes of those windows,
    as ranges (pos, len)."""
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select(*text_key(F.col(f"`{text}`")), F.col(f"`{text}`").alias("text")).where(F.octet_length("text") >= depth)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in pieces(batch, "text"):
                r = runs_of(data, at, depth, gram)
                who = pa.array(r["row"], pa.int64())
                cols = [rows.column(0).take(who), rows.column(1).take(who), pa.array(r["pos"], pa.int32()), pa.array(r["len"], pa.int32())]
                cols += [pa.array(r["h"].astype(np.uint64).view(np.int64)), pa.array(r["e"].astype(np.uint64).view(np.int64)), pa.array(r["tied"].astype(bool))]
                yield pa.RecordBatch.from_arrays(cols, ["k1", "k2", "pos", "len", "h", "e", "tied"])

    runs = scratch.keep(keyed.mapInArrow(sample, "k1 long, k2 int, pos int, len int, h long, e long, tied boolean"))
    # pass 1: digits that occur once, and in one place, are done
    digits = runs.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("e").alias("lo"), F.max("e").alias("hi"), F.max("tied").alias("tied"))
    digits = scratch.keep(digits.where("n > 1 OR tied").select("h", (F.expr("n > 1 AND lo = hi")).alias("same")))
    open_runs = scratch.keep(runs.join(digits, "h"))
    scratch.drop(runs)
    # pass 2: runs that occur twice are repeated throughout
    mixed = open_runs.where(~F.col("same"))
    byte_runs = scratch.keep(mixed.groupBy("h", "e").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "pos", "len")).alias("at")))
    whole = mixed.join(byte_runs.where("n > 1").select("h", "e"), ["h", "e"], "left_semi")
    settled = open_runs.where("same").unionByName(whole).select("k1", "k2", "pos", "len").distinct()

    # pass 3: the bytes of the other runs, each kind of run once, to the task of their digit
    kinds = byte_runs.groupBy("h").agg((F.count(F.lit(1)) > MANY).alias("many"))
    todo = byte_runs.join(kinds, "h").select("at.*", "h", (F.col("n") == 1).alias("need"), "many")
    todo = todo.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "len", "h", "need", "many")).alias("runs"))
    left = todo.join(packed(keyed, "text"), ["k1", "k2"]).select("k1", "k2", "runs", "text")

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = unpack(batch.column(3), pa.binary()).to_pylist()
                row = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy())
                flat = batch.column(2).flatten()
                pos, length = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                cut = [texts[r][p : p + n + depth - 1] for r, p, n in zip(row, pos, length)]
                who = pa.array(row, pa.int64())
                cols = [batch.column(0).take(who), batch.column(1).take(who), *(flat.field(i) for i in range(5)), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["k1", "k2", "pos", "len", "h", "need", "many", "bytes"])

    moved = left.mapInArrow(slices, "k1 long, k2 int, pos int, len int, h long, need boolean, many boolean, bytes binary")
    salt = F.when(F.col("many"), F.xxhash64("k1", "pos"))
    moved = moved.repartition(parts(docs.sparkSession), "h", salt).sortWithinPartitions("h")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in pieces(batch, "bytes"):
                length, h, pos = (rows.column(i).to_numpy().astype(np.int64) for i in (3, 4, 2))
                need, many = (rows.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (5, 6))
                split = many | (h == h[0]) | (h == h[-1])  # others may hold more runs of the digit
                each = np.repeat(np.arange(len(h)), length)
                inside = np.arange(len(each)) - np.repeat(np.cumsum(length) - length, length)
                start = at[each] + inside
                group = radix_groups(data, start, depth)
                alone, asks, shared = group < 0, need[each], split[each]
                # equal here: settled; neighbours make one range
                known = np.flatnonzero(~alone & asks)
                first = np.ones(len(known), bool)
                first[1:] = (each[known[1:]] != each[known[:-1]]) | (known[1:] != known[:-1] + 1)
                span = np.diff(np.append(np.flatnonzero(first), len(known)))
                # alone here, in a digit that others hold too: ask; what others may ask for: evidence
                wanted = np.flatnonzero(alone & asks & shared)
                lead = np.flatnonzero(~alone & shared)
                lead = lead[np.unique(group[lead], return_index=True)[1]]
                bare = np.concatenate([lead, np.flatnonzero(alone & ~asks & shared)])
                pick = np.concatenate([known[first], wanted, bare])
                width = np.concatenate([span, np.ones(len(wanted) + len(bare), int)])
                weight = np.repeat([0, 1, 2], [len(span), len(wanted), len(bare)])
                who = pc.if_else(pa.array(weight < 2), pa.array(each[pick], pa.int64()), pa.scalar(None, pa.int64()))
                sums = prefix(data.astype(np.uint64) + np.uint64(1))
                digest = run_hash(sums, start[pick], start[pick] + depth).view(np.int64)
                ints = [pa.array(x, pa.int32()) for x in (pos[each[pick]] + inside[pick], width, weight)]
                cols = [rows.column(0).take(who), rows.column(1).take(who), *ints[:2], pa.array(h[each[pick]]), pa.array(digest), ints[2]]
                yield pa.RecordBatch.from_arrays(cols, ["k1", "k2", "pos", "len", "h", "d", "weight"])

    found = scratch.keep(moved.mapInArrow(suffixes, "k1 long, k2 int, pos int, len int, h long, d long, weight int"))
    # weight 0: settled; 1: alone in its task and asking; 2: evidence
    counted = found.where("weight > 0").groupBy("h", "d").agg(F.sum("weight").alias("w")).where("w > 1").select("h", "d")
    asking = found.where("weight = 1").join(counted, ["h", "d"], "left_semi")
    border = asking.unionByName(found.where("weight = 0")).select("k1", "k2", "pos", "len")
    return settled.unionByName(border).groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "len")).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """The rows of `docs` with `n_bytes`, `n_removed`, `n_spans` and `kept_bytes`: the UTF-8
    bytes of the text without those covered by a window that also starts anywhere else."""
    docs = aside(docs, RESULTS)
    spans = Scratch(docs.sparkSession).keep(repeated_spans(docs, text, depth, gram))
    k1, k2, at = (free_name(docs.columns, c) for c in ("k1", "k2", "spans"))
    one, two = text_key(F.col(f"`{text}`"))
    keyed = packed(docs.withColumn(k1, one).withColumn(k2, two), text)
    rest = [c for c in docs.columns if c != text]
    joined = keyed.join(spans.toDF(k1, k2, at), [k1, k2], "left").select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`"), at)
    names = ["n_bytes", "n_removed", "n_spans", "kept_bytes"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for small in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            body = unpack(small.column(len(rest)), pa.string())
            batch = pa.RecordBatch.from_arrays([*small.columns[:-2], body, small.column(len(rest) + 1)], small.schema.names)
            for rows, data, off in pieces(batch, text):
                lists = rows.column(rows.num_columns - 1)
                sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                flat = lists.flatten()
                pos, length = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
                begin = off[np.repeat(np.arange(rows.num_rows), sizes)] + pos
                steps = np.zeros(len(data) + 1, np.int64)
                np.add.at(steps, begin, 1)
                np.add.at(steps, begin + length + depth - 1, -1)
                gone = np.cumsum(steps[:-1]) > 0
                lead = gone.copy()
                lead[1:] &= ~gone[:-1]
                inner = off[:-1][np.diff(off) > 0]
                lead[inner] = gone[inner]
                total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[off])
                removed, kept = total(gone), data[~gone].tobytes()
                ends = np.concatenate([[0], np.cumsum(np.diff(off) - removed)])
                texts = [kept[a:b] for a, b in zip(ends[:-1], ends[1:])]
                cols = [pa.array(np.diff(off), pa.int64()), pa.array(removed, pa.int64()), pa.array(total(lead), pa.int64()), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *cols], [*rows.schema.names[:-1], *names])

    kinds = [LongType(), LongType(), LongType(), BinaryType()]
    shape = StructType([*docs.select(*[F.col(f"`{c}`") for c in [*rest, text]]).schema, *[StructField(n, t) for n, t in zip(names, kinds)]])
    return joined.mapInArrow(cut, shape).select(*[F.col(f"`{c}`") for c in [*docs.columns, *names]])
