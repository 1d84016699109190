"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a text's word
shingles. To find all pairs within a few bits, the bits are cut into partitions and each partition
gets a threshold; if the thresholds plus one add up to the distance plus one, two
fingerprints within the distance are within the threshold of at least one partition. The partitions
group correlated bits, greedily by the correlations over all distinct fingerprints, so that what
is common stays in few of them. The thresholds are chosen for every fingerprint by dynamic
programming on its estimated candidates: the fingerprints that share its value in a partition are
counted exactly, those further off are estimated from histograms of sub-partitions. A common value
is then skipped (threshold -1) and a rarer partition is probed wider instead. Every candidate is
verified on all bits inside the join.

Equal fingerprints are one class before anything is compared. Classes are first linked with the
most copied class of each of their values; the join then returns only links between classes that are not
connected yet. Values that many classes share are dealt into parts of bounded size by their
measured count.

Defined cases: a text with fewer words than a shingle has its whole sequence as the only
shingle; one without words, or null, has fingerprint zero and is linked like any other; repeated rows
have equal results; rows with a null key are linked, but name no component, so a component of null
keys alone is null; extra columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

from math import ceil, comb
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .components import components
from .store import Scratch, aside, free_name
from .words import LOWER, SPACE, pieces

RESULTS = ("fingerprint", "component_id")
SHINGLE = 3
SEED = 42
DISTANCE = 3
NARROW = 8
DEALT = 1024
PROBE = 4.0
AT_ONCE = 1 << 15


def shingle_ranges(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words joined by single blanks, the byte range of every shingle in that, and
    how many shingles each text has."""
    n = len(data)
    word = ~SPACE[data]
    first = np.zeros(n + 1, bool)
    first[at] = True
    left, right = np.ones(n, bool), np.ones(n, bool)
    left[1:], right[:-1] = ~word[:-1], ~word[1:]
    start = np.flatnonzero(word & (left | first[:n]))
    size = np.flatnonzero(word & (right | first[1:])) + 1 - start
    begin = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = LOWER[data[word]]
    stop = begin + size
    own = np.searchsorted(start, at)
    count = np.diff(own)
    some = np.flatnonzero(count)
    shingles = np.maximum(count - k + 1, 1) * (count > 0)
    wide = np.minimum(count, k)[some]
    before = np.cumsum(shingles[some]) - shingles[some]
    at_word = np.arange(int(shingles.sum())) + np.repeat(own[:-1][some] - before, shingles[some])
    return joined, begin[at_word], stop[at_word + np.repeat(wide, shingles[some]) - 1], shingles


def fingerprints_of(data: np.ndarray, at: np.ndarray, k: int, seed: int) -> np.ndarray:
    joined, begin, stop, count = shingle_ranges(data, at, k)
    view = memoryview(joined)
    row = np.repeat(np.arange(len(count)), count)
    votes = np.zeros((len(count), 64), np.int64)
    for lo in range(0, len(begin), AT_ONCE):
        part = slice(lo, lo + AT_ONCE)
        h = np.fromiter((xxhash.xxh64_intdigest(view[a:b], seed) for a, b in zip(begin[part].tolist(), stop[part].tolist())), np.uint64)
        whose, first = np.unique(row[part], return_index=True)
        votes[whose] += np.add.reduceat(bits_of(h), first, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > count[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def bits_of(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprinted(docs: DataFrame, text: str, name: str, k: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """`docs` with the fingerprint as a long column `name`, at the end, instead of the text."""
    own = F.col(f"`{text}`").alias(name)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    taken = docs.select(*rest, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in pieces(batch, name):
                got = pa.array(fingerprints_of(data, at, k, seed).view(np.int64))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], got], rows.schema.names)

    return taken.mapInArrow(run, StructType([*taken.schema.fields[:-1], StructField(name, LongType())]))


def co_occurrence(classes: DataFrame) -> np.ndarray:
    """How often two bits are set together, over all fingerprints (64 x 64; the diagonal counts single bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64), np.int64)
        for batch in batches:
            x = bits_of(np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64)).astype(np.float32)
            for lo in range(0, len(x), AT_ONCE):
                total += (x[lo : lo + AT_ONCE].T @ x[lo : lo + AT_ONCE]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel())], ["at", "n"])

    got = classes.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(4096, np.int64)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(64, 64)


def grouped_bits(together: np.ndarray, n: int, groups: int) -> list[list[int]]:
    """Bits in groups of nearly equal width: each group starts with the free bit most correlated with
    the other free ones and takes the one most correlated with its members."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    r = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(r, 0)
    free, out = list(range(64)), []
    for i in range(groups):
        width = 64 // groups + (i < 64 % groups)
        bits = [max(free, key=lambda b: (r[b, free].sum(), -b))]
        free.remove(bits[0])
        while len(bits) < width:
            b = max(free, key=lambda b: (r[b, bits].sum(), -b))
            free.remove(b)
            bits.append(b)
        out.append(sorted(bits))
    return out


def partitions_for(n: int, distance: int) -> int:
    """How many partitions cost least for n fingerprints of independent bits."""

    def cost(parts: int) -> float:
        total = 0.0
        for i in range(parts):
            width, t = 64 // parts, (distance + 1) // parts + (i < (distance + 1) % parts) - 1
            probes = sum(comb(width, e) for e in range(t + 1))
            total += probes * (PROBE + n / 2**width)
        return total

    return min(range(1, distance + 2), key=cost)


def projected(h: np.ndarray, bits: list[int]) -> np.ndarray:
    """The named bits of each fingerprint, packed."""
    out = np.zeros(len(h), np.uint64)
    for i, b in enumerate(bits):
        out |= ((h >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


def halves(bits: list[int]) -> list[list[int]]:
    """Sub-partitions of at most `NARROW` bits."""
    n = ceil(len(bits) / NARROW)
    return [bits[i * len(bits) // n : (i + 1) * len(bits) // n] for i in range(n)]


def sub_histograms(classes: DataFrame, subs: list[list[int]]) -> np.ndarray:
    """How many fingerprints have each value of each sub-partition (one row of 256 each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(subs), 1 << NARROW), np.int64)
        for batch in batches:
            h = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64)
            for i, bits in enumerate(subs):
                total[i] += np.bincount(projected(h, bits).astype(np.int64), minlength=1 << NARROW)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "n"])

    got = classes.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(subs) << NARROW, np.int64)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(len(subs), -1)


def distance_shares(histogram: np.ndarray, n: int, most: int) -> np.ndarray:
    """For each value of a sub-partition the share of fingerprints at distance 0 .. most."""
    v = np.arange(1 << NARROW)
    apart = np.bitwise_count(v[:, None] ^ v)
    return np.stack([(histogram * (apart == e)).sum(1) for e in range(most + 1)], 1) / max(n, 1)


def allocate(cost: np.ndarray, units: int) -> np.ndarray:
    """Thresholds (rows x partitions, -1 for none) of least total cost whose sum plus one each is `units`.

    cost[row, partition, t + 1]: cost of threshold t. Dynamic programming over partitions and units spent.
    """
    rows, parts, _ = cost.shape
    best = np.full((rows, units + 1), np.inf)
    best[:, 0] = 0
    taken = np.zeros((parts, rows, units + 1), np.int8)
    for i in range(parts):
        new = np.full_like(best, np.inf)
        for spent in range(units + 1):
            for t in range(spent + 1):
                c = best[:, spent - t] + cost[:, i, t]
                better = c < new[:, spent]
                new[better, spent] = c[better]
                taken[i, better, spent] = t
        best = new
    out, left = np.zeros((rows, parts), np.int64), np.full(rows, units)
    for i in reversed(range(parts)):
        out[:, i] = taken[i, np.arange(rows), left]
        left -= out[:, i]
    return out - 1


def flips(width: int, t: int) -> np.ndarray:
    """All masks of at most t of `width` bits."""
    masks = {0}
    for _ in range(t):
        masks |= {m | 1 << b for m in masks for b in range(width)}
    return np.array(sorted(masks), np.uint64)


def estimates(h: np.ndarray, groups: list[list[int]], shares: list[list[np.ndarray]], same: np.ndarray, n: int, distance: int) -> np.ndarray:
    """cost[row, partition, t + 1] of probing a partition within t bits: the probes and the
    candidates. `same`: how many fingerprints share the row's value of each partition."""
    cost = np.zeros((len(h), len(groups), distance + 2))
    for i, bits in enumerate(groups):
        total = np.zeros((len(h), distance + 1))
        total[:, 0] = 1
        for sub, share in zip(halves(bits), shares[i]):
            s = share[projected(h, sub).astype(np.int64)]
            total = np.stack([sum(total[:, a] * s[:, e - a] for a in range(e + 1)) for e in range(distance + 1)], 1)
        further = np.cumsum(total, 1) - total[:, :1]
        probes = np.array([sum(comb(len(bits), e) for e in range(t + 1)) for t in range(distance + 1)])
        cost[:, i, 1:] = PROBE * probes + same[:, i : i + 1] + n * further
    return cost


def index_rows(classes: DataFrame, groups: list[list[int]]) -> DataFrame:
    """(part, value, fp, copies): every fingerprint under its value of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64)
            for i, bits in enumerate(groups):
                value = pa.array(projected(h, bits).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), i, np.int32)), value, batch.column(0), batch.column(1)], ["part", "value", "fp", "copies"])

    return classes.select("fp", "copies").mapInArrow(run, "part int, value long, fp long, copies long")


def probe_rows(counted: DataFrame, groups: list[list[int]], shares: list[list[np.ndarray]], n: int, distance: int) -> DataFrame:
    """(part, value, fp, comp): the values that each fingerprint is looked up under, by its own
    thresholds. `counted`: (fp, comp, same), the last one a count per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = {(len(b), t): flips(len(b), t) for b in groups for t in range(distance + 1)}
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                rows = batch.slice(lo, 4096)
                h = np.ascontiguousarray(rows.column(0).to_numpy()).view(np.uint64)
                comp = rows.column(1).to_numpy()
                same = rows.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(h), len(groups))
                limit = allocate(estimates(h, groups, shares, same, n, distance), distance + 1)
                for i, bits in enumerate(groups):
                    value = projected(h, bits)
                    for t in range(distance + 1):
                        at = np.flatnonzero(limit[:, i] == t)
                        mask = masks[len(bits), t]
                        step = max(1, (1 << 18) // len(mask))
                        for b in range(0, len(at), step):
                            some = at[b : b + step]
                            key = (value[some][:, None] ^ mask).ravel()
                            whose = np.repeat(some, len(mask))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(key), i, np.int32)), pa.array(key.view(np.int64)), pa.array(h[whose].view(np.int64)), pa.array(comp[whose])],
                                ["part", "value", "fp", "comp"],
                            )

    return counted.select("fp", "comp", "same").mapInArrow(run, "part int, value long, fp long, comp long")


def links_within(classes: DataFrame, distance: int, scratch: Scratch) -> DataFrame:
    """(a, b): enough of the pairs of distinct fingerprints within `distance` bits to connect all of
    them. `classes`: (fp, copies)."""
    n = classes.count()
    parts = partitions_for(n, distance)
    groups = grouped_bits(co_occurrence(classes), n, parts)
    subs = [s for bits in groups for s in halves(bits)]
    share_of = iter(distance_shares(x, n, distance) for x in sub_histograms(classes, subs))
    shares = [[next(share_of) for _ in halves(bits)] for bits in groups]
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance

    # first round: each class with the most copied class of its values
    index = scratch.keep(index_rows(classes, groups))
    values = scratch.keep(index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("c"), F.max_by("fp", F.struct("copies", "fp")).alias("head")).where("c > 1"))
    heads = index.join(values, ["part", "value"], "left").select("part", "value", "fp", F.coalesce("c", F.lit(1)).alias("c"), "head")
    heads = scratch.keep(heads)
    star = scratch.keep(heads.where((F.col("fp") != F.col("head")) & close("fp", "head")).select(F.col("head").alias("a"), F.col("fp").alias("b")).distinct())
    comps = components(star, scratch).withColumnRenamed("id", "fp")

    # second round: what is not connected yet, each class by its own thresholds
    per = [F.coalesce(F.max(F.when(F.col("part") == i, F.col("c"))), F.lit(1)) for i in range(parts)]
    counted = heads.groupBy("fp").agg(F.array(*per).alias("same")).join(comps, "fp", "left").select("fp", F.coalesce("comp", "fp").alias("comp"), "same")
    counted = scratch.keep(counted)
    dealt = F.ceil(F.col("c") / DEALT)
    there = heads.join(counted.select("fp", "comp"), "fp").select("part", "value", F.col("fp").alias("b"), F.col("comp").alias("comp_b"), F.pmod(F.xxhash64("fp"), dealt).alias("deal"))
    common = values.where(F.col("c") > DEALT).select("part", "value", dealt.alias("deals"))
    asked = probe_rows(counted, groups, shares, n, distance).join(common, ["part", "value"], "left")
    asked = asked.select("part", "value", F.col("fp").alias("a"), "comp", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("deals", F.lit(1)) - 1)).alias("deal"))
    met = asked.join(there, ["part", "value", "deal"]).where((F.col("a") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & close("a", "b"))
    return star.unionByName(scratch.keep(met.select("a", "b").distinct()))


def simhash_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE) -> DataFrame:
    """The rows of `docs`, without their text, with `fingerprint` (16 hexadecimal digits) and `component_id`
    (the smallest key reachable by links of at most `distance` differing bits, the row's own included)."""
    docs = aside(docs, RESULTS)
    scratch = Scratch(docs.sparkSession)
    fp = free_name(docs.columns, "fp")
    rows = scratch.keep(fingerprinted(docs, text, fp, k, seed))
    classes = scratch.keep(rows.groupBy(F.col(fp).alias("fp")).agg(F.count(F.lit(1)).alias("copies"), F.min(F.col(f"`{key}`")).alias("low")))
    comps = components(links_within(classes, distance, scratch), scratch)
    named = scratch.keep(classes.select("fp", "low").join(comps.withColumnRenamed("id", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp")))
    lowest = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    by_class = named.join(lowest, "comp").select(F.col("fp").alias(fp), "component_id")
    out = rows.join(by_class, fp)
    return out.select(*[F.col(f"`{c}`") for c in rows.columns if c != fp], F.lpad(F.lower(F.hex(F.col(fp))), 16, "0").alias("fingerprint"), "component_id")
