"""Phrase collocation mining with stripes.

A stripe is a prefix of words with a counter of the words that follow it. Tasks build the
stripes of a few MB of text, emit one row a stripe, and rows of one prefix are merged
elementwise where they meet. The merged stripes hold everything that the scores need: an
entry is a phrase one word longer and its count, the sum of a stripe is the count of its
prefix, the largest entry is the best extension to the right, and the largest entry by
phrase without its first word is the best extension to the left. The stripe of no word counts
the words of a language.

A phrase is no more frequent than its parts, and most phrases are rare. Before stripes are
built, tasks count hashes of phrases, cut to `SLOT_BITS` bits, by length: words, then pairs of words that may be
frequent, then longer phrases of such pairs. Slots that reach the least count set a bit in
an array of fixed size, which all tasks get. Where a phrase has no bit, it is rare for sure: it gets no
stripe, and as an extension it goes, like the end of a piece, under the null entry, which keeps the
stripe's sum whole. A bit set by chance costs work and changes nothing.

A task adds up its stripes over all of its text, as far as `HELD` entries go, and packs them by
bucket into rows. A stripe is kept in `SEGMENTS` parts by the hash of the next word, each in a bucket
of its own, so that no task holds the counter of a whole vocabulary. Sums, scores and subsumption are joins and aggregates of the
frequent entries only.

Defined cases: a null or empty text has no words; a null language is `und`, as if it were
written so; rows are counted one by one, so repeated rows count as often as they stand;
other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .store import Scratch, parts
from .words import LOWER, mix, pieces

HARD = np.zeros(256, bool)
HARD[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
GAP = HARD.copy()
GAP[[0x20, 0x09]] = True
NO_LANGUAGE = "und"
SEGMENTS = 64
SLOT_BITS, BLOCK_BITS, SHARED = 32, 20, 64
PIECE_BYTES = 8 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
BUCKETS = 4096
HELD = 1 << 21
SHAPE = "bucket int, langs array<string>, prefixes array<string>, sizes array<int>, words array<string>, counts array<long>"
ENTRY = pa.schema([("bucket", pa.int32()), ("lang", pa.large_string()), ("prefix", pa.large_string()), ("word", pa.large_string()), ("count", pa.int64())])
MERGED = "lang string, prefix string, total long, words array<string>, counts array<long>"


def word_hash(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def extended(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of its prefix and that of its last word."""
    return mix(before * STEP + word)


def slot_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = slot_of(h) // SHARED
    return bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1


def dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and each entry's place among them."""
    e = pa.array(keys).dictionary_encode()
    return e.dictionary.to_numpy(zero_copy_only=False), e.indices.to_numpy(zero_copy_only=False)


class Tokens:
    """The words of a buffer of texts: codes into a vocabulary, and where pieces end."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        n = len(data)
        word = ~GAP[data]
        first = np.zeros(n + 1, bool)
        first[at] = True
        left, right = np.ones(n, bool), np.ones(n, bool)
        left[1:], right[:-1] = ~word[:-1], ~word[1:]
        start = np.flatnonzero(word & (left | first[:n]))
        end = np.flatnonzero(word & (right | first[1:])) + 1
        offsets = np.zeros(len(start) + 1, np.int64)
        np.cumsum(end - start, out=offsets[1:])
        joined = np.ascontiguousarray(LOWER[data[word]])
        texts = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
        coded = texts.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.searchsorted(at, start, "right") - 1
        stops = np.cumsum(HARD[data])[start] if n else np.zeros(0, np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (self.row[1:] != self.row[:-1]) | (stops[1:] != stops[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(start)))
        self.left = np.repeat(begin + size, size) - np.arange(len(start))


def grams(t: Tokens, language: pa.Array, known: dict[int, np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first words, hashes) of the phrases of 1 to `longest` words that may be frequent, judged
    by the bit arrays in `known` (by size) and by their parts."""
    hashes, named = word_hash(t.vocabulary), language.dictionary_encode()
    h = word_hash(named.dictionary)[named.indices.to_numpy(zero_copy_only=False)[t.row]]
    at, alive = np.arange(len(t.code)), np.ones(len(t.code) + 1, bool)
    for size in range(1, longest + 1):
        fits = (t.left[at] >= size) & alive[at + 1] if size > 1 else np.ones(len(at), bool)
        at = at[fits]
        h = extended(h[fits], hashes[t.code[at + size - 1]])
        if size in known:
            keep = has(known[size], h)
            at, h = at[keep], h[keep]
        alive = np.zeros(len(t.code) + 1, bool)
        alive[at] = True
        yield size, at, h


def tokens_of(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[Tokens, pa.Array]]:
    """The tokens of a few MB of (lang, text) at a time, with the languages of their texts."""
    for batch in batches:
        for rows, data, at in pieces(batch, "text", limit):
            for some, where in parts_of(data, at, limit):
                t = Tokens(some, where)
                if len(t.code):
                    yield t, rows.column(0).cast(pa.large_string())


def slot_counts(docs: DataFrame, sizes: list[int], known, limit: int) -> DataFrame:
    """(block, slots, counts): how often the hash slots of phrases of these sizes occur, packed by
    block of slots; one row a block and buffer of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, language in tokens_of(batches, limit):
            for size, _, h in grams(t, language, known.value, sizes[-1]):
                if size not in sizes or not len(h):
                    continue
                slots = np.sort(slot_of(h))
                first = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))
                counts, slots = np.diff(np.append(first, len(slots))).astype(np.int32), slots[first]
                block = slots >> BLOCK_BITS
                row = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                offsets = pa.array(np.append(row, len(slots)).astype(np.int32))
                low = (slots & ((1 << BLOCK_BITS) - 1)).astype(np.int32)
                number = (size << (SLOT_BITS - BLOCK_BITS)) + block[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(low)), pa.ListArray.from_arrays(offsets, pa.array(counts))],
                    ["block", "slots", "counts"],
                )

    return docs.select("lang", "text").mapInArrow(run, "block int, slots array<int>, counts array<int>")


def frequent_blocks(counted: DataFrame, least: int) -> DataFrame:
    """(block, bits): a bit for every `SHARED` neighbouring slots of which one reaches `least`."""
    wide = 1 << BLOCK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, now, touched, held = np.zeros(wide, np.int64), None, [], 0

        def closed() -> pa.RecordBatch:
            used = np.concatenate(touched)
            bits = np.zeros(wide // SHARED, bool)
            bits[used[sums[used] >= least] // SHARED] = True
            sums[used] = 0
            found = [np.packbits(bits, bitorder="little").tobytes()] if bits.any() else []
            return pa.RecordBatch.from_arrays([pa.array([now] * len(found), pa.int32()), pa.array(found, pa.binary())], ["block", "bits"])

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            begin = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
            for lo, hi in zip(begin, np.append(begin, len(blocks))[1:]):
                if now is not None and blocks[lo] != now:
                    yield closed()
                    touched, held = [], 0
                now = int(blocks[lo])
                part = batch.slice(lo, hi - lo)
                slots = part.column(1).flatten().to_numpy()
                np.add.at(sums, slots, part.column(2).flatten().to_numpy())
                touched.append(slots)
                held += len(slots)
                if held > 2 * wide:
                    touched = [np.unique(np.concatenate(touched))]
                    held = len(touched[0])
        if now is not None:
            yield closed()

    return counted.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block int, bits binary")


def bit_arrays(docs: DataFrame, longest: int, least: int, limit: int) -> dict[int, np.ndarray]:
    """For phrases of 1 to `longest` words an array of 2^SLOT_BITS / SHARED bits: what may be frequent."""
    context, known = docs.sparkSession.sparkContext, {}
    bytes_each = 1 << (BLOCK_BITS - 3)
    bytes_each //= SHARED
    for sizes in ([1], [2], list(range(3, longest + 1))):
        sizes = [s for s in sizes if s <= longest]
        if not sizes:
            continue
        shared = context.broadcast(dict(known))
        got = frequent_blocks(slot_counts(docs, sizes, shared, limit), least).toArrow()
        known |= {s: np.zeros(bytes_each << (SLOT_BITS - BLOCK_BITS), np.uint8) for s in sizes}
        for block, bits in zip(got.column("block").to_pylist(), got.column("bits")):
            size, block = divmod(block, 1 << (SLOT_BITS - BLOCK_BITS))
            known[size][block * bytes_each : (block + 1) * bytes_each] = np.frombuffer(bits.as_buffer(), np.uint8)
        shared.unpersist()
    return known


def local_stripes(t: Tokens, language: pa.Array, known: dict[int, np.ndarray], longest: int) -> Iterator[pa.Table]:
    """The entries of the stripes of no word to `longest` - 1 words of one buffer. `language`: a name per text."""
    wide = len(t.vocabulary) + 1
    hashes = word_hash(t.vocabulary)
    ids = language.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[t.row]
    before = np.arange(len(t.code))
    for size, at, _ in grams(t, language, known, longest):
        goes = np.zeros(len(t.code), bool)
        goes[at] = True
        after = np.full(len(before), -1, np.int64)
        after[goes[before]] = t.code[before[goes[before]] + size - 1]
        yield stripe_entries(t, language, hashes, size - 1, before, ids[before], after)
        _, place = dense(ids[at] * wide + t.code[at + size - 1])
        ids = np.full(len(t.code), -1, np.int64)
        ids[at] = place
        before = at
        if not len(at):
            return


def stripe_entries(t: Tokens, language: pa.Array, hashes: np.ndarray, size: int, at: np.ndarray, prefix: np.ndarray, after: np.ndarray) -> pa.Table:
    """The entries of stripes, from places: the first word, the number of the prefix and the next
    word's code (-1 for none)."""
    wide = len(hashes) + 1
    keys, place = dense(prefix * wide + after + 1)
    counts = np.bincount(place, minlength=len(keys))
    prefix_of, word_of = keys // wide, keys % wide - 1
    whose = np.zeros(int(prefix.max()) + 1 if len(prefix) else 0, np.int64)
    whose[prefix] = at
    begin = whose[prefix_of]
    named = language.dictionary_encode()
    h = word_hash(named.dictionary)[named.indices.to_numpy(zero_copy_only=False)[t.row[begin]]]
    for i in range(size):
        h = extended(h, hashes[t.code[begin + i]])
    segment = np.where(word_of < 0, np.uint64(0), hashes[word_of] % np.uint64(SEGMENTS))
    bucket = (mix(h + segment) % np.uint64(BUCKETS)).astype(np.int32)
    names = [t.vocabulary.take(pa.array(t.code[begin + i])) for i in range(size)]
    written = pc.binary_join_element_wise(*names, pa.scalar(" ", pa.large_string())) if size else pa.array([""] * len(keys), pa.large_string())
    word = t.vocabulary.take(pa.array(word_of, mask=word_of < 0))
    return pa.table([pa.array(bucket), language.take(pa.array(t.row[begin])), written, word, pa.array(counts)], schema=ENTRY)


class Counters:
    """Entries of many stripes, added up whenever they have doubled."""

    def __init__(self):
        self.parts, self.size, self.known = [], 0, 1 << 18

    def add(self, entries: pa.Table) -> None:
        self.parts.append(entries)
        self.size += len(entries)
        if self.size > 2 * self.known:
            self.parts = [self.summed()]
            self.size = len(self.parts[0])
            self.known = max(self.known, self.size)

    def summed(self) -> pa.Table:
        whole = pa.concat_tables(self.parts) if self.parts else ENTRY.empty_table()
        got = whole.group_by(["bucket", "lang", "prefix", "word"], use_threads=False).aggregate([("count", "sum")])
        return got.rename_columns({"count_sum": "count"}).select(ENTRY.names).combine_chunks()


def runs(*columns: pa.Array) -> np.ndarray:
    """Where the rows of sorted columns begin a new value."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def flat(table: pa.Table, name: str) -> pa.Array:
    c = table.column(name).combine_chunks()
    return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c


def packed_stripes(entries: pa.Table) -> Iterator[pa.RecordBatch]:
    """One row a bucket: its stripes, each with its number of entries, and their entries."""
    if not len(entries):
        return
    entries = entries.sort_by([("bucket", "ascending"), ("lang", "ascending"), ("prefix", "ascending")])
    bucket, lang, prefix, word, count = (flat(entries, n) for n in ENTRY.names)
    stripe, row = runs(bucket, lang, prefix), runs(bucket)
    sizes = np.diff(np.append(stripe, len(entries))).astype(np.int32)
    own = pa.array(np.append(np.searchsorted(stripe, row), len(stripe)).astype(np.int32))
    every = pa.array(np.append(row, len(entries)).astype(np.int32))
    at = pa.array(stripe)
    lists = [pa.ListArray.from_arrays(own, x) for x in (lang.take(at).cast(pa.string()), prefix.take(at).cast(pa.string()), pa.array(sizes))]
    lists += [pa.ListArray.from_arrays(every, x) for x in (word.cast(pa.string()), count)]
    whole = pa.RecordBatch.from_arrays([bucket.take(pa.array(row)), *lists], ["bucket", "langs", "prefixes", "sizes", "words", "counts"])
    for lo in range(0, whole.num_rows, 512):
        yield whole.slice(lo, 512)


def parts_of(data: np.ndarray, at: np.ndarray, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A buffer of texts as it is, or one over-long text cut where a piece ends, so that no
    phrase is cut: (bytes, offsets)."""
    if len(at) > 2 or len(data) <= limit:
        return [(data, at)]
    stops = np.flatnonzero(HARD[data])
    near = np.searchsorted(stops, np.arange(limit, len(data), limit))
    cuts = np.unique(np.concatenate([[0], stops[near[near < len(stops)]], [len(data)]]))
    return [(data[a:b], np.array([0, b - a])) for a, b in zip(cuts[:-1], cuts[1:])]


def stripes(docs: DataFrame, longest: int, known, limit: int, most: int) -> DataFrame:
    """Partial stripes of no word to `longest` - 1 words of (lang, text). `known`: a broadcast of bit
    arrays; a task holds up to about `most` entries before it emits them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counters()
        for t, language in tokens_of(batches, limit):
            for entries in local_stripes(t, language, known.value, longest):
                held.add(entries)
                if held.size > most:
                    yield from packed_stripes(held.summed())
                    held = Counters()
        yield from packed_stripes(held.summed())

    return docs.select("lang", "text").mapInArrow(run, SHAPE)


def merge(partial: DataFrame, least: int) -> DataFrame:
    """Stripes merged elementwise, bucket by bucket as they pass in sorted order: for each prefix (and
    bucket) the sum of all entries, and the entries of at least `least`. A task holds one bucket's
    distinct entries."""

    def merged(bucket: Counters) -> pa.RecordBatch:
        entries = bucket.summed().sort_by([("lang", "ascending"), ("prefix", "ascending")])
        lang, prefix, word, count = (flat(entries, n) for n in ENTRY.names[1:])
        counts, stripe = count.to_numpy(), runs(lang, prefix)
        total = np.add.reduceat(counts, stripe)
        keep = np.flatnonzero((counts >= least) & ~word.is_null().to_numpy(zero_copy_only=False))
        offsets = pa.array(np.searchsorted(keep, np.append(stripe, len(counts))).astype(np.int32))
        at = pa.array(stripe)
        lists = [pa.ListArray.from_arrays(offsets, x) for x in (word.take(pa.array(keep)).cast(pa.string()), pa.array(counts[keep]))]
        return pa.RecordBatch.from_arrays([lang.take(at).cast(pa.string()), prefix.take(at).cast(pa.string()), pa.array(total), *lists], ["lang", "prefix", "total", "words", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Counters()
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, (langs, prefixes, sizes, words, counts) = batch.column(0)[i].as_py(), (batch.column(c)[i].values for c in range(1, 6))
                if bucket != now and now is not None:
                    yield merged(held)
                    held = Counters()
                now = bucket
                stripe = pa.array(np.repeat(np.arange(len(sizes)), sizes.to_numpy()))
                named = [x.take(stripe).cast(pa.large_string()) for x in (langs, prefixes)]
                held.add(pa.table([pa.array(np.full(len(words), bucket, np.int32)), *named, words.cast(pa.large_string()), counts], schema=ENTRY))
        if now is not None:
            yield merged(held)

    return partial.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, MERGED)


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 5, least: int = 100, subsumed_percent: int = 100, top: int = 2000, per: int = 1000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to `longest` words of each language.

    a, l, r: counts of the phrase and of the two parts of its lowest-scoring cut; score:
    floor(per * a * n / (l * r)) with n words in all. A phrase with a longer one around it
    that has at least `subsumed_percent` % of its count is left out.
    """
    scratch = Scratch(docs.sparkSession)
    d = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(f"`{text}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bit_arrays(d, longest, least, PIECE_BYTES))
    merged = scratch.keep(merge(stripes(d, longest, shared, PIECE_BYTES, HELD), least))
    shared.unpersist()
    sizes = merged.where("prefix = ''").groupBy("lang").agg(F.sum("total").alias("n"))
    longer = merged.where("prefix != ''")
    entry = longer.select("lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    found = scratch.keep(entry.select("lang", F.concat_ws(" ", "prefix", "e.words").alias("phrase"), F.col("e.counts").alias("a")))
    sums = scratch.keep(longer.groupBy("lang", F.col("prefix").alias("part")).agg(F.sum("total").alias("f"), F.max(F.array_max("counts")).alias("right")))

    # the best extensions, by phrase
    tail = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    left = found.groupBy("lang", tail.alias("phrase")).agg(F.max("a").alias("left"))
    right = sums.select("lang", F.col("part").alias("phrase"), "right")
    around = F.greatest(F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0)))
    alone = found.join(left, ["lang", "phrase"], "left").join(right, ["lang", "phrase"], "left").where(100 * around < subsumed_percent * F.col("a"))

    words = alone.select("lang", "phrase", "a", F.split("phrase", " ").alias("w"))
    cut = words.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"), F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("rest"))
    cut = cut.join(sums.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(sums.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(sizes, "lang")
    # products of 38 digits, divided exactly
    score = F.expr(f"(cast({per} * a AS decimal(19,0)) * cast(n AS decimal(18,0))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*")

    # the first rows of each language: by salt first, so that no task sorts a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(parts(docs.sparkSession))))
    near = salted.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("at") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
