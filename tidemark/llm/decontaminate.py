"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A benchmark item's windows (13 consecutive words, or all words of a shorter item) are
looked for in documents. A window is a set of word shingles. A document holds the window
only if it holds all its shingles, so by the prefix principle for full containment one
necessary shingle is enough to find every candidate, and the rarest one in the corpus
gives the fewest. Where that shingle stands in the document fixes where the window would
begin (positional bound), the window must end inside the document (length bound), and the
words themselves are then compared.

The corpus is cut into shingles once; positions whose shingle occurs in the benchmark are
kept with the words around them, and rarity counts, candidates and comparison all come
from that table. Nothing is grouped but a document's own windows.

Defined cases: null and empty texts have no words and no windows; items without words are
no items, those with a null id are hit but not named; documents are told apart by key and text, so repeated rows get equal results;
an empty table on either side gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import Scratch, aside, free_name

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# the same words before lower-casing
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RESULTS = ("n_words", "n_hit", "items")
SPAN = 13
SHINGLE = 4
BROADCAST_ROWS = 500_000


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, SMALL))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def shingle_hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + i) for i in range(k)])


def item_windows(benchmark: DataFrame, item: str, text: str, span: int, k: int) -> DataFrame:
    """Distinct windows: words, m (their number), items (ids as strings)."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("all")).where(F.size("all") > 0)
    m = F.least(F.lit(span), F.size("all"))
    starts = items.select("item", "all", m.alias("m"), F.explode(F.sequence(F.lit(0), F.size("all") - m)).alias("s"))
    cut = starts.select("item", "m", F.slice("all", F.col("s") + 1, F.col("m")).alias("words"))
    return cut.groupBy("words", "m").agg(F.collect_set("item").alias("items"))


def met_apart(scratch: Scratch, source: DataFrame, at: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of `at` whose shingle is wanted, where a large benchmark meets the documents in a
    shuffle: only keys, positions and hashes move, and words come from the document, read once
    more, for the positions that stay (a document's own, as a list)."""
    stay = scratch.keep(at.select("k", "t", "p", "h").distinct().join(wanted, "h"))
    by_text = stay.groupBy("k", "t").agg(F.collect_list(F.struct("p", "h")).alias("ph"))
    same = source["k"].eqNullSafe(by_text["k"]) & (source["t"] == by_text["t"])
    # repeated rows have the same key and text: one of them gives the words
    words = source.join(by_text, same).select(source["k"], source["t"], "w", "ph").groupBy("k", "t").agg(F.first("w").alias("w"), F.first("ph").alias("ph"))
    return words.select("k", "t", "w", F.inline("ph"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    span: int = SPAN, shingle: int = SHINGLE,
) -> DataFrame:
    """The rows of `docs` with `n_words`, `n_hit` (words inside any occurrence of a window) and
    `items` (sorted ids, as strings, of the items with occurring windows)."""
    docs = aside(docs, RESULTS)
    scratch = Scratch(docs.sparkSession)
    windows = scratch.keep(item_windows(benchmark, item, item_text, span, shingle))
    size = F.least(F.lit(shingle), F.col("m"))
    offset = F.explode(F.sequence(F.lit(0), F.col("m") - size)).alias("o")
    hashes = F.coalesce(*[F.when(size == k, shingle_hash(F.col("words"), F.col("o"), k)) for k in range(1, shingle + 1)])
    tokens = windows.select("words", "m", "items", offset).withColumn("h", hashes)
    lengths = [r["k"] for r in windows.select(size.alias("k")).distinct().collect()]  # at most `shingle` numbers
    wanted = scratch.keep(tokens.select("h").distinct())
    few = wanted.count() <= BROADCAST_ROWS

    # positions of benchmark shingles in documents, each with the words around it
    reach, back = 2 * span - shingle, F.greatest(F.lit(0), F.col("p") - (span - 1))
    around = F.slice("w", back + 1, F.lit(reach + shingle)).alias("around")
    source = docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("t"), words_of(F.col(f"`{text}`")).alias("w"))
    hits = None
    for k in lengths or [shingle]:
        at = source.where(F.size("w") >= k).select("k", "t", "w", F.posexplode("w").alias("p", "word"))
        at = at.where(F.col("p") + k <= F.size("w")).withColumn("h", shingle_hash(F.col("w"), F.col("p"), k))
        out = ["k", "t", "p", "h", F.size("w").alias("n"), back.alias("from"), around]
        # a small benchmark is sent to the documents
        got = at.join(F.broadcast(wanted), "h").select(*out) if few else met_apart(scratch, source, at, wanted).select(*out)
        hits = got if hits is None else hits.unionByName(got)
    hits = scratch.keep(hits)

    rarity = hits.groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    rarest = F.min_by(F.struct("h", "o"), F.struct("c", "h", "o"))
    ranked = tokens.join(rarity, "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    prefix = ranked.groupBy("words", "m", "items").agg(rarest.alias("r"), F.min("c").alias("c")).where("c > 0")
    prefix = scratch.keep(prefix.select("words", "m", "items", "r.h", "r.o"))

    start = F.col("p") - F.col("o")
    found = hits.join(prefix, "h").where((start >= 0) & (start + F.col("m") <= F.col("n")))
    found = found.where(F.slice("around", start - F.col("from") + 1, F.col("m")) == F.col("words"))
    found = scratch.keep(found.select("k", "t", start.alias("s"), (start + F.col("m")).alias("e"), "items"))

    spans = found.groupBy("k", "t", "s").agg(F.max("e").alias("e"))
    past = Window.partitionBy("k", "t").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)  # one document's windows
    fresh = F.greatest(F.lit(0), F.col("e") - F.greatest(F.col("s"), F.coalesce(F.max("e").over(past), F.lit(0))))
    hit = spans.select("k", "t", fresh.alias("fresh")).groupBy("k", "t").agg(F.sum("fresh").cast("long").alias("n_hit"))
    named = found.select("k", "t", F.explode_outer("items").alias("item")).groupBy("k", "t").agg(F.sort_array(F.collect_set("item")).alias("items"))
    per_doc = scratch.keep(hit.join(named, hit["k"].eqNullSafe(named["k"]) & (hit["t"] == named["t"])).select(hit["k"].alias("k__"), hit["t"].alias("t__"), "n_hit", "items"))

    own, count = free_name(docs.columns, "own__"), F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(RAW_WORD)), F.lit(0)).cast("long")
    base = docs.withColumn("n_words", count).withColumn(own, F.xxhash64(F.col(f"`{text}`")))
    joined = base.join(per_doc, base[key].eqNullSafe(per_doc["k__"]) & (base[own] == per_doc["t__"]), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items")
    )
