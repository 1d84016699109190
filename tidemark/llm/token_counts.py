"""Token counts by separator scan.

A corpus of token files holds documents one after another, each ended by a separator id,
with no index. Files come as blocks of raw little-endian ids that cut documents anywhere.
Each block is searched for separators with numpy; what a block says about its borders
(ids, separators, ids after its last separator) is a small row, and a prefix scan over
those rows gives every block the number of documents before it and the length of the
document that it finds open.

Defined cases: two separators in a row are an empty document; ids after a file's last
separator are a document that is not ended (`ended` false); an empty file has no documents;
a null block is an empty one. Texts may be of any length, runs of one character included.
"""

from __future__ import annotations

import functools
from typing import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .store import Scratch

BLOCK_IDS = 1 << 18
WIDE = 1024
LONG_RUN = 10_000
AHEAD = r"\s+(?!\S)"


@functools.lru_cache(4)
def encoder(path: str, pattern: str):
    """A byte-pair encoder from a public rank file: one token (base64) and rank a line."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ids_of(text: str, path: str, pattern: str, long: int = LONG_RUN) -> list[int]:
    """The ids of a text of any length.

    The rule for white space looks ahead and would need a stack as deep as a run is long, so runs of `long`
    and more are cut out. By that rule such a run is one piece up to its last character,
    which begins the next piece, or altogether where the text ends: the ids are those of the whole text.
    """
    enc, out, at = encoder(path, pattern), [], 0
    if len(text) >= long and AHEAD in pattern:
        for run in regex.finditer(rf"\p{{White_Space}}{{{long},}}", text):
            end = run.end() - (run.end() < len(text))
            out += enc.encode_ordinary(text[at : run.start()])
            out += encoder(path, r"\s+").encode_ordinary(text[run.start() : end])
            at = end
    out += enc.encode_ordinary(text[at:])
    return out


def token_blocks(
    docs: DataFrame, ranks: str, pattern: str, separator: int, text: str = "text", key: str = "doc_id", block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Encode texts to flat token files, one per task: (file, block, ids, keys).

    `ids` are unsigned 16-bit numbers, each document followed by the separator. `keys` is
    provenance that the scan does not use: the keys of the documents ended in the block, in
    order. Separator strings inside a text are ordinary text. A null text has no ids.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        size, keys, block = 0, [], 0
        names = ["file", "block", "ids", "keys"]

        def row(ids: np.ndarray) -> pa.RecordBatch:
            cols = [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([ids.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays([*cols, pa.array([keys], pa.list_(key_type))], names)

        key_type = pa.int64()
        for batch in batches:
            texts, names_of = batch.column(0), batch.column(1)
            key_type = names_of.type
            for t, k in zip(texts, names_of):
                got = ids_of(t.as_py() or "", ranks, pattern)
                got.append(separator)
                held.append(np.array(got, np.uint16))
                size += len(got)
                while size >= block_ids:
                    flat = np.concatenate(held)
                    ends = size == block_ids
                    if ends:
                        keys.append(k.as_py())
                    yield row(flat[:block_ids])
                    held, size, keys, block = [flat[block_ids:]], size - block_ids, [], block + 1
                    if ends:
                        break
                else:
                    keys.append(k.as_py())
        if size:
            yield row(np.concatenate(held))

    return docs.select(text, key).mapInArrow(run, f"file long, block long, ids binary, keys array<{kind}>")


def scan(blocks: DataFrame, separator: int, dtype: str = "<u2", keys: str | None = None) -> DataFrame:
    """Documents of the files in `blocks` (file, block, ids): (file, doc, n_tokens, ended),
    with the provenance column's entry as `key` if one is named.

    Blocks are numbered in file order. One pass over the ids; everything after it works on
    one row per block and one number per document.
    """
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n: [] for n in ("n_ids", "lengths", "tail")}
            for raw in batch.column(batch.schema.get_field_index("ids")):
                buf = raw.as_buffer() if raw.is_valid else b""
                ids = np.frombuffer(buf, dtype) if len(buf or b"") >= width else np.zeros(0, dtype)
                at = np.flatnonzero(ids == separator)
                out["n_ids"].append(len(ids))
                out["lengths"].append(np.diff(at, prepend=-1) - 1)
                out["tail"].append(len(ids) - (at[-1] + 1 if len(at) else 0))
            got = [pa.array(out["n_ids"], pa.int64()), pa.array(out["lengths"], pa.list_(pa.int64())), pa.array(out["tail"], pa.int64())]
            keep = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "ids"]
            yield pa.RecordBatch.from_arrays([*keep, *got], [*[n for n in batch.schema.names if n != "ids"], *out])

    carried = ["file", "block", *([keys] if keys else [])]
    kinds = {"n_ids": "long", "lengths": "array<long>", "tail": "long"}
    shape = blocks.select(*carried, *[F.lit(None).cast(t).alias(n) for n, t in kinds.items()]).schema
    found = Scratch(blocks.sparkSession).keep(blocks.select(*carried, "ids").mapInArrow(run, shape))

    # prefix scan in two levels: inside runs of WIDE blocks, then over the runs of a file.
    # state of a stretch: documents ended in it, ids after its last separator, any separator
    light = found.select("file", "block", F.floor(F.col("block") / WIDE).alias("run"), F.size("lengths").alias("n"), "tail", "n_ids")
    light = light.withColumn("cut", F.col("n") > 0)

    def before(rows: DataFrame, part: list[str], order: str) -> DataFrame:
        """Per row, of all rows before it in its part: documents `d0`, open ids `open`, any separator `some`."""
        past = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        ids = rows.withColumn("ids0", F.coalesce(F.sum("n_ids").over(past), F.lit(0)))
        last = F.last(F.when(F.col("cut"), F.col("ids0") + F.col("n_ids") - F.col("tail")), ignorenulls=True).over(past)
        return ids.select(
            *rows.columns, F.coalesce(F.sum("n").over(past), F.lit(0)).alias("d0"),
            (F.col("ids0") - F.coalesce(last, F.lit(0))).alias("open"), last.isNotNull().alias("some"),
        )

    inner = before(light, ["file", "run"], "block")
    end = F.max_by(F.struct((F.col("d0") + F.col("n")).alias("n"), F.when(F.col("cut"), F.col("tail")).otherwise(F.col("open") + F.col("n_ids")).alias("tail"), (F.col("some") | F.col("cut")).alias("cut")), "block")
    runs = inner.groupBy("file", "run").agg(end.alias("e"), F.sum("n_ids").alias("n_ids")).select("file", "run", "e.*", "n_ids")
    outer = before(runs, ["file"], "run").select("file", "run", F.col("d0").alias("d1"), F.col("open").alias("open1"))
    carry = inner.join(outer, ["file", "run"]).select(
        "file", "block", (F.col("d0") + F.col("d1")).alias("first"), (F.col("open") + F.when(F.col("some"), 0).otherwise(F.col("open1"))).alias("open")
    )
    whole = found.join(carry, ["file", "block"])
    each = F.posexplode("lengths").alias("i", "length")
    picked = [F.get(F.col(keys), F.col("i")).alias("key")] if keys else []
    ended = whole.select("file", "first", "open", *([keys] if keys else []), each).select(
        "file", (F.col("first") + F.col("i")).alias("doc"), (F.col("length") + F.when(F.col("i") == 0, F.col("open")).otherwise(0)).alias("n_tokens"), F.lit(True).alias("ended"), *picked
    )
    tail = F.col("tail") + F.when(F.size("lengths") == 0, F.col("open")).otherwise(0)
    rest = whole.groupBy("file").agg(F.max_by(F.struct((F.col("first") + F.size("lengths")).alias("doc"), tail.alias("n_tokens")), "block").alias("e"))
    rest = rest.select("file", "e.*", F.lit(False).alias("ended")).where("n_tokens > 0")
    return ended.unionByName(rest, allowMissingColumns=True)
