"""Quality rules by repetition coverage.

For each text, rolling hashes of several n-gram lengths find n-grams and lines that occur
more than once; what counts is the share of the text's characters they cover, so that
overlapping and repeated n-grams are counted once. All measures of a text come from the
text alone: there is no shuffle, and a task holds a few MB of text at a time.

Defined cases: a null text has no words, like an empty one, and fails the base rule;
rows are judged one by one, so repeated rows get equal results; extra columns pass through.
"""

from __future__ import annotations

from typing import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .store import aside
from .words import Words, again, covered, mix, pieces, prefix, row_sums, run_hash

# highest share of characters in duplicated n-grams, by n, and in duplicated lines
NGRAM_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_SHARE = 0.20
RESULTS = ("measures", "base_failed", "kept")
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_share double, dup_gram_shares array<double>"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def measure(data: np.ndarray, at: np.ndarray, lengths: tuple[int, ...]) -> list:
    """The measures of each text of a byte buffer, one array per column."""
    w = Words(data, at, lower=False)
    chars = (data & 0xC0) != 0x80
    inside = chars & ~w.gap
    own = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=own[1:])
    word_chars = own[at[1:]] - own[at[:-1]]
    size = own[w.end] - own[w.start]

    # lines: their ends are newlines and the ends of texts
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([at[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    stop = np.append(begin[1:], len(data))
    stop = np.where((stop > begin) & (data[stop - 1] == 10), stop - 1, stop) if len(begin) else stop
    line_row = np.searchsorted(at, begin, "right") - 1
    worded = own[stop] > own[begin]
    begin, stop, line_row = begin[worded], stop[worded], line_row[worded]
    key = run_hash(w.sums, begin, stop) ^ mix(line_row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    later = np.zeros(len(key), bool)
    later[order[1:]] = key[order[1:]] == key[order[:-1]]
    line_chars = own[stop] - own[begin]
    rows = len(at) - 1
    dup_lines = np.bincount(line_row[later], minlength=rows)
    line_share = np.bincount(line_row[later], line_chars[later], minlength=rows) / np.maximum(word_chars, 1)

    sums, salt = prefix(w.hash), mix(w.row.astype(np.uint64) + np.uint64(7))
    shares, repeat = [], np.zeros(rows, np.int64)
    for k in sorted({*lengths, WINDOW}):
        first, gram = w.grams(k, sums)
        twice = again(gram ^ salt[first])
        inside = covered(len(w.hash), first[twice], k)
        if k == WINDOW:
            repeat = row_sums(inside, w.first)
        if k in lengths:
            shares.append(row_sums(inside * size, w.first) / np.maximum(word_chars, 1))
    return [
        w.count, word_chars, row_sums(SYMBOLS[data], at), dup_lines, repeat, line_share,
        list(np.stack(shares, 1)) if shares else [[]] * rows,
    ]


def repetition(docs: DataFrame, text: str = "text", lengths: tuple[int, ...] = tuple(NGRAM_SHARE)) -> DataFrame:
    """The rows of `docs` with a struct column `measures`: counts of words, characters,
    symbols, later copies of lines, words in repeated windows, and the shares of characters
    covered by duplicated lines and by duplicated n-grams of each length."""
    docs = aside(docs, RESULTS)
    schema = docs.select(F.lit(None).cast(f"struct<{MEASURES.replace(' ', ':').replace(',:', ',')}>").alias("measures")).schema
    names = [f.name for f in schema["measures"].dataType.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, at in pieces(batch, text):
                cols = measure(data, at, lengths)
                kinds = [pa.int64()] * 5 + [pa.float64(), pa.list_(pa.float64())]
                got = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
                yield pa.RecordBatch.from_arrays([*rows.columns, got], [*rows.schema.names, "measures"])

    return docs.mapInArrow(run, StructType([*docs.schema, schema["measures"]]))


def judge(measured: DataFrame, shares: Mapping[int, float] = NGRAM_SHARE, line_share: float = LINE_SHARE) -> DataFrame:
    """Add `base_failed` and `kept`. A text fails the base rule with under 20 words or over
    30 % of its words in repeated windows; the verdict of the method also needs every
    coverage at or below its limit. Call with the lengths that `repetition` was given."""
    m = F.col("measures")
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    over = m["dup_line_share"] > line_share
    for i, k in enumerate(sorted(shares)):
        over = over | (F.get(m["dup_gram_shares"], i) > shares[k])
    return measured.withColumns({"base_failed": base, "kept": ~(base | over)})
