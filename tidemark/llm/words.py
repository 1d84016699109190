"""Words, lines and n-grams of many texts at once, as numpy arrays over their UTF-8 bytes.

A batch of texts is one byte buffer with offsets. Words are runs of bytes outside a
separator set. Hashes are polynomials modulo two primes taken from prefix sums, so that the
hash of any run of bytes (or of word hashes) costs a few look-ups; a final mixing step
spreads the bits. (Modulo a power of two, some regular texts would collide for every base.) Equal runs have equal hashes in every task and on every machine.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
PRIMES = (2147483647, 2147483629)
BASES = (1315423911, 987654323)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 21

_powers: dict[int, np.ndarray] = {}
_modular: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; grown on demand."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 4096), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective bit mixing of 64-bit numbers, in place on a copy."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def modular(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo a prime below 2^31; grown on demand by doubling."""
    have = _modular.get((base, prime), np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), prime)) % np.uint64(prime)])
    _modular[base, prime] = have
    return have[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums, a row a prime: entry i covers the first i values."""
    out = np.zeros((len(PRIMES), len(values) + 1), np.uint64)
    for row, base, prime in zip(out, BASES, PRIMES):
        np.cumsum(values % np.uint64(prime) * modular(base, prime, len(values)) % np.uint64(prime), out=row[1:])
    return out


def run_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs [start, end) of what `sums` was made from."""
    out = np.zeros(len(start), np.uint64)
    for row, base, prime in zip(sums, BASES, PRIMES):
        back = modular(pow(base, -1, prime), prime, sums.shape[1])
        out = out << np.uint64(31) | (row[end] - row[start]) % np.uint64(prime) * back[start] % np.uint64(prime)
    return mix(out)


def sampling_hash(data: np.ndarray, k: int) -> np.ndarray:
    """A cheap hash of every k neighbouring bytes, modulo 2^64: to choose places and to deal rows
    out, where unequal bytes of one hash do no harm."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * powers(INVERSE, len(sums))[: len(sums) - k])


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with at most `limit` text bytes (or one row), as (rows, bytes, offsets)."""
    col = batch.column(batch.schema.get_field_index(column))
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if len(col) and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(col):
        last = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield batch.slice(row, last - row), data[at[row] : at[last]], at[row : last + 1] - at[row]
        row = last


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values (numbers or flags) over each row's range."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


class Words:
    """Words of a batch: byte ranges, hashes, and each row's first word."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool, sums: np.ndarray | None = None):
        n = len(data)
        self.gap = SPACE[data]
        before, after = np.ones(n + 1, bool), np.ones(n + 1, bool)
        before[1:n] = self.gap[:-1] if n else False
        after[: n - 1] = self.gap[1:] if n else False
        before[at[:-1]] = True
        after[at[1:][at[1:] > 0] - 1] = True
        self.start = np.flatnonzero(~self.gap & before[:n])
        self.end = np.flatnonzero(~self.gap & after[:n]) + 1
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)
        self.sums = prefix((LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)) if sums is None else sums
        self.hash = run_hash(self.sums, self.start, self.end)
        self.row = np.repeat(np.arange(len(at) - 1), self.count)

    def grams(self, k: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of k words inside a row; `sums` is prefix(self.hash)."""
        first = np.arange(max(0, len(self.hash) - k + 1))
        first = first[self.row[first] == self.row[first + k - 1]] if len(first) else first
        return first, run_hash(sums, first, first + k)


def again(keys: np.ndarray) -> np.ndarray:
    """Which entries have an equal one elsewhere in the array."""
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    return np.isin(keys, twice) if len(twice) else np.zeros(len(keys), bool)


def covered(n: int, first: np.ndarray, length: int) -> np.ndarray:
    """Flags of n places inside any of the runs that begin at `first`."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + length, -1)
    return np.cumsum(steps[:-1]) > 0
