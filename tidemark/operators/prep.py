"""Feature preparation: counts, growth, ratios, pruning, encoding, outliers."""

from __future__ import annotations

from typing import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from ..functions import numeric as num
from ..session import cut_lineage
from .order import ranks
from .skew import spread_join

LAGS = ("", "__q1", "__q2", "__m1", "__m2")
MONTHLY = ("__m2", "__m1", "")
QUARTERLY = ("__q2", "__q1", "")


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NumericType)


def drop_like(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Drop columns whose name holds any of the parts."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not any(p in c for p in parts)])


def fill(df: DataFrame, value: float | Mapping[str, float] = -1) -> DataFrame:
    """Fill nulls with a constant, or per column (training means)."""
    return df.fillna(value if not isinstance(value, Mapping) else dict(value))


def training_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """One number per column; bounded by the schema."""
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols if row[c] is not None}


def tech_counts(df: DataFrame, cols: Sequence[str], lags: Sequence[str] = LAGS) -> DataFrame:
    """Per lag: number of non-zero technology columns and their sum."""
    out = []
    for lag in lags:
        held = [F.col(c + lag) for c in cols]
        out += [num.nonzero_count(held).alias("n_tech" + lag), num.row_sum(held).alias("n_repos" + lag)]
    return df.select("*", *out)


def leading(df: DataFrame, cols: Sequence[str], merge: Sequence[str] = (), name: str = "leading_tech") -> DataFrame:
    """Name of the row maximum; the rare names in `merge` become 'else'."""
    top = num.argmax_name(cols, [F.col(c) for c in cols])
    return df.withColumn(name, F.when(top.isin(list(merge)), F.lit("else")).otherwise(top) if merge else top)


def row_std(df: DataFrame, cols: Sequence[str], name: str = "n_tech_std") -> DataFrame:
    return df.withColumn(name, num.row_std([F.col(c) for c in cols]))


def growth(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean relative step over three points, monthly and quarterly, for many features."""
    out = []
    for f in features:
        for label, lags in (("monthly", MONTHLY), ("quarter", QUARTERLY)):
            p = [F.col(f + lag) for lag in lags]
            steps = [num.relative_step(p[0], p[1]), num.relative_step(p[1], p[2])]
            out.append(num.mean_of(steps).alias(f"{f}_{label}_growth"))
    return df.select("*", *out)


def growth_pair(df: DataFrame, feature: str, scheme: str = "monthly", normalize: bool = True, keep_older: bool = False) -> DataFrame:
    """Newer (q1) and older (q2) step and a flag whether growth slowed down."""
    p = [F.col(feature + lag) for lag in (MONTHLY if scheme == "monthly" else QUARTERLY)]
    step = num.relative_step if normalize else (lambda a, b: b - a)
    older, newer = step(p[0], p[1]), step(p[1], p[2])
    out = [newer.alias(f"q1_{feature}_growth"), F.when(newer < older, 1).otherwise(0).alias(f"binary_{feature}")]
    if keep_older:
        out.append(older.alias(f"q2_{feature}_growth"))
    return df.select("*", *out)


def usage_features(df: DataFrame, tech: Sequence[str], usage: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """From the filled matrix to model input: technology counts, growth of every usage
    column, size ratios; earlier windows and the listed columns are dropped."""
    out = growth(tech_counts(df, tech), [*usage, "n_tech", "n_repos"])
    lagged = [lag for lag in LAGS if lag]
    out = out.select(*[c for c in out.columns if not any(c.endswith(lag) for lag in lagged) and c not in drop])
    return out.select(
        "*",
        num.safe_ratio(F.col("artifacts_size"), F.col("binaries_size")).alias("artifacts/binaries_size"),
        num.safe_ratio(F.col("artifacts_count"), F.col("binaries_count")).alias("artifacts/binaries_count"),
    )


def variance_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: population std (numbers) and whether it varies at all.

    A column varies iff min and max differ or nulls mix with values, so no distinct
    count is needed; numbers ignore nulls, categories count a null as a value.
    """
    aggs = []
    for i, c in enumerate(cols):
        q = F.col(f"`{c}`")
        aggs += [F.min(q).alias(f"lo{i}"), F.max(q).alias(f"hi{i}"), F.count(q).alias(f"n{i}")]
        aggs.append((F.stddev_pop(q) if is_numeric(df, c) else F.lit(None).cast("double")).alias(f"sd{i}"))
    one = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = []
    for i, c in enumerate(cols):
        differs = F.coalesce(F.col(f"lo{i}") != F.col(f"hi{i}"), F.lit(False))
        if not is_numeric(df, c):
            differs = differs | ((F.col(f"n{i}") > 0) & (F.col(f"n{i}") < F.col("n")))
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"sd{i}").alias("std"), differs.alias("varies")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def drop_zero_variance(df: DataFrame, exempt: Sequence[str] = ()) -> DataFrame:
    cols = [c for c in df.columns if c not in exempt]
    # column names only
    flat = {r["column"] for r in variance_table(df, cols).where("not varies").collect()}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in flat])


TILE = 64
SUMS = 6


def tile_sums(z: np.ndarray, there: np.ndarray, i: int, j: int) -> np.ndarray:
    """For the column pairs of one tile: rows present in both, sums, squares and products over those."""
    a, b = z[:, i * TILE : (i + 1) * TILE], z[:, j * TILE : (j + 1) * TILE]
    p, q = there[:, i * TILE : (i + 1) * TILE], there[:, j * TILE : (j + 1) * TILE]
    return np.stack([p.T @ q, a.T @ q, p.T @ b, (a * a).T @ q, p.T @ (b * b), a.T @ b])


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r of every column pair (a before b), as rows (a, b, r); gaps (null or NaN) pairwise skipped.

    One way for any number of columns: each task sums, over its rows, tiles of `TILE` x `TILE` pairs
    under masks; tiles of one number are added as they pass in sorted order. No matrix reaches the driver. Columns
    are shifted by their means first, so that large values lose no digits. r is null where a pair has no spread.
    """
    names = list(cols)
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    mean = [F.avg(F.when(~F.isnan(f"x{i}"), F.col(f"x{i}"))).alias(f"x{i}") for i in range(len(names))]
    shift = np.array([v or 0.0 for v in values.agg(*mean).first()])
    tiles = -(-len(names) // TILE)
    numbers = [(i, j) for i in range(tiles) for j in range(i, tiles)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list = [0.0] * len(numbers)
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1) if batch.num_rows else np.zeros((0, len(names)))
            there = (~np.isnan(x)).astype(float)
            z = np.where(there > 0, x - shift, 0.0)
            for t, (i, j) in enumerate(numbers):
                total[t] = total[t] + tile_sums(z, there, i, j)
        for t, v in enumerate(total):
            if isinstance(v, np.ndarray):
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([v.ravel()], pa.list_(pa.float64()))], ["tile", "sums"])

    def pairs(t: int, total: np.ndarray) -> pa.RecordBatch:
        i, j = numbers[t]
        n, a, b, aa, bb, ab = total.reshape(SUMS, min(TILE, len(names) - i * TILE), -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            u, v = aa - a * a / n, bb - b * b / n
            r = (ab - a * b / n) / np.sqrt(u * v)
        r[~((u > 1e-12 * aa) & (v > 1e-12 * bb))] = np.nan
        at, to = np.nonzero(np.ones_like(r))
        ok = at + i * TILE < to + j * TILE
        at, to = at[ok], to[ok]
        got = [pa.array([names[x + y * TILE] for x in z], pa.string()) for z, y in ((at, i), (to, j))]
        return pa.RecordBatch.from_arrays([*got, pa.array(np.clip(r[at, to], -1, 1), from_pandas=True)], ["a", "b", "r"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for t, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if t != now and now is not None:
                    yield pairs(now, total)
                total = v.values.to_numpy() + (total if t == now else 0.0)
                now = t
        if now is not None:
            yield pairs(now, total)

    tiled = values.mapInArrow(sums, "tile int, sums array<double>")
    return tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(added, "a string, b string, r double")


def correlated(df: DataFrame, cols: Sequence[str], threshold: float = 0.9) -> list[str]:
    """Columns correlated above the threshold with any earlier column, dropped or not."""
    hit = {r["b"] for r in correlations(df, cols).where(F.abs("r") > threshold).select("b").distinct().collect()}
    return [c for c in cols if c in hit]


def drop_by_correlation(df: DataFrame, cols: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """`df` without the columns that `correlated` names (names only reach the driver)."""
    gone = set(correlated(df, cols, threshold))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])


def category_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not is_numeric(df, c)]


class Encoding:
    """Indexes of labels as a table (column, label, idx); the labels stay in the executors."""

    def __init__(self, table: DataFrame, sizes: Mapping[str, int]):
        self.table, self.sizes = table, dict(sizes)

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with `<column>_idx` of every column; labels not seen, and nulls, get the next free index."""
        for c, n in self.sizes.items():
            own = self.table.where(F.col("column") == c).select(F.col("label").alias("label__"), F.col("idx").cast("double").alias("idx__"))
            df = df.join(own, F.col(f"`{c}`").cast("string") == F.col("label__"), "left")
            df = df.withColumn(f"{c}_idx", F.coalesce("idx__", F.lit(float(n)))).drop("label__", "idx__")
        return df


def encode(train: DataFrame, cols: Sequence[str]) -> Encoding:
    """Indexes by falling frequency, ties by name; unseen values get their own index.

    A column may have as many labels as rows: labels are ranked by range partitions, and
    the driver learns how many there are.
    """
    long = train.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "label")
    counts = long.where("label is not null").groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))
    table = cut_lineage(ranks(counts, ["column"], [F.desc("n"), F.asc("label")], "idx").select("column", "label", "idx"))
    found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Encoding(table, {c: found.get(c, 0) for c in cols})


def align(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames on their common columns, in the training order."""
    common = [c for c in train.columns if c in set(test.columns)]
    return train.select(*common), test.select(*common)


def z_limits(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column: two numbers each."""
    row = df.agg(*[F.avg(c).alias(f"{c}__m") for c in cols], *[F.stddev_pop(c).alias(f"{c}__s") for c in cols]).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}


def remove_outliers(df: DataFrame, cols: Sequence[str], score: str | None = None, keep_scored: bool = False, z: float = 3.0) -> DataFrame:
    """Rows with |z| < 3 in every column; optionally also all rows with a score.

    A constant column has z = 0 here, so that it removes nothing.
    """
    keep = F.lit(True)
    for c, (m, s) in z_limits(df, cols).items():
        if m is None:
            keep = F.lit(False)
        elif s == 0:
            keep = keep & F.col(c).isNotNull()
        else:
            keep = keep & (F.abs((F.col(c) - F.lit(m)) / F.lit(s)) < z)
    if keep_scored:
        keep = F.coalesce(keep, F.lit(False)) | F.col(score).isNotNull()
    return df.where(keep)


def multiplicity(df: DataFrame, x: str, y: str, scale: int = 2, name: str = "point_size") -> DataFrame:
    """scale x number of rows sharing (x, y): grouped first, and the rows of a hot point are spread.

    A null is a coordinate like others (structs with nulls in the same places are equal)."""
    at = F.struct(F.col(f"`{x}`"), F.col(f"`{y}`"))
    n = df.groupBy(at.alias("at__")).agg((F.count(F.lit(1)) * scale).alias(name))
    by = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return spread_join(df.withColumn("at__", at), n, "at__", by, "inner").drop("at__")
