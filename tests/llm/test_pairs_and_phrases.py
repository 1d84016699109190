"""Phrases, hard negatives and SimHash against brute force on small tables with odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import components as comps, hard_negatives, phrases, simhash
from tidemark.llm.store import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string"


def brute_phrases(rows, least, longest=5, percent=100, top=2000):
    f = {}
    for text, lang in rows:
        c = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            c.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        cand = {k: v for k, v in c.items() if len(k) > 1 and v >= least}
        inside = {k[i:j] for k, v in cand.items() for i in range(len(k)) for j in range(i + 2, len(k) + 1) if j - i < len(k) and 100 * v >= percent * cand[k[i:j]]}
        best = []
        for k, a in cand.items():
            if k not in inside:
                s, _, lf, r = min((1000 * a * n // (c[k[:q]] * c[k[q:]]), q, c[k[:q]], c[k[q:]]) for q in range(1, len(k)))
                best.append((-s, -a, " ".join(k).encode(), lf, r))
        out += [(lang, i + 1, p.decode(), -a, lf, r, n, -s) for i, (s, a, p, lf, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


def phrase_rows():
    rng = np.random.default_rng(11)
    words = ["a", "b", "C", "dé", "E f", "ẞ", "x" * 50]
    rows = [(i, "".join(str(rng.choice(words)) + str(rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "!? "])) for _ in range(int(rng.integers(0, 60)))), ["en", "fr", None, "und"][i % 4]) for i in range(80)]
    rows += [(100, None, "en"), (101, "", None), (102, " \t\n.", "de"), (None, "a b a b c", "fr"), (103, "a b C a b", None), (103, "a b C a b", None)]
    rows += [(104, "m n o p q r " * 3000 + ". " + "m n! " * 2000, "en"), (105, "z" * 200_000, "en"), (106, "of the " * 4000, "en")]
    return rows


@pytest.mark.parametrize("least, percent", [(3, 100), (20, 60)])
def test_phrases_against_brute_force(spark, monkeypatch, least, percent):
    df = spark.createDataFrame(phrase_rows(), SCHEMA).repartition(6)
    for c in ("rank", "phrase", "a", "score", "words", "prefix", "n"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    got = phrases.collocations(df, least=least, subsumed_percent=percent)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases([(r[1], r[2]) for r in phrase_rows()], least, percent=percent)
    assert [r for r in brute_phrases([(r[1], r[2]) for r in phrase_rows()], least, percent=percent, top=3)] == sorted(
        map(tuple, phrases.collocations(df, least=least, subsumed_percent=percent, top=3).collect())
    )


def test_phrases_of_no_rows_and_nulls(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None, None)] * 3, SCHEMA), least=1).count() == 0


def test_scores_beyond_64_bits_are_exact(spark):
    got = phrases.collocations(spark.createDataFrame([(1, "a b. " * 300, "en")], SCHEMA), least=2, per=10**16).collect()
    assert [(r.phrase, r.a, r.score) for r in got] == [("a b", 300, 10**16 * 300 * 600 // (300 * 300))]


def test_long_texts_are_cut_where_pieces_end():
    data = np.frombuffer(b"a b c. d e f\ng h i j k l m n o p, q", np.uint8)
    parts = phrases.parts_of(data, np.array([0, len(data)]), 5)
    assert b"".join(bytes(p) for p, _ in parts) == bytes(data) and len(parts) > 2
    assert all(bytes(p)[:1] in b".\n," for p, _ in parts[1:])


def test_stripes_merge_over_many_batches(spark):
    rows = [(4, ["en"], ["p"], [2], [f"w{i % 500}", None], [1, 2]) for i in range(3000)] + [(4, ["de", "en"], ["p", "q"], [1, 2], ["w1", "w1", "w2"], [5, 5, 1]), (9, ["en"], ["p"], [1], ["w1"], [7])]
    partial = spark.createDataFrame(rows, phrases.SHAPE)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        got = sorted((r.lang, r.prefix, r.total, sorted(zip(r.words, r.counts))) for r in phrases.merge(partial, 2).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == [("de", "p", 5, [("w1", 5)]), ("en", "p", 7, [("w1", 7)]), ("en", "p", 9000, sorted((f"w{i}", 6) for i in range(500))), ("en", "q", 6, [("w1", 5)])]


def test_stripes_that_do_not_fit_are_emitted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "PIECE_BYTES", 2000)
    df = spark.createDataFrame(phrase_rows(), SCHEMA).repartition(2)
    assert sorted(map(tuple, phrases.collocations(df, least=3).collect())) == brute_phrases([(r[1], r[2]) for r in phrase_rows()], 3)


def test_residue_products_are_exact_and_signed():
    rng = np.random.default_rng(2)
    for d, size in ((1, 3), (64, 300), (300, 10**6), (700, 5)):
        a, b = rng.integers(-size, size + 1, (6, d)), rng.integers(-size, size + 1, (9, d))
        a[0], b[0], b[1] = size, size, -size
        p = hard_negatives.primes_for(d, d * size * size)
        assert math.prod(p) > 2 * d * size * size and len(set(p)) == len(p)
        assert (hard_negatives.products(hard_negatives.residues(a, p), hard_negatives.residues(b, p), p) == a @ b.T).all()


def brute_negatives(rows):
    ok = [(i, lab, [math.floor(256 * float(x)) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda u, v: sum(x * y for x, y in zip(u, v))
    out = []
    for i, lab, v in ok:
        if i % 10:
            continue
        s = sorted(((-dot(v, w), j, m) for j, m, w in ok if j != i))
        for p, j, m in [x for x in s if x[2] == lab][:5]:
            near = [x for x in s if x[2] != lab and 80 * -p <= 100 * -x[0] <= 100 * -p][:5]
            out += [(i, j, r + 1, x[1], -p, -x[0]) for r, x in enumerate(near)]
    return Counter(out)


@pytest.mark.parametrize("anchor_bytes", [8 << 20, 400])
def test_hard_negatives_against_brute_force(spark, monkeypatch, anchor_bytes):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", anchor_bytes)
    monkeypatch.setattr(hard_negatives, "ROWS_AT_ONCE", 16)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)], int(rng.integers(0, 3))) for i in range(90)]
    rows += [(100 + i, rows[4][1], 1) for i in range(30)]  # many ties
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [float("nan")] * 6, 2), (203, [float("inf")] + [0.0] * 5, 2), (204, [1.0] * 6, None), (210, [], 0), (220, [1.0, -2.0], 1), (None, [1.0] * 6, 1)]
    rows += [(33, rows[33][1], rows[33][2])]  # a repeated row
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    for c in ("id", "v", "asked", "score", "rank"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows)


def test_hard_negatives_of_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, None, None), (100, [], 3)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(one, F.col("vec_id") % 100 == 0).count() == 0


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(fps, distance):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def simhash_rows():
    rng = np.random.default_rng(8)
    say = lambda n: " ".join(f"w{int(x)}" for x in rng.integers(0, 300, n))
    base = say(400).split()
    rows = [(i, say(int(rng.integers(1, 60)))) for i in range(40)]
    rows += [(50 + i, " ".join([*base[: i * 9], "Changed", *base[i * 9 :]])) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\t"), (None, "lonely"), (103, "LONELY"), (None, None), (104, "a b"), (105, "A\x0bB"), (106, "Ünï ẞ " * 20_000), (106, "Ünï ẞ " * 20_000)]
    return rows


@pytest.mark.parametrize("dealt", [1, 1024])
def test_simhash_against_brute_force(spark, monkeypatch, dealt):
    monkeypatch.setattr(simhash, "DEALT", dealt)
    monkeypatch.setattr(comps, "PART", dealt)
    rows = simhash_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for c in ("fingerprint", "fp", "comp", "low", "copies"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    got = simhash.simhash_duplicates(df)
    fps = [brute_fingerprint(t) for _, t in rows]
    where = components_of(fps, 3)
    low = {}
    for (k, _), c in zip(rows, where):
        low[c] = min((x for x in (low.get(c), k) if x is not None), default=None)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == Counter((k, f"{f:016x}", low[c]) for (k, _), f, c in zip(rows, fps, where))
    assert got.first().fingerprint__in == "own fingerprint" and got.first().comp == "own comp"


def test_simhash_of_no_rows(spark):
    assert simhash.simhash_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_pigeonhole_finds_every_pair_of_clustered_fingerprints(spark, distance):
    """Fingerprints in balls around few centres and in a line of single flips, some bits constant."""
    rng = np.random.default_rng(distance)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64) & np.uint64(0x0FFFFFFFFFFF0FFF)
    fps = set()
    for c in centres:
        for _ in range(60):
            fps.add(int(c) ^ sum(1 << int(b) for b in rng.integers(0, 64, int(rng.integers(0, 6)))))
    walk = int(centres[0])
    for b in rng.permutation(64):
        walk ^= 1 << int(b)
        fps.add(walk)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    scratch = Scratch(spark)
    classes = scratch.keep(spark.createDataFrame([(f, 1 + i % 3) for i, f in enumerate(signed)], "fp long, copies long"))
    links = simhash.links_within(classes, distance, scratch).collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= distance and a != b for a, b in links)
    want = components_of(fps, distance)
    at = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(at[a])] = find(at[b])
    got = [find(i) for i in range(len(fps))]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_thresholds_cost_least():
    rng = np.random.default_rng(1)
    cost = np.concatenate([np.zeros((30, 3, 1)), np.cumsum(rng.random((30, 3, 4)), 2)], 2)
    got = simhash.allocate(cost, 4)
    assert (got.sum(1) + 3 == 4).all() and got.min() >= -1
    for row, c in zip(got, cost):
        every = [(i - 1, j - 1, 4 - i - j - 1) for i in range(5) for j in range(5 - i)]
        price = lambda t: sum(c[p, x + 1] for p, x in enumerate(t))
        assert math.isclose(price(row), min(map(price, every)))


def test_components_of_hubs_and_chains(spark, monkeypatch):
    monkeypatch.setattr(comps, "PART", 3)
    links = [(0, i) for i in range(1, 40)] + [(i, i + 1) for i in range(100, 140)] + [(200, 200), (300, 301), (301, 300)]
    got = dict(map(tuple, comps.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark)).collect()))
    assert got == {**{i: 0 for i in range(40)}, **{i: 100 for i in range(100, 141)}, 300: 300, 301: 300}
    assert comps.components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0
