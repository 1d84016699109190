"""Corpus operators against brute force on small tables with odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, fixity, language, mixing, near_dup, quality_mil, quality_rules, sharding, suffix_dedup, token_counts
from tidemark.llm.store import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, vocabulary, n))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, near copies."""
    rng = np.random.default_rng(4)
    base = sentence(rng, 120)
    words = base.split()
    rows = [(i, sentence(rng, int(rng.integers(1, 90))), "en", f"s{i % 4}") for i in range(40)]
    rows += [(40 + i, " ".join([*words[:i], "edited", *words[i + 1 :]]), "en", "s0") for i in range(0, 20)]
    rows += [(70, base, "en", "s0"), (71, base.upper(), "fr", None), (71, base.upper(), "fr", None)]
    rows += [(72, None, "en", "s1"), (73, "", None, "s2"), (None, "lonely row " + base, "de", "s3"), (74, "\n\t ", "en", None)]
    rows += [(75, sentence(rng, 30_000), "en", "s3"), (76, "Ünï cödé ẞ " * 60, "de", "s3"), (77, "a b", "en", "s1"), (78, "A B", "en", "s1")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns, some called like results
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    for c in ("score", "shard", "kept", "n_words", "size", "items", "n_bytes", "key", "k", "n", "measures"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return [(r[0], r[1] or "") for r in odd_rows()]


def test_shards_hold_every_row_once(docs, tmp_path):
    out = sharding.shuffle_shards(docs, 7, seed=1)
    got = sharding.write_shards(out, str(tmp_path / "shards")).collect()
    want = Counter((r[0], r[1]) for r in odd_rows())
    assert Counter((r.doc_id, r.text) for r in got) == want
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    again = {(r.shard, r.slot): (r.doc_id, r.text) for r in sharding.shuffle_shards(docs.repartition(3), 7, seed=1).collect()}
    assert again == {(r.shard, r.slot): (r.doc_id, r.text) for r in got}
    other = {(r.shard, r.slot): (r.doc_id, r.text) for r in sharding.shuffle_shards(docs, 7, seed=2).collect()}
    assert other != again
    assert got[0].shard__in == "own shard"


def test_shards_of_few_and_no_rows(spark, empty):
    assert sharding.shuffle_shards(empty, 4).count() == 0
    few = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert sorted((r.shard, r.slot) for r in sharding.shuffle_shards(few, 4).collect()) == [(0, 0), (1, 0)]


def ids_of(lists, sep=9):
    return [i for x in lists for i in [*x, sep]]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_scan_of_flat_files_at_any_block_size(spark, block):
    rng = np.random.default_rng(block)
    files = [[rng.integers(0, 9, int(n)).tolist() for n in rng.integers(0, 6, 40)], [], [[]], [[1] * 3000, [], [2]]]
    rows, want = [], []
    for f, lists in enumerate(files):
        flat = ids_of(lists) + ([1, 2] if f == 3 else [])
        rows += [(f, b, np.array(flat[b * block : (b + 1) * block], "<u2").tobytes()) for b in range(-(-len(flat) // block))]
        want += [(f, i, len(x), True) for i, x in enumerate(lists)] + ([(3, 3, 2, False)] if f == 3 else [])
    rows.append((9, 0, None))
    blocks = spark.createDataFrame(rows, "file long, block long, ids binary")
    got = token_counts.scan(blocks, 9).select("file", "doc", "n_tokens", "ended").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_token_files_round_trip(docs, empty):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_50k.tiktoken")
    blocks = Scratch(docs.sparkSession).keep(token_counts.token_blocks(docs, path, P.PATTERN, 50256, block_ids=100))
    enc = token_counts.encoder(path, P.PATTERN)
    got = Counter((r.key, r.n_tokens) for r in token_counts.scan(blocks, 50256, keys="keys").collect())
    assert got == Counter((k, len(enc.encode_ordinary(t))) for k, t in texts())
    flat = b"".join(r.ids for r in blocks.where("file = 0").orderBy("block").collect())
    assert np.frombuffer(flat, "<u2")[-1] == 50256
    assert token_counts.scan(token_counts.token_blocks(empty, path, P.PATTERN, 50256), 50256, keys="keys").count() == 0


def test_attention_gradients_match_differences():
    rng = np.random.default_rng(0)
    shape = [(5, 4), (4,), (4, 3), (4, 3), (3,), (4,), (1,)]
    net = quality_mil.Net(*[rng.normal(size=s) for s in shape])
    x, row, y = rng.normal(size=(7, 5)), np.array([0, 0, 0, 1, 1, 2, 2]), np.array([1.0, 0, 1])

    def loss(n):
        s, _ = quality_mil.forward(n, x, row, 3)
        p = quality_mil.sigmoid(s)
        return -np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))

    s, _ = quality_mil.forward(net, x, row, 3)
    grad = quality_mil.gradients(net, x, row, 3, quality_mil.sigmoid(s) - y)
    for i, g in enumerate(grad):
        for at in np.ndindex(*g.shape):
            up, down = [p.copy() for p in net], [p.copy() for p in net]
            up[i][at] += 1e-6
            down[i][at] -= 1e-6
            assert abs((loss(quality_mil.Net(*up)) - loss(quality_mil.Net(*down))) / 2e-6 - g[at]) < 1e-4


def test_quality_scores_of_odd_rows(docs, empty):
    labels = docs.where("doc_id < 60").withColumn("quality", (F.col("doc_id") < 40).cast("int"))
    net = quality_mil.fit(labels, sample=60, epochs=3)
    got = quality_mil.score(docs, net).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got) and got[0].score__in == "own score"
    assert len({round(r.score, 5) for r in got if r.doc_id == 71}) == 1
    assert len({round(r.score, 5) for r in got if r.doc_id in (72, 73, 74)}) == 1
    assert quality_mil.score(empty, net).count() == 0
    one = quality_mil.fit(labels.where("quality = 1"))
    assert quality_mil.score(docs, one).where("score > 0.9").count() == len(odd_rows())


def benchmark_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.mark.parametrize("few", [0, 500_000])
def test_decontamination_against_brute_force(spark, docs, empty, few, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", few)  # both ways of meeting the benchmark
    rows = odd_rows()
    items = [(1, " ".join(rows[3][1].split()[:40])), (2, rows[60][1].upper()), (3, "a, B!"), (4, None), (5, "..."), (10, "cödé ẞ ünï"), (None, "w1 w2")]
    items += [(20, rows[50][1][30:300]), (21, "w1 w2 w3 w4 w5"), (22, rows[50][1][30:300])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = benchmark_words(t)
        m = min(13, len(w))
        for s in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[s : s + m]), set()).add(None if i is None else str(i))
    want = Counter()
    for k, t in texts():
        w, hit, found = benchmark_words(t), set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if tuple(w[s : s + m]) in windows:
                    hit.update(range(s, s + m))
                    found |= windows[tuple(w[s : s + m])]
        want[(k, len(w), len(hit), tuple(sorted(x for x in found if x is not None)))] += 1
    got = decontaminate.contamination(docs, bench)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()) == want
    assert got.first().n_words__in == "own n_words"
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_water_filling(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, "d": 0, None: 500}
    weights = dict(zip(sizes, (5, 2, 1, 5, 2)))
    src = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    weighed = mixing.cyclic_weights(src, "source", (5, 2, 1))
    assert {r.source: r.weight for r in weighed.collect()} == weights
    got = {r.source: r.target for r in mixing.water_fill(weighed, 3).collect()}
    level, capped = 0, set()
    while True:  # clamp and share again
        free = [s for s in sizes if s not in capped]
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in capped)) / sum(weights[s] for s in free)
        more = {s for s in free if weights[s] * level > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    assert got == pytest.approx({s: 3 * sizes[s] if s in capped else weights[s] * level for s in sizes})
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_meets_targets_and_repeats_rows(docs, empty):
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sources = docs.groupBy("source").agg(F.sum(size).alias("size")).withColumn("target", F.col("size") * 1.4)
    mixed = mixing.mix(docs, sources, size, seed=3)
    rows = mixed.collect()
    assert len(rows) == len(odd_rows()) and all(r["size"] == len(WORD.findall(r.text or "")) for r in rows)
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        taken = sum(r.repeats * r["size"] for r in own)
        assert abs(taken - own[0].target) <= max(r["size"] for r in own) / 2 + 1
    key = lambda rs: sorted((str(r.doc_id), r.repeats) for r in rs)
    assert key(rows) == key(mixing.mix(docs.repartition(2), sources, size, seed=3).collect())
    assert mixing.repeat_rows(mixed).count() == sum(r.repeats for r in rows)
    assert mixing.mix(empty, sources, size).count() == 0


def test_language_learns_and_defines_odd_rows(spark, docs, empty):
    rng = np.random.default_rng(1)
    rows = []
    for lang, stems in (("aa", "la le li lo lu"), ("bb", "krak prok trek"), ("cc", "öß äß üß")):
        rows += [(len(rows) + i, " ".join(rng.choice(stems.split(), 30)), lang) for i in range(60)]
    train = spark.createDataFrame(rows + [(999, "krak", None), (1000, None, "aa")], "doc_id long, text string, lang string")
    model = language.fit(train, sample=120)
    got = language.predict(train, model).collect()
    assert np.mean([r.lang == r.lang_pred for r in got if r.lang and r.text]) > 0.98
    assert np.mean(model.weights == 0) > 0.5
    odd = language.predict(docs, model).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r.score <= 1 for r in odd)
    assert {(r.lang_pred, r.score) for r in odd if r.doc_id in (72, 73, 74)} == {("und", 0.0)}
    assert language.predict(empty, model).count() == 0
    nothing = language.fit(train.where("lang IS NULL"))
    assert {r.lang_pred for r in language.predict(train, nothing).collect()} == {"und"}


def test_audit_finds_each_damage(spark):
    rows = [(a, i, "x" * int(10 + (i * 7) % 50) + f"{a}-{i}") for a in range(3) for i in range(300)]
    rec = fixity.place_records(spark.createDataFrame(rows, "archive long, i long, record string"), "archive", "i", "record")
    first = fixity.leaves(rec).cache()
    at = {(r.archive, r.i): r.offset for r in rec.collect()}
    damaged = rec.withColumn("record", F.when(F.expr("archive = 1 AND i = 77"), "rotten").otherwise(F.col("record"))).where("NOT (archive = 0 AND i IN (5, 299)) AND archive != 2")
    extra = fixity.leaves(damaged).unionByName(spark.createDataFrame([(1, 10**6, 5, "d")], "archive long, offset long, length long, digest string"))
    for span, fan in ((64, 2), (1 << 18, 16)):
        got = {(r.archive, r.offset): r.status for r in fixity.audit(first, extra, span, fan).collect()}
        want = {(1, at[1, 77]): "changed", (0, at[0, 5]): "missing", (0, at[0, 299]): "missing", (1, 10**6): "extra"}
        want |= {(2, at[2, i]): "missing" for i in range(300)}
        assert got == want
    assert fixity.audit(first, first).count() == 0
    assert fixity.audit(first.limit(0), first.limit(0)).count() == 0


def brute_components(rows, k=4, percent=80):
    sets = {}
    for key, t in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t).split() if t else []
        got = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        if key is not None:
            sets[key] = got
    comp = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and comp[a] != comp[b]:
                lo, hi = sorted((comp[a], comp[b]))
                comp = {i: lo if c == hi else c for i, c in comp.items()}
    return sets, comp


@pytest.mark.parametrize("small", [16, 2])
def test_near_duplicates_against_brute_force(docs, empty, small):
    sets, comp = brute_components(texts())
    got = near_dup.near_duplicates(docs, small=small).collect()
    assert len(got) == len(odd_rows()) and got[0].kept__in == "own kept"
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), comp[r.doc_id], comp[r.doc_id] == r.doc_id)
    assert near_dup.near_duplicates(empty).count() == 0


def test_near_duplicates_in_large_nodes(spark):
    """Two families of texts that share a long passage: nodes stay large and hold both."""
    rng = np.random.default_rng(2)
    shared = sentence(rng, 150, 10_000).split()
    rows = []
    for f in range(3):
        own = sentence(rng, 60, 10_000).split()
        for i in range(120):
            tail = list(own)
            tail[i % 60] = f"edit{f}x{i}"
            rows.append((len(rows), " ".join(shared + tail)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, comp = brute_components(rows)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df, levels=1, trees=12, small=4).collect()}
    assert got == comp


def test_repetition_against_brute_force(docs, empty):
    got = quality_rules.judge(quality_rules.repetition(docs)).collect()
    want = Counter()
    for k, t in texts():
        w = WORD.findall(t)
        seen, dup, dup_chars = set(), 0, 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup, dup_chars = dup + (line in seen), dup_chars + (line in seen) * sum(map(len, WORD.findall(line)))
                seen.add(line)
        inside = {}
        for n in (5, 8, 10):
            grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
            many = Counter(grams)
            inside[n] = {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + n)}
        total = max(1, sum(map(len, w)))
        share = [round(sum(len(w[j]) for j in inside[n]) / total, 9) for n in (5, 10)]
        want[(k, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside[8]), round(dup_chars / total, 9), *share)] += 1
    measures = lambda m: (*m[:5], round(m[5], 9), round(m[6][0], 9), round(m[6][5], 9))
    assert Counter((r.doc_id, *measures(r.measures)) for r in got) == want
    assert not any(r.kept for r in got if r.doc_id in (72, 73, 74, 76, 77)) and all(not r.kept for r in got if r.base_failed)
    assert got[0].measures__in == "own measures"
    assert quality_rules.repetition(empty).count() == 0


def test_repeated_lines(spark):
    t = "one line\n\nother # line\r\none line\n \none line\nother # line\nlast"
    r = quality_rules.repetition(spark.createDataFrame([(1, t)], "doc_id long, text string")).first().measures
    assert (r.n_dup_lines, r.n_symbols) == (2, 2)


def brute_removal(rows, depth):
    raw = [(k, (t or "").encode()) for k, t in rows]
    many = Counter(b[i : i + depth] for _, b in raw for i in range(len(b) - depth + 1))
    out = Counter()
    for k, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - depth + 1):
            if many[b[i : i + depth]] > 1:
                gone[i : i + depth] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[(k, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes())] += 1
    return out


@pytest.mark.parametrize("many", [0, 2048])
def test_suffix_dedup_against_brute_force(docs, empty, many, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", many)  # with 0, every digit is spread over tasks
    got = suffix_dedup.remove_repeats(docs, depth=60, gram=12)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got.collect()) == brute_removal([(r[0], r[1]) for r in odd_rows()], 60)
    assert got.first().n_bytes__in == "own n_bytes"
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_of_periodic_texts(spark):
    rows = [(1, "ab" * 400), (2, "abc" * 300 + "x"), (3, "q" + "ab" * 120), (4, "z" * 199), (5, "z" * 200), (6, "y" * 201)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got.collect()) == brute_removal(rows, 200)


def test_segments_cover_every_suffix(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    at = np.array([0, 0, 1200, 1200, 1290, 5000, 5000])
    whole = suffix_dedup.runs_of(data, at, 100, 10)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    cut = suffix_dedup.runs_of(data, at, 100, 10)
    suffixes = lambda r: sorted((a, p + i, h) for a, p, n, h in zip(r["row"], r["pos"], r["len"], r["h"]) for i in range(n))
    assert suffixes(whole) == suffixes(cut)
    assert len(suffixes(whole)) == 1101 + 3611


def test_radix_groups_are_the_equal_windows():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    starts = rng.permutation(2980)
    group = suffix_dedup.radix_groups(data, starts, 11)
    windows = [bytes(data[s : s + 11]) for s in starts]
    many = Counter(windows)
    assert all((g < 0) == (many[w] == 1) for g, w in zip(group, windows))
    assert len({(g, w) for g, w in zip(group, windows) if g >= 0}) == len({w for w in windows if many[w] > 1}) == len({g for g in group if g >= 0})


def thue_morse(n):
    """Two different texts of n characters that a polynomial modulo a power of two cannot tell apart."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_regular_texts_do_not_collide(spark, n):
    one, two = thue_morse(n)
    rows = [(1, one), (2, two), (3, f"{one}\n{two}"), (4, " ".join([one] * 8 + [two] * 8))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    near = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()}
    assert near == {1: 1, 2: 2, 3: 3, 4: 4}
    m = {r.doc_id: r.measures for r in quality_rules.repetition(df).collect()}
    assert m[3].n_dup_lines == 0 and m[4].n_repeat_words == 0
    got = suffix_dedup.remove_repeats(df)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got.collect()) == brute_removal(rows, 200)


def test_string_keys_that_are_no_numbers_are_not_linked(spark):
    rows = [("7", "a b c d e"), ("5", "A b c d e"), ("x", "a b c d e"), (None, "a b c d e")]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {("7", 5, False), ("5", 5, True), ("x", None, True), (None, None, True)}


def test_ids_of_long_runs_are_those_of_the_whole_text():
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_50k.tiktoken")
    enc = token_counts.encoder(path, P.PATTERN)
    for run in (" " * 50, "\n" * 40, " \t\n\u2003" * 9, "\u3000" * 30 + " "):
        for text in (run, f"a{run}b", f"it's{run}", f"{run}7{run}\x1c{run}!", f"x {run} y"):
            assert token_counts.ids_of(text, path, P.PATTERN, long=20) == enc.encode_ordinary(text)


@pytest.mark.parametrize("text", [" " * 10_000_000, "\n" * 10_000_000, "x" + " " * 10_000_000 + "y", "q" * 10_000_000, "中" * 3_300_000])
def test_very_long_runs_are_encoded(text):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_50k.tiktoken")
    ids = token_counts.ids_of(text, path, P.PATTERN)
    assert token_counts.encoder(path, P.PATTERN).decode(ids) == text


def test_fixity_on_measured_records(spark):
    """Digests taken before records are placed give the audit of the bodies, with nulls, repeats and no rows."""
    rows = [(a, i, None if i % 9 == 0 else f"{a}-{i % 4}" * (i % 5)) for a in range(2) for i in range(60)]
    df = spark.createDataFrame(rows, "archive long, i long, record string")
    bodies = fixity.leaves(fixity.place_records(df, "archive", "i", "record"))
    narrow = fixity.place_records(fixity.measured(df, "archive", "i", "record"), "archive", "i").select("archive", "offset", "length", "digest")
    assert sorted(map(tuple, bodies.collect())) == sorted(map(tuple, narrow.collect()))
    assert fixity.audit(bodies, narrow, 64, 3).count() == 0
    none = fixity.measured(df.limit(0), "archive", "i", "record")
    assert fixity.place_records(none, "archive", "i").count() == 0
