"""The stages of the corpus pipeline on odd rows, an empty table and clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tidemark.llm.store import Scratch

CLASHES = ("score", "lang_pred", "kept", "n_shingles", "component_id", "n_words", "items", "size", "repeats", "shard", "slot", "key", "id")


def rows():
    rng = np.random.default_rng(2)
    say = lambda n, words: " ".join(str(x) for x in rng.choice(words, n))
    en, fr = "the of and that with this from have been which".split(), "le des une dans pour avec cette était être où".split()
    out = [(i, say(60, en) + f" {i} {i * 7} {i * 11}", "en", f"s{i % 3}") for i in range(40)] + [(100 + i, say(60, fr) + f" {i} {i * 7} {i * 11}", "fr", f"s{i % 4}") for i in range(40)]
    base = out[3][1]
    return out + [(200, base, "en", None), (201, base + " more", "en", "s1"), (201, base + " more", "en", "s1"), (None, say(50, en), None, "s1"), (202, None, "en", "s0"), (203, "", None, None), (204, "12 34", "fr", "s2"), (205, say(30_000, en), "en", "s0")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    for c in CLASHES:
        df = df.withColumn(c, F.lit(f"own {c}"))
    return Scratch(spark).keep(df.repartition(4))


def folder(spark, tmp_path_factory, items):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_stages_on_odd_rows(spark, docs, tmp_path_factory):
    item = " ".join(rows()[10][1].split()[20:45])
    at = folder(spark, tmp_path_factory, [("b", item), ("n", None), (None, "x y")])
    now, scratch = docs, Scratch(spark)
    ids = {}
    for name, stage in cp.STAGES:
        out = scratch.keep(stage(spark, now, at))
        got = out.collect()
        ids[name] = [r.doc_id for r in got]
        if name != "sharding":
            assert out.columns == docs.columns
            assert all(r[c] == f"own {c}" for r in got for c in CLASHES)
        now = out
    gone = {i for i in ids["language_id"]}
    assert 202 not in gone and 203 not in gone and 204 not in gone and {*range(40), *range(100, 140)} <= gone
    after = ids["near_dedup"]
    assert 200 not in after and 201 not in after and {*range(40), *range(100, 140), 205} <= set(after) and None in after
    assert 10 not in ids["decontamination"] and set(ids["near_dedup"]) - set(ids["decontamination"]) == {10}
    assert set(ids["mixing"]) <= set(ids["decontamination"]) and sorted(map(str, ids["sharding"])) == sorted(map(str, ids["mixing"]))


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES if n != "language_id"])
def test_stages_on_an_empty_table(spark, docs, name, tmp_path_factory):
    at = folder(spark, tmp_path_factory, [("b", "some words of an item")])
    out = dict(cp.STAGES)[name](spark, docs.where("false"), at)
    assert out.count() == 0
    if name != "sharding":
        assert out.columns == docs.columns


def test_language_stage_on_an_empty_table(spark, docs):
    out = cp.identify_language(spark, docs.where("false"), "")
    assert out.columns == docs.columns and out.count() == 0
