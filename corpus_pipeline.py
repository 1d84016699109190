"""The corpus pipeline: documents in, mixed and sharded training data out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes to the
shared folder and reads again as the next stage's input.

Defined cases, in every stage: a null or empty text has no letter, so language
identification drops it, and the other stages keep it as a document without words;
rows with a null key are no copy of another row and are judged one by one; repeated rows are
copies, of which near-copy removal keeps those of the smallest key, so rows that are equal in
their key too all stay or all go; ties go by the smallest key; an empty table stays empty; other columns pass
through under their names, also where an operator's results are called the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, language, mixing, near_dup, sharding
from tidemark.llm.queries import SHARDS, WORD, contaminated, table, targets
from tidemark.llm.store import Scratch, restored
from tidemark.llm.suffix_dedup import packed, unpacked

MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without a letter and undecided ones go."""
    model = language.fit(docs.where(language.remainder(F.col("doc_id"), 3) != 1), seed=6)
    judged = language.predict(docs, model)
    known = judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return restored(known, docs.columns, language.RESULTS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies. What goes is decided on keys; the
    documents then move once, their texts packed."""
    judged = near_dup.near_duplicates(docs.select("doc_id", "text"))
    gone = judged.where("NOT kept").select("doc_id").distinct()
    return unpacked(packed(docs, "text").join(gone.hint("merge"), "doc_id", "left_anti"), "text").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark windows."""
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return restored(judged.where(~contaminated()), docs.columns, decontaminate.RESULTS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    mixed = mixing.mix(docs, targets(docs, size), size, seed=5)
    return restored(mixing.repeat_rows(mixed), docs.columns, mixing.RESULTS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in a seeded order, cut into equal shards."""
    return sharding.shuffle_shards(docs, SHARDS, seed=17)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# a trained model decides in the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    before = None
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
