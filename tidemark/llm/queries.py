"""Registered queries of the corpus operators, over their whole tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Callable
from ..session import scratch_dir
from . import decontaminate, fixity, hard_negatives, language, mixing, near_dup, phrases, quality_mil, quality_rules, sharding, simhash, suffix_dedup, token_counts
from .store import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD = r"[^\x20\x09-\x0D]+"
SHARDS = 16


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A given table; Python workers get the place that this package was imported from."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")


def size_of(text: str = "text"):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


@query("op1_sharding")
def op1(spark, path):
    """All documents in 16 shards by the law `rows`; the digest is read from the written shards."""
    sharded = sharding.shuffle_shards(table(spark, path, "documents"), SHARDS, seed=17)
    d = sharding.write_shards(sharded, scratch_dir(spark))
    return d.select(
        "doc_id", size_of().alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_token_counts")
def op2(spark, path):
    """Tokens of every document: texts encoded to flat token files, counted by the scan."""
    import public_tokenizers

    docs = table(spark, path, "documents")
    blocks = token_counts.token_blocks(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, separator=50256)
    files = Scratch(spark).keep(blocks)
    found = token_counts.scan(files, 50256, keys="keys")
    return found.select(F.col("key").alias("doc_id"), "n_tokens")


@query("op3_quality_classifier")
def op3(spark, path):
    """Every document scored by a model of the labels whose fold is not 2."""
    docs = table(spark, path, "documents").select("doc_id", "text")
    fold = language.remainder(F.col("doc_id"), 4) == 2
    labels = table(spark, path, "labels").select("doc_id", "quality").where(~fold & F.col("quality").isNotNull())
    net = quality_mil.fit(docs, labels=labels, border=0.7, seed=3)
    s = quality_mil.score(docs, net)
    return s.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op4_decontamination")
def op4(spark, path):
    """Every document's words inside windows of benchmark items."""
    found = decontaminate.contamination(table(spark, path, "documents").select("doc_id", "text"), table(spark, path, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", *decontamination_digest())


def decontamination_digest():
    return [
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    ]


def contaminated():
    """The contract's rule: at least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


@query("op6_language_id")
def op6(spark, path):
    """Every document's language by a model of the rows whose fold is not 1."""
    docs = table(spark, path, "documents")
    fold = language.remainder(F.col("doc_id"), 3) == 1
    model = language.fit(docs.where(~fold).select("doc_id", "text", "lang"), seed=6)
    p = language.predict(docs.select("doc_id", "text"), model)
    return p.select("doc_id", fold.alias("held_out"), "lang_pred", "score")


@query("op5_mixing")
def op5(spark, path):
    """All documents mixed to weights 5, 2, 1, 5, ... at no more than 3 epochs a source."""
    docs = table(spark, path, "documents").select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n"))
    docs = Scratch(spark).keep(docs)
    mixed = mixing.mix(docs, targets(docs, F.col("n")), F.col("n"), seed=5)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def targets(docs: DataFrame, size) -> DataFrame:
    """One row per source: its size, weight by turn and target."""
    sources = docs.groupBy("source").agg(F.sum(size).cast("long").alias("size"))
    weighed = mixing.cyclic_weights(sources, "source", (5, 2, 1))
    return mixing.water_fill(Scratch(docs.sparkSession).keep(weighed), max_epochs=3)


PAGES_PER_ARCHIVE = 4096


@query(
    "op7_warc_fixity",
    r"""
WITH rec AS (
  SELECT page_id, page_id // 4096 AS archive, coalesce(html, '') AS body,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
      || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
)
SELECT page_id, archive, CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest,
  CASE WHEN page_id % 211 = 5 THEN 'missing' WHEN page_id % 97 = 13 THEN 'changed' ELSE 'same' END AS status
FROM rec
""",
)
def op7(spark, path):
    """All pages as WARC records in archives of 4,096; a second replica has lost some records
    (page_id % 211 = 5) and some bytes of others (page_id % 97 = 13); the audit says which."""
    p = table(spark, path, "pages").select("page_id", F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).alias("archive"), fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    rotten = F.expr("CASE WHEN page_id % 97 = 13 THEN concat(substr(record, 1, length(record) - 5), '~', substr(record, -4, 4)) ELSE record END")
    # lengths and digests of both replicas before anything moves
    both = p.select("page_id", "archive", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"), F.sha2(rotten, 256).alias("rotten"))
    placed = Scratch(spark).keep(fixity.place_records(both, "archive", "page_id"))
    own = placed.drop("rotten")
    second = placed.where("page_id % 211 != 5").select("archive", "offset", "length", F.col("rotten").alias("digest"))
    bad = fixity.audit(own.drop("page_id"), second)
    out = own.join(bad, ["archive", "offset"], "left")
    return out.select("page_id", "archive", "offset", "length", "digest", F.coalesce("status", F.lit("same")).alias("status"))


@query("op8_near_duplicates")
def op8(spark, path):
    """Every document's component of near copies."""
    d = near_dup.near_duplicates(table(spark, path, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_quality_rules")
def op9(spark, path):
    """Every document's repetition measures and the verdict."""
    docs = table(spark, path, "documents").select("doc_id", "text")
    j = quality_rules.judge(quality_rules.repetition(docs))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return j.select("doc_id", *[F.col(f"measures.{n}").alias(n) for n in names], "base_failed", "kept")


@query("op10_suffix_dedup")
def op10(spark, path):
    """Every document's bytes without repeated strings of 200 bytes."""
    d = suffix_dedup.remove_repeats(table(spark, path, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query(
    "op11_phrases",
    r"""
WITH w AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) AS t(k)) GROUP BY ALL
), n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (SELECT * FROM f WHERE k > 1 AND f >= 100
), inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM c s JOIN c b ON s.lang = b.lang AND b.k > s.k AND 100 * b.f >= 100 * s.f
    AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')
), cut AS (
  SELECT lang, phrase, f AS a, j, array_to_string(u[1:j], ' ') AS head, array_to_string(u[j + 1:], ' ') AS rest
  FROM (SELECT c.*, string_split(c.phrase, ' ') AS u, unnest(range(1, c.k)) AS j FROM c ANTI JOIN inside USING (lang, phrase))
), scored AS (
  SELECT cut.lang, cut.phrase, cut.a, x.f AS l, y.f AS r, n.n, cut.j, CAST((1000::HUGEINT * cut.a * n.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.head JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rest JOIN n ON n.lang = cut.lang
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM best QUALIFY rank <= 2000
""",
)
def op11(spark, path):
    """The best 2,000 phrases of each language, over all texts."""
    return phrases.collocations(table(spark, path, "documents"))


@query(
    "op12_hard_negatives",
    r"""
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS own, b.vec_id AS id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (SELECT anchor_id, id, score FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INT) AS rank, s.id AS negative_id,
  p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.own AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
""",
)
def op12(spark, path):
    """Hard negatives of every vector whose id is divisible by 100, against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, path, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


@query("op13_simhash")
def op13(spark, path):
    """Every document's fingerprint and component of near fingerprints."""
    return simhash.simhash_duplicates(table(spark, path, "documents").select("doc_id", "text"))
