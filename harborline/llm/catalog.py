"""The registered queries of the operators, with check SQL where SQL can express them.

Each query applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import alignment, bpe, dedup, langid, licenses, minhash, mixing, pii, quality, rtree, simhash, tokencount, warc
from harborline.llm.frames import documents, table, tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under ``name``."""
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tuned(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op1_warc", """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
first AS (SELECT payload AS f, max(page_id) AS top FROM p WHERE octet_length(payload) >= 1000 GROUP BY payload)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN top IS DISTINCT FROM page_id AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top IS DISTINCT FROM page_id THEN top END AS refers_to
FROM p LEFT JOIN first ON payload = f
""")
def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Write every page to dictionary-compressed archives and read them back."""
    return warc.archive_round_trip(table(spark, folder, "pages"))


@query("op2_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by Kneser-Ney character models."""
    return langid.identified_documents(documents(spark, folder))


@query("op3_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, counted through a digest cache that starts empty."""
    return tokencount.token_counts(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@query("op4_simhash")
def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(documents(spark, folder))


@query("op5_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Known licences that a whole document, or a whole line of it, consists of."""
    return licenses.license_scan(documents(spark, folder), licenses.known_licenses(spark))


@query("op6_mix_sources", r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS draw, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         sum(source_size) OVER ()::BIGINT AS total FROM sources),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS r FROM weighed),
cut AS (
  SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS gone,
         sum(weight) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS shares FROM ranked),
stop AS (
  SELECT gone, shares, r FROM cut WHERE weight * (total - gone) <= 3 * source_size * shares ORDER BY r LIMIT 1),
targets AS (
  SELECT cut.source, source_size, CASE WHEN cut.r < stop.r THEN (3 * source_size)::DOUBLE
         ELSE (weight * (total - stop.gone))::DOUBLE / stop.shares::DOUBLE END AS target FROM cut, stop),
rates AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || md5(draw || ':mix-1')[1:13])::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source),
copied AS (SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM rates)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM copied
""")
def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Repetitions of every document in a mix of its sources."""
    return mixing.mix_plan(documents(spark, folder))


@query("op7_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encoded(documents(spark, folder).select("doc_id", "text"), path, public_tokenizers.PATTERN)
    both = bpe.decoded(ids.select("doc_id", "ids"), path)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_pii")
def pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with pseudonyms for its personal data, and how many spans they replace."""
    docs = documents(spark, folder).select("doc_id", "text")
    found = pii.pseudonymised(docs, out="clean").select("doc_id", F.col("clean").alias("text"), "spans")
    return found.withColumn("n_spans", F.size("spans").cast("bigint"))


@query("op9_quality")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and the log-likelihood ratio of every document."""
    return quality.quality(documents(spark, folder), table(spark, folder, "labels")).drop("_th")


@query("op10_exact_dedup", """
WITH groups AS (
  SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM documents JOIN groups ON coalesce(text, '') = t
""")
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts and the document of each that stays."""
    return dedup.exact_groups(documents(spark, folder)).select(
        "doc_id", "keep_id", F.col("group_size"), "kept", "text_sha256")


@query("op11_hard_negatives", """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CASE WHEN len(a.v) = 0 THEN 0 ELSE list_inner_product(a.v, b.v) END::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
   AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
""")
def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The hardest negatives inside the score window of every anchor's positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.hard_negatives(table(spark, folder, "embeddings"), label=label)


@query("op12_minhash")
def minhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate group of every document by the shingles it shares."""
    return minhash.near_duplicates(documents(spark, folder))


@query("op13_token_alignment")
def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups, links and corpus counts of two tokenizers over every document."""
    return alignment.alignment(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, folder)
