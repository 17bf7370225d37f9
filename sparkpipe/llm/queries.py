"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, dart, exact, licenses, linededup, negatives, packing, powers, quality_lm, repair, spans, toxicity
from .common import prepare, table


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that is not blank: its class, its links, whether it stays."""
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: which of the equal texts stays."""
    return exact.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: digests of its tokens and of the text decoded from them."""
    return bpe.digests(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: probabilities of the chain (junk, then toxic) and the verdict."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    return toxicity.toxicity(table(spark, sf_dir, "documents"), labels, ["junk", "toxic"])


def document_path():
    """documents as a file tree: source / language / document."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return F.concat_ws("/", F.col("source"), F.col("lang"), name)


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its licence, from its text, its header or the nearest directory above."""
    return licenses.licence_report(table(spark, sf_dir, "documents"), document_path())


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its perplexity, its language's threshold, whether it stays."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_lm.classify(docs, labels, ["doc_id", "lang"]).select(
        "doc_id", "lang", F.col("__perplexity").alias("perplexity"), F.col("__threshold").alias("threshold"),
        F.col("__keep").alias("kept"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its class of near duplicates, whether it stays."""
    return dart.class_ids(dart.near_duplicates(table(spark, sf_dir, "documents")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document: its sequence and its place there."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its text without repeated runs, and what went."""
    out = spans.substring_dedup(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", F.col("__sentences").alias("sentences"), F.col("__removed").alias("removed"),
                      F.col("__spans").alias("spans"), F.col("__text").alias("text"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after planted damage: its faults, cheapest edits and repaired turns."""
    damaged = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.report(repair.repair(damaged, present=F.col("present")))


def op12_power_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document: a sequence whose length is a power of two."""
    sequences = powers.power_sequences(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    return sequences.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                            "offset", "bucket")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector and each of its five positives."""
    vectors = negatives.quantised(table(spark, sf_dir, "embeddings"))
    return negatives.mine(vectors, vectors.where("vec_id % 100 = 0"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def _prepared(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)
    return run


QUERIES = {f.__name__: _prepared(f) for f in (
    op1_neighbours, op2_line_dedup, op3_exact_dedup, op4_bpe, op5_toxicity, op6_licences, op7_quality,
    op8_near_dedup, op9_packing, op10_substring_dedup, op11_conversation_repair,
    op12_power_packing, op13_hard_negatives, pipeline)}

ORACLE = {
    "op13_hard_negatives": negatives.ORACLE,
    "op2_line_dedup": linededup.oracle(),
    "op3_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
w AS (SELECT doc_id, cp, sha256(body) AS text_sha256,
             first_value(doc_id) OVER g AS keep_id, first_value(cp) OVER g AS keep_cp,
             count(*) OVER (PARTITION BY body) AS group_size
      FROM d WINDOW g AS (PARTITION BY body ORDER BY cp DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AND cp = keep_cp AS kept, text_sha256 FROM w""",
}
