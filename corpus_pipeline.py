"""The training-corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the
stage before kept, and all but the last return the columns of documents.  ``run`` writes
each stage as Parquet in the shared folder, and the next reads that.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkpipe.llm import dart, linededup, packing, quality_lm, spans
from sparkpipe.llm.common import materialise, prepare, table

#: SQL cannot express a trained model, signatures or a packing plan.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that the language model rejects."""
    return quality_lm.quality_filter(docs, table(prepare(spark), sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that repeat an earlier line or come within two edits of it."""
    prepare(spark)
    return linededup.line_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one document stays."""
    prepare(spark)
    return dart.near_dedup(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of sentences go that an earlier document has."""
    prepare(spark)
    return spans.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left of the documents as sequences of 4096 tokens."""
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
