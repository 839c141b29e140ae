"""Corpus pipeline: documents -> quality rules -> line dedup -> SimHash
near-dedup -> benchmark decontamination -> byte-level BPE.

Each stage takes what its predecessor kept, as a written table; all but the
last return the columns of ``documents``. SQL cannot express the hashing
stages, so ``ORACLE_SQL`` is None and the tests compare every stage with a
brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from titleflow.llm import bpe, decontaminate, lines, quality, simhash
from titleflow.llm.common import stored, table
from titleflow.llm.queries import BPE_RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return quality.keep_good(docs, policy="v1")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand elsewhere before; documents
    of which no line is left are copies and go. ``n_chars`` follows."""
    return lines.dedup_lines(docs, similarity=0.8, chars="n_chars" if "n_chars" in docs.columns else None,
                             width=lines.WIDTH)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each near-duplicate group."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of tokens and the digests of ids and decoded text."""
    keep = [c for c in docs.columns if c in ("doc_id", "lang", "source", "text")]
    return bpe.encode_documents(docs.select(*keep), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written below
    the shared folder and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
