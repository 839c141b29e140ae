"""The registered queries of this subpackage: thin (spark, sf_dir) wrappers
over the operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.llm import (bpe, chat, collocations, decontaminate, html_text, licenses, lines, neighbours, periodic, quality,
                           simhash, toxicity, warc)
from titleflow.llm.common import table


#: Rank file and pattern of the byte-level tokenizer (parameters of the operator).
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a factorization machine fitted on the
    labelled rows outside the held-out fold."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents leak, with the best window of each."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality ledger of every document, judged by policy v1."""
    rows = quality.judge(quality.ledger(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "n_lines", "n_letter_words", "n_capital_runs", "failed_bits")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with a word of every document: the first line of its
    component (document and line number) and whether it is that line."""
    found = lines.line_components(table(spark, sf_dir, "documents"), similarity=0.8, width=lines.WIDTH)
    return found.select(F.col("doc").alias("doc_id"), F.col("pos").alias("line_no"),
                        F.col("first.doc").alias("first_doc_id"), F.col("first.pos").alias("first_line_no"), "kept")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written into archives and read back, payloads verified."""
    back = warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered turns of the conversations that no longer log extends."""
    return chat.format_turns(table(spark, sf_dir, "conversations"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and expressions of every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of every language of the documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and the text without their repeats."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic.run_digest(periodic.periodic_runs(docs))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_html_extraction, op3_byte_bpe, op4_decontamination, op5_quality_rules, op6_line_dedup, op7_warc,
        op8_simhash_near_dedup, op9_chat_format, op10_license_scan,
        op11_nearest_neighbours, op12_collocations, op13_periodic_runs)}
