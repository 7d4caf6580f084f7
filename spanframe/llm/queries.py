"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanframe.llm import audit, bpe, classifier, codes, html, leaks, lines, mixing, quality, rans, simhash, substrings, vectors
from spanframe.llm.common import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed_lines, kept_sha256. Null and empty texts are one empty line; the first copy of a passage stays; rows that repeat id and text keep the same. An empty table gives an empty result."""
    found = lines.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed_lines", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256. Null texts have no words; rows that repeat an id are documents of their own. An empty table gives an empty result."""
    return substrings.without_repeats(_table(spark, sf_dir, "documents"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, read back from the token files: doc_id, start, n_tokens, ids_crc32. Null texts have the end id alone; equal ids stand in the order of a hash of their texts. An empty table gives an empty result."""
    path = f"{shared_dir(spark)}/spanframe/tokens-{uuid.uuid4().hex}"
    rans.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return rans.read_tokens(spark, path)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, fingerprint, component_id. Texts without words have fingerprint 0 and link like any other; a null doc_id takes its component from rows with an id. An empty table gives an empty result."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken. Null texts have size 0; a null source is one of its own, last; repeated rows are taken alike. An empty table gives an empty result."""
    return mixing.with_copies(_table(spark, sf_dir, "documents")).drop("copies")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: page_id, url, text, n_chars. Null and empty pages have the empty text; pages without a host share one wrapper; repeated rows give repeated results. An empty table gives an empty result."""
    return html.extracted(_table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, counts, base_failed, kept. Null texts have no words and fail; repeated rows are judged alike. An empty table gives an empty result."""
    return quality.judged(_table(spark, sf_dir, "documents")).drop("posterior")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256. Null and empty texts have no ids; repeated rows give repeated results. An empty table gives an empty result."""
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept. Vectors that are null, empty, zero or not finite link with nothing; repeated rows of one vector link with each other. An empty table gives an empty result."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Null and empty texts score as the empty text; a null doc_id is held out, since no label names it; repeated rows score alike. An empty table gives an empty result."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    found = classifier.scored(docs, classifier.fit(docs, labels, usable=~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256. Null vectors and such with null or non-finite components are dropped; repeated rows get the same code each. An empty table gives an empty result."""
    return codes.digests(*codes.compressed(_table(spark, sf_dir, "embeddings")))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. Null texts have no words; repeated rows get the same result each. An empty table gives an empty result."""
    return leaks.digests(leaks.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. Null texts are empty, null langs the empty string; a null doc_id repeats no text. An empty table gives an empty result."""
    return audit.audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_output": op3_token_output,
    "op4_simhash": op4_simhash,
    "op5_mixing": op5_mixing,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality_rules": op7_quality_rules,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_vector_codes": op11_vector_codes,
    "op12_decontamination": op12_decontamination,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {"op1_line_dedup": lines.OP1_SQL, "op5_mixing": mixing.OP5_SQL, "op11_vector_codes": codes.OP11_SQL, "op12_decontamination": leaks.OP12_SQL, "op13_filter_audit": audit.OP13_SQL}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
