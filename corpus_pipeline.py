"""The corpus pipeline: documents in, token digests out, one operator a stage.

run() writes what a stage returns as Parquet in the shared folder and reads it
again for the next one, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spanframe.llm import bpe, lines, mixing, quality, simhash
from spanframe.llm.common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. Short ones are judged by the rules as well, so that clean short documents stay.

    Null, empty and blank texts have no words and go; repeated rows stay or go together; an empty table stays empty.
    """
    return quality.passing(docs, least_words=1)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines go from all but the first document; n_chars follows.

    Null and empty texts stay as they are; rows that repeat id and text keep the same; an empty table stays empty.
    """
    return lines.with_kept_text(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: similarity of 0.8 or more by shingles of five words.

    Links come from the binary trie of fingerprints, confirmed by shingles; texts that it leaves apart are compared by bands of minima.
    The smallest doc_id of a group stays, of repeated rows one. Texts without words are copies of each other; rows without a doc_id stay; an empty table stays empty.
    """
    return simhash.one_of_each(docs, shingle=5)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as their source's target asks.

    Null sources are one source, last; texts without words weigh nothing; repeated rows are emitted alike; an empty table stays empty.
    """
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the bytes they decode to.

    Null and empty texts have no ids; repeated rows give repeated results; an empty table an empty result.
    """
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: Expectation maximisation, connected components and byte-pair merges are no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
