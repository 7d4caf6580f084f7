"""Typed rows from nested recognition output, and catalogue lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = "array<struct<start:double,end:double,text:string,words:array<struct<start:double,end:double,word:string,probability:double>>>>"


def millis(seconds: Column) -> Column:
    """Whole milliseconds, halves to even."""
    return F.bround(seconds * 1000, 0).cast("bigint")


def segments_from_json(df: DataFrame, key: str, value: str, offset_ms: int = 0) -> DataFrame:
    """(key, segment, start_ms, end_ms, text): segments of a JSON array, numbered in order; empty intervals and texts go."""
    rows = df.select(key, F.posexplode(F.from_json(value, SEGMENTS)).alias("segment", "s"))
    out = rows.select(key, "segment", (millis(F.col("s.start")) + offset_ms).alias("start_ms"), (millis(F.col("s.end")) + offset_ms).alias("end_ms"), F.trim("s.text").alias("text"))
    return out.filter("end_ms > start_ms AND text <> ''")


def words_from_json(df: DataFrame, key: str, value: str, offset_ms: int = 0) -> DataFrame:
    """(key, segment, word_index, start_ms, end_ms, text, probability): valid words in order of time, numbered anew by key; none is made up."""
    rows = df.select(key, F.posexplode(F.from_json(value, SEGMENTS)).alias("segment", "s")).select(key, "segment", F.explode("s.words").alias("w"))
    out = rows.select(key, "segment", (millis(F.col("w.start")) + offset_ms).alias("start_ms"), (millis(F.col("w.end")) + offset_ms).alias("end_ms"), F.col("w.word").alias("text"), F.col("w.probability").alias("probability"))
    out = out.filter("start_ms >= 0 AND end_ms > start_ms AND trim(text) <> ''")
    return out.withColumn("word_index", F.row_number().over(Window.partitionBy(key).orderBy("start_ms", "end_ms", "segment", "text")) - 1)


def catalogue_match(df: DataFrame, title_tokens: str, wanted: list[str], url: str) -> DataFrame:
    """(n_urls, url): distinct URLs of entries whose title tokens are exactly the wanted ones; url is null unless there is one."""
    hit = df.filter(F.col(title_tokens) == F.array(*map(F.lit, wanted)))
    return hit.agg(F.count_distinct(url).alias("n_urls"), F.min(url).alias("url")).withColumn("url", F.when(F.col("n_urls") == 1, F.col("url")))


def stream_hashes(df: DataFrame, line: str, keys: list[str]) -> DataFrame:
    """(keys, kind, ordinal, algorithm, digest) of lines like "0,v,SHA256=..."; the ordinal counts within a kind."""
    pattern = r"^(\d+),([a-z]),([A-Za-z0-9]+)=([0-9a-fA-F]+)$"
    get = lambda i: F.regexp_extract(F.trim(line), pattern, i)
    rows = df.filter(F.trim(line).rlike(pattern)).select(*keys, get(1).cast("int").alias("stream"), get(2).alias("kind"), F.lower(get(3)).alias("algorithm"), F.lower(get(4)).alias("digest"))
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys, "kind").orderBy("stream")) - 1).drop("stream")
