"""SubRip and WebVTT, read and written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanframe.functions.text import format_timestamp, parse_timestamp

_TIMING = r"^(\d{2,}:[0-5]\d:[0-5]\d,\d{3}) --> (\d{2,}:[0-5]\d:[0-5]\d,\d{3})$"
_CUE = r"^\s*((?:\d+:)?[0-5]\d:[0-5]\d\.\d{3})[ \t]+-->[ \t]+((?:\d+:)?[0-5]\d:[0-5]\d\.\d{3})(?:[ \t].*)?$"
_STAMP = r"<((?:\d+:)?[0-5]\d:[0-5]\d\.\d{3})>"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files; a byte-order mark goes. Files that aren't UTF-8 have a null text."""
    files = spark.read.format("binaryFile").load(path)
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.regexp_replace(F.col("content").cast("string"), "^﻿", ""))
    return files.select("path", text.alias("text"))


def parse_srt(files: DataFrame, key: str = "path", text: str = "text", strict: bool = True) -> DataFrame:
    """(key, index, start_ms, end_ms, text, problem): the entries of SubRip files; problem says why one isn't strict, null otherwise.

    Nothing is repaired. Entries are parted by blank lines; strict asks indexes to count up from 1.
    """
    clean = F.regexp_replace(F.regexp_replace(F.col(text), "\r\n?", "\n"), r"^\n+|\n+$", "")
    parts = files.filter(F.col(text).isNotNull()).select(key, F.posexplode(F.filter(F.split(clean, r"\n(?:[ \t]*\n)+"), lambda b: F.trim(b) != "")).alias("position", "block"))
    lines = F.split("block", "\n")
    index = F.trim(F.get(lines, 0)).try_cast("int")
    timing = F.get(lines, 1)
    body = F.array_join(F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(0))), "\n")
    start, end = (parse_timestamp(F.regexp_extract(timing, _TIMING, i)) for i in (1, 2))
    out = parts.select(key, "position", index.alias("index"), F.when(timing.rlike(_TIMING), start).alias("start_ms"), F.when(timing.rlike(_TIMING), end).alias("end_ms"), body.alias("text"))
    problem = (
        F.when(F.col("index").isNull(), "no index")
        .when(F.lit(strict) & (F.col("index") != F.col("position") + 1), "index out of order")
        .when(F.col("start_ms").isNull() | F.col("end_ms").isNull(), "no timing line")
        .when(F.col("end_ms") <= F.col("start_ms"), "empty interval")
        .when(F.trim("text") == "", "no text")
    )
    return out.withColumn("problem", problem).drop("position")


def render_srt(entries: DataFrame, keys: list[str], index: str = "index", start: str = "start_ms", end: str = "end_ms", text: str = "text", newline: str = "\r\n") -> DataFrame:
    """(keys, srt): one file's text per key, in order of index; entries are numbered anew from 1."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), F.col(start).alias("s"), F.col(end).alias("e"), F.col(text).alias("t"))))
    one = lambda r, k: F.concat((k + 1).cast("string"), F.lit(newline), format_timestamp(r["s"]), F.lit(" --> "), format_timestamp(r["e"]), F.lit(newline), F.regexp_replace(r["t"], "\r\n?|\n", newline), F.lit(newline))
    return entries.groupBy(*keys).agg(F.array_join(F.transform(rows, one), newline).alias("srt"))


def caption_entries(blocks: DataFrame, texts: DataFrame, key: str, index: str, text: str) -> DataFrame:
    """Blocks with their texts by key, whatever the texts' order; the caller has checked the keys with validate.key_issues."""
    return blocks.join(texts.select(key, F.col(text).alias("text")), key).withColumn("index", F.col(index))


def parse_vtt(files: DataFrame, key: str = "path", text: str = "text", snapshot_ms: int = 50, tail_ms: int = 500) -> DataFrame:
    """(key, caption_index, start_ms, end_ms, text) of WebVTT files.

    Rolling captions are brought to plain ones: of a cue's lines the newest that
    can be seen counts, cues of at most snapshot_ms without inline stamps go, a cue
    ends at most tail_ms behind its last inline stamp, and of equal cues the first stays.
    """
    clean = F.regexp_replace(F.regexp_replace(F.col(text), "\r\n?", "\n"), "^﻿", "")
    parts = files.filter(F.col(text).isNotNull()).select(key, F.posexplode(F.split(clean, r"\n(?:[ \t]*\n)+")).alias("position", "block"))
    lines = F.split("block", "\n")
    at = F.coalesce(F.get(F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(_CUE), i)), lambda i: i.isNotNull()), 0), F.lit(-1))
    cues = parts.withColumn("lines", lines).withColumn("at", at).filter("at >= 0")
    timing = F.get("lines", F.col("at"))
    start, end = (parse_timestamp(F.regexp_extract(timing, _CUE, i), ".", hours=False) for i in (1, 2))
    body = F.expr("slice(lines, at + 2, greatest(size(lines) - at - 1, 0))")
    plain = lambda x: _unescaped(F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]*>", ""), r"\s+", " ")))
    seen = F.filter(F.transform(body, plain), lambda x: x != "")
    stamps = F.regexp_extract_all(F.array_join(body, "\n"), F.lit(_STAMP), 1)
    cues = cues.select(key, "position", start.alias("start_ms"), end.alias("end_ms"), F.get(seen, F.size(seen) - 1).alias("text"), F.transform(stamps, lambda s: parse_timestamp(s, ".", hours=False)).alias("stamps"))
    cues = cues.filter("text IS NOT NULL AND end_ms > start_ms").filter((F.size("stamps") > 0) | (F.col("end_ms") - F.col("start_ms") > snapshot_ms))
    last = F.array_max("stamps")
    cues = cues.withColumn("end_ms", F.when(last.isNotNull(), F.least(F.col("end_ms"), F.greatest(F.col("start_ms") + 1, last + tail_ms))).otherwise(F.col("end_ms")))
    firsts = Window.partitionBy(key, "start_ms", "end_ms", "text").orderBy("position")
    kept = cues.withColumn("r", F.row_number().over(firsts)).filter("r = 1")
    return kept.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("start_ms", "position")) - 1).alias("caption_index"), "start_ms", "end_ms", "text")


def _unescaped(text: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&lrm;", "‎"), ("&rlm;", "‏"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def render_vtt(entries: DataFrame, keys: list[str], index: str = "index", start: str = "start_ms", end: str = "end_ms", text: str = "text") -> DataFrame:
    """(keys, vtt): WebVTT with texts escaped."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), F.col(start).alias("s"), F.col(end).alias("e"), F.col(text).alias("t"))))
    escaped = lambda t: F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    one = lambda r: F.concat(format_timestamp(r["s"], "."), F.lit(" --> "), format_timestamp(r["e"], "."), F.lit("\n"), escaped(r["t"]), F.lit("\n"))
    return entries.groupBy(*keys).agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(rows, one), "\n")).alias("vtt"))
