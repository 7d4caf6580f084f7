"""Line dedup in DataFrame expressions: content-defined chunks of lines.

A rolling hash over the hashes of two neighbouring lines sets the boundaries, so
inserted or deleted lines shift none beyond their neighbours. Chunks with two
lines or more that have a word count as passages; of equal passages in the whole
corpus the first by document and place stays and all others are removed. Passages
are found by a digest and confirmed by their bytes: they are grouped by digest
and text, which compares whole texts, and a digest that two texts share removes
nothing. Counts are combined before they are moved, so a passage that a third of
all documents hold is one row from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import SPACES
from spanframe.llm.quality import let

#: One line in so many begins a chunk.
DIVISOR = 3
#: The rolling hash: of lines a and b, (a * ROLL + b) modulo a prime; ROLL and the prime keep their order apart in every divisor.
ROLL, PRIME = 1_000_003, 2_147_483_647


def tie(text: Column) -> Column:
    """128 bits that tell texts under one id, or without any, apart."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def line_hash(line: Column) -> Column:
    """The first 32 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("bigint")


def chunks(text: Column) -> Column:
    """array of (at, lines): where a chunk begins among the lines, and its lines. Null and empty texts are one empty line."""

    def of_lines(lines: Column) -> Column:
        def of_hashes(h: Column) -> Column:
            inner = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: (i == 0) | ((i >= 2) & ((F.get(h, i - 2) * ROLL + F.get(h, i - 1)) % PRIME % DIVISOR == 0)))
            return let(inner, lambda s: F.transform(s, lambda at, k: F.struct(at.alias("at"), F.slice(lines, at + 1, F.coalesce(F.get(s, k + 1), F.size(lines)) - at).alias("lines"))))

        return let(F.transform(lines, line_hash), of_hashes)

    return let(F.split(F.coalesce(text, F.lit("")), "\n"), of_lines)


def _full(lines: Column) -> Column:
    return F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(SPACES)) != "")) >= 2


def removed_chunks(rows: DataFrame) -> DataFrame:
    """rows: (doc, tie, text). (doc, tie, gone): where the chunks begin that are equal to an earlier one."""
    passage = rows.select("doc", "tie", F.explode(F.filter(chunks(F.col("text")), lambda c: _full(c["lines"]))).alias("c"))
    passage = passage.select("doc", "tie", F.col("c.at").alias("at"), F.array_join("c.lines", "\n").alias("passage")).withColumn("digest", F.md5(F.col("passage").cast("binary")))
    equal = passage.groupBy("digest", "passage").agg(F.count("*").alias("n"), F.min(F.struct("doc", "tie", "at")).alias("first")).drop("passage")
    known = equal.groupBy("digest").agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.min("first").alias("first")).filter("n > 1 AND texts = 1")
    later = passage.drop("passage").join(known.select("digest", "first"), "digest").filter(~F.struct("doc", "tie", "at").eqNullSafe(F.col("first")))
    return later.groupBy("doc", "tie").agg(F.collect_list("at").alias("gone"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, n_lines, n_removed_lines, kept): row is a struct of all columns of docs, kept the text without its repeated chunks.

    Null and empty texts are one empty line and lose nothing; kept is null where
    the text is. The first copy of a passage stays, also within one document.
    Rows that repeat id and text are one document and keep the same; of rows
    without an id, equal ones likewise. An empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc"), tie(text).alias("tie"))
    gone = removed_chunks(docs.select(F.col(id_col).alias("doc"), tie(text).alias("tie"), text.alias("text")))
    # the text travels once, inside the row
    both = rows.join(gone, rows["doc"].eqNullSafe(gone["doc"]) & (rows["tie"] == gone["tie"]), "left").select("row", F.col("row")[text_col].cast("string").alias("text"), "gone")
    kept = F.filter(chunks(F.col("text")), lambda c: ~F.array_contains("gone", c["at"]))
    left = F.when(F.col("gone").isNull(), F.split("text", "\n")).otherwise(F.flatten(F.transform(kept, lambda c: c["lines"])))
    both = both.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint"))
    both = both.withColumn("left", left)
    return both.select("row", "n_lines", F.when(F.col("gone").isNull(), 0).otherwise(F.col("n_lines") - F.size("left")).cast("bigint").alias("n_removed_lines"), F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("left", "\n")).alias("kept"))


def with_kept_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs with its text replaced by what deduplicated keeps, and chars_col, where docs has it, by its length.

    Null and empty texts stay as they are; rows that repeat id and text, or text
    without an id, keep the same; an empty table stays empty.
    """
    found = deduplicated(docs, id_col, text_col)
    new = {text_col: F.col("kept")} | ({chars_col: F.length("kept").cast(docs.schema[chars_col].dataType)} if chars_col in docs.columns else {})
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


OP1_SQL = r"""
WITH lined AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS i FROM lined),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM each),
marked AS (
  SELECT doc_id, i, line, CASE WHEN i = 0 THEN 1 WHEN i >= 2 AND (lag(h, 2) OVER w * 1000003 + lag(h, 1) OVER w) % 2147483647 % 3 = 0 THEN 1 ELSE 0 END AS opens
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
chunked AS (
  SELECT doc_id, k, min(i) AS begins, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS passage,
         count(*) FILTER (regexp_matches(line, '[^ \t-\r]')) >= 2 AS passes
  FROM numbered GROUP BY doc_id, k),
ranked AS (SELECT *, row_number() OVER (PARTITION BY passes, passage ORDER BY doc_id, begins) AS nth FROM chunked)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, CAST(coalesce(sum(n) FILTER (passes AND nth > 1), 0) AS BIGINT) AS n_removed_lines,
       sha256(coalesce(string_agg(passage, chr(10) ORDER BY begins) FILTER (NOT passes OR nth = 1), '')) AS kept_sha256
FROM ranked GROUP BY doc_id
"""
