"""What filters do to each other: failures as masks, their histogram, and every order of the filters.

A document fails any of five filters, whatever the others say, so a mask of five
bits holds all that an order of filters can ask. One pass over the texts writes
four bits, a digest and the id; grouping by digest gives the least id of each
text and so the fifth bit. What remains of a part is 32 cells of counts at most,
and all 120 orders are worked out from these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanframe.llm.common import SPACES, written
from spanframe.llm.quality import let

#: One letter a filter; the bit of the k-th letter is 2 ** k.
LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 100, 80, 10
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = r"[#$%&*|]"


def text_mask(text: Column) -> Column:
    """The bits of A to D of a text that isn't null."""
    bare = F.btrim(text, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))

    def of_words(w: Column) -> Column:
        few = (F.size(w) < LEAST_WORDS).cast("int")
        return few + F.when(100 * F.size(F.array_distinct(w)).cast("bigint") < LEAST_DISTINCT_PERCENT * F.size(w).cast("bigint"), 2).otherwise(0)

    n = F.length(text).cast("bigint")
    capitals = n - F.length(F.translate(text, CAPITALS, ""))
    return let(words, of_words) + F.when(100 * capitals > MOST_CAPITALS_PERCENT * n, 4).otherwise(0) + F.when(text.rlike(SIGNS), 8).otherwise(0)


def failure_masks(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """Per row of docs: id, part, mask (int), written to the shared folder.

    Null texts count as empty, null parts as the empty string. A text repeats if
    a row with a smaller id has the same (by SHA-256 and length); a row without an
    id neither repeats a text nor makes another one a repeat, and of rows that
    share id and text none repeats the other. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), part.alias("part"), text.alias("text"))
    # texts end here: what follows sees some 60 bytes a document
    slim = written(rows.select("id", "part", text_mask(F.col("text")).alias("bits"), F.unhex(F.sha2("text", 256)).alias("digest"), F.length("text").alias("n")), "masks")
    first = slim.filter("id IS NOT NULL").groupBy("digest", "n").agg(F.min("id").alias("id"))
    # joined by id and digest, not by digest alone, so that copies of one text don't meet in one task
    known = slim.join(first.withColumn("is_first", F.lit(True)), ["id", "digest", "n"], "left")
    repeats = F.col("id").isNotNull() & F.col("is_first").isNull()
    return known.select("id", "part", (F.col("bits") + F.when(repeats, 16).otherwise(0)).alias("mask"))


def histogram(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, cells): cells is an array of (mask, n, good, toxic), 32 at most.

    An id counts as good or toxic if any of its labels says so; labels without
    an id name no document.
    """
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    counted = masks.join(known, "id", "left").groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def orders_of(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, cells, filter_order, step, bit, before): each order of the letters, a row a step; before is the mask of the filters in front."""
    rows = cells.withColumn("filter_order", F.lit("")).withColumn("__left", F.lit(letters))
    for _ in letters:
        rows = rows.withColumn("__next", F.explode(F.split("__left", ""))).filter("__next <> ''")
        rows = rows.withColumn("filter_order", F.concat("filter_order", "__next")).withColumn("__left", F.replace(F.col("__left"), F.col("__next"), F.lit("")))
    bits = F.transform(F.split("filter_order", ""), lambda c: F.pow(F.lit(2), F.instr(F.lit(letters), c) - 1).cast("int"))
    steps = rows.withColumn("__bits", bits).select("part", "cells", "filter_order", "__bits", F.posexplode("__bits").alias("__k", "bit"))
    return steps.withColumn("before", F.aggregate(F.slice("__bits", F.lit(1), F.col("__k")), F.lit(0), lambda a, b: a + b)).withColumn("step", F.col("__k") + 1).drop("__bits", "__k")


def audited(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """Per part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Zeros are rows too. Nulls, repeats and the empty table are as in
    failure_masks and histogram; further columns are not read.
    """
    cells = histogram(failure_masks(docs, text_col, id_col, part_col), labels, id_col)
    steps = orders_of(cells)

    def total(what: str, holds) -> Column:
        return F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + F.when(holds(c["mask"]), c[what]).otherwise(0))

    bit, before = F.col("bit"), F.col("before")
    fails = lambda m: m.bitwiseAND(bit) != 0
    reached = lambda m: m.bitwiseAND(before) == 0
    here = lambda m: fails(m) & reached(m)
    counted = steps.select(
        "part", "filter_order", "step", "bit",
        total("n", lambda m: reached(m) & ~fails(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & ~reached(m)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    # a window of 120 rows, however large the part
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


OP13_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
cut AS (SELECT *, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> '') AS words FROM texts),
failed AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM cut),
known AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN known USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l) JOIN letters d ON d.l NOT IN (a.l, b.l, c.l)
  JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INTEGER AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & before = 0 AND mask & bit = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM counted
"""
