"""Mixing sources to target weights.

Sizes are words. Sources in code-point order, null last, get the weights of a
cycle; together they share a part of all words. A source's target stops at a
multiple of its size and the excess is shared by weight among the others: that
is filling to a common level per weight, which sorted cumulative sums give
directly. A document is then emitted floor(rate) times, and once more if a hash
of its id falls below the fraction; rate is its source's target over its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanframe.llm.common import SPACES, written

#: Up to so many sources the targets are broadcast.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    bare = F.btrim(text.cast("string"), F.lit(SPACES))
    return F.when(text.isNull() | (bare == ""), F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("bigint")


def unit_hash(column: Column, seed: str) -> Column:
    """A number in [0, 1) that follows from the value as text and the seed; of null as of the empty text."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(column.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """sizes: (source, size). Per source: source, source_size, target. One row a source stands in one task."""
    all_of = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    named = named.withColumn("cap", F.lit(float(limit)) * F.col("source_size")).withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), nth % len(weights)))
    named = named.withColumn("whole", F.lit(float(share)) * F.sum("source_size").over(all_of))
    summed = named.withColumn("weight_on", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))).withColumn("cap_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    marked = summed.withColumn("full", F.col("cap") * F.col("weight_on") + F.col("cap_before") * F.col("weight") <= F.col("whole") * F.col("weight"))
    left = F.col("whole") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(all_of)
    weight = F.nullif(F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(all_of), F.lit(0.0))
    return marked.withColumn("level", left / weight).select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))


def with_copies(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: str = "mix:", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: bool = False) -> DataFrame:
    """Per row of docs: id_col, size, source_size, target, copies, taken; with keep also a column row, a struct of all columns of docs.

    copies is how often the mix holds the row, taken = copies * size. Null
    texts have size 0. A source without words has target 0 and no copies.
    Rows of one id get the same hash, so repeated rows are taken alike and
    reruns agree. An empty table gives an empty result. Names in docs can't
    clash with ours: they stay inside the struct.
    """
    if share > limit:
        raise ValueError("sources can't share more than their limit")
    columns = [F.col(id_col).alias("__id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")]
    rows = docs.select(*columns, *([F.struct(*docs.columns).alias("row")] if keep else []))
    sizes = rows if keep else written(rows, "mix-sizes")
    targets = written(source_targets(sizes.select("source", "size"), weights, share, limit), "mix-targets")
    there = F.broadcast(targets) if targets.count() <= BROADCAST_SOURCES else targets
    joined = sizes.join(there.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", rate)
    copies = F.floor("rate") + (unit_hash(F.col("__id"), seed) < F.col("rate") - F.floor("rate")).cast("bigint")
    joined = joined.withColumn("copies", copies)
    return joined.select(F.col("__id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["row"] if keep else []))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: docs with every row as often as with_copies says.

    Null and empty texts and null sources are rows like others; repeated rows
    are emitted alike; columns with any names pass through; an empty table stays empty.
    """
    rows = with_copies(docs, keep=True, **options).filter("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("__n")).select("row.*")


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> '')), 0) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
named AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         ([3.0, 1.0, 2.0]::DOUBLE[])[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
         1.5::DOUBLE * sum(source_size) OVER () AS whole FROM totals),
summed AS (
  SELECT *, sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_on,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before FROM named),
marked AS (SELECT *, cap * weight_on + cap_before * weight <= whole * weight AS is_full FROM summed),
levelled AS (
  SELECT *, (whole - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (), 0) AS level FROM marked),
targets AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE least(cap, level * weight) END AS target FROM levelled),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM rated
"""
