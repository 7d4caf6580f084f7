"""Interval algebra and interval joins over half-open integer intervals.

A relation of intervals has key columns, a start and an end; end > start. All
operators are windows, aggregations and equi joins. Joins carry a time bucket
beside the key: an interval goes to the buckets it touches, and a pair is kept in
the bucket of the later start alone, so pairs come once and a hot key is spread
over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a join bucket in the units of the intervals.
BUCKET = 3_600_000


def require_intervals(df: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """df with a column problem: null, or why the row is no interval of an ordered, disjoint relation."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    problem = (
        F.when(F.col(start).isNull() | F.col(end).isNull(), "missing bound")
        .when(F.col(start) < 0, "negative start")
        .when(F.col(end) <= F.col(start), "empty interval")
        .when(F.lag(end).over(order) > F.col(start), "overlaps the one before")
    )
    return df.withColumn("problem", problem)


def _islands(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col(start) > reach + gap)).cast("int")
    return df.withColumn("__opens", opens).withColumn("__island", F.sum("__opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def coalesce_intervals(df: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms", gap: int = 0, bucket: int | None = None) -> DataFrame:
    """Union: (keys, start, end, n_merged). Intervals up to gap apart become one; gap -1 keeps touching ones apart.

    With bucket, intervals are united by bucket of their start first and the
    unions then by key, so no task sees more of a hot key than its unions.
    """
    rows = df.select(*keys, F.col(start).alias(start), F.col(end).alias(end)).withColumn("n_merged", F.lit(1).cast("bigint"))
    for by in [[*keys, "__bucket"], list(keys)] if bucket else [list(keys)]:
        if "__bucket" in by:
            rows = rows.withColumn("__bucket", F.floor(F.col(start) / bucket))
        rows = _islands(rows, by, start, end, gap).groupBy(*by, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("n_merged").alias("n_merged")).select(*keys, start, end, "n_merged")
    return rows


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Common length of two intervals; null if a bound is null, since least and greatest would pass over it."""
    known = a_start.isNotNull() & a_end.isNotNull() & b_start.isNotNull() & b_end.isNotNull()
    return F.when(known, F.greatest(F.lit(0).cast("bigint"), F.least(a_end, b_end) - F.greatest(a_start, b_start)))


def _bucketed(df: DataFrame, start: str, end: str, bucket: int) -> DataFrame:
    return df.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor((F.col(end) - 1) / bucket))))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_bounds: tuple[str, str], right_bounds: tuple[str, str], bucket: int = BUCKET) -> DataFrame:
    """Inner join of rows whose intervals overlap. Column names of the two sides must differ, keys apart."""
    (ls, le), (rs, re) = left_bounds, right_bounds
    both = _bucketed(left, ls, le, bucket).join(_bucketed(right, rs, re, bucket), [*keys, "__bucket"])
    hit = (F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le)) & (F.floor(F.greatest(ls, rs) / bucket) == F.col("__bucket"))
    return both.filter(hit).drop("__bucket")


def containment_join(outer: DataFrame, inner: DataFrame, keys: Sequence[str], outer_bounds: tuple[str, str], inner_bounds: tuple[str, str], bucket: int = BUCKET) -> DataFrame:
    """Inner join of rows whose inner interval lies within the outer one."""
    (os, oe), (s, e) = outer_bounds, inner_bounds
    both = _bucketed(outer, os, oe, bucket).join(inner.withColumn("__bucket", F.floor(F.col(s) / bucket)), [*keys, "__bucket"])
    return both.filter((F.col(os) <= F.col(s)) & (F.col(e) <= F.col(oe))).drop("__bucket")


def intersect_intervals(regions: DataFrame, items: DataFrame, keys: Sequence[str], region_bounds: tuple[str, str] = ("region_start", "region_end"), item_bounds: tuple[str, str] = ("start_ms", "end_ms"), bucket: int = BUCKET) -> DataFrame:
    """(keys, region bounds, start, end): what of each region items cover, clipped and united; touching pieces merge."""
    (rs, re), (s, e) = region_bounds, item_bounds
    hit = interval_join(regions.select(*keys, rs, re), items.select(*keys, s, e), keys, region_bounds, item_bounds, bucket)
    clipped = hit.select(*keys, rs, re, F.greatest(rs, s).alias(s), F.least(re, e).alias(e))
    return coalesce_intervals(clipped, [*keys, rs, re], s, e).drop("n_merged")


def subtract_intervals(regions: DataFrame, items: DataFrame, keys: Sequence[str], region_bounds: tuple[str, str] = ("region_start", "region_end"), item_bounds: tuple[str, str] = ("start_ms", "end_ms"), bucket: int = BUCKET) -> DataFrame:
    """(keys, region bounds, gap_start, gap_end): what of each region no item covers. A region that none touches is one gap."""
    (rs, re), (s, e) = region_bounds, item_bounds
    covered = intersect_intervals(regions, items, keys, region_bounds, item_bounds, bucket)
    by = [*keys, rs, re]
    # each covered piece ends a gap, and the region's end ends the last one
    stops = covered.select(*by, F.col(s).alias("gap_end"), F.col(e).alias("__reach")).unionByName(regions.select(*by).distinct().select(*by, F.col(re).alias("gap_end"), F.col(re).alias("__reach")))
    order = Window.partitionBy(*by).orderBy("gap_end", "__reach")
    return stops.withColumn("gap_start", F.coalesce(F.lag("__reach").over(order), F.col(rs))).filter("gap_start < gap_end").select(*by, "gap_start", "gap_end")


def coverage(regions: DataFrame, items: DataFrame, keys: Sequence[str], region_bounds: tuple[str, str] = ("region_start", "region_end"), item_bounds: tuple[str, str] = ("start_ms", "end_ms"), bucket: int = BUCKET) -> DataFrame:
    """(keys, region bounds, covered_ms, region_ms, n_pieces): regions without items included; an empty region has no row in a relation of intervals."""
    (rs, re), (s, e) = region_bounds, item_bounds
    covered = intersect_intervals(regions, items, keys, region_bounds, item_bounds, bucket)
    sums = covered.groupBy(*keys, rs, re).agg(F.sum(F.col(e) - F.col(s)).alias("covered_ms"), F.count("*").alias("n_pieces"))
    all_regions = regions.select(*keys, rs, re).distinct()
    return all_regions.join(sums, [*keys, rs, re], "left").select(*keys, rs, re, F.coalesce("covered_ms", F.lit(0)).cast("bigint").alias("covered_ms"), (F.col(re) - F.col(rs)).alias("region_ms"), F.coalesce("n_pieces", F.lit(0)).cast("bigint").alias("n_pieces"))


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole; of nothing, all is covered."""
    return F.when(whole == 0, F.lit(1.0)).otherwise(part / whole)


def chop(df: DataFrame, longest: int, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Intervals cut from their start into pieces of at most longest."""
    pieces = df.withColumn("__at", F.explode(F.sequence(F.col(start), F.col(end) - 1, F.lit(longest).cast("bigint"))))
    return pieces.withColumn(end, F.least(F.col("__at") + longest, F.col(end))).withColumn(start, F.col("__at")).drop("__at")


def elementary_intervals(df: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """(keys, start, end, n_active): time cut at every bound, with the number of intervals that hold each piece; pieces of none are left out.

    A running sum of +1 and -1 at the bounds: linear in them, however many intervals hold a piece.
    """
    bounds = df.select(*keys, F.col(start).alias("__at"), F.lit(1).alias("__d")).unionByName(df.select(*keys, F.col(end).alias("__at"), F.lit(-1).alias("__d")))
    steps = bounds.groupBy(*keys, "__at").agg(F.sum("__d").alias("__d"))
    order = Window.partitionBy(*keys).orderBy("__at")
    run = steps.select(*keys, F.col("__at").alias(start), F.lead("__at").over(order).alias(end), F.sum("__d").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("n_active"))
    return run.filter(F.col(end).isNotNull() & (F.col("n_active") > 0))


def active_sets(df: DataFrame, keys: Sequence[str], label: str, start: str = "start_ms", end: str = "end_ms", bucket: int = BUCKET) -> DataFrame:
    """elementary_intervals with active: the sorted labels of the intervals that hold each piece."""
    pieces = elementary_intervals(df, keys, start, end).select(*keys, F.col(start).alias("piece_start"), F.col(end).alias("piece_end"))
    held = interval_join(pieces, df.select(*keys, F.col(start), F.col(end), F.col(label)), keys, ("piece_start", "piece_end"), (start, end), bucket)
    return held.groupBy(*keys, "piece_start", "piece_end").agg(F.sort_array(F.collect_list(label)).alias("active")).select(*keys, F.col("piece_start").alias(start), F.col("piece_end").alias(end), "active")


def outside_runs(items: DataFrame, regions: DataFrame, keys: Sequence[str], item_bounds: tuple[str, str], region_bounds: tuple[str, str], bucket: int = BUCKET) -> DataFrame:
    """(keys, item bounds, gap_start, gap_end): the parts of each item outside all regions."""
    return subtract_intervals(items, regions, keys, item_bounds, region_bounds, bucket)


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, columns: Sequence[str], direction: str = "previous", order: Sequence[str] = ()) -> DataFrame:
    """left with columns of the last right row at or before at (previous), or of the first at or after it (next).

    order breaks ties among right rows of one time: the last of them counts
    for previous, the first for next. One sort of both sides by key and time.
    """
    packed = F.struct(*[F.col(c) for c in columns])
    before = direction == "previous"
    l_rows = left.select(*keys, F.col(at).alias("__t"), F.lit(1 if before else 0).alias("__side"), F.struct(*left.columns).alias("__l"), F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType).alias("__r"), *[F.lit(None).cast(right.schema[c].dataType).alias(f"__o{i}") for i, c in enumerate(order)])
    r_rows = right.select(*keys, F.col(right_at).alias("__t"), F.lit(0 if before else 1).alias("__side"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType).alias("__l"), packed.alias("__r"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])
    by = Window.partitionBy(*keys).orderBy("__t", "__side", *[f"__o{i}" for i in range(len(order))])
    frame = by.rowsBetween(Window.unboundedPreceding, -1) if before else by.rowsBetween(1, Window.unboundedFollowing)
    found = (F.last("__r", ignorenulls=True) if before else F.first("__r", ignorenulls=True)).over(frame)
    return l_rows.unionByName(r_rows).withColumn("__found", found).filter(F.col("__l").isNotNull()).select("__l.*", *[F.col("__found")[c].alias(c) for c in columns])


def band_join(df: DataFrame, keys: Sequence[str], index: str, width: int, columns: Sequence[str]) -> DataFrame:
    """Each row with its neighbours of the same key up to width indexes away, itself left out: offset, and the neighbour's columns behind other_.

    The band is exploded to offsets, so it is an equi join.
    """
    offsets = F.filter(F.sequence(F.lit(-width), F.lit(width)), lambda o: o != 0)
    mine = df.withColumn("offset", F.explode(offsets)).withColumn("__at", F.col(index) + F.col("offset"))
    other = df.select(*keys, F.col(index).alias("__at"), *[F.col(c).alias(f"other_{c}") for c in columns])
    return mine.join(other, [*keys, "__at"]).drop("__at")


def rebased(items: DataFrame, parts: DataFrame, keys: Sequence[str], part_bounds: tuple[str, str] = ("part_start", "part_end"), item_bounds: tuple[str, str] = ("start_ms", "end_ms"), bucket: int = BUCKET) -> DataFrame:
    """Items clipped to each part that they overlap, in the part's own time."""
    (ps, pe), (s, e) = part_bounds, item_bounds
    hit = interval_join(parts, items, keys, part_bounds, item_bounds, bucket)
    return hit.withColumn(e, F.least(pe, e) - F.col(ps)).withColumn(s, F.greatest(F.lit(0).cast("bigint"), F.col(s) - F.col(ps)))


def dominant_column(frames: DataFrame, keys: Sequence[str], values: str, least_frames: int = 1, least_share: float = 0.0) -> DataFrame:
    """(keys, winner, frames, share): the column that is largest in most frames; values is an array, the first of equal maxima counts.

    Null where it wins too few frames or too small a share of them.
    """
    voted = frames.select(*keys, F.array_position(values, F.array_max(values)).cast("int").alias("winner"))
    counted = voted.groupBy(*keys, "winner").agg(F.count("*").alias("frames"))
    by = Window.partitionBy(*keys)
    ranked = counted.withColumn("share", F.col("frames") / F.sum("frames").over(by)).withColumn("__r", F.row_number().over(by.orderBy(F.desc("frames"), "winner")))
    top = ranked.filter("__r = 1").drop("__r")
    return top.withColumn("winner", F.when((F.col("frames") >= least_frames) & (F.col("share") >= least_share), F.col("winner")))
