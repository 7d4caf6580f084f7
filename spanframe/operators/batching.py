"""Batches and parts: balanced, fixed, byte-bounded, contiguous shares, cuts at silences."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanframe.operators.ordering import BLOCK_ROWS, chained, numbered, written


def balanced_sizes(total: int, target: int = 400, least: int = 350, most: int = 500) -> list[int]:
    """Sizes that differ by one at most, none over most: as many batches as come near target and keep to least where they can."""
    if total <= 0:
        return []
    if total <= most:
        return [total]
    fewest, widest = math.ceil(total / most), total // least
    count = min(max(round(total / target), fewest), widest) if fewest <= widest else fewest
    small, extra = divmod(total, count)
    return [small + (k < extra) for k in range(count)]


def balanced_batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], target: int = 400, least: int = 350, most: int = 500) -> DataFrame:
    """df with batch, from 0: a key's rows in order, in balanced_sizes."""
    by = Window.partitionBy(*keys)
    n, row = F.count("*").over(by), F.row_number().over(by.orderBy(*order)) - 1
    fewest, widest = F.ceil(n / most), F.floor(n / least)
    count = F.when(n <= most, F.lit(1)).when(fewest <= widest, F.least(F.greatest(F.bround(n / target).cast("bigint"), fewest), widest)).otherwise(fewest)
    marked = df.withColumn("__n", n).withColumn("__row", row).withColumn("__count", count.cast("bigint"))
    marked = marked.withColumn("__small", F.floor(F.col("__n") / F.col("__count"))).withColumn("__extra", F.col("__n") % F.col("__count"))
    big = F.col("__extra") * (F.col("__small") + 1)
    batch = F.when(F.col("__row") < big, F.floor(F.col("__row") / (F.col("__small") + 1))).otherwise(F.col("__extra") + F.floor((F.col("__row") - big) / F.col("__small")))
    return marked.withColumn("batch", batch.cast("bigint")).drop("__n", "__row", "__count", "__small", "__extra")


def fixed_batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1) / size))


def contiguous_shares(df: DataFrame, keys: Sequence[str], order: Sequence[str], shares: int = 3) -> DataFrame:
    """df with share: row i of n goes where i * shares div n changes by the bounds k * n div shares (remainders differ from ntile)."""
    by = Window.partitionBy(*keys)
    row, n = F.row_number().over(by.orderBy(*order)) - 1, F.count("*").over(by)
    marked = df.withColumn("__row", row).withColumn("__n", n)
    bounds = F.transform(F.sequence(F.lit(1), F.lit(shares - 1)), lambda k: F.floor(k * F.col("__n") / shares)) if shares > 1 else F.array().cast("array<bigint>")
    return marked.withColumn("share", F.size(F.filter(bounds, lambda b: b <= F.col("__row")))).drop("__row", "__n")


def byte_batches(df: DataFrame, keys: Sequence[str], order: str, size: str, most_rows: int = 200, most_bytes: int = 1_500_000, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """df with batch, from 0: a batch ends before it would hold over most_rows rows or most_bytes; a larger row stands alone.

    A recurrence, whose state is where a batch begins; a key's rows are cut in
    blocks that are tasks of their own. A null size counts as 0.
    """

    def following(i: int, n: int, sizes: list[int]) -> int:
        held, k = sizes[i], i + 1
        while k < n and k - i < most_rows and held + sizes[k] <= most_bytes:
            held, k = held + sizes[k], k + 1
        return k

    sized = df.withColumn("__size", F.coalesce(F.col(size).cast("bigint"), F.lit(0).cast("bigint")))
    placed = written(numbered(sized, keys, [order], "__at"), "sized")
    return chained(placed, keys, "__at", ["__size"], following, "__at", most_rows, block_rows, "batch").drop("__at", "__size")


def silence_gaps(busy: DataFrame, keys: Sequence[str], least: int = 1000, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """(keys, gap_start, gap_end): pauses of at least least between united busy intervals."""
    from spanframe.operators.intervals import coalesce_intervals

    united = coalesce_intervals(busy, keys, start, end)
    by = Window.partitionBy(*keys).orderBy(start)
    return united.select(*keys, F.col(end).alias("gap_start"), F.lead(start).over(by).alias("gap_end")).filter(F.col("gap_end") - F.col("gap_start") >= least)


def part_cuts(gap_ends: Sequence[int], total: int, target: int = 3_600_000, guard: int = 120, forced_after: int | None = None, most_parts: int = 64) -> list[int]:
    """Cuts of one timeline: each at the first pause that ends at least target behind the last cut, guard before its end.

    With forced_after, a cut is made at target where no pause follows within that time.
    More than most_parts parts are an error, not a longer last part.
    """
    ends = sorted(g - guard for g in gap_ends)
    cuts, last = [], 0
    while True:
        k = bisect_left(ends, last + target)
        cut = ends[k] if k < len(ends) and ends[k] < total else None
        if forced_after is not None and last + target < total and (cut is None or cut > last + target + forced_after):
            cut = last + target
        if cut is None:
            return cuts
        if len(cuts) == most_parts - 1:
            raise ValueError(f"a timeline would have over {most_parts} parts")
        cuts.append(cut)
        last = cut


def planned_parts(busy: DataFrame, keys: Sequence[str], totals: DataFrame, total: str = "total_ms", least_gap: int = 1000, start: str = "start_ms", end: str = "end_ms", **cutting) -> DataFrame:
    """(keys, part, part_start, part_end): every key's timeline cut by part_cuts; the pauses of a key are what one task sees of it."""
    gaps = silence_gaps(busy, keys, least_gap, start, end).groupBy(*keys).agg(F.sort_array(F.collect_list("gap_end")).alias("gap_ends"))
    joined = totals.join(gaps, list(keys), "left").select(*keys, F.col(total).cast("bigint").alias("total"), F.coalesce("gap_ends", F.array().cast("array<bigint>")).alias("gap_ends"))

    def cut(batches):
        for rows in batches:
            found = [part_cuts(list(g), int(t), **cutting) for g, t in zip(rows["gap_ends"], rows["total"], strict=True)]
            rows["bounds"] = [[0, *c, int(t)] for c, t in zip(found, rows["total"], strict=True)]
            yield rows.drop(columns=["gap_ends", "total"])

    fields = ", ".join(f"`{k}` {joined.schema[k].dataType.simpleString()}" for k in keys)
    bounds = joined.mapInPandas(cut, f"{fields}, bounds array<bigint>")
    parts = bounds.select(*keys, F.posexplode(F.transform(F.sequence(F.lit(0), F.size("bounds") - 2), lambda i: F.struct(F.get("bounds", i).alias("a"), F.get("bounds", i + 1).alias("b")))).alias("part", "p"))
    return parts.select(*keys, "part", F.col("p.a").alias("part_start"), F.col("p.b").alias("part_end"))
