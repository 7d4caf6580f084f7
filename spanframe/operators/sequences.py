"""Ordered-sequence operators: boundaries, sessions, contexts, islands, grouping, timing.

Order is data: every operator takes the columns that order a key's rows. Windows
and aggregations do the work; only recurrences that depend on what they have
emitted themselves run in Python, down sorted rows or one key's sequence at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from spanframe.operators import segmentation
from spanframe.operators.ordering import group_batches, same_rows, scanned, shared_folder

SENTENCE_END = r"[.!?…][\"'”’»)]*\s*$"
CLAUSE_END = r"[,;:][\"'”’»)]*\s*$"
TURN_START = r"^\s*[-–—]\s*\S"


def ends_sentence(text: Column) -> Column:
    return text.rlike(SENTENCE_END)


def ends_clause(text: Column) -> Column:
    return text.rlike(CLAUSE_END)


def starts_turn(text: Column) -> Column:
    return text.rlike(TURN_START)


def speakers_unsafe(a: Column, b: Column) -> Column:
    """An overlap is unsafe if a speaker is unknown or both are the same; never null."""
    return F.coalesce(a.isNull() | b.isNull() | (a == b), F.lit(True))


def hard_boundaries(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, text: str | None = None, regions: str | None = None, hard_gap: int = 1000, review_gap: int = 650, sentence_gap: int = 180, clause_gap: int = 350) -> DataFrame:
    """df with gap_ms to the row before and reasons: why a group must end there. First rows have neither.

    regions: an array column; rows whose regions have nothing in common, both having some, are apart.
    """
    by = Window.partitionBy(*keys).orderBy(*order)
    gap = F.col(start) - F.lag(end).over(by)
    found = [F.when(gap >= hard_gap, "hard_gap")]
    if text:
        before = F.lag(text).over(by)
        found += [F.when(starts_turn(F.col(text)) & before.isNotNull(), "turn")]
    if regions:
        other = F.lag(regions).over(by)
        found += [F.when((F.size(regions) > 0) & (F.size(other) > 0) & ~F.arrays_overlap(regions, other), "region")]
    found += [F.when(gap >= review_gap, "review_gap")]
    if text:
        found += [F.when(ends_sentence(before) & (gap >= sentence_gap), "sentence"), F.when(ends_clause(before) & (gap >= clause_gap), "clause")]
    return df.withColumn("gap_ms", gap).withColumn("reasons", F.array_compact(F.array(*found)))


def sessions(df: DataFrame, keys: Sequence[str], order: Sequence[str], opens: Column, name: str = "session") -> DataFrame:
    """df with the number, from 0, of the run it is in; a run begins at a key's first row and wherever opens is true."""
    by = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(by) == 1
    flagged = df.withColumn("__opens", F.when(first, 0).otherwise(F.coalesce(opens, F.lit(False)).cast("int")))
    return flagged.withColumn(name, F.sum("__opens").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("__opens")


def gap_sessions(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, gap: int, name: str = "session") -> DataFrame:
    """Runs that end where a row starts more than gap behind the end of the row before."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return sessions(df.withColumn("__gap", F.col(start) - F.lag(end).over(by)), keys, order, F.col("__gap") > gap, name).drop("__gap")


def reach_sessions(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: int, window_end: str | None = None, name: str = "session") -> DataFrame:
    """Runs that end where a row starts more than gap behind the row before and behind the furthest end so far."""
    by = Window.partitionBy(*keys).orderBy(start, end)
    so_far = F.max(window_end or end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("__break", ((F.col(start) - F.lag(end).over(by)) > gap) & (F.col(start) > so_far))
    return sessions(marked, keys, [start, end], F.col("__break"), name).drop("__break")


def with_context(df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, count: int = 2, separator: str = " / ") -> DataFrame:
    """df with the texts of up to count rows before and behind, joined in order."""
    by = Window.partitionBy(*keys).orderBy(*order)
    near = lambda a, b: F.array_join(F.collect_list(text).over(by.rowsBetween(a, b)), separator)
    return df.withColumn("context_before", near(-count, -1)).withColumn("context_after", near(1, count))


def islands(df: DataFrame, keys: Sequence[str], index: str, value: str, least: int = 2) -> DataFrame:
    """df with island (first index), run_length and in_run: rows whose indexes follow each other with one value."""
    by = Window.partitionBy(*keys, value).orderBy(index)
    marked = df.withColumn("__i", F.col(index) - F.row_number().over(by))
    run = Window.partitionBy(*keys, value, "__i")
    return marked.withColumn("island", F.min(index).over(run)).withColumn("run_length", F.count("*").over(run)).withColumn("in_run", F.col("run_length") >= least).drop("__i")


def gap_split(df: DataFrame, keys: Sequence[str], start: str, end: str, text: str, gap: int, review_gap: int) -> DataFrame:
    """(keys, part, start, end, n, text, review): rows grouped at gaps over gap; review where a gap reaches review_gap in front of the group."""
    by = Window.partitionBy(*keys).orderBy(start, end)
    marked = df.withColumn("__gap", F.col(start) - F.lag(end).over(by))
    numbered = sessions(marked, keys, [start, end], F.col("__gap") > gap, "part")
    return numbered.groupBy(*keys, "part").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(start, end, text))), lambda x: x[text]), " ").alias(text), F.coalesce(F.max(F.col("__gap") >= review_gap), F.lit(False)).alias("review"))


def overlap_before(df: DataFrame, keys: Sequence[str], start: str, end: str, touching: bool = False) -> DataFrame:
    """df with overlaps: whether any row before reaches into it; with touching also if it only touches."""
    by = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("overlaps", F.coalesce(reach >= F.col(start) if touching else reach > F.col(start), F.lit(False)))


def adjacent_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, speaker: str, start: str, end: str, short: int = 1200) -> DataFrame:
    """df with duplicate: the row before has the same text, an unsafe speaker pair, and one of the two is short."""
    by = Window.partitionBy(*keys).orderBy(*order)
    length = F.col(end) - F.col(start)
    same = (F.col(text) == F.lag(text).over(by)) & ((length <= short) | (F.lag(length).over(by) <= short))
    first = F.row_number().over(by) == 1
    return df.withColumn("duplicate", ~first & F.coalesce(same, F.lit(False)) & speakers_unsafe(F.col(speaker), F.lag(speaker).over(by)))


def assigned_timings(df: DataFrame, keys: Sequence[str], start: str, last: str, text: str, tail: int = 220, guard: int = 80, least: int = 700, longest: int = 7000, chars_per_second: float = 20.0) -> DataFrame:
    """df with display_end: last spoken + tail or what reading takes, at most longest, and guard before the next start (else 1 before it)."""
    by = Window.partitionBy(*keys).orderBy(start, last)
    following = F.lead(start).over(by)
    needed = F.greatest(F.lit(least).cast("bigint"), F.ceil(F.length(text) / chars_per_second * 1000))
    wanted = F.least(F.greatest(F.col(last) + tail, F.col(start) + needed), F.col(start) + longest)
    free = F.when(following - guard >= F.col(last), following - guard).otherwise(following - 1)
    return df.withColumn("display_end", F.when(following.isNull(), wanted).otherwise(F.least(wanted, free)))


def speaker_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], speaker: str, name: str = "session") -> DataFrame:
    """Runs of one speaker; unknown speakers belong to the run they stand in, and tainted says that a run has one."""
    by = Window.partitionBy(*keys).orderBy(*order)
    carried = F.last(speaker, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    known = df.withColumn("__opens", F.col(speaker).isNotNull() & carried.isNotNull() & (F.col(speaker) != carried))
    out = sessions(known, keys, order, F.col("__opens"), name).drop("__opens")
    return out.withColumn("tainted", F.max(F.col(speaker).isNull()).over(Window.partitionBy(*keys, name)))


def _grouped(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, number: Callable[[pd.DataFrame], Iterable[int]]) -> DataFrame:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(list(order), kind="stable").reset_index(drop=True)
        rows[name] = list(number(rows))
        return rows

    return df.groupBy(*keys).applyInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", {name} bigint")


def _apart(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, gap: int) -> DataFrame:
    """df with __chunk: a new one wherever a row starts more than gap behind all before it, so that a recurrence need not see a whole key."""
    by = Window.partitionBy(*keys).orderBy(*order)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return sessions(df.withColumn("__far", F.col(start) > reach + gap), keys, order, F.col("__far"), "__chunk").drop("__far")


def capped_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, size: str, longest: int = 6000, most: int = 78, gap: int = 3500, name: str = "part") -> DataFrame:
    """Greedy grouping: a row opens a group if the group would last over longest, hold over most of size, or the gap is over gap."""

    def begin() -> Callable[..., tuple[int]]:
        group, first, last, held = -1, 0, 0, 0

        def step(s: int, e: int, n: int, following: tuple | None) -> tuple[int]:
            nonlocal group, first, last, held
            if group < 0 or e - first > longest or held + n > most or s - last > gap:
                group, first, held, last = group + 1, s, 0, e
            held, last = held + n, max(last, e)
            return (group,)

        return step

    # such a gap opens a group whatever came before
    found = scanned(_apart(df, keys, order, start, end, gap), [*keys, "__chunk"], order, [start, end, size], begin, "__part bigint")
    return found.withColumn(name, (F.dense_rank().over(Window.partitionBy(*keys).orderBy("__chunk", "__part")) - 1).cast("bigint")).drop("__chunk", "__part")


def optimal_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, text: str, cost: Callable[..., float | None] | None = None, most_rows: int = 24, name: str = "part", following_text: bool = False, block_rows: int = 5000, **limits) -> DataFrame:
    """Least-cost segmentation by dynamic programming with at most most_rows rows a group; of equal costs the shortest last group.

    cost(starts, ends, texts, following) gives a group's cost, None where it may not be; following is the
    next row's start, or with following_text its (start, text).
    A row that no feasible group holds stands alone. Keys of up to block_rows rows
    are solved together, many at once where the cost is reading_cost; longer ones by blocks that compose (segmentation).
    """
    price = cost or (lambda s, e, t, nxt: reading_cost(s, e, t, nxt, **limits))

    def of_rows(begin: int, stop: int, starts: list, ends: list, texts: list) -> float | None:
        following = None if stop == len(starts) else (starts[stop], texts[stop]) if following_text else starts[stop]
        return price(starts[begin:stop], ends[begin:stop], texts[begin:stop], following)

    def number(rows: pd.DataFrame) -> Iterable[int]:
        data = rows[start].tolist(), rows[end].tolist(), rows[text].tolist()
        marks = set(segmentation.path_from(segmentation.solved(len(rows), lambda a, b: of_rows(a, b, *data), most_rows, {0: 0})[1], len(rows)))
        group = -1
        for k in range(len(rows)):
            group += k in marks
            yield group

    def parts(rows: pa.Table, begins: np.ndarray) -> pa.Array:
        return pa.array(segmentation.reading_parts(rows.column(start).to_numpy(), rows.column(end).to_numpy(), rows.column(text).combine_chunks(), begins, most_rows, **{**READING, **limits}), pa.int64())

    def grouped(rows: DataFrame) -> DataFrame:
        if cost is None and all(isinstance(limits.get(k, READING[k]), int) and 0 <= limits.get(k, READING[k]) <= 100_000 for k in ("most_chars", "longest", "least")) and all(rows.schema[c].dataType in (LongType(), IntegerType()) for c in (start, end)):
            return group_batches(rows, keys, order, parts, name, "bigint")
        return _grouped(rows, keys, order, name, number)

    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    long = sizes.filter(F.col("__n") > block_rows).drop("__n")
    if long.isEmpty():
        return grouped(df)
    same = long.withColumnsRenamed({k: f"__l_{k}" for k in keys})
    short = df.join(same, [F.col(k).eqNullSafe(F.col(f"__l_{k}")) for k in keys], "left_anti")
    blocks = segmentation.segmented(same_rows(df, long, keys), keys, order, [start, end, text], of_rows, most_rows, block_rows, name)
    return grouped(short).unionByName(blocks)


#: Limits of reading_cost unless others are given.
READING = {"most_chars": 84, "longest": 7000, "least": 700, "chars_per_second": 20.0, "wanted_chars": 58.8}


def reading_cost(starts: list[int], ends: list[int], texts: list[str], following: int | None, most_chars: int = 84, longest: int = 7000, least: int = 700, chars_per_second: float = 20.0, wanted_chars: float = 58.8) -> float | None:
    """Cost of a cue: its distance from a comfortable length and duration, less for good ends; None if it can't be read in its time."""
    text = " ".join(texts)
    if len(text) > most_chars or ends[-1] - starts[0] > longest:
        return None
    needed = max(ends[-1], starts[0] + max(least, math.ceil(len(text) / chars_per_second * 1000)))
    if needed > starts[0] + longest or following is not None and needed > following - 1:
        return None
    expected = max(1200, min(6500, round(len(text) / 17 * 1000)))
    total = ((needed - starts[0] - expected) / 1000) ** 2 + ((len(text) - wanted_chars) / 35) ** 2
    total += 8 if len(texts) == 1 else 3 if len(texts) == 2 and len(text) < 12 else 0
    total -= 5 if text.rstrip("\"'”’»)")[-1:] in ".!?…" else 2 if text[-1:] in ",;:" else 0
    gap = 0 if following is None else max(0, following - ends[-1])
    return total - min(gap, 800) / 180


def trimmed_overlaps(df: DataFrame, keys: Sequence[str], start: str, end: str, least: int = 400, ties: Sequence[str] = ()) -> DataFrame:
    """Sequential trim, in order of start, end and ties: a row starts no earlier than the row before now ends, and short ones grow to least into free time; rows left without time go."""

    def begin() -> Callable[..., tuple[int, int] | None]:
        last = None

        def step(s: int, e: int, following: tuple | None) -> tuple[int, int] | None:
            nonlocal last
            first = s if last is None else max(s, last)
            if e - first < least:
                e = max(e, min(first + least, following[0] if following is not None else first + least))
            if e <= first:
                return None
            last = e
            return first, e

        return step

    # a row behind all before it, and behind what they may grow to, depends on none of them
    apart = _apart(df, keys, [start, end, *ties], start, end, least)
    found = scanned(apart, [*keys, "__chunk"], [start, end, *ties], [start, end], begin, "__begin bigint, __end bigint")
    return found.withColumns({start: F.col("__begin").cast(df.schema[start].dataType), end: F.col("__end").cast(df.schema[end].dataType)}).select(*df.columns)


def interval_components(df: DataFrame, keys: Sequence[str], node: str, start: str, end: str) -> DataFrame:
    """(node, component): nodes that overlap others of their key, and the least node that overlaps lead to. One window instead of a graph."""
    by = Window.partitionBy(*keys).orderBy(start, end, node)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = sessions(df.filter(F.col(end) > F.col(start)).withColumn("__far", F.col(start) >= reach), keys, [start, end, node], F.col("__far"), "__run")
    own = Window.partitionBy(*keys, "__run")
    return runs.withColumn("component", F.min(node).over(own)).withColumn("__n", F.count("*").over(own)).filter("__n > 1").select(node, "component")


def overlap_components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): connected components of an overlap graph, named by their least node.

    The least label spreads along edges and jumps to its own label each round, so
    rounds grow with the logarithm of a component's width; each round's table goes
    to the checkpoint folder.
    """
    sc = pairs.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(pairs.sparkSession))
    edges = pairs.select(F.col(a).alias("x"), F.col(b).alias("y")).unionByName(pairs.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct().checkpoint()
    labels = edges.select(F.col("x").alias("node"), F.col("x").alias("label")).distinct()
    while True:
        near = edges.join(labels, edges["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels["node"] == near["x"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = spread.join(up, "label").select("node", "old", F.least("label", "up").alias("label")).checkpoint()
        if new.filter("label <> old").isEmpty():
            return new.select("node", F.col("label").alias("component"))
        labels = new.drop("old")
