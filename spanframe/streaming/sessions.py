"""Streams of intervals and points: watermarked windows, and union of intervals with late data."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def binned_counts(stream: DataFrame, time: str, keys: list[str], width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """(keys, bin_start, n): tumbling counts; rows later than `late` behind the newest are left out."""
    return stream.withWatermark(time, late).groupBy(*keys, F.window(time, width).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("bin_start"), "n")


def point_sessions(stream: DataFrame, time: str, keys: list[str], gap: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """(keys, first, until, n) of points with pauses under gap."""
    return stream.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("first"), F.col("w.end").alias("until"), "n")


def merged_intervals(known: list[tuple[int, int, int]], new: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(start, end, n) lists united; pieces up to gap apart become one."""
    out: list[tuple[int, int, int]] = []
    for s, e, n in sorted([*known, *new]):
        if out and s <= out[-1][1] + gap:
            out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + n)
        else:
            out.append((s, e, n))
    return out


def interval_sessions(stream: DataFrame, key: str, time: str, start: str = "start_ms", end: str = "end_ms", gap: int = 0, late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n): unions of a key's intervals, emitted once the watermark is past their end and gap.

    time is an event-time column of the interval's start. A late interval that
    touches a union still held re-opens it; one behind the watermark is dropped by
    Spark. Only unions not yet emitted are state.
    """

    def run(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in zip(*state.get, strict=True)] if state.exists else []
        if not state.hasTimedOut:
            for rows in batches:
                held = merged_intervals(held, [(int(a), int(b), 1) for a, b in zip(rows[start], rows[end], strict=True)], gap)
        mark = state.getCurrentWatermarkMs()
        done = [x for x in held if x[1] + gap < mark]
        left = [x for x in held if x[1] + gap >= mark]
        if left:
            state.update(tuple([x[i] for x in left] for i in range(3)))
            state.setTimeoutTimestamp(max(mark + 1, min(x[1] for x in left) + gap + 1))
        elif state.exists:
            state.remove()
        if done:
            yield pd.DataFrame({key: [group[0]] * len(done), start: [x[0] for x in done], end: [x[1] for x in done], "n": [x[2] for x in done]})

    kind = stream.schema[key].dataType.simpleString()
    marked = stream.withWatermark(time, late)
    return marked.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, {start} bigint, {end} bigint, n bigint", "s array<bigint>, e array<bigint>, n array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)
