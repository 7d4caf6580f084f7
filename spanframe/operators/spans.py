"""Spans made of spans: merging to a budget, merging under a cap, and evidence that is new besides what is known."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.operators.intervals import interval_join
from spanframe.operators.ordering import chained, each_group, numbered, ranged, running, same_rows, written


def _barred(bounds: DataFrame, trusted: DataFrame, keys: Sequence[str], trusted_bounds: tuple[str, str]) -> DataFrame:
    """(keys, position) of the gaps (left_end to right_start, perhaps negative) that a trusted interval reaches into."""
    ts, te = trusted_bounds
    wide = bounds.select(*keys, "position", "left_end", "right_start", (F.least("left_end", "right_start") - 1).alias("__from"), (F.greatest("left_end", "right_start") + 1).alias("__to"))
    other = trusted.select(*keys, F.col(ts).alias("__ts"), F.col(te).alias("__te"))
    hit = interval_join(wide, other, keys, ("__from", "__to"), ("__ts", "__te")).filter("left_end < __te AND __ts < right_start")
    return hit.select(*keys, "position").distinct()


def _accepted(rows: DataFrame, keys: Sequence[str], kinds: str) -> DataFrame:
    """(keys, position, gap): of each chunk the gaps that close, were there no limit.

    A gap's size never changes, and once too long a join stays too long; so the
    gaps are taken in order of size and place, each joining the two runs beside it.
    """

    def run(key: tuple, table: pa.Table) -> list[tuple]:
        at, starts, ends, caps = (table.column(c).to_pylist() for c in ("position", "__start", "__end", "__cap"))
        n = len(at)
        first, last = list(range(n)), list(range(n))  # of the run that begins, or ends, at a row
        least = list(caps)  # by the first row of a run
        taken = []
        for gap, left in sorted((starts[k + 1] - ends[k], k) for k in range(n - 1)):
            begin, stop = first[left], last[left + 1]
            cap = min(least[begin], least[left + 1])
            if ends[stop] - starts[begin] <= cap:
                first[stop], last[begin], least[begin] = begin, stop, cap
                taken.append((*key[:-1], at[left], gap))
        return taken

    return each_group(rows, [*keys, "__chunk"], ["position"], run, f"{kinds}position bigint, gap bigint")


def budgeted_merge(spans: DataFrame, keys: Sequence[str], limit: int, trusted: DataFrame | None = None, start: str = "start_ms", end: str = "end_ms", trusted_bounds: tuple[str, str] = ("start_ms", "end_ms"), longest: int | None = None, cap: str | None = None, lock: str | None = None, sets: Sequence[str] = ()) -> DataFrame:
    """(keys, start, end, n_spans, members, sets, over): neighbours with the smallest gap joined until a key has at most limit spans.

    Of equal gaps the first closes first. A join may last no longer than longest
    (else a key's longest span) or than cap of any of its spans, and no trusted
    interval may reach into the gap. Spans with a lock join only touching ones of
    the same lock. members are the positions, from 1, of the spans in order of
    start and end; sets, array columns, are united. over says that a key keeps
    more than limit spans, since nothing more may be joined. Rows without bounds
    are left out; equal spans count each; an empty relation has no result.

    Which gaps may close at all is decided by chunk (rows between which no gap
    is out of the question), so a hot key is many tasks; a running count over a
    key's closable gaps in order of size then applies the limit.
    """
    kinds = "".join(f"`{k}` {spans.schema[k].dataType.simpleString()}, " for k in keys)
    rows = spans.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*keys, F.col(start).cast("bigint").alias("__start"), F.col(end).cast("bigint").alias("__end"), (F.col(cap).cast("bigint") if cap else F.lit(None).cast("bigint")).alias("__cap"), (F.col(lock).cast("string") if lock else F.lit(None).cast("string")).alias("__lock"), *[F.col(c).alias(f"__set{i}") for i, c in enumerate(sets)])
    totals = written(rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.max(F.col("__end") - F.col("__start")).alias("__longest")), "totals")
    most = F.lit(longest).cast("bigint") if longest is not None else F.col("__longest")
    capped = same_rows(rows, totals, keys).withColumn("__cap", F.least(most, "__cap"))
    placed = written(numbered(capped, keys, ["__start", "__end"]), "spans")
    after = placed.select(*keys, (F.col("position") - 1).alias("position"), F.col("__start").alias("right_start"), F.col("__end").alias("right_end"), F.col("__cap").alias("right_cap"), F.col("__lock").alias("right_lock"))
    bounds = same_rows(placed.select(*keys, "position", F.col("__start").alias("left_start"), F.col("__end").alias("left_end"), "__cap", "__lock"), after, [*keys, "position"])
    free = F.col("__lock").isNull() & F.col("right_lock").isNull()
    locked = (F.col("__lock") == F.col("right_lock")) & (F.col("left_end") == F.col("right_start"))
    open_ = bounds.filter((free | F.coalesce(locked, F.lit(False))) & (F.col("right_end") - F.col("left_start") <= F.least("__cap", "right_cap"))).select(*keys, "position", "left_end", "right_start")
    if trusted is not None:
        barred = _barred(open_, trusted, keys, trusted_bounds).withColumnsRenamed({c: f"__b_{c}" for c in [*keys, "position"]})
        open_ = open_.join(barred, [F.col(c).eqNullSafe(F.col(f"__b_{c}")) for c in [*keys, "position"]], "left_anti")
    # a row goes on its chunk if the gap in front of it may close
    goes_on = open_.select(*keys, (F.col("position") + 1).alias("position"), F.lit(1).alias("__on"))
    chunks = _marked(placed, goes_on, keys, "__on", "__chunk")
    some = _accepted(chunks.select(*keys, "__chunk", "position", "__start", "__end", "__cap"), keys, kinds)
    ranked = numbered(some, keys, ["gap", "position"], "rank")
    closed = same_rows(ranked, totals, keys).filter(F.col("rank") < F.col("__n") - limit)
    grouped = written(_marked(placed, closed.select(*keys, (F.col("position") + 1).alias("position"), F.lit(1).alias("__on")), keys, "__on", "__group"), "merged")
    merged = grouped.groupBy(*keys, "__group").agg(F.min("__start").alias(start), F.max_by("__end", "position").alias(end), F.count("*").alias("n_spans"), F.array_sort(F.collect_list(F.col("position") + 1)).alias("members"), *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"__set{i}")))).alias(c) for i, c in enumerate(sets)])
    left = merged.groupBy(*keys).agg(F.count("*").alias("__left"))
    out = same_rows(merged, left, keys)
    return out.select(*keys, start, end, "n_spans", "members", *sets, (F.col("__left") > limit).alias("over"))


def _marked(placed: DataFrame, marks: DataFrame, keys: Sequence[str], mark: str, name: str) -> DataFrame:
    """placed with name: a running number that grows at each position without a mark."""
    by = [*keys, "position"]
    other = marks.withColumnsRenamed({c: f"__m_{c}" for c in by})
    both = placed.join(other, [F.col(c).eqNullSafe(F.col(f"__m_{c}")) for c in by], "left").drop(*[f"__m_{c}" for c in by])
    found = running(ranged(both, keys, ["position"]), keys, ["position"], {name: F.when(F.col(mark).isNull(), 1).otherwise(0).cast("bigint")})
    return found.drop("__range", mark)


def capped_merge(spans: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms", gap: int = 1200, longest: int = 45_000, ties: Sequence[str] = (), sets: Sequence[str] = (), greatest: Sequence[str] = (), texts: Sequence[str] = (), block: int | None = None) -> DataFrame:
    """(keys, span, start, end, n_spans, sets, greatest, texts): spans in order of start, end and ties, joined while the gap is at most gap and the whole at most longest.

    span numbers a key's results from 1. sets are array columns, united and
    sorted; of greatest the maximum counts; texts are joined by spaces, without
    null and empty ones. A span longer than longest stands alone. Rows without
    bounds are left out. What joins hangs on the first span of each result, so a
    key's timeline is cut in blocks (of 64 times longest) that are tasks of their own.
    """
    rows = spans.filter(F.col(start).isNotNull() & F.col(end).isNotNull())

    def following(i: int, n: int, starts: list[int], ends: list[int]) -> int:
        reach, k = ends[i], i + 1
        while k < n and starts[k] - reach <= gap and max(ends[k], reach) - starts[i] <= longest:
            reach, k = max(ends[k], reach), k + 1
        return k

    placed = written(numbered(rows, keys, [start, end, *ties], "__at"), "spans")
    found = chained(placed, keys, "__at", [start, end], following, start, longest, block or 64 * longest, "__part")
    joined = lambda c: F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("__at", F.col(c).alias("t")))), lambda x: F.coalesce(x["t"] != "", F.lit(False))), lambda x: x["t"]), " ")
    out = found.groupBy(*keys, "__part").agg(
        F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_spans"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in sets],
        *[F.max(c).alias(c) for c in greatest], *[joined(c).alias(c) for c in texts],
    )
    return out.select(*keys, (F.col("__part") + 1).alias("span"), start, end, "n_spans", *sets, *greatest, *texts)


def first_come(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """nodes, in order of their number, without those that an edge (earlier, later) leads to from a node that stays.

    A round decides every node whose earlier neighbours are all decided, so rounds
    grow with the longest chain of undecided ones; each round is written.
    """
    edges = written(edges.filter("earlier < later").distinct(), "edges")
    stay = nodes.select(node).join(edges.select(F.col("later").alias(node)), node, "left_anti")
    while not edges.isEmpty():
        firsts = edges.select("earlier").distinct().join(edges.select(F.col("later").alias("earlier")), "earlier", "left_anti")
        gone = written(edges.join(firsts, "earlier", "left_semi").select(F.col("later").alias("gone")).distinct(), "gone")
        # edges from and to what has gone say no more; what they alone held is free
        left = written(edges.join(gone, F.col("earlier") == F.col("gone"), "left_anti").join(gone, F.col("later") == F.col("gone"), "left_anti"), "edges")
        freed = edges.select(F.col("later").alias(node)).distinct().join(gone.withColumnRenamed("gone", node), node, "left_anti").join(left.select(F.col("later").alias(node)), node, "left_anti")
        stay = stay.unionByName(freed)
        edges = left
    return stay.distinct()


def merged_evidence(primary: DataFrame, extra: DataFrame, keys: Sequence[str], order: Sequence[str], same: Callable[[str, str, Column], Column], columns: Sequence[str], start: str = "start_ms", end: str = "end_ms", usable: Column | None = None) -> DataFrame:
    """primary and those rows of extra that bring something new, with source: primary or extra.

    A row of extra is known if same(a, b, overlap) holds of a row a in front of
    it and itself, b; these are prefixes of the two rows' columns, overlap is
    positive. Rows in front are the usable ones of primary and the rows of extra before it, in
    order, that are taken. Nothing of primary is ever changed.
    """
    both_bounds = (start, end)
    numbered_extra = written(numbered(extra.select(*keys, *both_bounds, *columns), [], [*keys, *order], "__no"), "extra")
    prefixed = lambda df, p: df.select(*keys, *[F.col(c).alias(f"{p}{c}") for c in [*both_bounds, *columns]], *([F.col("__no").alias(f"{p}__no")] if "__no" in df.columns else []))
    overlap = F.least(F.col(f"a_{end}"), F.col(f"b_{end}")) - F.greatest(F.col(f"a_{start}"), F.col(f"b_{start}"))
    bounds = lambda p: (f"{p}{start}", f"{p}{end}")
    mine = prefixed(numbered_extra, "b_")
    front = prefixed(primary.filter(usable) if usable is not None else primary, "a_")
    known = interval_join(front, mine, keys, bounds("a_"), bounds("b_")).filter(same("a_", "b_", overlap)).select(F.col("b___no").alias("__no")).distinct()
    fresh = written(numbered_extra.join(known, "__no", "left_anti"), "fresh")
    pairs = interval_join(prefixed(fresh, "a_"), prefixed(fresh, "b_"), keys, bounds("a_"), bounds("b_")).filter("a___no < b___no").filter(same("a_", "b_", overlap))
    taken = first_come(fresh, pairs.select(F.col("a___no").alias("earlier"), F.col("b___no").alias("later")), "__no")
    new = fresh.join(taken, "__no", "left_semi").drop("__no").withColumn("source", F.lit("extra"))
    return primary.select(*keys, *both_bounds, *columns).withColumn("source", F.lit("primary")).unionByName(new)
