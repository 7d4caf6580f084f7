"""Budgeted selection, priorities and review samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanframe.operators.ordering import each_group, numbered, running, same_rows, written


def priority(reasons: Column, weights: Mapping[str, int], default: int = 0) -> Column:
    """The greatest weight among an array of reasons; 0 for none."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,int>")
    return F.coalesce(F.array_max(F.transform(reasons, lambda r: F.coalesce(table[r], F.lit(default)))), F.lit(0))


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int = 1) -> DataFrame:
    """The first count rows of each key in the given order."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(by)).filter(F.col("__r") <= count).drop("__r")


def first_of_each(df: DataFrame, same: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of rows that agree in some columns the first in order."""
    return top_by(df, same, order)


def budgeted(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], cost: str, most: int, budget: int, task_rows: int = 200_000) -> DataFrame:
    """df with chosen: taking a key's rows in order, a row is taken if its cost still fits the budget, else skipped; at most `most` rows in all.

    order: (column, ascending). A later, smaller row may fit where an earlier
    one didn't. Costs aren't negative; a row without one is never taken. Keys of
    up to task_rows rows are scanned in one task each; larger ones in rounds in
    which the budget that is left at least halves (_in_rounds), each over all their tasks.
    """
    signed = [f"__o{i}" for i in range(len(order))]
    rows = df.withColumns({s: F.col(c) if up else -F.col(c) for s, (c, up) in zip(signed, order, strict=True)}).withColumn("__cost", F.col(cost).cast("bigint"))
    placed = written(numbered(rows, keys, [*signed, "__cost"], "__at", keep_range=True), "costs")
    slim = placed.filter((F.col("__cost") <= budget) & (F.col("__cost") >= 0)).select(*keys, "__range", "__at", "__cost")
    sizes = slim.groupBy(*keys).agg(F.count("*").alias("__n"))
    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)

    def scan(key: tuple, table: pa.Table) -> list[tuple]:
        left, taken = budget, []
        for at, c in zip(table.column("__at").to_pylist(), table.column("__cost").to_pylist(), strict=True):
            if len(taken) == most:
                break
            if c <= left:
                left -= c
                taken.append((*key[: len(keys)], at))
        return taken

    by_size = same_rows(slim, sizes, keys)
    few = by_size.filter(F.col("__n") <= task_rows).drop("__n", "__range").withColumn("__all", F.lit(0))
    taken = each_group(few, keys or ["__all"], ["__at"], scan, f"{kinds}__at bigint")
    large = by_size.filter(F.col("__n") > task_rows).drop("__n")
    if not large.isEmpty():
        taken = taken.unionByName(_in_rounds(written(large, "large"), keys, most, budget))
    by = [*keys, "__at"]
    flags = taken.withColumnsRenamed({c: f"__t_{c}" for c in by}).withColumn("__taken", F.lit(True))
    both = placed.join(flags, [F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in by], "left")
    return both.select(*df.columns, F.coalesce("__taken", F.lit(False)).alias("chosen"))


def _in_rounds(rows: DataFrame, keys: Sequence[str], most: int, budget: int) -> DataFrame:
    """(keys, __at) of the rows taken. rows: (keys, __range, __at, __cost).

    With R left, rows that cost at most R / 2 all fit until their running sum
    passes R / 2 or a row that costs more fits besides them; both leave less than
    R / 2. A round finds the first such row of each key, and takes it and the small
    ones before it. So there are as many rounds as the budget has bits, at most.
    """
    state = rows.select(*keys).distinct().withColumns({"left": F.lit(budget).cast("bigint"), "may": F.lit(most).cast("bigint"), "behind": F.lit(-1).cast("bigint")})
    state, out = written(state, "state"), []
    while not state.isEmpty():
        live = same_rows(rows, state, keys).filter((F.col("__at") > F.col("behind")) & (F.col("__cost") <= F.col("left")))
        small = 2 * F.col("__cost") <= F.col("left")
        summed = running(live, keys, ["__at"], {"spent": F.when(small, F.col("__cost")).otherwise(0).cast("bigint"), "held": small.cast("bigint")})
        whole = F.col("spent") + F.when(small, 0).otherwise(F.col("__cost"))
        ends = F.when(small, (2 * F.col("spent") > F.col("left")) | (F.col("held") == F.col("may"))).otherwise(whole <= F.col("left"))
        marked = written(summed.withColumn("ends", ends).withColumn("whole", whole).withColumn("count", F.col("held") + F.when(small, 0).otherwise(1)), "round")
        first = written(marked.filter("ends").groupBy(*keys).agg(F.min(F.struct("__at", "whole", "count")).alias("end")), "ends")
        other = first.withColumnsRenamed({k: f"__f_{k}" for k in keys})
        both = marked.join(other, [F.col(k).eqNullSafe(F.col(f"__f_{k}")) for k in keys] or [F.lit(True)], "left")
        out.append(both.filter(F.col("end").isNull() & (2 * F.col("__cost") <= F.col("left")) | (F.col("__at") < F.col("end.__at")) & (2 * F.col("__cost") <= F.col("left")) | (F.col("__at") == F.col("end.__at"))).select(*keys, "__at"))
        now = same_rows(state, first, keys)
        state = written(now.select(*keys, (F.col("left") - F.col("end.whole")).alias("left"), (F.col("may") - F.col("end.count")).alias("may"), F.col("end.__at").alias("behind")).filter("may > 0"), "state")
    return reduce(DataFrame.unionByName, out)


def review_sample(df: DataFrame, mandatory: str, score: str, index: str, share: float = 0.05, keys: Sequence[str] = ()) -> DataFrame:
    """All mandatory rows, and of the others the best scored until the sample holds share of all rows (at least one)."""
    whole = Window.partitionBy(*keys)
    capacity = F.greatest(F.lit(1), F.ceil(F.count("*").over(whole) * share))
    ranked = df.withColumn("__cap", capacity - F.sum(F.col(mandatory).cast("int")).over(whole))
    ranked = ranked.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, mandatory).orderBy(F.desc(score), index)))
    return ranked.filter(F.col(mandatory) | (F.col("__r") <= F.col("__cap"))).drop("__cap", "__r")


def argmax_neighbour(pairs: DataFrame, keys: Sequence[str], score: str, position: str) -> DataFrame:
    """Of a row's neighbours the one with the greatest score; of equal ones the first by position."""
    return top_by(pairs, keys, [F.desc(score), F.asc(position)])


def share_limit(count: Column, share: float, floor: int, hard: int, ratio: Column, enough: float = 0.9) -> Column:
    """floor, or where ratio is enough the share of count between floor and hard."""
    return F.when(ratio >= enough, F.least(F.lit(hard), F.greatest(F.lit(floor), F.ceil(count * share).cast("int")))).otherwise(F.lit(floor))


def ranked_choice(df: DataFrame, keys: Sequence[str], kind: str, kinds: Sequence[str], code: str, wanted: str) -> DataFrame:
    """Per key the row of the first kind in kinds that has one; within it the exact code before the shortest that begins with it."""
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col(kind))
    fits = df.filter((rank > 0) & ((F.col(code) == wanted) | F.col(code).startswith(f"{wanted}-")))
    return top_by(fits, keys, [rank.asc(), (F.col(code) != wanted).asc(), F.length(code).asc(), F.col(code).asc()])
