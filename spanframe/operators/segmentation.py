"""Least-cost segmentation of a long key over many tasks.

Costs are whole numbers (COST_UNIT of one), so sums don't hang on their order and
blocks of rows compose exactly: a block maps the costs at the last places where
a group may end in front of it to those at its own last ones, by (min, +). The
chain of blocks gives the costs with which each is entered; with these each block
is solved as if alone, and the path is traced back from block to block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanframe.operators.ordering import numbered, ranged, running, same_rows, written

#: What a cost of 1 is, and the cost of a row that no feasible group holds.
COST_UNIT, ALONE = 1 << 26, 10**6
_NONE = 1 << 62

Price = Callable[[int, int], float | None]


def whole_cost(own: float | None, rows: int) -> int | None:
    """A group's cost in whole units; of one row that may not be a group the cost of standing alone."""
    if own is None:
        return ALONE * COST_UNIT if rows == 1 else None
    return round(own * COST_UNIT)


def solved(n: int, price: Price, most_rows: int, entries: dict[int, int], lead: int = 0) -> tuple[list[int], list[int]]:
    """(best, cut) by place 0 .. n: least cost up to a place, and where its last group begins; of equal costs the shortest last group.

    entries: costs of places up to lead, which are given; place k is in front of row k.
    """
    best, cut = [_NONE] * (n + 1), [-1] * (n + 1)
    for k, c in entries.items():
        best[k] = c
    for stop in range(lead + 1, n + 1):
        for begin in range(stop - 1, max(-1, stop - 1 - most_rows), -1):
            if best[begin] >= _NONE:
                continue
            own = whole_cost(price(begin, stop), stop - begin)
            if own is not None and best[begin] + own < best[stop]:
                best[stop], cut[stop] = best[begin] + own, begin
    return best, cut


def reading_parts(starts: np.ndarray, ends: np.ndarray, texts: pa.Array, begins: np.ndarray, most_rows: int, most_chars: int, longest: int, least: int, chars_per_second: float, wanted_chars: float) -> np.ndarray:
    """The part of each row, from 0 in each group, of the least-cost segmentation of many groups at once by sequences.reading_cost; as solved gives it.

    begins: where groups begin among the rows. Groups go forward together, a row
    of each at a time; squares and shares come from tables of the formula's own values.
    """
    n, none = len(starts), 1 << 61
    sizes = np.diff(np.append(begins, n))
    group = np.repeat(np.arange(len(begins)), sizes)
    inside = np.arange(n) - begins[group]
    # what the end of a text adds, by distinct text: alone, and behind others
    coded = texts.dictionary_encode()
    said = coded.dictionary.to_pylist()
    bare = [t.rstrip("\"'”’»)") for t in said]
    tail = [2 if t[-1:] and t[-1:] in ",;:" else 0 for t in said]
    alone = np.array([5 if b[-1:] in ".!?…" else t for b, t in zip(bare, tail, strict=True)], np.float64)
    behind = np.array([5 if b and b[-1] in ".!?…" else t for b, t in zip(bare, tail, strict=True)], np.float64)
    code = coded.indices.to_numpy()
    chars = np.array([len(t) for t in said], np.int64)[code]
    alone, behind = alone[code], behind[code]
    before = np.append(0, np.cumsum(chars + 1))  # each with the space in front of it
    last = np.append(begins[1:], n)[group] - 1 == np.arange(n)
    following = np.append(starts[1:], 0)
    by_length = range(most_chars + 1)
    needs = np.array([max(least, math.ceil(k / chars_per_second * 1000)) for k in by_length], np.int64)
    expected = np.array([max(1200, min(6500, round(k / 17 * 1000))) for k in by_length], np.int64)
    of_chars = np.array([((k - wanted_chars) / 35) ** 2 for k in by_length])
    of_time = np.array([(k / 1000) ** 2 for k in range(-6500, longest + 1)])
    gap = np.where(last, 0, np.minimum(np.maximum(0, following - ends), 800)) / 180
    cost = np.full((n, most_rows), none, np.int64)  # by last row and, from the right, number of rows
    for rows in range(1, min(most_rows, int(sizes.max(initial=0))) + 1):
        k = np.flatnonzero(inside >= rows - 1)
        begin = starts[k - rows + 1]
        length = before[k + 1] - before[k + 1 - rows] - 1
        ok = (length <= most_chars) & (ends[k] - begin <= longest)
        k, begin, length = k[ok], begin[ok], length[ok]
        needed = np.maximum(ends[k], begin + needs[length])
        ok = (needed <= begin + longest) & (last[k] | (needed <= following[k] - 1))
        k, length, lasts = k[ok], length[ok], (needed - begin)[ok]
        total = of_time[lasts - expected[length] + 6500] + of_chars[length]
        total = total + (8 if rows == 1 else np.where(length < 12, 3, 0) if rows == 2 else 0)
        total = total - (alone if rows == 1 else behind)[k] - gap[k]
        cost[k, most_rows - rows] = np.rint(total * COST_UNIT).astype(np.int64)
    cost[cost[:, -1] == none, -1] = ALONE * COST_UNIT
    # place q of group g stands at base[g] + most_rows + q, behind places that are none
    base = begins + np.arange(len(begins)) * (most_rows + 1)
    best = np.full(n + len(begins) * (most_rows + 1), none, np.int64)
    best[base + most_rows] = 0
    taken = np.zeros(n, np.int64)
    ordered = np.argsort(-sizes, kind="stable")
    still = np.searchsorted(-sizes[ordered], -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
    back = np.arange(most_rows)
    for step, many in enumerate(still):
        now = ordered[:many]
        row = begins[now] + step
        sums = best[(base[now] + step + 1)[:, None] + back] + cost[row]
        found = most_rows - 1 - sums[:, ::-1].argmin(axis=1)  # of equal costs the shortest last group
        best[base[now] + most_rows + step + 1] = sums[np.arange(many), found]
        taken[row] = most_rows - found
    opens, at = np.zeros(n, np.int64), begins + sizes
    while len(at):
        at = at - taken[at - 1]
        opens[at] = 1
        at = at[inside[at] > 0]
    parts = np.cumsum(opens)
    return parts - parts[begins][group]


def path_from(cut: Sequence[int], at: int, lead: int = 0) -> list[int]:
    """Places where groups begin, from the last one back to the first place at or in front of lead."""
    out = []
    while at > lead:
        at = cut[at]
        out.append(at)
    return out


def segmented(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], price: Callable[..., float | None], most_rows: int, block_rows: int, name: str) -> DataFrame:
    """df with name: the number, from 0, of the group of the least-cost segmentation; price(begin, stop, *columns) of a group of rows, which may look at row stop."""
    block_rows = max(block_rows, most_rows)
    placed = written(numbered(df, keys, order, "__at"), "rows")
    slim = placed.select(*keys, "__at", F.floor(F.col("__at") / block_rows).alias("__block"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(columns)])
    inside = F.col("__at") - F.col("__block") * block_rows
    # a block also sees the rows of groups that reach into it, and the one behind it
    seen_next = slim.filter(inside >= block_rows - most_rows).withColumn("__block", F.col("__block") + 1)
    seen_before = slim.filter(inside == 0).withColumn("__block", F.col("__block") - 1)
    own = slim.select(*keys, "__block").distinct().withColumn("__real", F.lit(True))
    all_rows = same_rows(slim.unionByName(seen_next).unionByName(seen_before), own, [*keys, "__block"]).drop("__real")
    all_rows = written(all_rows, "blocks")
    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)

    def of_block(key: tuple, table: pa.Table) -> tuple[int, int, int, Price]:
        """(block, places of the block in front of its first row, its own rows, price by place of the block)."""
        block, table = key[-1].as_py(), table.sort_by("__at")
        at = table.column("__at").to_pylist()
        lead = sum(x < block * block_rows for x in at)
        rows = sum(block * block_rows <= x < (block + 1) * block_rows for x in at)
        data = [table.column(f"__c{i}").to_pylist() for i in range(len(columns))]
        return block, lead, rows, lambda begin, stop: price(begin, stop, *data)

    def keyed(key: tuple, n: int) -> dict:
        return {k: pa.array([v.as_py()] * n, v.type) for k, v in zip(keys, key, strict=False)}

    def exits_of(lead: int, rows: int) -> range:
        """Places at which the next block may be entered."""
        return range(max(lead + 1, lead + rows - most_rows + 1), lead + rows + 1)

    def maps(key: tuple, table: pa.Table) -> pa.Table:
        block, lead, rows, cost = of_block(key, table)
        n = lead + rows
        first = max(0, lead - most_rows + 1) if lead else 0
        width = lead - first + 1
        reach = np.full((n + 1, width), _NONE, np.int64)  # by place and by place of entry
        for j in range(width):
            reach[first + j, j] = 0
        for stop in range(lead + 1, n + 1):
            for begin in range(stop - 1, max(first - 1, stop - 1 - most_rows), -1):
                c = whole_cost(cost(begin, stop), stop - begin)
                if c is not None:
                    ok = reach[begin] < _NONE
                    reach[stop][ok] = np.minimum(reach[stop][ok], reach[begin][ok] + c)
        exits = exits_of(lead, rows)
        # entries and exits are named by how far they are in front of the block's first row and of its end
        out = [[(lead - first - j, lead + rows - x, int(reach[x, j])) for j in range(width)] for x in exits]
        flat = [o for x in out for o in x if o[2] < _NONE]
        return pa.table({**keyed(key, len(flat)), "block": pa.array([block] * len(flat), pa.int64()), "entry": pa.array([o[0] for o in flat], pa.int32()), "leave": pa.array([o[1] for o in flat], pa.int32()), "cost": pa.array([o[2] for o in flat], pa.int64())})

    def forward(key: tuple, table: pa.Table) -> pa.Table:
        """Costs with which each block of a key is entered, the least of them being 0."""
        steps: dict[int, list[tuple[int, int, int]]] = {}
        for b, e, x, c in zip(*(table.column(c).to_pylist() for c in ("block", "entry", "leave", "cost")), strict=True):
            steps.setdefault(b, []).append((e, x, c))
        now, out = {0: 0}, []
        for block in sorted(steps):
            out += [(block, e, c) for e, c in now.items()]
            following: dict[int, int] = {}
            for e, x, c in steps[block]:
                if e in now and now[e] + c < following.get(x, _NONE):
                    following[x] = now[e] + c
            least = min(following.values())
            now = {x: c - least for x, c in following.items()}
        return pa.table({**keyed(key, len(out)), "__block": pa.array([o[0] for o in out], pa.int64()), "entry": pa.array([o[1] for o in out], pa.int32()), "cost": pa.array([o[2] for o in out], pa.int64())})

    def answered(key: tuple, table: pa.Table) -> tuple[int, int, int, list[int]]:
        block, lead, rows, cost = of_block(key, table)
        given = {lead - e: c for e, c in table.column("__entries")[0].as_py()} if table.num_rows else {}
        return block, lead, rows, solved(lead + rows, cost, most_rows, given, lead)[1]

    def back(key: tuple, table: pa.Table) -> pa.Table:
        block, lead, rows, cut = answered(key, table)
        pairs = [(lead + rows - x, lead - path_from(cut, x, lead)[-1]) for x in exits_of(lead, rows) if cut[x] >= 0]
        return pa.table({**keyed(key, len(pairs)), "block": pa.array([block] * len(pairs), pa.int64()), "leave": pa.array([p[0] for p in pairs], pa.int32()), "entry": pa.array([p[1] for p in pairs], pa.int32())})

    def traced(key: tuple, table: pa.Table) -> pa.Table:
        """Where the path leaves each block of a key, from the last one back."""
        steps = {(b, x): e for b, x, e in zip(*(table.column(c).to_pylist() for c in ("block", "leave", "entry")), strict=True)}
        out, at = [], 0
        for block in sorted({b for b, _ in steps}, reverse=True):
            out.append((block, at))
            at = steps[block, at]
        return pa.table({**keyed(key, len(out)), "__block": pa.array([o[0] for o in out], pa.int64()), "__leave": pa.array([o[1] for o in out], pa.int32())})

    def cuts(key: tuple, table: pa.Table) -> pa.Table:
        block, lead, rows, cut = answered(key, table)
        x = lead + rows - table.column("__leave")[0].as_py()
        found = [block * block_rows + p - lead for p in path_from(cut, x, lead)]
        return pa.table({**keyed(key, len(found)), "__at": pa.array(found, pa.int64())})

    steps = all_rows.groupBy(*keys, "__block").applyInArrow(maps, f"{kinds}block bigint, entry int, leave int, cost bigint")
    # a key's blocks meet as most_rows x most_rows numbers each
    given = written(steps.groupBy(*keys).applyInArrow(forward, f"{kinds}__block bigint, entry int, cost bigint"), "entries")
    lists = given.groupBy(*keys, "__block").agg(F.collect_list(F.array(F.col("entry").cast("bigint"), "cost")).alias("__entries"))
    ready = written(same_rows(all_rows, lists, [*keys, "__block"]), "ready")
    leaves = written(ready.groupBy(*keys, "__block").applyInArrow(back, f"{kinds}block bigint, leave int, entry int").groupBy(*keys).applyInArrow(traced, f"{kinds}__block bigint, __leave int"), "leaves")
    starts = written(same_rows(ready, leaves, [*keys, "__block"]).groupBy(*keys, "__block").applyInArrow(cuts, f"{kinds}__at bigint").distinct(), "starts")
    by = [*keys, "__at"]
    named = starts.withColumnsRenamed({c: f"__s_{c}" for c in by}).withColumn("__opens", F.lit(1).cast("bigint"))
    marked = placed.join(named, [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in by], "left").drop(*[f"__s_{c}" for c in by])
    counted = running(ranged(marked, keys, ["__at"]), keys, ["__at"], {name: F.coalesce("__opens", F.lit(0).cast("bigint"))})
    return counted.withColumn(name, F.col(name) - 1).drop("__range", "__opens", "__at")
