"""Choosing one option for each member of an overlap component without conflicts.

An option is a list of timed words; two options conflict where words of theirs
overlap and the speakers are unknown or the same. Components are found in Spark
(sequences.overlap_components); the search runs inside a component's group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanframe.operators.ordering import each_group, written
from spanframe.operators.sequences import sessions

Word = tuple[int, int, str | None]  # start, end, speaker


def conflict(a: Sequence[Word], b: Sequence[Word]) -> bool:
    """Whether any words of the two overlap unsafely: one sweep over both in order of start."""
    events = sorted([(s, e, p, 0) for s, e, p in a] + [(s, e, p, 1) for s, e, p in b], key=lambda w: w[:2])
    active: list[tuple[int, int, str | None, int]] = []
    for w in events:
        active = [x for x in active if x[1] > w[0]]
        if any(x[3] != w[3] and (x[2] is None or w[2] is None or x[2] == w[2]) for x in active):
            return True
        active.append(w)
    return False


class Compatibility:
    """Pairwise conflicts, each worked out once."""

    def __init__(self, options: Mapping[str, Sequence[Sequence[Word]]]):
        self.options = options
        self.known: dict[tuple[str, int, str, int], bool] = {}
        self.checks = 0

    def fits(self, u: str, i: int, v: str, j: int) -> bool:
        key = (u, i, v, j) if (u, i) <= (v, j) else (v, j, u, i)
        if key not in self.known:
            self.checks += 1
            self.known[key] = not conflict(self.options[u][i], self.options[v][j])
        return self.known[key]


def best_selection(options: Mapping[str, Sequence[Sequence[Word]]], scores: Mapping[str, Sequence[tuple]], most_checks: int = 2_097_152) -> dict[str, int] | None:
    """Options of all members without conflicts and with the greatest sum of scores, compared position by position; of equal sums the first options by member.

    Branch and bound: the member with the fewest options left comes first, and a
    branch goes if even the best of the rest can't exceed what is found. None if
    there is no such selection, or the checks run out.
    """
    table = Compatibility(options)
    width = max((len(s) for found in scores.values() for s in found), default=0)
    zero = (0,) * width
    add = lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True))
    best: tuple[tuple, list[int], dict[str, int]] | None = None
    names = sorted(options)

    def branches(chosen: dict[str, int], left: dict[str, list[int]], total: tuple) -> Iterator[tuple]:
        nonlocal best
        if not left:
            rank = [chosen[u] for u in names]
            if best is None or (total, [-x for x in rank]) > (best[0], [-x for x in best[1]]):
                best = total, rank, dict(chosen)
            return
        bound = total
        for u, found in left.items():
            bound = add(bound, tuple(max(scores[u][i][k] for i in found) for k in range(width)))
        if best is not None and bound < best[0]:
            return
        u = min(left, key=lambda x: (len(left[x]), x))
        for i in sorted(left[u], key=lambda i: ([-x for x in scores[u][i]], i)):
            rest = {v: [j for j in found if table.fits(u, i, v, j)] for v, found in left.items() if v != u}
            if all(rest.values()):
                yield {**chosen, u: i}, rest, add(total, scores[u][i])

    # A stack of open branches, as components can be longer than Python's recursion limit.
    start = {u: list(range(len(o))) for u, o in options.items()}
    open_ = [branches({}, start, zero)] if all(options.values()) else []
    while open_ and table.checks <= most_checks:
        following = next(open_[-1], None)
        if following is None:
            open_.pop()
        else:
            open_.append(branches(*following))
    return None if best is None or table.checks > most_checks else best[2]


def selected_options(df: DataFrame, component: str, uid: str, option: str, words: str, score: str, most_checks: int = 2_097_152) -> DataFrame:
    """(component, uid, option, solved): the option chosen for each member; solved is false, and the option null, where there is none.

    words is an array of (start_ms, end_ms, speaker_id), score an array of numbers.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([uid, option])
        options: dict[str, list] = {}
        scores: dict[str, list] = {}
        labels: dict[str, list] = {}
        for u, o, w, s in zip(rows[uid], rows[option], rows[words], rows[score], strict=True):
            options.setdefault(u, []).append([(x["start_ms"], x["end_ms"], x["speaker_id"]) for x in w])
            scores.setdefault(u, []).append(tuple(s))
            labels.setdefault(u, []).append(o)
        found = best_selection(options, scores, most_checks)
        return pd.DataFrame({component: [rows[component].iloc[0]] * len(options), uid: list(options), option: pd.array([None if found is None else labels[u][found[u]] for u in options], dtype="Int64"), "solved": [found is not None] * len(options)})

    kind = lambda c: df.schema[c].dataType.simpleString()
    return df.groupBy(component).applyInPandas(run, f"{component} {kind(component)}, {uid} {kind(uid)}, {option} bigint, solved boolean")


def overlapping_pairs(words: Mapping[str, Sequence[Word]]) -> frozenset[tuple[str, str]]:
    """Pairs of members, the lesser first, of which words overlap unsafely: one sweep over all words."""
    pairs, active = set(), []
    for s, e, p, u in sorted(((s, e, p, u) for u, own in words.items() for s, e, p in own), key=lambda w: w[:2]):
        active = [x for x in active if x[1] > s]
        pairs |= {(min(u, x[3]), max(u, x[3])) for x in active if x[3] != u and (x[2] is None or p is None or x[2] == p)}
        active.append((s, e, p, u))
    return frozenset(pairs)


def _clusters(pairs: frozenset[tuple[str, str]]) -> list[list[str]]:
    near: dict[str, set[str]] = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out, seen = [], set()
    for u in sorted(near):
        if u in seen:
            continue
        stack, own = [u], set()
        while stack:
            x = stack.pop()
            if x not in own:
                own.add(x)
                stack += near[x] - own
        seen |= own
        out.append(sorted(own))
    return out


def improved_once(members: Sequence[str], bounds: Mapping[str, tuple[int, int]], options: Mapping[str, Sequence[Sequence[Word]]], scores: Mapping[str, Sequence[tuple]], selected: Mapping[str, int], radius: int, most_gap: int, most_checks: int) -> dict[str, int]:
    """One round: each cluster of conflicting members, with up to radius neighbours on both sides that no gap over most_gap parts from it, is given options that conflict with nothing. So the conflicts left are always a strict subset of those before.

    members are in order; bounds are their coarse times.
    """
    now, at = dict(selected), {u: k for k, u in enumerate(members)}
    box = {u: [(min((w[0] for w in o), default=0), max((w[1] for w in o), default=0)) for o in options[u]] for u in members}
    apart = lambda k: bounds[members[k]][0] - bounds[members[k - 1]][1] > most_gap
    left = overlapping_pairs({u: options[u][now[u]] for u in members})
    for seed in sorted(_clusters(left), key=lambda c: min(at[u] for u in c)):
        if not any(a in seed or b in seed for a, b in left):
            continue
        low, high = min(at[u] for u in seed), max(at[u] for u in seed)
        first = next((k for k in range(low, max(0, low - radius), -1) if apart(k)), max(0, low - radius))
        last = next((k - 1 for k in range(high + 1, min(len(members), high + radius + 1)) if apart(k)), min(len(members), high + radius + 1) - 1)
        inside = members[first : last + 1]
        held = set(inside)
        begin, end = min(b[0] for u in inside for b in box[u]), max(b[1] for u in inside for b in box[u])
        # of the others only what lies where options of these may lie
        fixed = [(box[u][now[u]], options[u][now[u]]) for u in members if u not in held and box[u][now[u]][0] < end and begin < box[u][now[u]][1]]
        free = lambda u, i, fixed=fixed: not any(b[0] < box[u][i][1] and box[u][i][0] < b[1] and conflict(options[u][i], f) for b, f in fixed)
        fits = {u: [i for i in range(len(options[u])) if free(u, i)] for u in inside}
        found = best_selection({u: [options[u][i] for i in k] for u, k in fits.items()}, {u: [scores[u][i] for i in k] for u, k in fits.items()}, most_checks) if all(fits.values()) else None
        if found is None:
            continue
        now |= {u: fits[u][k] for u, k in found.items()}
        # these conflict with nothing now, and nothing else has moved: fewer conflicts are left, none of them new
        left = frozenset(p for p in left if p[0] not in held and p[1] not in held)
    return now


def stabilized(df: DataFrame, keys: Sequence[str], uid: str, position: str, start: str, end: str, options: str, selected: str, rounds: int = 4, radius: int = 2, most_gap: int = 2000, most_checks: int = 2_097_152) -> DataFrame:
    """(keys, uid, selected, round): the option of each member after at most so many rounds of improved_once, and the last round that changed it (0: none).

    options is an array of (words array of (start_ms, end_ms, speaker_id), score
    array of numbers); selected the 0-based number of the option now taken. A key's
    members are cut into sections where one starts more than most_gap behind
    whatever an earlier one may take; sections are groups. Each round is written
    to the shared folder, and only sections that the last one changed go on.
    Members without options keep what they have; an empty relation stays empty.
    """
    some = df.filter(F.size(options) > 0)
    reach = F.greatest(F.col(end), F.array_max(F.flatten(F.transform(options, lambda o: F.transform(o["words"], lambda w: w["end_ms"])))))
    begin = F.least(F.col(start), F.array_min(F.flatten(F.transform(options, lambda o: F.transform(o["words"], lambda w: w["start_ms"])))))
    by = Window.partitionBy(*keys).orderBy(position)
    # a section may only end where all that follows, in order, begins late enough
    marked = some.withColumns({"__reach": reach, "__begin": begin})
    so_far = F.max("__reach").over(by.rowsBetween(Window.unboundedPreceding, -1))
    to_come = F.min("__begin").over(by.rowsBetween(0, Window.unboundedFollowing))
    cut = sessions(marked.withColumn("__far", to_come - so_far > most_gap), keys, [position], F.col("__far"), "__section").drop("__reach", "__begin", "__far")
    columns = [*keys, "__section", uid, position, start, end, options, selected]
    whole = Window.partitionBy(*keys, "__section")
    sections = written(cut.select(*columns).withColumn("round", F.lit(0)).withColumn("__n", F.count("*").over(whole)), "selection")
    # a member alone has no conflict
    done, now = [sections.filter("__n = 1").drop("__n")], sections.filter("__n > 1").drop("__n")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in now.schema.fields)
    at = {c: k for k, c in enumerate(now.columns)}

    def a_round(number: int) -> Callable[[tuple, pa.Table], list[tuple]]:
        def run(key: tuple, table: pa.Table) -> list[tuple]:
            rows = list(zip(*(c.to_pylist() for c in table.columns), strict=True))
            names = [f"{k:09d}" for k in range(len(rows))]  # in order as text, too
            given = dict(zip(names, rows, strict=True))
            words = {u: [[(w["start_ms"], w["end_ms"], w["speaker_id"]) for w in o["words"]] for o in r[at[options]]] for u, r in given.items()}
            before = {u: r[at[selected]] for u, r in given.items()}
            if not overlapping_pairs({u: words[u][before[u]] for u in names}):
                return rows
            scores = {u: [tuple(o["score"]) for o in r[at[options]]] for u, r in given.items()}
            after = improved_once(names, {u: (r[at[start]], r[at[end]]) for u, r in given.items()}, words, scores, before, radius, most_gap, most_checks)
            new = lambda u, c, old: after[u] if c == selected else number if c == "round" and after[u] != before[u] else old
            return [tuple(new(u, c, x) for c, x in zip(at, r, strict=True)) for u, r in given.items()]

        return run

    for number in range(1, rounds + 1):
        after = written(each_group(now, [*keys, "__section"], [position], a_round(number), kinds), "selection")
        split = written(after.withColumn("__moved", F.max("round").over(whole) == number), "selection")
        done.append(split.filter("NOT __moved").drop("__moved"))
        now = split.filter("__moved").drop("__moved")
        if now.isEmpty():
            break
    done.append(now)
    return reduce(DataFrame.unionByName, done).select(*keys, uid, selected, "round")
