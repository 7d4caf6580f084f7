"""Contracts between relations: what comes back, what is locked, what is carried over. Each gives rows of issues; an empty relation has none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanframe.functions import identity
from spanframe.operators import validate
from spanframe.operators.ordering import numbered, ranged, running


def sourced(parts: Mapping[str, DataFrame], order: Sequence[str]) -> DataFrame:
    """All parts as one relation, with part, line (from 1, in order, within the part) and position (from 0, over all parts in order of their names). Rows are numbered by ranges, whatever a part holds."""
    both = reduce(DataFrame.unionByName, [df.withColumn("part", F.lit(name)) for name, df in sorted(parts.items())])
    rows = ranged(both, ["part"], order)
    lined = running(rows, ["part"], order, {"line": F.lit(1).cast("bigint")})
    counts = dict(sorted(map(tuple, rows.groupBy("part").count().collect())))  # a row a part, as many as the caller names
    base, held = {}, 0
    for name in sorted(parts):
        base[name], held = held, held + counts.get(name, 0)
    before = F.create_map(*[F.lit(x) for pair in base.items() for x in pair])
    return lined.withColumn("position", (before[F.col("part")] + F.col("line") - 1).cast("bigint")).drop("__range")


def span_safety(words: DataFrame, spans: DataFrame, keys: Sequence[str], index: str, start: str, end: str, speaker: str, scene: str, most_gap: int = 1000) -> DataFrame:
    """spans (keys, span, first, last) with safe: whether all words between are there, no gap inside is over most_gap, and one speaker and one scene at most are named."""
    each = spans.withColumn(index, F.explode(F.sequence("first", "last"))).join(words.select(*keys, index, start, end, speaker, scene), [*keys, index])
    by = [*keys, "span"]
    gaps = each.withColumn("__gap", F.col(start) - F.lag(end).over(Window.partitionBy(*by).orderBy(index)))
    found = gaps.groupBy(*by).agg(F.count("*").alias("__n"), F.max("__gap").alias("__g"), F.count_distinct(speaker).alias("__s"), F.count_distinct(scene).alias("__c"))
    safe = (F.col("__n") == F.col("last") - F.col("first") + 1) & (F.coalesce("__g", F.lit(0)) <= most_gap) & (F.col("__s") <= 1) & (F.col("__c") <= 1)
    return spans.join(found, by, "left").withColumn("safe", F.coalesce(safe, F.lit(False))).select(*spans.columns, "safe")


def resolution_issues(windows: DataFrame, blocks: DataFrame, window: str, block: str, first: str, last: str, lower: str, upper: str) -> DataFrame:
    """(window, block, code): blocks that are empty ranges, leave their window (lower to upper), or begin before the block in front has ended; and windows without blocks (block null)."""
    both = blocks.join(windows.select(window, lower, upper), window, "left")
    before = F.max(last).over(Window.partitionBy(window).orderBy(block).rowsBetween(Window.unboundedPreceding, -1))
    code = F.when(F.col(lower).isNull(), "unknown_window").when(F.col(first) > F.col(last), "empty_range").when((F.col(first) < F.col(lower)) | (F.col(last) > F.col(upper)), "outside").when(F.col(first) <= before, "overlap")
    found = both.withColumn("code", code).filter("code IS NOT NULL").select(window, block, "code")
    bare = windows.select(window).join(blocks.select(window), window, "left_anti").select(window, F.lit(None).cast(blocks.schema[block].dataType).alias(block), F.lit("no_blocks").alias("code"))
    return found.unionByName(bare)


def return_issues(sent: DataFrame, back: DataFrame, key: str, order: str, fields: Sequence[str], forbidden: Sequence[str] = ()) -> DataFrame:
    """(code, item): columns that came back though forbidden or unknown, or are missing; keys that are missing, extra or double; and positions at which the order of common keys differs."""
    columns = [("forbidden_column", c) for c in forbidden if c in back.columns] + [("unknown_column", c) for c in back.columns if c not in fields and c not in forbidden] + [("missing_column", c) for c in fields if c not in back.columns]
    found = sent.sparkSession.createDataFrame(columns, "code string, item string")
    keys = validate.key_issues(sent, back, key).select("code", F.col(key).cast("string").alias("item"))
    common = sent.select(key).join(back.select(key), key, "left_semi")
    mine = numbered(sent.join(common, key, "left_semi").select(key, order), [], [order, key], "__no").select(key, "__no")
    theirs = numbered(back.join(common, key, "left_semi").select(key, order), [], [order, key], "__no").select(F.col(key).alias("got"), "__no")
    moved = mine.join(theirs, "__no").filter(~F.col(key).eqNullSafe(F.col("got"))).select(F.lit("order").alias("code"), F.col(key).cast("string").alias("item"))
    return found.unionByName(keys).unionByName(moved)


def locked_relation(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], report: DataFrame) -> DataFrame:
    """(keys, n, digest): the digest that locks each key's rows, for keys whose row in the counters report (keys, passed, ...) has passed."""
    passed = report.groupBy(*keys).agg(F.every("passed").alias("passed")).filter("passed").drop("passed")
    return identity.relation_digest(df.join(passed, list(keys), "left_semi"), keys, order, columns)


def lock_issues(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], locks: DataFrame) -> DataFrame:
    """(keys, code): locks (keys, n, digest) that the rows recomputed don't meet."""
    now = identity.relation_digest(df, keys, order, columns).select(*keys, F.col("n").alias("n_now"), F.col("digest").alias("d_now"))
    both = locks.select(*keys, "n", "digest").join(now, list(keys), "full_outer")
    code = F.when(F.col("d_now").isNull(), "gone").when(F.col("digest").isNull(), "not_locked").when(F.col("n") != F.col("n_now"), "count_differs").when(F.col("digest") != F.col("d_now"), "digest_differs")
    return both.withColumn("code", code).filter("code IS NOT NULL").select(*keys, "code")


def config_issues(actual: DataFrame, expected: Mapping[str, object], name: str = "name", value: str = "value") -> DataFrame:
    """(name, code, expected, actual) of settings, as text, that are missing, unknown or not exactly as expected."""
    wanted = actual.sparkSession.createDataFrame([(k, str(v)) for k, v in expected.items()], "name string, expected string")
    both = wanted.join(actual.select(F.col(name).alias("name"), F.col(value).cast("string").alias("actual"), F.lit(True).alias("there")), "name", "full_outer")
    code = F.when(F.col("there").isNull(), "missing").when(F.col("expected").isNull(), "unknown").when(~F.col("expected").eqNullSafe(F.col("actual")), "differs")
    return both.withColumn("code", code).filter("code IS NOT NULL").select("name", "code", "expected", "actual")


def recomputed_issues(stored: DataFrame, recomputed: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, code): rows of a stored plan, lineage or snapshot that its recomputation lacks, has besides, or has otherwise."""
    digest = lambda df, name: df.select(*key, identity.row_digest(*recomputed.columns).alias(name))
    both = digest(stored, "a").join(digest(recomputed, "b"), list(key), "full_outer")
    code = F.when(F.col("a").isNull(), "lacking").when(F.col("b").isNull(), "extra").when(F.col("a") != F.col("b"), "differs")
    return both.withColumn("code", code).filter("code IS NOT NULL").select(*key, "code")


def sequence_contract_issues(rows: DataFrame, keys: Sequence[str], uid: str, index: str, start: str, end: str, checks: Mapping[str, Column] | None = None) -> DataFrame:
    """(uid, code) of an ordered relation of timed rows: index not dense from 0, empty or negative interval, start before the row in front (order) or before its end (overlap), double ids, and further checks by name."""
    by = Window.partitionBy(*keys).orderBy(index, uid)
    marked = rows.withColumns({"__at": F.row_number().over(by) - 1, "__ps": F.lag(start).over(by), "__pe": F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1)), "__n": F.count("*").over(Window.partitionBy(uid))})
    rules = {
        "index": F.col(index) != F.col("__at"),
        "interval": (F.col(start) < 0) | (F.col(end) <= F.col(start)),
        "order": F.col(start) < F.col("__ps"),
        "overlap": F.col(start) < F.col("__pe"),
        "double_id": F.col("__n") > 1,
        **(checks or {}),
    }
    return validate.issues(marked, uid, {code: ("error", rule) for code, rule in rules.items()}).drop("severity")


def carried_edits(before: DataFrame, edits: DataFrame, after: DataFrame, uid: str, index: str, fixed: Sequence[str], flags: str, addable: Sequence[str]) -> DataFrame:
    """(uid, edited, status, code): edits (uid, edited, status) of the rows before, carried to the rows after, whose flags may only have grown by addable ones.

    code says why a row can't be carried: it moved, a fixed column changed, or its
    flags changed otherwise. A reviewed row that is carried is pending again.
    """
    old = numbered(before, [], [index, uid], "__a").select(uid, "__a", F.struct(*fixed).alias("__f"), F.col(flags).alias("__o"))
    new = numbered(after, [], [index, uid], "__b").select(uid, "__b", F.struct(*fixed).alias("__g"), F.col(flags).alias("__p"))
    both = old.join(new, uid, "full_outer").join(edits, uid, "left")
    grown = (F.size(F.array_except("__o", "__p")) == 0) & (F.size(F.array_except(F.array_except("__p", "__o"), F.array(*map(F.lit, addable)).cast("array<string>"))) == 0)
    code = F.when(F.col("__a").isNull(), "new").when(F.col("__b").isNull(), "gone").when(F.col("__a") != F.col("__b"), "moved").when(~F.col("__f").eqNullSafe(F.col("__g")), "field_changed").when(~grown, "flags_changed")
    status = F.when(F.col("status") == "reviewed", "pending").otherwise(F.col("status"))
    return both.withColumn("code", code).select(uid, F.when(F.col("code").isNull(), F.col("edited")).alias("edited"), F.when(F.col("code").isNull(), status).alias("status"), "code")


def collected_returns(owners: DataFrame, returns: DataFrame, key: str, worker: str, lenient: bool = False) -> DataFrame:
    """(key, worker, code) of returned rows and of owned rows (owners: key, worker): accepted, missing, not_owned or double.

    A row that several returns hold is double in all of them; lenient, the first by worker is accepted.
    """
    n, first = F.count("*").over(Window.partitionBy(key, worker)), F.row_number().over(Window.partitionBy(key, worker).orderBy(worker))
    back = returns.select(key, worker).withColumns({"__n": n, "__r": first})
    joined = back.join(owners.select(key, worker, F.lit(True).alias("__own")), [key, worker], "left")
    double = F.col("__r") > 1 if lenient else F.col("__n") > 1
    got = joined.select(key, worker, F.when(F.col("__own").isNull(), "not_owned").when(double, "double").otherwise("accepted").alias("code"))
    missing = owners.join(returns.select(key, worker).distinct(), [key, worker], "left_anti").select(key, worker, F.lit("missing").alias("code"))
    return got.unionByName(missing)


def pack_issues(members: DataFrame, listed: DataFrame, static: Sequence[str] = ("manifest.json",)) -> DataFrame:
    """(path, member, code): what a pack's members (path, member, sha256, problem) and the members its manifest lists (path, member, sha256, records) disagree on. A refused pack is one row."""
    refused = members.filter("problem IS NOT NULL").select("path", "member", F.lit("refused").alias("code"))
    own = members.filter(F.col("problem").isNull() & ~F.col("member").isin(*static)).select("path", "member", F.col("sha256").alias("now"))
    both = listed.select("path", "member", "sha256").join(own, ["path", "member"], "full_outer")
    bad = members.filter("problem IS NOT NULL").select("path")
    code = F.when(F.col("now").isNull(), "missing").when(F.col("sha256").isNull(), "extra").when(F.col("now") != F.col("sha256"), "digest_differs")
    found = both.join(bad, "path", "left_anti").withColumn("code", code).filter("code IS NOT NULL").select("path", "member", "code")
    return refused.unionByName(found)


def listed_members(members: DataFrame) -> DataFrame:
    """(path, member, sha256): what the manifests of packs list."""
    manifest = members.filter("member = 'manifest.json' AND problem IS NULL").select("path", F.from_json(F.col("content").cast("string"), "members map<string,string>").alias("m"))
    return manifest.select("path", F.explode("m.members").alias("member", "sha256"))
