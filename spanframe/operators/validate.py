"""Relational validation: what is missing, extra, doubled, out of order or changed, and gates on the counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class GateError(ValueError):
    """A relation that a gate doesn't let through."""


def require_exact_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    missing, extra = [c for c in expected if c not in df.columns], [c for c in df.columns if c not in expected]
    if missing or extra:
        raise GateError(f"missing columns {missing}, unexpected columns {extra}")
    return df.select(*expected)


def key_issues(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(code, key, n): missing and extra keys, and keys that actual has n times. Null keys of actual are extra."""
    e, a = expected.select(key).distinct(), actual.groupBy(key).agg(F.count("*").alias("n"))
    missing = e.join(a, key, "left_anti").select(F.lit("missing").alias("code"), key, F.lit(0).cast("bigint").alias("n"))
    extra = a.join(e, key, "left_anti").select(F.lit("extra").alias("code"), key, "n")
    return missing.unionByName(extra).unionByName(a.filter("n > 1").select(F.lit("duplicate").alias("code"), key, "n"))


def order_issues(expected: DataFrame, actual: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """(keys, position, expected, actual): positions at which the two sequences of a key differ."""
    by = Window.partitionBy(*keys).orderBy(order)
    side = lambda df, name: df.select(*keys, (F.row_number().over(by) - 1).alias("position"), F.col(value).alias(name))
    both = side(expected, "expected").join(side(actual, "actual"), [*keys, "position"], "full_outer")
    return both.filter(~F.col("expected").eqNullSafe(F.col("actual")))


def echo_issues(expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, field, expected, actual): immutable fields that came back changed, values as JSON."""
    both = expected.select(key, *[F.col(c).alias(f"e_{c}") for c in columns]).join(actual.select(key, *[F.col(c).alias(f"a_{c}") for c in columns]), key)
    as_text = lambda c: F.to_json(F.struct(F.col(c).alias("v")))
    changed = F.array_compact(F.array(*[F.when(~F.col(f"e_{c}").eqNullSafe(F.col(f"a_{c}")), F.struct(F.lit(c).alias("field"), as_text(f"e_{c}").alias("expected"), as_text(f"a_{c}").alias("actual"))) for c in columns]))
    return both.select(key, F.explode(changed).alias("i")).select(key, "i.*")


def same_relation(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, row): rows, with their number, of one relation that the other doesn't have as often."""
    json = lambda df: df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("row"))
    x, y = json(a), json(b)
    return x.exceptAll(y).select(F.lit("left").alias("side"), "row").unionByName(y.exceptAll(x).select(F.lit("right").alias("side"), "row"))


def counters(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """For each rule the number of rows that it holds for, and passed: whether all are 0."""
    out = df.groupBy(*keys).agg(*[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return out.withColumn("passed", F.greatest(*rules, F.lit(0)) == 0 if rules else F.lit(True))


def issues(df: DataFrame, uid: str, rules: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """(uid, code, severity): a row for each rule, code: (severity, condition), that holds for a row."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, (severity, rule) in rules.items()]))
    return df.select(uid, F.explode(found).alias("i")).select(uid, "i.*")


def require_zero(report: DataFrame) -> None:
    """Raises unless every row of a counters report has passed."""
    bad = report.filter(~F.col("passed")).limit(1).collect()
    if bad:
        raise GateError(f"counters aren't zero: {bad[0].asDict()}")


def gated(df: DataFrame, report: DataFrame) -> DataFrame:
    """df if every row of the counters report has passed, else nothing of it; stays lazy. An empty report lets through."""
    passed = report.agg(F.coalesce(F.every("passed"), F.lit(True)).alias("__passed"))  # one row
    return df.crossJoin(F.broadcast(passed)).filter("__passed").drop("__passed")


def link_issues(parents: DataFrame, children: DataFrame, key: str, wants_child: Column, fields: Mapping[str, str]) -> DataFrame:
    """(key, code): rows that want a child without one, children without such a row, and fields (parent's: child's) that differ."""
    p = parents.filter(wants_child).select(key, *[F.col(a).alias(f"p{i}") for i, a in enumerate(fields)], F.lit(True).alias("__p"))
    c = children.select(key, *[F.col(b).alias(f"c{i}") for i, b in enumerate(fields.values())], F.lit(True).alias("__c"))
    both = p.join(c, key, "full_outer")
    differs = F.lit(False)
    for i in range(len(fields)):
        differs = differs | ~F.col(f"p{i}").eqNullSafe(F.col(f"c{i}"))
    code = F.when(F.col("__c").isNull(), "no_child").when(F.col("__p").isNull(), "no_parent").when(differs, "field_differs")
    return both.select(key, code.alias("code")).filter("code IS NOT NULL")


def ownership_issues(windows: DataFrame, items: DataFrame, window: str, owned: str, context: str, item: str) -> DataFrame:
    """(item, code): owned twice, owned by none, unknown, or both owned and context of one window."""
    each = windows.select(window, F.explode(owned).alias(item))
    twice = each.groupBy(item).count().filter("count > 1").select(item, F.lit("owned_twice").alias("code"))
    none = items.select(item).join(each, item, "left_anti").select(item, F.lit("unowned").alias("code"))
    unknown = each.join(items.select(item), item, "left_anti").select(item, F.lit("unknown").alias("code"))
    own_context = windows.select(F.explode(F.array_intersect(owned, context)).alias(item)).select(item, F.lit("owned_context").alias("code"))
    return twice.unionByName(none).unionByName(unknown).unionByName(own_context)
