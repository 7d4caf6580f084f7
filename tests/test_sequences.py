import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from spanframe.operators import batching, select, sequences, validate

KEYS = ["k"]


def frame(spark, rows, names="k int, s bigint, e bigint, text string, speaker string"):
    return spark.createDataFrame(rows, names)


def test_boundaries(spark):
    rows = [(1, 0, 100, "Hi,", "a"), (1, 460, 500, "there.", "a"), (1, 690, 800, "Yes", "a"), (1, 1450, 1500, "- no", "b"), (1, 2500, 2600, "x", "b")]
    got = sequences.hard_boundaries(frame(spark, rows), KEYS, ["s"], "s", "e", "text").orderBy("s").collect()
    assert [r["reasons"] for r in got] == [[], ["clause"], ["sentence"], ["turn", "review_gap"], ["hard_gap", "review_gap"]]


def test_speaker_rules(spark):
    rows = [(1, 0, 10, "a", "x"), (1, 5, 15, "a", "x"), (1, 12, 20, "a", "y"), (1, 19, 30, "a", None)]
    out = sequences.adjacent_duplicates(frame(spark, rows), KEYS, ["s"], "text", "speaker", "s", "e").orderBy("s").collect()
    assert [r["duplicate"] for r in out] == [False, True, False, True]
    runs = sequences.speaker_runs(frame(spark, rows), KEYS, ["s"], "speaker").orderBy("s").collect()
    assert [(r["session"], r["tainted"]) for r in runs] == [(0, False), (0, False), (1, True), (1, True)]
    touching = sequences.overlap_before(frame(spark, [(1, 0, 10, "", ""), (1, 10, 20, "", "")]), KEYS, "s", "e", touching=True).orderBy("s").collect()
    assert [r["overlaps"] for r in touching] == [False, True]


def best_cost(rows):
    best = math.inf
    n = len(rows)
    for cuts in itertools.product([0, 1], repeat=n - 1):
        bounds = [0, *[i + 1 for i, c in enumerate(cuts) if c], n]
        total = 0.0
        for a, b in itertools.pairwise(bounds):
            own = sequences.reading_cost([r[1] for r in rows[a:b]], [r[2] for r in rows[a:b]], [r[3] for r in rows[a:b]], rows[b][1] if b < n else None)
            own = 1e6 if own is None and b - a == 1 else own
            total += math.inf if own is None else own
        best = min(best, total)
    return best


def test_optimal_groups_match_exhaustive_search(spark):
    rng = random.Random(6)
    for _ in range(4):
        rows, at = [], 0
        for _ in range(10):
            at += rng.randint(20, 900)
            rows.append((1, at, at + 250, rng.choice(["word", "longer-word,", "end.", "it"]), "a"))
            at += 250
        out = sequences.optimal_groups(frame(spark, rows), KEYS, ["s"], "s", "e", "text").orderBy("s").collect()
        total = 0.0
        for _, group in itertools.groupby(out, key=lambda r: r["part"]):
            group = list(group)
            following = next((r[1] for r in rows if r[1] > group[-1]["s"]), None)
            own = sequences.reading_cost([r["s"] for r in group], [r["e"] for r in group], [r["text"] for r in group], following)
            total += 1e6 if own is None else own
        assert math.isclose(total, best_cost(rows))


def test_capped_groups_and_trims(spark):
    rows = [(1, 0, 1000, "", ""), (1, 1000, 3000, "", ""), (1, 6000, 7000, "", ""), (1, 11_000, 12_000, "", "")]
    got = sequences.capped_groups(frame(spark, rows).withColumn("n", F.lit(30)), KEYS, ["s"], "s", "e", "n").orderBy("s").collect()
    assert [r["part"] for r in got] == [0, 0, 1, 2]
    trimmed = sequences.trimmed_overlaps(frame(spark, [(1, 0, 1000, "", ""), (1, 500, 900, "", ""), (1, 800, 1500, "", ""), (1, 2000, 2100, "", "")]), KEYS, "s", "e").orderBy("s").collect()
    assert [(r["s"], r["e"]) for r in trimmed] == [(0, 1000), (1000, 1500), (2000, 2400)]


def test_contexts_islands_components(spark):
    turns = spark.createDataFrame([(1, i, f"t{i}") for i in range(4)], "k int, i int, text string")
    got = sequences.with_context(turns, KEYS, ["i"], "text").orderBy("i").collect()
    assert [(r["context_before"], r["context_after"]) for r in got] == [("", "t1 / t2"), ("t0", "t2 / t3"), ("t0 / t1", "t3"), ("t1 / t2", "")]
    moved = spark.createDataFrame([(1, i, v) for i, v in enumerate([0, 2, 2, 2, 0, 2])], "k int, i int, v int")
    assert [r["in_run"] for r in sequences.islands(moved, KEYS, "i", "v").orderBy("i").collect()] == [False, True, True, True, False, False]
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "a bigint, b bigint")
    assert dict(map(tuple, sequences.overlap_components(pairs).collect())) == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}


def test_timings(spark):
    rows = [(1, 0, 500, "a" * 40, ""), (1, 1000, 1200, "b", ""), (1, 1210, 1300, "c", ""), (1, 9000, 9100, "d" * 400, "")]
    got = sequences.assigned_timings(frame(spark, rows), KEYS, "s", "e", "text").orderBy("s").collect()
    assert [r["display_end"] for r in got] == [920, 1209, 2000 - 90, 16_000]


def test_selection(spark):
    rows = spark.createDataFrame([(1, 9, 400), (1, 8, 500), (1, 7, 300), (1, 6, 200), (1, 5, 1)], "k int, score int, cost int")
    got = select.budgeted(rows, KEYS, [("score", False)], "cost", 3, 720).orderBy(F.desc("score")).collect()
    assert [r["chosen"] for r in got] == [True, False, True, False, True]
    sample = spark.createDataFrame([(1, i, i < 2, 100 - i) for i in range(60)], "k int, i int, must boolean, score int")
    assert sorted(r["i"] for r in select.review_sample(sample, "must", "score", "i").collect()) == [0, 1, 2]
    assert spark.range(1).select(select.priority(F.array(F.lit("x"), F.lit("y")), {"x": 3, "y": 7})).first()[0] == 7
    tracks = spark.createDataFrame([(1, "auto", "tr"), (1, "manual", "tr-TR"), (1, "manual", "tr-X-Y"), (1, "manual", "de")], "k int, kind string, code string")
    assert select.ranked_choice(tracks, KEYS, "kind", ["manual", "auto"], "code", "tr").first()["code"] == "tr-TR"
    limit = spark.range(1).select(select.share_limit(F.lit(2000), 0.11, 96, 192, F.lit(0.95)), select.share_limit(F.lit(2000), 0.11, 96, 192, F.lit(0.5))).first()
    assert tuple(limit) == (192, 96)


def test_batches(spark):
    for n in (0, 1, 349, 500, 501, 699, 700, 1000, 1201, 5000):
        sizes = batching.balanced_sizes(n)
        assert sum(sizes) == n and (not sizes or max(sizes) - min(sizes) <= 1 and max(sizes) <= 500)
        rows = spark.range(n).selectExpr("1 AS k", "id")
        got = [r["count"] for r in batching.balanced_batches(rows, KEYS, ["id"]).groupBy("batch").count().orderBy("batch").collect()]
        assert got == sizes
    sized = spark.createDataFrame([(1, i, s) for i, s in enumerate([5, 5, 20, 1, 1, 1, 1])], "k int, i bigint, size bigint")
    assert [r["batch"] for r in batching.byte_batches(sized, KEYS, "i", "size", 3, 10).orderBy("i").collect()] == [0, 0, 1, 2, 2, 2, 3]
    shares = batching.contiguous_shares(spark.range(8).selectExpr("1 AS k", "id"), KEYS, ["id"]).orderBy("id").collect()
    assert [r["share"] for r in shares] == [0, 0, 1, 1, 1, 2, 2, 2]


def test_part_cuts(spark):
    assert batching.part_cuts([3_603_000], 7_200_001) == [3_602_880]
    with pytest.raises(ValueError, match="over 3 parts"):
        batching.part_cuts([], 9_000_000, target=2_000_000, forced_after=0, most_parts=3)
    assert batching.part_cuts([], 9_000_000) == [] and batching.part_cuts([], 9_000_000, forced_after=90_000) == [3_600_000, 7_200_000]
    busy = spark.createDataFrame([(1, 0, 3_599_000), (1, 3_603_000, 7_199_000)], "k int, start_ms bigint, end_ms bigint")
    parts = batching.planned_parts(busy, KEYS, spark.createDataFrame([(1, 7_200_001)], "k int, total_ms bigint"))
    assert [(r["part_start"], r["part_end"]) for r in parts.orderBy("part").collect()] == [(0, 3_602_880), (3_602_880, 7_200_001)]


def test_validation(spark):
    import pytest

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    back = spark.createDataFrame([(1, "a"), (1, "a"), (3, "x"), (4, "d")], "id int, v string")
    assert sorted(map(tuple, validate.key_issues(rows, back, "id").collect())) == [("duplicate", 1, 2), ("extra", 4, 1), ("missing", 2, 0)]
    assert [(r["id"], r["field"], r["actual"]) for r in validate.echo_issues(rows, back, "id", ["v"]).collect()] == [(3, "v", '{"v":"x"}')]
    assert validate.same_relation(rows, rows.repartition(3)).count() == 0 and validate.same_relation(rows, back).count() == 5
    bad, good = validate.counters(rows, {"b": F.col("v") == "b"}), validate.counters(rows, {"z": F.col("v") == "z"})
    with pytest.raises(validate.GateError):
        validate.require_zero(bad)
    validate.require_zero(good)
    assert validate.gated(rows, bad).count() == 0 and validate.gated(rows, good).count() == 3
    with pytest.raises(validate.GateError):
        validate.require_exact_columns(rows, ["id"])
    windows = spark.createDataFrame([(1, ["a", "b"], ["c"]), (2, ["b", "x"], ["x"])], "w int, owned array<string>, context array<string>")
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "item string")
    assert sorted(map(tuple, validate.ownership_issues(windows, items, "w", "owned", "context", "item").collect())) == [("b", "owned_twice"), ("c", "unowned"), ("x", "owned_context"), ("x", "unknown")]
