import random

import pytest
from pyspark.sql import functions as F

from spanframe.operators import intervals as iv
from spanframe.plans.coverage import CoverageConfig, coverage_report

KEYS = ["k"]


def rel(spark, rows, names="k int, start_ms bigint, end_ms bigint"):
    return spark.createDataFrame(rows, names)


def random_rows(seed, n=120, span=4000, keys=3):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        s = rng.randrange(span)
        out.append((rng.randrange(keys), s, s + rng.randint(1, 200)))
    return out


def union(rows, gap):
    out = []
    for k, s, e in sorted(rows):
        if out and out[-1][0] == k and s <= out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([k, s, e])
    return {tuple(x) for x in out}


@pytest.mark.parametrize("gap", [-1, 0, 25])
@pytest.mark.parametrize("bucket", [None, 300])
def test_union(spark, gap, bucket):
    rows = random_rows(gap + 7)
    got = iv.coalesce_intervals(rel(spark, rows), KEYS, gap=gap, bucket=bucket)
    assert {tuple(r)[:3] for r in got.collect()} == union(rows, gap) and got.agg(F.sum("n_merged")).first()[0] == len(rows)


def covered_points(rows, k):
    return {t for key, s, e in rows if key == k for t in range(s, e)}


@pytest.mark.parametrize("bucket", [150, 10**9])
def test_intersect_subtract_and_coverage(spark, bucket):
    regions = [(k, s, e) for k, s, e in union(random_rows(1, 12), 0)]
    items = random_rows(2, 60)
    r, i = rel(spark, regions, "k int, region_start bigint, region_end bigint"), rel(spark, items)
    inside = iv.intersect_intervals(r, i, KEYS, bucket=bucket).collect()
    gaps = iv.subtract_intervals(r, i, KEYS, bucket=bucket).collect()
    sums = {tuple(x)[:3]: x["covered_ms"] for x in iv.coverage(r, i, KEYS, bucket=bucket).collect()}
    for k, s, e in regions:
        cover = covered_points(items, k) & set(range(s, e))
        assert {t for x in inside if tuple(x)[:3] == (k, s, e) for t in range(x["start_ms"], x["end_ms"])} == cover
        assert {t for x in gaps if tuple(x)[:3] == (k, s, e) for t in range(x["gap_start"], x["gap_end"])} == set(range(s, e)) - cover
        assert sums[k, s, e] == len(cover)


def test_untouched_region_is_one_gap_and_nulls_stay_null(spark):
    gaps = iv.subtract_intervals(rel(spark, [(1, 10, 20)], "k int, region_start bigint, region_end bigint"), rel(spark, [(1, 20, 30), (2, 10, 20)]), KEYS).collect()
    assert [tuple(g) for g in gaps] == [(1, 10, 20, 10, 20)]
    assert spark.range(1).select(iv.overlap(F.lit(1), F.lit(5), F.lit(None).cast("bigint"), F.lit(9))).first()[0] is None
    assert spark.range(1).select(iv.safe_ratio(F.lit(0), F.lit(0))).first()[0] == 1.0


@pytest.mark.parametrize("bucket", [70, 10**9])
def test_joins_match_nested_loops(spark, bucket):
    a, b = random_rows(3, 80), random_rows(4, 80)
    left, right = rel(spark, a), rel(spark, b, "k int, s bigint, e bigint")
    got = sorted(map(tuple, iv.interval_join(left, right, KEYS, ("start_ms", "end_ms"), ("s", "e"), bucket).select("k", "start_ms", "end_ms", "s", "e").collect()))
    assert got == sorted((k, s, e, s2, e2) for k, s, e in a for k2, s2, e2 in b if k == k2 and s < e2 and s2 < e)
    got = sorted(map(tuple, iv.containment_join(left, right, KEYS, ("start_ms", "end_ms"), ("s", "e"), bucket).select("k", "start_ms", "end_ms", "s", "e").collect()))
    assert got == sorted((k, s, e, s2, e2) for k, s, e in a for k2, s2, e2 in b if k == k2 and s <= s2 and e2 <= e)


def test_sweep(spark):
    rows = [(1, 0, 10), (1, 5, 15), (1, 20, 25)]
    got = sorted(map(tuple, iv.active_sets(rel(spark, [(*r, n) for n, r in enumerate(rows)], "k int, start_ms bigint, end_ms bigint, n int"), KEYS, "n").collect()))
    assert got == [(1, 0, 5, [0]), (1, 5, 10, [0, 1]), (1, 10, 15, [1]), (1, 20, 25, [2])]
    assert [r["n_active"] for r in iv.elementary_intervals(rel(spark, rows), KEYS).orderBy("start_ms").collect()] == [1, 2, 1, 1]


def test_chop_rebase_and_checks(spark):
    assert sorted((r[1], r[2]) for r in iv.chop(rel(spark, [(1, 0, 25)]), 10).collect()) == [(0, 10), (10, 20), (20, 25)]
    parts = rel(spark, [(1, 100, 200)], "k int, part_start bigint, part_end bigint")
    assert [(r["start_ms"], r["end_ms"]) for r in iv.rebased(rel(spark, [(1, 50, 120), (1, 150, 300)]), parts, KEYS).orderBy("start_ms").collect()] == [(0, 20), (50, 100)]
    bad = iv.require_intervals(rel(spark, [(1, 0, 10), (1, 5, 8), (1, 9, 9), (1, None, 3), (1, -5, -1)]), KEYS)
    assert sorted(r["problem"] or "" for r in bad.collect()) == ["", "empty interval", "missing bound", "negative start", "overlaps the one before"]


def test_dominant_column(spark):
    frames = spark.createDataFrame([("a", [0.1, 0.9]), ("a", [0.2, 0.8]), ("a", [0.9, 0.1]), ("b", [0.5, 0.5])], "u string, p array<double>")
    got = {r["u"]: (r["winner"], r["frames"]) for r in iv.dominant_column(frames, ["u"], "p", least_frames=2, least_share=0.6).collect()}
    assert got == {"a": (2, 2), "b": (None, 1)}


def test_coverage_report(spark):
    speech, words = rel(spark, [(1, 0, 10_000), (1, 20_000, 21_000)]), rel(spark, [(1, 500, 4000), (1, 12_000, 13_000)])
    report = coverage_report(speech, words, KEYS)
    assert sorted((r["gap_start"], r["gap_end"], r["reason"]) for r in report.issues.collect()) == [(0, 380, "low_coverage_speech_hole"), (4120, 10_000, "low_coverage_speech_hole"), (20_000, 21_000, "low_coverage_speech_hole")]
    assert [(r["word_start"], r["gap_end"]) for r in report.violations.collect()] == [(12_000, 13_000)]
    assert not report.summary.first()["passed"]
    assert sorted((r["start_ms"], r["end_ms"]) for r in report.rescue.collect()) == [(0, 880), (3620, 10_500), (19_500, 21_500)]
    reviewed = report.issues.select("k", "region_start", "region_end", "gap_start", "gap_end")
    clean = coverage_report(speech, words.filter("start_ms < 10000"), KEYS, CoverageConfig(), reviewed)
    assert clean.summary.first()["passed"]


def test_asof_and_band(spark):
    left = spark.createDataFrame([(1, 10), (1, 5), (2, 7)], "k int, t bigint")
    right = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 11, "c")], "k int, at bigint, v string")
    before = {(r["k"], r["t"]): r["v"] for r in iv.asof(left, right, KEYS, "t", "at", ["v"], order=["v"]).collect()}
    after = {(r["k"], r["t"]): r["v"] for r in iv.asof(left, right, KEYS, "t", "at", ["v"], "next", order=["v"]).collect()}
    assert before == {(1, 10): "b", (1, 5): "b", (2, 7): None} and after == {(1, 10): "c", (1, 5): "a", (2, 7): None}
    rows = spark.createDataFrame([(1, i, i * i) for i in range(6)], "k int, i int, v int")
    got = sorted((r["i"], r["offset"], r["other_v"]) for r in iv.band_join(rows, KEYS, "i", 2, ["v"]).collect())
    assert got == sorted((i, j - i, j * j) for i in range(6) for j in range(6) if 0 < abs(i - j) <= 2)
