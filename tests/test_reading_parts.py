"""Many groups solved at once against the recursion that solves one."""

import random

import numpy as np
import pyarrow as pa
import pytest

from spanframe.operators import segmentation, sequences


@pytest.mark.parametrize("limits", [{}, {"most_chars": 30, "longest": 2500, "least": 300, "chars_per_second": 13.7, "wanted_chars": 21.5}])
def test_parts_of_many_groups(limits):
    rng = random.Random(6)
    starts, ends, texts, begins = [], [], [], []
    for size in [1, 2, 3, 70, 1, 140, *(rng.randrange(1, 60) for _ in range(60))]:
        begins.append(len(starts))
        at = rng.randrange(10_000)
        for _ in range(size):
            starts.append(at)
            ends.append(at + rng.choice([0, 80, 300, 900, 9000]))
            texts.append(rng.choice(["a", "word", "so,", "end.", 'said."', "”", "x" * 40, "x" * 90, "ünïcode…", "", "and", "of;", "Ja!)"]))
            at += rng.choice([0, 60, 350, 350, 1200])
    want = []
    for begin, stop in zip(begins, [*begins[1:], len(starts)], strict=True):
        s, e, t = starts[begin:stop], ends[begin:stop], texts[begin:stop]
        price = lambda a, b, s=s, e=e, t=t: sequences.reading_cost(s[a:b], e[a:b], t[a:b], s[b] if b < len(s) else None, **limits)
        marks = set(segmentation.path_from(segmentation.solved(len(s), price, 24, {0: 0})[1], len(s)))
        group = -1
        for k in range(len(s)):
            group += k in marks
            want.append(group)
    got = segmentation.reading_parts(np.array(starts), np.array(ends), pa.array(texts), np.array(begins), 24, **{**sequences.READING, **limits})
    assert got.tolist() == want


def test_groups_over_several_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    rows = [(None if g == 3 else g, k, k * 350, k * 350 + 300, "word." if k % 5 == 4 else "word") for g, size in enumerate([1, 20, 7, 3, 14, 1, 2]) for k in range(size)]
    df = spark.createDataFrame(rows, "g int, k int, s bigint, e bigint, t string")
    quick = sequences.optimal_groups(df, ["g"], ["k"], "s", "e", "t")
    slow = sequences.optimal_groups(df, ["g"], ["k"], "s", "e", "t", cost=sequences.reading_cost)
    assert "FlatMapGroups" not in quick._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, quick.collect())) == sorted(map(str, slow.collect())) and quick.count() == 48
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
