"""Recurrences over many small groups are read down sorted partitions, not called a group at a time."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spanframe.operators import ordering, sequences
from spanframe.plans import more_queries, queries


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def spans(n, seed):
    rng = random.Random(seed)
    return [(rng.randrange(40), k, s := rng.randrange(60_000), s + rng.choice([1, 30, 300, 900, 4000])) for k in range(n)]


def plain_groups(rows, longest, most, gap):
    out, by = {}, defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    for own in by.values():
        part, first, last, held = -1, 0, 0, 0
        for _, k, s, e in sorted(own, key=lambda r: (r[2], r[1])):
            if part < 0 or e - first > longest or held + 1 > most or s - last > gap:
                part, first, held, last = part + 1, s, 0, e
            held, last = held + 1, max(last, e)
            out[k] = part
    return out


def plain_trimmed(rows, least):
    out, by = {}, defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    for own in by.values():
        own.sort(key=lambda r: (r[2], r[3], r[1]))
        last = None
        for i, (_, k, s, e) in enumerate(own):
            begin = s if last is None else max(s, last)
            if e - begin < least:
                e = max(e, min(begin + least, own[i + 1][2] if i + 1 < len(own) else begin + least))
            if e > begin:
                out[k], last = (begin, e), e
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "key bigint, id bigint, start_ms bigint, end_ms bigint").repartition(3)


def test_capped_groups(spark, small_batches):
    rows = spans(900, 1)
    found = sequences.capped_groups(frame(spark, rows).withColumn("one", F.lit(1)), ["key"], ["start_ms", "id"], "start_ms", "end_ms", "one", 5000, 3, 2000)
    assert {r["id"]: r["part"] for r in found.collect()} == plain_groups(rows, 5000, 3, 2000)


def test_trimmed_overlaps(spark, small_batches):
    rows = spans(900, 2)
    found = sequences.trimmed_overlaps(frame(spark, rows), ["key"], "start_ms", "end_ms", ties=["id"])
    assert found.columns == ["key", "id", "start_ms", "end_ms"]
    assert {r["id"]: (r["start_ms"], r["end_ms"]) for r in found.collect()} == plain_trimmed(rows, 400)


def test_scanned_takes_nulls_and_empty_tables(spark, small_batches):
    rows = frame(spark, [(None, 1, 0, 5), (None, 2, None, 9), (3, 3, 4, 6)])

    def begin():
        seen = []
        return lambda s, following: (seen.append(s) or len(seen), following is None)

    found = ordering.scanned(rows, ["key"], ["start_ms"], ["start_ms"], begin, "n bigint, last boolean")
    assert {(r["id"], r["n"], r["last"]) for r in found.collect()} == {(1, 1, False), (2, 2, True), (3, 1, True)}
    assert ordering.scanned(rows.limit(0), ["key"], ["start_ms"], ["start_ms"], begin, "n bigint, last boolean").count() == 0


@pytest.mark.parametrize("made", [queries.capped_groups_events, queries.trimmed_overlaps_events, more_queries.semantic_windows_events])
def test_no_call_a_group(spark, sf_dir, made):
    assert "FlatMapGroups" not in made(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
