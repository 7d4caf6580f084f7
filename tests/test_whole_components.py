"""Conflict search by component, without a limit on its depth."""

import datetime

from spanframe.operators import conflicts
from spanframe.plans import more_queries


def test_selection_of_a_long_component():
    options = {f"u{u:04}": [[(100 * u, 100 * u + 50, "a")]] for u in range(1100)}
    assert conflicts.best_selection(options, {u: [(1,)] for u in options}) == dict.fromkeys(options, 0)


def test_an_unsolvable_component_leaves_others_of_the_user(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(k, at, 1, "click", 5000.0) for k in range(3)] + [(k, at + datetime.timedelta(days=9), 1, "click", 100.0) for k in (10, 11)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {r["uid"]: (r["user_id"], r["option"], r["solved"]) for r in more_queries.conflict_free_options(spark, str(tmp_path)).collect()}
    assert got == {"0": (1, None, False), "1": (1, None, False), "2": (1, None, False), "10": (1, 0, True), "11": (1, 1, True)}
