"""Near scores that can't count aren't worked out, and rows that cost much are dealt to all tasks."""

from spanframe.functions import text
from spanframe.plans import checks, suspicion
from spanframe.plans.span_queries import spoken_turns


def test_displaced_texts_match_no_further_than_counts(spark, tmp_path):
    said = [f"{w} " * 30 for w in ("alpha beta", "gamma delta", "some words here", "other things there", "quite a lot")]
    rows = [(1, k, s, said[(k + 1) % 5] if k < 2 else f"{s} and more {k}") for k, s in enumerate(said)]
    frame = spark.createDataFrame(rows, "conv bigint, turn bigint, s string, b string")
    found = {r["turn"]: (r["offset"], r["reason"], r["score"]) for r in checks.displaced_texts(frame, ["conv"], "turn", "s", "b").collect()}
    assert found == {0: (1, "exact_neighbour", 1.0), 1: (1, "exact_neighbour", 1.0)}
    assert text.blended("alpha beta " * 30, "xyz uvw " * 30, 0.62) is None


def test_captions_are_matched_in_all_tasks(spark, sf_dir):
    segments, captions = spoken_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    asked = []
    real = suspicion.dealt
    try:
        suspicion.dealt = lambda df, by: asked.append(by) or real(df, by)
        suspicion.suspicious_spans(segments, captions, ["conv_id"], "turn")
    finally:
        suspicion.dealt = real
    assert asked == [["conv_id", "turn"]]
