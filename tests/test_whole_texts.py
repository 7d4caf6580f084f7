"""Queries over conversations read whole texts."""

from spanframe.plans import more_queries, queries


def conversations(spark, folder, texts):
    rows = [(1, k, "user", t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def test_blocks_and_groups_hold_every_word(spark, tmp_path):
    said = [" ".join(f"word{k}" for k in range(n)) for n in (150, 3)]
    d = conversations(spark, tmp_path, said)
    blocks = more_queries.words_to_blocks_conversations(spark, d).orderBy("start_ms").collect()
    assert " ".join(r["text"] for r in blocks).split() == " ".join(said).split() and sum(r["n_words"] for r in blocks) == 153
    assert queries.optimal_groups_conversations(spark, d).count() == 153


def test_similar_turns_differ_behind_a_common_beginning(spark, tmp_path):
    begin = "the same beginning " * 20
    row = queries.similar_turns(spark, conversations(spark, tmp_path, [begin + "apples and pears", begin + "quick brown foxes"])).first()
    assert row["ratio"] < 1 and row["blended"] < 1 and row["dice"] < 1


def test_displaced_texts_and_final_qa_see_the_end_of_a_text(spark, tmp_path):
    begin = "all of these turns begin with one long sentence that says nothing of what follows it and goes on for quite a while " * 2
    rows = [(3, k, "user", begin + end) for k, end in enumerate(["apples", "boats 7", "clouds"])]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    moved = {r["turn"]: (r["offset"], r["reason"]) for r in more_queries.displaced_texts_conversations(spark, str(tmp_path)).collect()}
    assert moved == {0: (1, "exact_neighbour"), 1: (1, "exact_neighbour")}
    found = more_queries.final_qa_conversations(spark, str(tmp_path)).collect()
    assert sum(r["code"] == "line_over_limit" for r in found) == 3 and not any(r["code"] == "numeric_anchor_mismatch" for r in found)
