"""Passages of fewer tokens than the join key has."""

from spanframe.plans import queries


def test_short_passages_are_found(spark, tmp_path):
    docs = [(1, "one two three four five six seven eight nine ten"), (2, "three four"), (3, "five four three"), (4, "")]
    passages = [(0, "three four"), (1, "Ten!"), (2, "two three four five six seven eight nine ten"), (3, "..."), (4, "eight seven")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(passages, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, queries.benchmark_contiguous_match(spark, str(tmp_path)).collect()))
    assert got == [(1, 0), (1, 1), (1, 2), (2, 0), (4, 3)]
