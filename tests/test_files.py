import zipfile

from pyspark.sql import functions as F

from spanframe.sources import captions, jsonlines, packs, subtitles
from spanframe.streaming import incremental, sessions

SRT = "1\r\n00:00:01,000 --> 00:00:02,000\r\nHello\r\nthere\r\n\r\n3\r\n00:00:03,000 --> 00:00:02,000\r\nback\r\n\r\n3\r\nno timing\r\nx\r\n"
VTT = """WEBVTT

NOTE x

00:01.000 --> 00:03.000 align:start
old line
new <00:01.500><c>line</c>

00:03.000 --> 00:03.010
new line

1
00:00:04.000 --> 00:00:05.000
a &amp; b

00:00:04.000 --> 00:00:05.000
a &amp; b
"""


def test_srt(spark, tmp_path):
    (tmp_path / "a.srt").write_bytes(b"\xef\xbb\xbf" + SRT.encode())
    (tmp_path / "b.srt").write_bytes(b"\xff\xfe")
    files = subtitles.read_texts(spark, str(tmp_path))
    assert files.filter("text IS NULL").count() == 1
    got = [tuple(r)[1:] for r in subtitles.parse_srt(files).collect()]
    assert got[0] == (1, 1000, 2000, "Hello\nthere", None) and [g[-1] for g in got] == [None, "index out of order", "no timing line"]
    loose = [r["problem"] for r in subtitles.parse_srt(files, strict=False).collect()]
    assert loose == [None, "empty interval", "no timing line"]


def test_vtt(spark):
    files = spark.createDataFrame([("a", VTT)], "path string, text string")
    got = [tuple(r)[1:] for r in subtitles.parse_vtt(files).orderBy("caption_index").collect()]
    assert got == [(0, 1000, 2000, "new line"), (1, 4000, 5000, "a & b")]


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 1, "a": 2}\n{"a": NaN}\n{"a": 4}\n')
    got = [(r["line"], r["problem"] is None, r["value"] and r["value"]["a"]) for r in jsonlines.read_jsonl(spark, str(tmp_path), "a int").orderBy("line").collect()]
    assert got == [(1, True, 1), (3, False, None), (4, False, None), (5, True, 4)]
    rows = spark.createDataFrame([(2, None), (1, "ü")], "b int, a string")
    jsonlines.write_jsonl(rows, str(tmp_path / "out"), ["b"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text == '{"a":"ü","b":1}\n{"a":null,"b":2}\n'
    (tmp_path / "one.json").write_text('{"a": [1, 2]}')
    assert jsonlines.read_json(spark, str(tmp_path / "one.json"), "a array<int>").first()["value"]["a"] == [1, 2]


def test_packs(spark, tmp_path):
    rows = spark.createDataFrame([(1, i // 2, i, f"t{i}") for i in range(5)], "k int, batch int, i int, text string")
    pack = bytes(packs.packs(rows, ["k"], "batch", "i", ["i", "text"]).first()["pack"])
    assert pack == bytes(packs.packs(rows.repartition(3), ["k"], "batch", "i", ["i", "text"]).first()["pack"])
    (tmp_path / "good.zip").write_bytes(pack)
    (tmp_path / "broken.zip").write_bytes(pack[:-30])
    with zipfile.ZipFile(tmp_path / "bomb.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.jsonl", b"0" * (2 << 20))
    with zipfile.ZipFile(tmp_path / "path.zip", "w") as z:
        z.writestr("../x", b"0")
    members = packs.read_packs(spark, str(tmp_path / "*.zip"))
    assert members.filter("problem IS NOT NULL").count() == 3
    lines = packs.pack_lines(members).orderBy("member", "line").collect()
    assert [r["value"] for r in lines] == [f'{{"i":{i},"text":"t{i}"}}' for i in range(5)]
    good = members.filter("member IS NOT NULL")
    assert packs.membership_issues(good, ["manifest.json"], 3).count() == 0
    assert sorted(r["code"] for r in packs.membership_issues(good, ["readme"], 2).collect()) == ["extra", "extra", "missing"]


def test_recognition_rows(spark):
    value = '[{"start": 0.0005, "end": 1.0, "text": " a b ", "words": [{"start": 0.5, "end": 0.9, "word": " b", "probability": 0.5}, {"start": 0.1, "end": 0.4, "word": " a", "probability": 0.9}, {"start": 0.4, "end": 0.4, "word": "x", "probability": 1}]}]'
    frame = spark.createDataFrame([("e", value)], "k string, v string")
    assert tuple(captions.segments_from_json(frame, "k", "v", 10).first()) == ("e", 0, 10, 1010, "a b")
    assert [(r["word_index"], r["text"]) for r in captions.words_from_json(frame, "k", "v").orderBy("word_index").collect()] == [(0, " a"), (1, " b")]
    hashes = spark.createDataFrame([("0,v,SHA256=AB",), ("1,a,SHA256=cd",), ("2,a,SHA256=ef",), ("x",)], "line string")
    assert [(r["kind"], r["ordinal"], r["digest"]) for r in captions.stream_hashes(hashes, "line", []).orderBy("kind", "ordinal").collect()] == [("a", 0, "cd"), ("a", 1, "ef"), ("v", 0, "ab")]
    shows = spark.createDataFrame([(["a", "1"], "u"), (["a", "1"], "u"), (["a", "2"], "w")], "t array<string>, url string")
    assert tuple(captions.catalogue_match(shows, "t", ["a", "1"], "url").first()) == (1, "u")


def test_memo(spark, tmp_path):
    memo, calls = incremental.Memo(spark, str(tmp_path / "memo")), []

    def work(rows):
        calls.append(rows.count())
        return rows.select("uid", "input", F.upper("input").alias("result"))

    rows = spark.createDataFrame([(i, f"v{i}") for i in range(4)], "uid bigint, input string")
    bound = incremental.binding("stage", {"a": 1})
    assert memo.computed(rows, bound, work, most=3).count() == 3 and memo.computed(rows, bound, work).count() == 4
    changed = rows.withColumn("input", F.when(F.col("uid") == 2, "new").otherwise(F.col("input")))
    assert memo.computed(changed, bound, work).filter("result = 'NEW'").count() == 1
    assert memo.computed(rows, incremental.binding("stage", {"a": 2}), work).count() == 4
    assert calls == [3, 1, 1, 4]


def test_markers_and_parts(spark):
    markers = spark.createDataFrame([("s", "i", {"a": "1"}), ("s", "i", {"a": "2"})], "stage string, input string, outputs map<string,string>")
    files = spark.createDataFrame([("a", "1")], "path string, sha256 string")
    assert [r["outputs"] for r in incremental.reusable(markers, "s", "i", files).collect()] == [{"a": "1"}]
    parts = spark.createDataFrame([("p1", 1), ("p2", 2)], "part string, part_index int")
    done = spark.createDataFrame([("p1",)], "part string")
    assert incremental.next_part(parts, done).first()["part"] == "p2"
    assert tuple(incremental.all_published(parts, done).first()) == (False, 1)


def test_budget_and_retry():
    import pytest

    now = [0.0]
    budget = incremental.Budget(10, calls=1, clock=lambda: now[0])
    assert budget.reserve() and not budget.reserve()
    tries = []

    def fails(left):
        tries.append(left)
        raise incremental.Transient

    with pytest.raises(incremental.Transient):
        incremental.bounded_retry(fails, budget, sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert tries == [10, 9.5, 8.5]


def test_streams(spark, tmp_path):
    for k in range(3):
        spark.range(k * 5, k * 5 + 5).write.mode("append").parquet(str(tmp_path / "in"))
    seen = []
    assert incremental.run_parts(spark, str(tmp_path / "in"), "id bigint", str(tmp_path / "cp"), lambda df, n: seen.append(df.count())) >= 3
    assert sum(seen) == 15 and incremental.run_parts(spark, str(tmp_path / "in"), "id bigint", str(tmp_path / "cp"), lambda df, n: seen.append(1)) == 0


def run_stream(spark, tmp_path, batches, build, name):
    from datetime import datetime, timezone

    source, out = tmp_path / f"src-{name}", []
    source.mkdir()
    query = None
    for k, rows in enumerate(batches):
        data = [(u, datetime.fromtimestamp(s / 1000, timezone.utc), s, e) for u, s, e in rows]
        spark.createDataFrame(data, "u int, t timestamp, start_ms bigint, end_ms bigint").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("u int, t timestamp, start_ms bigint, end_ms bigint").parquet(str(source))
        query = build(stream).writeStream.outputMode("append").foreachBatch(lambda df, n: out.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
        query.awaitTermination()
    return sorted(out)


def test_interval_sessions_reopen_for_late_rows(spark, tmp_path):
    minute = 60_000
    batches = [[(1, 0, 2), (1, 10, 11)], [(1, 2, 3)], [(1, 100, 101)], [(1, 200, 201)]]
    batches = [[(u, (1000 + a) * minute, (1000 + b) * minute) for u, a, b in rows] for rows in batches]  # nothing is earlier than the first watermark, 0
    got = run_stream(spark, tmp_path, batches, lambda s: sessions.interval_sessions(s, "u", "t", gap=0, late="20 minutes"), "iv")
    assert got[:2] == [(1, 1000 * minute, 1003 * minute, 2), (1, 1010 * minute, 1011 * minute, 1)]


def test_bins_and_point_sessions(spark, tmp_path):
    minute = 60_000
    batches = [[(1, 0, 1), (1, 10_000, 1), (1, 5 * minute, 1)], [(1, 300 * minute, 1)], [(1, 400 * minute, 1)]]
    bins = run_stream(spark, tmp_path, batches, lambda s: sessions.binned_counts(s, "t", ["u"]), "bins")
    assert [r[2] for r in bins][:2] == [2, 1]
    points = run_stream(spark, tmp_path, batches, lambda s: sessions.point_sessions(s, "t", ["u"], "2 minutes"), "points")
    assert [r[3] for r in points][:2] == [2, 1]
