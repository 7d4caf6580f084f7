import itertools
import random

from pyspark.sql import functions as F

from spanframe.operators import conflicts
from spanframe.plans import captions, checks, semantic

KEYS = ["k"]


def brute_selection(options, scores):
    names = sorted(options)
    best = None
    for pick in itertools.product(*(range(len(options[u])) for u in names)):
        if any(conflicts.conflict(options[a][i], options[b][j]) for (a, i), (b, j) in itertools.combinations(zip(names, pick, strict=True), 2)):
            continue
        total = tuple(map(sum, zip(*(scores[u][i] for u, i in zip(names, pick, strict=True)), strict=True)))
        if best is None or (total, [-i for i in pick]) > best[0]:
            best = (total, [-i for i in pick]), dict(zip(names, pick, strict=True))
    return best and best[1]


def random_case(rng):
    options, scores = {}, {}
    for u in range(rng.randint(1, 4)):
        options[f"u{u}"], scores[f"u{u}"] = [], []
        for _ in range(rng.randint(1, 4)):
            at, words = rng.randint(0, 60), []
            for _ in range(rng.randint(1, 3)):
                words.append((at, at + rng.randint(5, 25), rng.choice(["a", "b", None])))
                at += rng.randint(5, 30)
            options[f"u{u}"].append(words)
            scores[f"u{u}"].append((rng.randint(0, 1), rng.randint(0, 1)))
    return options, scores


def test_conflict_is_a_pairwise_overlap():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([(s := rng.randint(0, 50), s + rng.randint(1, 20), rng.choice(["a", "b", None])) for _ in range(rng.randint(0, 4))] for _ in range(2))
        want = any(x[0] < y[1] and y[0] < x[1] and (x[2] is None or y[2] is None or x[2] == y[2]) for x in a for y in b)
        assert conflicts.conflict(a, b) == want


def test_selection_matches_exhaustive_search():
    rng = random.Random(20)
    for _ in range(200):
        options, scores = random_case(rng)
        assert conflicts.best_selection(options, scores) == brute_selection(options, scores)


def test_selection_does_bounded_work():
    options = {f"u{u}": [[(100 * u + 40 * i, 100 * u + 40 * i + 120, "a")] for i in range(6)] for u in range(5)}
    assert conflicts.best_selection(options, {u: [(1,)] * 6 for u in options}, most_checks=450) is not None
    assert conflicts.best_selection(options, {u: [(1,)] * 6 for u in options}, most_checks=2) is None


def test_selection_in_groups(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for c in range(6):
        options, scores = random_case(rng)
        found = brute_selection(options, scores)
        for u in options:
            want[c, u] = None if found is None else found[u]
            for i, (w, s) in enumerate(zip(options[u], scores[u], strict=True)):
                rows.append((c, u, i, w, list(s)))
    frame = spark.createDataFrame(rows, "c int, uid string, option bigint, words array<struct<start_ms:bigint,end_ms:bigint,speaker_id:string>>, score array<int>")
    got = {(r["c"], r["uid"]): r["option"] for r in conflicts.selected_options(frame, "c", "uid", "option", "words", "score").collect()}
    assert got == want


def test_orphan_captions(spark):
    caps = spark.createDataFrame([(1, 0, 0, 1000, "hello big world"), (1, 1, 5000, 6000, "nothing near"), (1, 2, 9000, 13_000, "late shared words here")], "k int, caption_index int, start_ms bigint, end_ms bigint, text string")
    said = spark.createDataFrame([(1, 100, 950, "hello"), (1, 9000, 9200, "late shared")], "k int, start_ms bigint, end_ms bigint, text string")
    vad = spark.createDataFrame([(1, 50, 1000)], "k int, start_ms bigint, end_ms bigint")
    assert [r["caption_index"] for r in captions.orphan_captions(caps, said, vad, KEYS).collect()] == [1]
    both = captions.merged_utterances(said.withColumn("utterance_index", F.lit(0)), captions.orphan_captions(caps, said, vad, KEYS).select("k", "start_ms", "end_ms", "text", F.lit(9).alias("utterance_index")), KEYS)
    assert [(r["utterance_index"], r["start_ms"]) for r in both.orderBy("utterance_index").collect()] == [(0, 100), (1, 5000), (2, 9000)]


def test_doubtful_utterances(spark):
    schema = "k int, uid string, start_ms bigint, end_ms bigint, text string, avg_logprob double, no_speech_prob double, compression_ratio double, temperature double, structural boolean"
    rows = [(1, "good", 0, 1000, "a b", -0.1, 0.0, 1.0, 0.0, False), (1, "silent", 5000, 6000, "a", -0.1, 0.0, 1.0, 0.0, False), (1, "weak", 0, 900, "a", -0.9, 0.6, 1.0, 0.0, False), (1, "one", 0, 900, "a", -0.9, 0.1, 1.0, 0.0, False), (1, "tight", 0, 900, "a", 0.0, 0.1, 3.0, 0.0, None)]
    vad = spark.createDataFrame([(1, 0, 1000)], "k int, start_ms bigint, end_ms bigint")
    got = {r["uid"]: (r["candidate"], r["reasons"]) for r in captions.doubtful_utterances(spark.createDataFrame(rows, schema), vad, KEYS, "uid").collect()}
    assert got == {"good": (False, []), "silent": (True, ["no_overlap"]), "weak": (True, ["low_logprob", "no_speech"]), "one": (False, ["low_logprob"]), "tight": (True, ["compressed"])}


def test_corrections(spark):
    words = spark.createDataFrame([(1, 0, 300, "a"), (1, 350, 600, "b"), (1, 2000, 2300, "c")], "k int, start_ms bigint, end_ms bigint, text string")
    caps = spark.createDataFrame([(1, 0, 500, "a b"), (1, 400, 700, "a b c")], "k int, start_ms bigint, end_ms bigint, text string")
    got = captions.correction_utterances(words, caps, KEYS).orderBy("utterance_index").collect()
    assert [(r["text"], r["caption_text"], r["context_after"]) for r in got] == [("a b", "a b c", "c"), ("c", "", "")]
    utterances = spark.createDataFrame([(u,) for u in "abcde"], "utterance_uid string")
    done = spark.createDataFrame([("a", "text", False, False, "ok"), ("b", "", True, True, "x"), ("c", "", False, True, "dialogue"), ("d", "", False, True, "noise")], "utterance_uid string, corrected string, non_dialogue boolean, audio_reviewed boolean, disposition string")
    holes = spark.createDataFrame([("c",), ("d",)], "utterance_uid string")
    assert {r["utterance_uid"]: r["route"] for r in captions.routed(utterances, done, holes).collect()} == {"a": "align", "b": "non_dialogue", "c": "dialogue", "d": "discard", "e": "pending"}
    said = spark.createDataFrame([("1", "hello there", "Hello there!", "", 900), ("2", "ghost", "", "", 0), ("3", "alpha", "zzz", "y", 10)], "uid string, text string, d1 string, d2 string, overlap int")
    decided = captions.machine_decisions(said, "text", "d1", "d2", "overlap")
    assert {r["uid"]: r["decision"] for r in decided.collect()} == {"1": "accept", "2": "drop", "3": "replace"}
    manual = spark.createDataFrame([("3", "keep")], "uid string, decision string")
    assert captions.with_overrides(decided, manual, "uid").filter("by_hand").first()["decision"] == "keep"


def test_duplicates_and_votes(spark):
    items = spark.createDataFrame([(1, "p", 0, 5000, "one two three"), (1, "c", 1000, 1500, "two three"), (1, "d", 1000, 1500, "threa"), (1, "e", 1000, 1500, "other")], "k int, uid string, start_ms bigint, end_ms bigint, text string")
    got = {r["uid"]: r["parent"] for r in captions.acoustic_duplicates(items, KEYS, "uid").collect()}
    assert got == {"c": "p", "d": "p"}
    frames = spark.createDataFrame([(1, 80 * i + 40, [0.1, 0.95] if 5 <= i <= 11 else [0.6, 0.2]) for i in range(20)], "k int, at_ms bigint, probabilities array<double>")
    utterances = spark.createDataFrame([(1, "u", 400, 960), (1, "v", 0, 400), (1, "w", 9000, 9900)], "k int, uid string, start_ms bigint, end_ms bigint")
    assert {r["uid"]: r["winner"] for r in captions.speaker_votes(frames, utterances, KEYS, "uid").collect()} == {"u": 1, "v": None, "w": None}


def timeline(spark, texts, step=300):
    words = spark.createDataFrame([(1, i * step, i * step + 200, t, "s", "x") for i, t in enumerate(texts)], "k int, start_ms bigint, end_ms bigint, text string, speaker_id string, scene_id string")
    vad = spark.createDataFrame([(1, 0, 0, len(texts) * step)], "k int, vad_region_index int, start_ms bigint, end_ms bigint")
    return semantic.word_timeline(words, vad, KEYS, ["credit"])


def test_windows_own_every_word_once(spark):
    texts = [f"w{i}" + ("." if i % 10 == 9 else "") for i in range(45)]
    got = semantic.semantic_windows(timeline(spark, texts, 400), KEYS, most_words=20).orderBy("sequence_index").collect()
    assert [r["sequence_index"] for r in got] == list(range(45))
    sizes = [len(list(g)) for _, g in itertools.groupby(got, key=lambda r: r["window"])]
    assert sizes == [10, 10, 10, 10, 5] and got[12]["context_before"].split()[-1] == "w9." and got[12]["context_after"].split()[0] == "w20"


def test_exact_cover():
    tokens = "a b c d e a".split()
    assert semantic.exact_cover(tokens, [(0, 1, ["a", "b"]), (0, 2, ["c", "d", "e", "a"]), (0, 3, ["c", "d"]), (1, 4, ["a"])]) == [(0, 1, 1), (2, 5, 2)]
    assert semantic.exact_cover(tokens, [(0, 1, ["a"])]) is None and semantic.exact_cover([], []) is None


def test_exact_results_and_blocks(spark):
    windows = semantic.semantic_windows(timeline(spark, ["Hi", "there.", "Go", "on"]), KEYS)
    candidates = spark.createDataFrame([(1, 0, 0, 7, "hi there"), (1, 0, 1, 8, "go on"), (1, 0, 1, 9, "Go, on")], "k int, window int, priority int, candidate bigint, text string")
    assert sorted(tuple(r)[2:] for r in semantic.exact_results(windows, candidates, KEYS).collect()) == [(0, 1, 7), (2, 3, 8)]
    blocks = spark.createDataFrame([(1, 1000, 2000, 900, 5000, "abc"), (1, 2250, 2300, 900, 5000, "d" * 60)], "k int, first_ms bigint, last_ms bigint, region_start bigint, region_end bigint, text string")
    got = semantic.final_blocks(blocks, KEYS).orderBy("first_ms").collect()
    assert [(r["start_ms"], r["end_ms"], r["flags"]) for r in got] == [(920, 2090, []), (2170, 2520, ["too_fast"])]


def test_words_to_blocks(spark):
    rows, at = [], 0
    for phrase in range(4):
        for i in range(7):
            rows.append((1, at, at + 300, f"word{i}" + ("." if i == 6 else ""), "a" if phrase % 2 else None, 0.9))
            at += 350
        at += 1600
    words = spark.createDataFrame(rows, "k int, start_ms bigint, end_ms bigint, text string, speaker_id string, probability double")
    got = semantic.words_to_blocks(words, KEYS).orderBy("block").collect()
    assert [r["block"] for r in got] == [0, 1, 2, 3] and all(r["n_words"] == 7 and r["text"].endswith("word6.") for r in got)
    assert all(a["display_end"] < b["start_ms"] for a, b in itertools.pairwise(got))


def test_final_qa(spark):
    schema = "k int, uid string, block_index int, start_ms bigint, end_ms bigint, speech_start bigint, speech_end bigint, src string, dst string, review_required boolean"
    rows = [
        (1, "ok", 0, 0, 3000, 0, 2900, "Ali has 12 cows", "Ali punya 12 sapi", False),
        (1, "bad", 1, 2900, 4000, 3100, 4100, "Ali pays $5", "- dia\n- bayar\n6", True),
        (1, "empty", 3, 5000, 5000, 5000, 5000, "x", "", None),
    ]
    found = checks.final_qa(spark.createDataFrame(rows, schema), KEYS, "uid", "src", "dst", names=["Ali"], units=["$"], rules=[("cow", "cow", "sapi")])
    got = {u: sorted(r["code"] for r in found.filter(F.col("uid") == u).collect()) for u in ("ok", "bad", "empty")}
    assert got["ok"] == []
    assert got["bad"] == sorted(["more_than_two_lines", "special_name_mismatch", "numeric_anchor_mismatch", "money_value_mismatch", "mixed_speaker_block", "translator_review_required", "subtitle_overlap", "early_start", "early_end"])
    assert got["empty"] == ["block_index_mismatch", "empty_text", "invalid_timing"]
    report = checks.qa_report(found, ["early_end", "high_cps"]).first()
    assert (report["early_end"], report["high_cps"], report["passed"]) == (1, 0, False)


def test_displaced_texts(spark):
    sources = [f"sentence number {w} about {v}" for w, v in zip(["apple", "boat", "cloud", "drum", "eagle", "forest", "garden"], ["ships", "trees", "music", "birds", "water", "stone", "wheat"], strict=True)]
    back = [*sources[:3], sources[4], sources[5], sources[6], sources[3]]
    blocks = spark.createDataFrame([(1, i, s, b) for i, (s, b) in enumerate(zip(sources, back, strict=True))], "k int, i int, s string, b string")
    got = {r["i"]: (r["offset"], r["reason"]) for r in checks.displaced_texts(blocks, KEYS, "i", "s", "b").collect()}
    assert got == {3: (1, "exact_neighbour"), 4: (1, "exact_neighbour"), 5: (1, "exact_neighbour"), 6: (-3, "exact_neighbour")}
    anchored = spark.createDataFrame([(1, 0, "Ali 5", "Ali 5"), (1, 1, "Bob 7", "Cem 9"), (1, 2, "Cem 9", "x")], "k int, i int, s string, t string")
    assert [tuple(r) for r in checks.anchor_displacements(anchored, KEYS, "i", "s", "t", ["Ali", "Bob", "Cem"]).collect()] == [(1, 1, 2)]
