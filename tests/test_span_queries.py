"""Merged spans, chains over blocks, stabilised selections and exact covers against plain versions."""

import itertools
import random
import re
from collections import defaultdict
from difflib import SequenceMatcher

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spanframe.operators import batching, conflicts, ordering, select, sequences, spans
from spanframe.plans import queries, semantic, suspicion
from tests.test_composites import brute_selection
from tests.test_plain_versions import clean, collected, events, turns  # noqa: F401

HOUR, DAY = 3_600_000, 86_400_000


def by_user(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["user_id"]].append(r)
    return out


# --- budgeted merge


def plain_merge(rows, limit, trusted, longest=None):
    """rows: (start, end, cap, lock, set) in order. The definition, step by step: the smallest gap that may close, the first of equal ones."""
    longest = max((r[1] - r[0] for r in rows), default=0) if longest is None else longest
    out = [[s, e, longest if c is None else min(c, longest), lock, set(x), [k + 1]] for k, (s, e, c, lock, x) in enumerate(rows)]
    while len(out) > limit:
        options = []
        for k, (a, b) in enumerate(itertools.pairwise(out)):
            locks = a[3] is None and b[3] is None or a[3] is not None and a[3] == b[3] and a[1] == b[0]
            if locks and b[1] - a[0] <= min(a[2], b[2]) and not any(a[1] < e and s < b[0] for s, e in trusted):
                options.append((b[0] - a[1], k))
        if not options:
            break
        k = min(options)[1]
        a, b = out[k : k + 2]
        out[k : k + 2] = [[a[0], b[1], min(a[2], b[2]), a[3], a[4] | b[4], a[5] + b[5]]]
    return [(s, e, len(m), m, sorted(x), len(out) > limit) for s, e, _, _, x, m in out]


def test_budgeted_merge_events(spark, sf_dir, events):  # noqa: F811
    got = defaultdict(list)
    for r in collected(spark, sf_dir, "budgeted_merge_events"):
        got[r["user_id"]].append((r["start_ms"], r["end_ms"], r["n_spans"], [int(x) for x in r["members"].split(",")], r["types"].split(","), r["over"]))
    rows, signups = by_user(r for r in events if r["event_type"] in ("view", "click")), by_user(r for r in events if r["event_type"] == "signup")
    assert any(len(x) > 5 for x in rows.values())
    for user, own in rows.items():
        own.sort(key=lambda r: (r["start"], r["end"]))
        want = plain_merge([(r["start"], r["end"], None, None, [r["event_type"]]) for r in own], 5, [(r["start"], r["end"]) for r in signups[user]], 10 * DAY)
        assert sorted(got[user]) == sorted(want)


def test_budgeted_merge_caps_locks_and_hot_keys(spark):
    rng = random.Random(6)
    data, trusted, want = [], [], []
    for key in ("hot", "b", None, "c"):
        n = 400 if key == "hot" else 12
        at, rows, bars = 0, [], []
        for k in range(n):
            at += rng.choice([0, 0, 3, 5, 5, 20, 60])
            rows.append((at, at + rng.randint(1, 30), rng.choice([None, None, 40, 90]), rng.choice([None, None, None, "l", "m"]), rng.sample("abc", 2)))
            at = rows[-1][1]
            if rng.random() < 0.1:
                bars.append((at - rng.randint(0, 3), at + rng.randint(1, 4)))
        rows.sort(key=lambda r: r[:2])
        data += [(key, *r) for r in rows]
        trusted += [(key, *b) for b in bars]
        if key is not None:  # trusted intervals are joined by key, and so a null key has none
            want += [(key, *r) for r in plain_merge(rows, 4, bars, 100)]
    df = spark.createDataFrame(data, "k string, start_ms bigint, end_ms bigint, cap int, lock string, tags array<string>").repartition(3)
    bars = spark.createDataFrame(trusted, "k string, start_ms bigint, end_ms bigint")
    got = [tuple(r) for r in spans.budgeted_merge(df, ["k"], 4, bars, longest=100, cap="cap", lock="lock", sets=["tags"]).select("k", "start_ms", "end_ms", "n_spans", "members", "tags", "over").collect()]
    assert sorted(g for g in got if g[0] is not None) == sorted(want)
    assert spans.budgeted_merge(df.limit(0), ["k"], 4).count() == 0


# --- capped merge, chains


def plain_capped(rows, gap, longest):
    out = []
    for s, e in rows:
        if out and s - out[-1][1] <= gap and max(e, out[-1][1]) - out[-1][0] <= longest:
            out[-1][1] = max(e, out[-1][1])
            out[-1][2] += 1
        else:
            out.append([s, e, 1])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("block", [None, 60, 200])
def test_capped_merge_of_a_hot_key(spark, block):
    rng = random.Random(8)
    rows = sorted((s := rng.randint(0, 9000), s + rng.randint(1, 80)) for _ in range(900))
    df = spark.createDataFrame([("k", *r) for r in rows] + [("k", None, 4)], "k string, start_ms bigint, end_ms bigint").repartition(3)
    got = spans.capped_merge(df, ["k"], gap=2, longest=60, block=block).orderBy("span").collect()
    assert [(r["start_ms"], r["end_ms"], r["n_spans"]) for r in got] == plain_capped(rows, 2, 60)
    assert [r["span"] for r in got] == list(range(1, len(got) + 1))
    assert spans.capped_merge(df.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("block_rows", [5, 64, 50_000])
def test_byte_batches_of_one_key(spark, block_rows):
    rng = random.Random(3)
    sizes = [rng.choice([1, 2, 5, 9, 30, None]) for _ in range(700)]
    df = spark.createDataFrame([("k", i, s) for i, s in enumerate(sizes)], "k string, i bigint, size int").repartition(3)
    got = [r["batch"] for r in batching.byte_batches(df, ["k"], "i", "size", 5, 20, block_rows).orderBy("i").collect()]
    want, n, held, batch = [], 0, 0, -1
    for s in (x or 0 for x in sizes):
        if batch < 0 or n >= 5 or held + s > 20:
            batch, n, held = batch + 1, 0, 0
        n, held = n + 1, held + s
        want.append(batch)
    assert got == want
    if block_rows == 64:
        blocks = batching.byte_batches(df, ["k"], "i", "size", 5, 20, block_rows).select(F.floor(F.col("i") / 64).alias("b")).distinct().count()
        assert blocks == 11  # tasks of their own, one key


def test_running_sums_have_no_single_partition(spark):
    df = spark.createDataFrame([(k % 2, k, 1) for k in range(1000)], "k int, at int, n int")
    found = ordering.numbered(df, ["k"], ["at"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert found.filter("position <> floor(at / 2)").count() == 0
    ranges = ordering.ranged(df, ["k"], ["at"])
    assert ranges.filter("k = 0").select("__range").distinct().count() > 1  # a key is several tasks


@pytest.mark.parametrize("task_rows", [3, 10_000])
def test_budgeted_in_rounds(spark, task_rows):
    rng = random.Random(12)
    rows = [(key, rng.randint(0, 10**9), rng.choice([0, 1, 3, 50, 200, 700, 1200, None, rng.randint(1, 1000)])) for key in ("a", "b", None) for _ in range(250)]
    for most, budget in ((1000, 5000), (9, 1000), (4, 3)):
        df = spark.createDataFrame(rows, "k string, score bigint, cost int").repartition(3)
        got = {(r["k"], r["score"]) for r in select.budgeted(df, ["k"], [("score", False)], "cost", most, budget, task_rows).filter("chosen").collect()}
        want = set()
        for key in ("a", "b", None):
            left, n = budget, 0
            for _, score, cost in sorted((r for r in rows if r[0] == key), key=lambda r: -r[1]):
                if cost is not None and cost <= left and n < most:
                    left, n = left - cost, n + 1
                    want.add((key, score))
        assert got == want


@pytest.mark.parametrize("block_rows", [24, 100])
def test_optimal_groups_of_a_long_key(spark, block_rows):
    """A key cut in blocks gives the groups of one dynamic program over all its rows."""
    rng = random.Random(block_rows)
    rows = []
    for key, n in (("long", 700), (None, 130), ("short", 20)):
        at = 0
        for _ in range(n):
            at += rng.choice([10, 200, 400, 900, 3000])
            word = "".join(rng.choice("abcdefg") for _ in range(rng.choice([1, 4, 7, 30, 90]))) + rng.choice(["", "", ".", ","])
            rows.append((key, at, at + 200, word))
            at += 200
    df = spark.createDataFrame(rows, "k string, s bigint, e bigint, t string").repartition(3)
    cut = lambda b: {(r["k"], r["s"]): r["part"] for r in sequences.optimal_groups(df, ["k"], ["s"], "s", "e", "t", block_rows=b, most_rows=12).collect()}
    assert cut(block_rows) == cut(10_000)


# --- suspicious spans


def test_suspicious_spans_conversations(spark, sf_dir, turns):  # noqa: F811
    segments, captions = defaultdict(list), defaultdict(list)
    for r in turns:
        text, t = r["text"] or "", r["turn"]
        words = [w for w in re.split(r"\s+", text) if w]
        at = t * 8000
        segments[r["conv_id"]].append((at, at + max(1, len(words)) * 300, t, text, [(at + i * 300 + (40 if len(w) > 9 else 0), at + i * 300 + 280, 1 / (1 + len(w) / 4)) for i, w in enumerate(words)], -0.1 * (t % 12), t % 10 / 10))
        captions[r["conv_id"]].append((at + 100, at + 900, r["role"] if t % 5 == 4 else text.upper()))
    want = {}
    for conv, own in segments.items():
        marked = []
        for start, end, t, text, words, logprob, no_speech in sorted(own, key=lambda x: x[:3]):
            heard = []
            for s, e, c in sorted(captions[conv]):
                if s < end and start < e and c.strip():
                    if heard and c in heard[-1]:
                        continue
                    if heard and c.startswith(heard[-1]):
                        heard[-1] = c
                    else:
                        heard.append(c)
            caption = " ".join(heard)
            tokens = re.findall(r"[^\W_]+", text.lower())
            solid = re.sub(r"\s+", "", text)
            least = min((p for _, _, p in words), default=None)
            reasons = {
                "low_word_confidence": least is not None and least < 0.55,
                "very_low_word_confidence": least is not None and least < 0.55 - 0.25,
                "low_segment_logprob": logprob < -0.8,
                "high_no_speech": bool(text.strip()) and no_speech > 0.6,
                "large_internal_gap": any(b[0] - a[1] > 1500 for a, b in itertools.pairwise(words)),
                "strange_text": not solid or sum(c.isalpha() for c in solid) < 0.45 * len(solid) or any(len(set(tokens[k : k + 4])) == 1 for k in range(len(tokens) - 3)),
                "possible_speaker_change": bool(re.search(r"(?:^|\n)\s*[-–—]\s*\S", text) or re.search(r"\s[-–—]\s", text)),
                "sensitive_term": " ra " in f" {' '.join(tokens)} ",
                "music": bool(re.search(r"(?i)\[music", text)),
                "caption_conflict": bool(text.strip()) and bool(caption) and SequenceMatcher(None, clean(text), clean(caption), autojunk=False).ratio() < 0.55,
            }
            found = sorted(n for n, hit in reasons.items() if hit)
            if found:
                marked.append([start, end, 1, set(found), [t], max(suspicion.WEIGHTS[n] for n in found), [text.strip()], [caption]])
        merged = []
        for m in marked:
            if merged and m[0] - merged[-1][1] <= 400 and max(m[1], merged[-1][1]) - merged[-1][0] <= 20_000:
                o = merged[-1]
                merged[-1] = [o[0], max(o[1], m[1]), o[2] + 1, o[3] | m[3], o[4] + m[4], max(o[5], m[5]), o[6] + m[6], o[7] + m[7]]
            else:
                merged.append(m)
        for k, (s, e, n, reasons, ids, priority, texts, heard) in enumerate(merged, 1):
            want[conv, k] = (s, e, n, ",".join(sorted(reasons)), ",".join(map(str, sorted(ids))), priority, " ".join(x for x in texts if x), " ".join(x for x in heard if x))
    got = {(r["conv_id"], r["span"]): (r["start_ms"], r["end_ms"], r["n_spans"], r["reasons"], r["segment_ids"], r["priority"], r["primary_text"], r["caption_text"]) for r in collected(spark, sf_dir, "suspicious_spans_conversations")}
    assert got == want
    assert any(v[2] > 1 for v in want.values()) and any("caption_conflict" in v[3] for v in want.values())


# --- evidence


def test_merged_evidence_events(spark, sf_dir, events):  # noqa: F811
    got = {(r["event_id"], r["source"]) for r in collected(spark, sf_dir, "merged_evidence_events")}
    want, refused_by_extra = set(), 0
    for own in by_user(events).values():
        rows = [(r["start"], r["end"] + 2 * HOUR, int(r["value"] // 25), r["event_id"], r["event_type"]) for r in own]
        front = [r for r in rows if r[4] == "view" and r[3] % 11]
        want |= {(r[3], "primary") for r in rows if r[4] == "view"}
        views = len(front)
        for b in sorted((r for r in rows if r[4] != "view"), key=lambda r: (r[0], r[1], r[3])):
            same = [k for k, a in enumerate(front) if a[2] == b[2] and min(a[1], b[1]) > max(a[0], b[0]) and min(a[1], b[1]) - max(a[0], b[0]) >= max(1, min(a[1] - a[0], b[1] - b[0]) // 2)]
            if not same:
                front.append(b)
                want.add((b[3], "extra"))
            elif same[0] >= views:
                refused_by_extra += 1
    assert got == want and len(want) < len(events) and refused_by_extra


def test_first_come_follows_chains(spark):
    rng = random.Random(2)
    edges = {(a, b) for _ in range(90) for a, b in [sorted(rng.sample(range(40), 2))]} | {(k, k + 1) for k in range(50, 70)}
    stay = []
    for n in range(80):
        if not any(a in stay for a, b in edges if b == n):
            stay.append(n)
    nodes = spark.range(80).withColumnRenamed("id", "node")
    got = [r[0] for r in spans.first_come(nodes, spark.createDataFrame(sorted(edges), "earlier bigint, later bigint")).collect()]
    assert sorted(got) == stay


# --- stabilised selections


def plain_round(members, bounds, options, scores, now, radius, most_gap):
    def signature(chosen):
        return {(a, b) for a, b in itertools.combinations(members, 2) if conflicts.conflict(options[a][chosen[a]], options[b][chosen[b]])}

    seeds = []
    for a, b in sorted(signature(now)):
        touching = [s for s in seeds if a in s or b in s]
        seeds = [s for s in seeds if s not in touching] + [set().union({a, b}, *touching)]
    for seed in sorted(seeds, key=lambda s: min(members.index(u) for u in s)):
        before = signature(now)
        if not any(a in seed or b in seed for a, b in before):
            continue
        places = [members.index(u) for u in seed]
        first, last = min(places), max(places)
        for _ in range(radius):
            if first > 0 and bounds[members[first]][0] - bounds[members[first - 1]][1] <= most_gap:
                first -= 1
            else:
                break
        for _ in range(radius):
            if last + 1 < len(members) and bounds[members[last + 1]][0] - bounds[members[last]][1] <= most_gap:
                last += 1
            else:
                break
        inside = members[first : last + 1]
        fits = {u: [i for i, o in enumerate(options[u]) if not any(conflicts.conflict(o, options[v][now[v]]) for v in members if v not in inside)] for u in inside}
        if not all(fits.values()):
            continue
        # exhaustive where that is short, else the search that test_composites holds against it
        search = brute_selection if 4 ** len(inside) < 5000 else conflicts.best_selection
        found = search({u: [options[u][i] for i in k] for u, k in fits.items()}, {u: [scores[u][i] for i in k] for u, k in fits.items()})
        if found:
            trial = now | {u: fits[u][k] for u, k in found.items()}
            if signature(trial) < before:
                now = trial
    return now


def test_stabilized_options_events(spark, sf_dir, events):  # noqa: F811
    want = {}
    for own in by_user(events).values():
        own.sort(key=lambda r: (r["start"], r["event_id"]))
        names = [f"{k:04d}" for k in range(len(own))]
        bounds = {n: (r["start"], r["end"] + DAY) for n, r in zip(names, own, strict=True)}
        options = {n: [[(bounds[n][0] + s * HOUR, bounds[n][1] + s * HOUR, r["event_type"])] for s in (0, 25, 50, -25)] for n, r in zip(names, own, strict=True)}
        scores = {n: [(int(s == 0), -abs(s)) for s in (0, 25, 50, -25)] for n in names}
        now, rounds = dict.fromkeys(names, 0), dict.fromkeys(names, 0)
        for k in range(1, 5):
            after = plain_round(names, bounds, options, scores, now, 1, HOUR)
            if after == now:
                break
            rounds |= {n: k for n in names if after[n] != now[n]}
            now = after
        want |= {r["event_id"]: (now[n], rounds[n]) for n, r in zip(names, own, strict=True)}
    got = {r["event_id"]: (r["selected"], r["round"]) for r in collected(spark, sf_dir, "stabilized_options_events")}
    assert got == want
    assert {1, 2} <= {r for _, r in want.values()}


KIND = "k int, uid string, position int, start_ms bigint, end_ms bigint, options array<struct<words:array<struct<start_ms:bigint,end_ms:bigint,speaker_id:string>>,score:array<int>>>, selected int"


def test_a_second_round_changes_rows(spark):
    """Random crowded timelines: sections, rounds and radius give what the plain rounds give, and some rows move in later rounds only."""
    rng = random.Random(5)
    rows, want, later = [], {}, 0
    for key in range(12):
        names = [f"u{k:02d}" for k in range(14)]
        bounds, options, at = {}, {}, 0
        for n in names:
            at += rng.choice([4, 6, 8, 30])
            bounds[n] = at, at + 8
            options[n] = [[(at + s, at + s + 8, "a")] for s in (0, *rng.sample([8, 16, 24, 32, 40], 3))]
        scores = {n: [(int(i == 0),) for i in range(4)] for n in names}
        now, rounds = dict.fromkeys(names, 0), dict.fromkeys(names, 0)
        for k in range(1, 5):
            after = plain_round(names, bounds, options, scores, now, 1, 20)
            rounds |= {n: k for n in names if after[n] != now[n]}
            if after == now:
                break
            now = after
        later += sum(r > 1 for r in rounds.values())
        want |= {(key, n): (now[n], rounds[n]) for n in names}
        rows += [(key, n, k, *bounds[n], [([dict(zip(("start_ms", "end_ms", "speaker_id"), w, strict=True)) for w in o], list(s)) for o, s in zip(options[n], scores[n], strict=True)], 0) for k, n in enumerate(names)]
    df = spark.createDataFrame(rows, KIND)
    got = {(r["k"], r["uid"]): (r["selected"], r["round"]) for r in conflicts.stabilized(df, ["k"], "uid", "position", "start_ms", "end_ms", "options", "selected", radius=1, most_gap=20).collect()}
    assert got == want and later
    assert conflicts.stabilized(df.limit(0), ["k"], "uid", "position", "start_ms", "end_ms", "options", "selected").count() == 0


# --- exact covers


def plain_cover(tokens, gaps_bad, candidates):
    spans_ = {}
    for rank, name, needle in candidates:
        n = len(needle)
        places = [i for i in range(len(tokens) - n + 1) if tokens[i : i + n] == needle] if n else []
        if len(places) == 1 and not any(gaps_bad[places[0] + 1 : places[0] + n]):
            at = places[0], places[0] + n - 1
            spans_[at] = min(spans_.get(at, (rank, name)), (rank, name))
    best = {0: []}
    for at in range(len(tokens)):
        for first, last in sorted((s for s in spans_ if s[0] == at and at in best), key=lambda s: -s[1]):
            path = [*best[at], (first, last, spans_[first, last][1])]
            if last + 1 not in best or len(path) < len(best[last + 1]):
                best[last + 1] = path
    return best.get(len(tokens)) if tokens else None


def test_exact_covers_conversations(spark, sf_dir, turns):  # noqa: F811
    want, tried = set(), 0
    for r in turns:
        words = [w for w in re.split(r"\s+", r["text"] or "") if w]
        tokens = [clean(w) for w in words]
        sentences = re.split(r"(?<=[.!?])\s+", r["text"] or "")
        found = {}
        for rank, texts in ((0, sentences), (1, [" ".join(words[i : i + 5]) for i in range(0, max(1, len(words)), 5)])):
            for k, t in enumerate(texts):
                key = tuple(clean(t).split(" "))
                found[key] = min(found.get(key, (rank, k)), (rank, k))
        bad = [False] + [b * 300 - (a * 300 + 280 - (250 if len(words[a]) > 12 else 0)) > 200 for a, b in itertools.pairwise(range(len(words)))]
        path = plain_cover(tokens, bad, [(*v, list(k)) for k, v in found.items()])
        tried += bool(words)
        want |= {(r["conv_id"], r["turn"], *p) for p in path or []}
    got = {(r["conv_id"], r["window"], r["first"], r["last"], r["candidate"]) for r in collected(spark, sf_dir, "exact_covers_conversations")}
    assert got == want and 0 < len({x[:2] for x in want}) < tried


def test_exact_cover_against_all_paths():
    rng = random.Random(7)
    for _ in range(300):
        tokens = [rng.choice("abcde") for _ in range(rng.randint(0, 9))]
        candidates = [(rng.randint(0, 2), k, [rng.choice("abcde") for _ in range(rng.randint(0, 3))] if rng.random() < 0.4 or not tokens else tokens[(i := rng.randrange(len(tokens))) : i + rng.randint(1, 4)]) for k in range(12)]
        assert semantic.exact_cover(tokens, candidates) == plain_cover(tokens, [False] * (len(tokens) + 1), candidates)


def test_safe_from():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randint(1, 9)
        gaps, speakers, scenes = [None] + [rng.choice([0, 5, 50]) for _ in range(n - 1)], [rng.choice("ab ") for _ in range(n)], [rng.choice("x  ") for _ in range(n)]
        speakers, scenes = ([None if x == " " else x for x in s] for s in (speakers, scenes))
        low = semantic.safe_from(gaps, speakers, scenes, 10)
        for first, last in itertools.combinations_with_replacement(range(n), 2):
            part = slice(first, last + 1)
            ok = all(g <= 10 for g in gaps[first + 1 : last + 1]) and all(len({x for x in s[part] if x}) <= 1 for s in (speakers, scenes))
            assert ok == (first >= low[last])


def test_span_queries_are_registered():
    assert {"budgeted_merge_events", "capped_merge_events"} <= set(queries.QUERIES)
