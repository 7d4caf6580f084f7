import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spanframe.llm import lines, simhash, substrings, vectors
from spanframe.llm.components import connected_components, forest
from tests.llm.fixtures import documents, empty, rows


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute_repeats(texts, window):
    seen = Counter(tuple(w[k : k + window]) for w in map(split, texts) for k in range(len(w) - window + 1))
    out = []
    for t in texts:
        w = split(t)
        gone = {i for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1 for i in range(k, k + window)}
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [35, 13])
def test_substrings_match_brute_force(spark, window):
    data = rows()
    want = Counter((r[0], *x) for r, x in zip(data, brute_repeats([r[1] for r in data], window), strict=True))
    got = Counter(map(tuple, substrings.without_repeats(documents(spark), window).collect()))
    assert got == want


def test_substrings_on_shuffled_sentences(spark):
    import random

    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(12)]
    pieces = [[rng.choice(vocabulary) for _ in range(rng.randint(10, 60))] for _ in range(25)]
    texts = [" ".join(w for _ in range(rng.randint(1, 6)) for w in rng.choice(pieces)) for _ in range(80)]
    got = {r[0]: tuple(r[1:]) for r in substrings.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 20).collect()}
    assert [got[k] for k in range(len(texts))] == brute_repeats(texts, 20)


def test_substrings_keep_text_and_empty_table(spark):
    found = substrings.without_repeats(documents(spark), keep_text=True).filter("doc_id = 10").first()
    assert found["n_removed"] == 60 and len(found["kept"].split()) == 20
    assert substrings.without_repeats(empty(spark)).count() == 0


def test_words_that_a_polynomial_hash_confuses(spark):
    """Texts equal but for two words of the Thue-Morse pattern, one the complement of the other, share no window."""
    pattern = "".join("ab"[k.bit_count() & 1] for k in range(4096))
    other = pattern.translate(str.maketrans("ab", "ba"))
    rest = [f"w{k}" for k in range(34)]
    texts = [" ".join([*rest[:17], x, *rest[17:]]) for x in (pattern, other)]
    texts += [" ".join([*rest, *rest, *(f"v{k}" for k in range(9))]), None, "na " * 500 + "b " * 40, "x y z " * 200]
    got = {r[0]: tuple(r[1:]) for r in substrings.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [got[k] for k in range(len(texts))] == brute_repeats(texts, 35) and got[0][1] == got[1][1] == 0


def test_a_repetitive_text_is_a_few_rows():
    text, start, count, times, low, digest = substrings.paths(["na " * 5000, "x y z " * 3000, None, "short"], 35, 12)
    assert len(text) < 20 and sum(count) == 5000 - 34 + 9000 - 34 and set(text.tolist()) == {0, 1}


def brute_fingerprint(text, size):
    w = split(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + size]).encode(), 42) for i in range(max(1, len(w) - size + 1))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_matches_brute_force(spark):
    data = [r for r in rows() if r[0] is not None]
    want = [brute_fingerprint(r[1], 4) for r in data]
    parent = {r[0]: r[0] for r in data}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in zip(data, want, strict=True):
        for b, y in zip(data, want, strict=True):
            if (x ^ y).bit_count() <= 4:
                p, q = sorted((find(a[0]), find(b[0])))
                parent[q] = p
    got = Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(documents(spark)).collect() if r["doc_id"] is not None)
    assert got == Counter((r[0], x, find(r[0])) for r, x in zip(data, want, strict=True))
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_walks_find_every_link(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    v = base[rng.integers(0, 150, 1500)]
    for _ in range(5):
        on = rng.random(len(v)) < 0.6
        v[on] ^= np.uint64(1) << rng.integers(0, 64, on.sum(), dtype=np.uint64)
    v = np.unique(v)
    x = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    i, j = np.nonzero(np.triu(x, 1))
    turned = (v << np.uint64(32)) | (v >> np.uint64(32))
    order = np.argsort(turned)
    a1, b1 = simhash.trie_pairs(v, None, 4, 2, 4, 0)
    a2, b2 = simhash.trie_pairs(turned[order], None, 4, 1, 4, 3)

    def labels(a, b):
        out = np.arange(len(v))
        node, root = forest(np.asarray(a), np.asarray(b), len(v))
        out[node] = root
        return out

    assert np.array_equal(labels(i, j), labels(np.concatenate((a1, order[a2])), np.concatenate((b1, order[b2]))))
    half = len(v) // 2
    a, b = simhash.trie_pairs(v[::2], v[1::2], 4, 4, 4, 0)
    assert len(a) < len(v) and half


@pytest.mark.parametrize("levels,near", [(4, (2, 1)), (7, (2, 1)), (9, (1, 0))])
def test_node_pairs_match_all_pairs(spark, levels, near):
    rng = np.random.default_rng(levels)
    nodes = {(w, int(p)) for w in (0, 1) for p in rng.integers(0, 1 << levels, 60)}
    got = list(map(tuple, simhash.node_pairs(spark.createDataFrame(sorted(nodes), "walk int, p int"), levels, near).collect()))
    assert len(got) == len(set(got)) and set(got) == {(w, p, q) for w, p in nodes for x, q in nodes if w == x and p <= q and (p ^ q).bit_count() <= near[w]}


def test_simhash_blocks_of_crowded_nodes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = np.unique(np.uint64(0xABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)))
    reps = spark.createDataFrame([(int(x.view(np.int64)), k) for k, x in enumerate(v)], "fp bigint, rep bigint")
    monkeypatch.setattr(simhash, "NODE_ROWS", 40)
    monkeypatch.setattr(simhash, "BROADCAST_PAIRS", 0)
    found = connected_components(simhash.similar_fingerprints(reps))
    x = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    np.fill_diagonal(x, False)
    assert found.count() == int(x.any(axis=1).sum()) and found.select("component").distinct().count() == 1


def test_one_of_each_keeps_the_least_id(spark):
    kept = simhash.one_of_each(documents(spark), shingle=5)
    assert kept.columns == documents(spark).columns
    ids = sorted(r[0] for r in kept.filter("doc_id IS NOT NULL").select("doc_id").collect())
    assert len(ids) == len(set(ids)) and 0 in ids and 1 not in ids and 5 in ids and 6 not in ids and 7 not in ids
    assert kept.filter("doc_id IS NULL").count() == 1


def test_one_of_each_reaches_a_similarity_of_0_8(spark):
    import random

    rng = random.Random(11)
    data, want = [], {}
    for k in range(120):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        near = list(base)
        for at in rng.sample(range(200), 2 + k % 8):
            near[at] = "changed"
        data += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
        x, y = ({tuple(t[i : i + 5]) for i in range(196)} for t in (base, near))
        want[k] = len(x & y) / len(x | y)
    data += [(1000, "one text of its own under an id"), (1000, "and quite another one under it")]
    kept = Counter(r[0] for r in simhash.one_of_each(spark.createDataFrame(data, "doc_id bigint, text string"), shingle=5).collect())
    assert {k for k, j in want.items() if 2 * k + 1 not in kept} == {k for k, j in want.items() if j >= 0.8}
    assert all(kept[2 * k] == 1 for k in want) and kept[1000] == 2
    assert sum(0.8 <= j < 0.85 for j in want.values()) > 5 and sum(j < 0.8 for j in want.values()) > 5


def test_links_of_a_bucket_in_blocks(spark, monkeypatch):
    import random

    monkeypatch.setattr(simhash, "BUCKET_ROWS", 7)
    monkeypatch.setattr(simhash, "BUCKET_BYTES", 4000)
    rng = random.Random(6)
    base = [[f"w{rng.randrange(5000)}" for _ in range(100 + 20 * k)] for k in range(5)]
    texts = []
    for k in range(44):
        own = list(base[k % 5])
        for at in rng.sample(range(len(own)), k % 7):
            own[at] = f"x{k}"
        texts.append(" ".join(own))
    texts[43] = "Too Short"
    sketch = [simhash.minima(np.array(simhash.shingle_hashes(t.encode().split(), 5), np.uint64)) for t in texts]
    # all share band 0 and band 3, half of them also band 2
    bands = [[7 if b in (0, 3) else 9 if b == 2 and k % 2 else 100 * k + b for b in range(simhash.BANDS)] for k in range(44)]
    members = spark.createDataFrame([(b, bands[k][b], k, k % 9) for k in range(44) for b in (0, 2, 3) if b != 2 or k % 2], "band int, key bigint, node bigint, part bigint")
    nodes = spark.createDataFrame([(k, bands[k], bytearray((m >> np.uint64(40)).astype("<u2").tobytes()), len(texts[k])) for k, m in enumerate(sketch)], "node bigint, bands array<bigint>, marks binary, n_bytes bigint")
    found = set(map(tuple, simhash.bucket_links(members, nodes, spark.createDataFrame(list(enumerate(texts)), "node bigint, text string"), 5, 0.8).collect()))
    want = {(a, b) for a in range(44) for b in range(a + 1, 44) if a % 9 != b % 9 and simhash.jaccard(simhash.shingle_set(texts[a], 5), simhash.shingle_set(texts[b], 5)) >= 0.8}
    assert found and found <= want

    def parts(links):
        label = [(k % 9) for k in range(44)]
        for a, b in links:
            label = [label[a] if x == label[b] else x for x in label]
        return {frozenset(k for k in range(44) if label[k] == x) for x in set(label)}

    assert parts(found) == parts(want)


def test_one_of_each_follows_chains_within_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(simhash, "band_keys", lambda hashes: np.zeros(simhash.BANDS, np.uint64))
    words = [f"w{k}" for k in range(200)]
    texts = [" ".join(words[8 * k : 8 * k + 100]) for k in range(8)] + ["quite another text that is long enough"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted(r[0] for r in simhash.one_of_each(rows, shingle=5).collect()) == [0, 8]


def test_one_of_each_links_by_the_trie(spark, monkeypatch):
    """Without any equal bands, fingerprints that differ in 4 bits at most and confirmed shingles are links; unlike texts of one fingerprint aren't."""
    import random

    monkeypatch.setattr(simhash, "band_keys", lambda least: np.frombuffer(np.random.bytes(8 * simhash.BANDS), np.uint64))
    rng = random.Random(2)
    texts = []
    for k in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        texts += [" ".join(base), " ".join([*base[:150], f"x{k}", *base[151:]])]
    # the shingle that all repeat sets every bit
    texts += [" ".join(["na"] * 3000 + [f"y{k}-{n}" for n in range(700)]) for k in range(2)]
    fps = simhash.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), shingle=5)
    fp = {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in fps.collect()}
    near = {2 * k + 1 for k in range(40) if (fp[2 * k] ^ fp[2 * k + 1]).bit_count() <= 4}
    assert len(near) > 20 and fp[80] == fp[81]
    kept = simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), shingle=5)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - near


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1400)] + [(2000, 2000)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {k: 0 for k in range(61)} | {k: 1000 for k in range(1000, 1400)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_boundaries_know_the_order_of_lines(spark):
    lines_ = [f"line {k}" for k in range(60)]
    pairs = [(f"{a}\n{b}\nend", f"{b}\n{a}\nend") for a, b in zip(lines_[::2], lines_[1::2], strict=True)]
    cut = [r["n"] for r in spark.createDataFrame([(t,) for p in pairs for t in p], "text string").select(F.size(lines.chunks(F.col("text"))).alias("n")).collect()]
    assert any(x != y for x, y in zip(cut[::2], cut[1::2], strict=True))


def test_lines_match_a_plain_version(spark):
    data = [r for r in rows()[:-2]]
    heard = {}

    def cut(text):
        each = (text or "").split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in each]
        starts = [i for i in range(len(each)) if i == 0 or i >= 2 and (h[i - 2] * 1_000_003 + h[i - 1]) % 2_147_483_647 % 3 == 0]
        return [(a, each[a:b]) for a, b in zip(starts, [*starts[1:], len(each)], strict=True)]

    want = {}
    for r in data:
        left, gone = [], 0
        for _, chunk in cut(r[1]):
            full = sum(bool(split(x)) for x in chunk) >= 2
            if full and heard.setdefault("\n".join(chunk), (r[0], _)) != (r[0], _):
                gone += len(chunk)
            else:
                left += chunk
        want[r[0]] = (gone, None if r[1] is None else "\n".join(left))
    frame = spark.createDataFrame(data, documents(spark).schema).repartition(3)
    got = {r["id"]: (r["n_removed_lines"], r["kept"]) for r in lines.deduplicated(frame).select(F.col("row.doc_id").alias("id"), "n_removed_lines", "kept").collect()}
    assert got == want and sum(x[0] for x in want.values()) > 0
    assert lines.with_kept_text(documents(spark)).columns == documents(spark).columns
    assert lines.with_kept_text(empty(spark)).count() == 0


def test_lines_run_no_python(spark):
    plan = lines.with_kept_text(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_links(data, threshold):
    usable = {i: np.array(v, float) for i, (_, v) in enumerate(data) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: {j for j, y in usable.items() if j != i and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold} for i, x in usable.items()}
    label = {i: data[i][0] for i in range(len(data))}
    while True:
        new = {i: min([label[i], *(label[j] for j in links.get(i, ()))]) for i in label}
        if new == label:
            return {(data[i][0], len(links.get(i, ())), label[i], label[i] == data[i][0]) for i in label}
        label = new


@pytest.mark.parametrize("rows_a_cell", [4, 1000])
def test_vectors_match_brute_force(spark, monkeypatch, rows_a_cell):
    monkeypatch.setattr(vectors, "CELL_ROWS", rows_a_cell)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 6))
    data = [(k, (base[k % 12] + rng.normal(scale=0.25, size=6)).tolist()) for k in range(90)]
    data += [(90, None), (91, []), (92, [0.0] * 6), (93, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (94, [float("nan")] * 6), (95, [float("inf")] * 6), (96, data[3][1]), (97, data[3][1]), (98, [2 * x for x in data[4][1]]), (99, [1.0, 2.0]), (100, [1e-300] * 6), (101, [1e300] * 6)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id bigint, embedding array<double>, links int")
    with np.errstate(all="ignore"):
        want = brute_links([(i, v if i not in (100, 101) else [1.0] * 6) for i, v in data], 0.9)
    assert set(map(tuple, vectors.near_vectors(frame).collect())) == want
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_vectors_meet_without_shuffled_copies(spark, monkeypatch):
    """Vectors without structure visit many cells; none of the visits may be a copy that is shuffled."""
    monkeypatch.setattr(vectors, "CELL_ROWS", 50)
    rng = np.random.default_rng(5)
    data = rng.normal(size=(600, 5)).astype(np.float32)
    data[:40] = data[0] + rng.normal(scale=0.02, size=(40, 5))
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "vec_id bigint, embedding array<float>")
    want = brute_links([(k, v.tolist()) for k, v in enumerate(data)], 0.9)
    assert set(map(tuple, vectors.near_vectors(frame).collect())) == want
    groups = vectors.distinct_vectors(frame, "vec_id", "embedding")
    plan = vectors._links(groups, 600, 0.9)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_rows_without_an_id_whose_32_bit_hashes_are_equal(spark):
    """Texts of one 32-bit hash are two documents: only the one that repeats a passage loses it."""
    passage = "\n".join(f"a line that many texts share {k}" for k in range(12))
    made = spark.range(300_000).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit(passage + "\n"), F.concat_ws(" ", F.lit("end"), "id"))).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(14)), lambda k: F.concat_ws(" ", F.lit("own"), "id", k)), "\n")).alias("text"), (F.col("id") % 2).alias("odd"))
    pairs = made.groupBy(F.hash("text").alias("h")).agg(F.collect_set("odd").alias("kinds"), F.collect_list("text").alias("texts")).filter("size(kinds) = 2").collect()
    assert pairs
    texts = [t for r in pairs for t in r["texts"]]
    docs = spark.createDataFrame([(1, passage)] + [(None, t) for t in texts], "doc_id bigint, text string")
    lost = {r["row"]["text"]: r["n_removed_lines"] for r in lines.deduplicated(docs).collect()}
    assert all(n == 0 for t, n in lost.items() if t.startswith("own"))
    assert sum(n == 0 for t, n in lost.items() if not t.startswith("own")) == 1  # the first copy stays
