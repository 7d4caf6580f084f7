"""Vector codes, decontamination and the filter audit against brute force."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from spanframe.llm import audit, codes, leaks
from tests.llm.fixtures import documents, empty, rows

# --- vector codes


def brute_codes(data, parts=16, entries=64, rounds=2):
    """data: (vec_id, vector, label), ids not null."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in data if v and all(x is not None and math.isfinite(x) for x in v)]
    each = len(kept[0][1]) // parts
    cut = [[q[p * each : (p + 1) * each] for p in range(parts)] for _, q, _ in kept]
    start = {}
    for (i, q, _), c in sorted(zip(kept, cut, strict=True), key=lambda x: (x[0][0], x[0][1])):
        start.setdefault(i, c)
    books = [[start[i][p] for i in sorted(start)[:entries]] for p in range(parts)]

    def assign(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cut:
                held.setdefault(assign(c[p], books[p])[0], []).append(c[p])
            books[p] = [[sum(x) // len(held[e]) for x in zip(*held[e], strict=True)] if e in held else b for e, b in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[assign(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(e for _, e in f) for f in found]
    by_label = {}
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    return sorted((i, "".join(f"{c:02x}" for c, _ in f), e, by_label[lab], sha) for (i, _, lab), f, e in zip(kept, found, errors, strict=True))


VECTORS = "vec_id bigint, embedding array<float>, label int, code string, part int, n bigint"


def vectors(n=300, width=32, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, width)).astype(np.float32) * 0.2
    base[50:150] = base[7]  # a third are copies
    base[160:170, :4] = base[7, :4]
    data = [(int(k), [float(x) for x in v], [None, 0, 1, 1, 1][k % 5]) for k, v in enumerate(base)]
    data[3] = (3, None, 1)
    data[5] = (5, [float("nan")] + data[5][1][1:], 1)
    data[8] = (8, data[8][1][:-1] + [float("-inf")], 0)
    data[9] = (9, data[9][1][:-1] + [None], 0)
    data[11] = (11, [], 0)
    return [*data, data[20]]


@pytest.mark.parametrize("share", [1000, 4])
def test_codes_match_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(codes, "HOT_SHARE", share)
    data = vectors()
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in data], VECTORS).repartition(3)
    got = sorted(map(tuple, codes.digests(*codes.compressed(df)).collect()))
    assert got == brute_codes(data)


def test_codes_with_few_vectors_and_ties(spark):
    data = [(2, [0.5] * 16, 1), (1, [0.25] * 16, 1), (2, [0.125] * 16, None), (7, [0.375] * 16, None)]
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in data], VECTORS)
    assert sorted(map(tuple, codes.digests(*codes.compressed(df)).collect())) == brute_codes(data)


def test_codes_edges(spark):
    assert codes.compressed(spark.createDataFrame([], VECTORS))[0].count() == 0
    odd = spark.createDataFrame([(1, [1.0] * 17, 1, "x", 1, 1)], VECTORS)
    assert codes.compressed(odd)[0].count() == 0  # no multiple of 16
    mixed = [(1, [1.0] * 16, 1), (2, [2.0] * 32, 1), (None, [3.0e38] * 16, None), (3, [-3.0e38] * 16, None)]
    found, books = codes.compressed(spark.createDataFrame([(*r, "x", 1, 1) for r in mixed], VECTORS))
    rows = {r[0]: r for r in found.collect()}
    assert set(rows) == {1, None, 3} and books.shape == (16, 3, 1)  # another width goes; a null id is the last entry
    assert rows[None]["codes"] == [2] * 16 and rows[None]["error"] == 0


def test_sums_beyond_64_bits(spark):
    distinct = spark.createDataFrame([(0, [2**29], 2**40), (0, [2**29 - 2], 2**40)], "pos int, part array<int>, n bigint")
    assert codes.codebooks(distinct, np.zeros((1, 1, 1), np.int64), 1).tolist() == [[[2**29 - 1]]]


# --- decontamination


def plain_words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_leaks(docs, items, window=10):
    patterns = {}
    for item, text in items:
        w = plain_words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            patterns.setdefault(tuple(w[k : k + window]), set()).add("" if item is None else str(item))
    lengths = {len(p) for p in patterns}
    out = []
    for i, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                which = patterns.get(tuple(w[k : k + m]))
                if which:
                    hit.update(range(k, k + m))
                    found |= which
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def leak_case():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(6)] + ["ß", "Été", "漢字"]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(say(rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 40])))) for k in range(60) if k % 7]
    items += [(5, "The quick-brown FOX jumps; over the lazy dog, again & again!"), (None, "w0 unnamed w1"), (77, None), (78, " ... "), (6, items[3][1]), (6, items[3][1])]
    docs = [(r[0], r[1]) for r in rows()]
    for k in range(120):
        words = say(rng.randint(0, 60))
        if k % 3 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = plain_words(items[rng.randrange(len(items))][1])
        docs.append((100 + k, rng.choice([" ", ", ", " - "]).join(words)))
    docs.append((900, "it said: THE QUICK brown fox jumps over the lazy dog again again. so"))
    return docs, items


@pytest.mark.parametrize("block_words, piece_windows", [(500_000, 1000), (60, 7)])
def test_leaks_match_brute_force(spark, block_words, piece_windows, monkeypatch):
    pieces_of = leaks.pieces_of
    monkeypatch.setattr(leaks, "pieces_of", lambda *a: pieces_of(*a, piece_windows=piece_windows))
    docs, items = leak_case()
    found = leaks.contaminated(
        spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, n_words bigint, items string").repartition(3),
        spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, piece string"),
        block_words=block_words,
    )
    assert sorted(map(tuple, leaks.digests(found).collect()), key=str) == brute_leaks(docs, items)


def test_long_items_only(spark):
    """With windows of ten words alone the search skips; every alignment of a passage is found."""
    rng = random.Random(4)
    item = [f"p{k}" for k in range(30)]
    docs = []
    for k in range(60):
        at, n = rng.randint(0, 15), rng.randint(8, 15)
        docs.append((k, " ".join([rng.choice(["q", "p3", "p4 p5"]) for _ in range(k % 13)] + item[at : at + n] + ["z"] * (k % 5))))
    items = [(1, " ".join(item)), (2, " ".join(item[5:20]))]
    found = leaks.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, leaks.digests(found).collect()), key=str) == brute_leaks(docs, items)
    searcher = leaks.Searcher([(0, " ".join(item).encode())])
    assert searcher.hits([b"x"] * 1000)[0] == [] and searcher.by_length[10].shift.get((b"x", b"x"), 9) == 9


def test_leaks_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert leaks.contaminated(empty(spark), items).count() == 0
    none = leaks.contaminated(documents(spark), items.limit(0))
    assert none.count() == len(rows()) and none.filter("size(runs) > 0").count() == 0
    kept = leaks.decontaminated(documents(spark), items)
    assert kept.columns == documents(spark).columns and kept.count() == len(rows())
    assert leaks.decontaminated(documents(spark), spark.createDataFrame([(1, "TWO words")], "item_id bigint, text string")).count() == len(rows()) - 1


# --- filter audit


def brute_audit(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    masks = {}
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(w) < 100:
            fails.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t):
            fails.add("C")
        if set(t) & set("#$%&*|"):
            fails.add("D")
        if i is not None and i > least[t]:
            fails.add("E")
        masks.setdefault(lang or "", []).append((fails, i in good, i in toxic))
    out = []
    for part, of in masks.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        table = []
        for order in itertools.permutations("ABCDE"):
            left = list(of)
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                redundant = sum(f in x[0] for x in of) - len(gone)
                removed_by[f] += len(gone)
                table.append((part, "".join(order), step, len(left), len(gone), redundant, sum(x[0] == {f} for x in of), sum(x[1] for x in gone), sum(x[2] for x in gone)))
        out += [(*r, removed_by[r[1][r[2] - 1]]) for r in table]
    return sorted(out)


def test_audit_matches_brute_force(spark):
    rng = random.Random(2)
    docs = [(r[0], r[1], r[2]) for r in rows()]
    texts = ["", "a b c", "A B C d", "x # y", " ".join(f"w{k}" for k in range(120)), " ".join(f"w{k % 50}" for k in range(120)), None, "CAPS " * 130, " ".join(f"v{k}" for k in range(100)) + " |"]
    docs += [(50 + k, rng.choice(texts), rng.choice(["en", "de", None, ""])) for k in range(200)]
    docs += [docs[40], (docs[41][0], "another text under the same id", "fr"), (None, texts[4], "fr")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 240, 2)] + [(60, 1, 0), (60, 0, 1), (None, 1, 1)]
    got = audit.audited(
        spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, lang string, mask int, part int").repartition(3),
        spark.createDataFrame([(*x, "y") for x in labels], "doc_id bigint, quality int, toxic int, lang string"),
    )
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)


def test_audit_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.audited(empty(spark), none).count() == 0
    assert audit.audited(documents(spark), none).count() == 600 * len({r[2] or "" for r in rows()})
