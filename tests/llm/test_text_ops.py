import hashlib
import random
import re
import tracemalloc
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from spanframe.llm import bpe, classifier, mixing, quality, rans
from tests.llm.fixtures import documents, empty, rows


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_pieces_encode_as_whole_texts(tokenizer):
    rng = random.Random(7)
    alphabet = ["a", "b", " ", "  ", "\n", " \n", "\t", "\x0b", "\x1c", " ", "　", "é", "ß", "漢", "²", "½", "́", "'s", "'", "1", "23", ",", "***", "<|endoftext|>", "_", "\r\n", "🙂", "the", "ɐ"]
    ours, (tik, encoding) = bpe.tokenizers_encoder(public_tokenizers.path("byte_bpe_50k.json")), bpe.tiktoken_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for _ in range(1500):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert ours.texts([t])[0] == array("I", tokenizer.encode(t, add_special_tokens=False).ids).tobytes()
        assert tik.texts([t])[0] == array("I", encoding.encode_ordinary(t)).tobytes()


def test_encoders_hold_bounded_tables(tokenizer):
    """However many unlike words a worker meets, it holds little, and codes them as the library does."""
    ours, rng = bpe.tokenizers_encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(8)
    texts = [" ".join(f"{rng.choice('abcdefghij')}{''.join(rng.choices('aeioulmnrst', k=7))}, known words" for _ in range(25_000)) for _ in range(28)]
    tracemalloc.start()
    for t in texts[:-1]:
        ours.texts([t])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 140e6
    assert ours.texts([texts[-1]])[0] == array("I", tokenizer.encode(texts[-1], add_special_tokens=False).ids).tobytes()


def test_known_pieces_are_not_sent_again(tokenizer):
    """Words with marks are sent as words and marks; once known, no part of a text goes to the library, whatever white space it has."""
    made, sent = bpe.tokenizers_encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    ours = bpe.PieceEncoder(lambda strings: sent.extend(strings) or made.many(strings), made.spaced, 10_000)
    words = [f"{a}{b}zé{c}" for a in "abcdefgh" for b in "aeiou" for c in "klmnop"]
    ours.texts([" ".join(w + mark for w in words for mark in ("", ",", "***", "'s"))])
    assert sum(map(len, sent)) < 2 * sum(map(len, words))
    text = "Known  words.\n And\tsome \n\n " + " ".join(words) + " \n"
    want = array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    assert ours.texts([text, "", text]) == [want, b"", want]
    sent.clear()
    assert ours.texts(["", text]) == [b"", want] and not sent


def test_encode_decode(spark):
    encoding = bpe.tiktoken_encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for r in rows():
        ids = encoding.encode_ordinary(r[1] or "")
        want[r[0], len(ids), sha(array("I", ids).tobytes()), sha((r[1] or "").encode())] += 1
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert Counter(map(tuple, bpe.encode_decode(documents(spark), path).collect())) == want
    assert bpe.encode_decode(empty(spark), path, keep_ids=True).count() == 0
    kept = bpe.encode_decode(documents(spark), path, keep_ids=True).filter("doc_id = 15").first()
    assert bytes(kept["decoded"]).decode() == rows()[15][1]


@pytest.mark.parametrize("n", [0, 1, 2, 1023, 1024, 1025, 5000])
def test_frames_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n) * rng.integers(1, 9, n), 50256).astype(np.uint32)
    lengths = np.array([n - n // 3, n // 3])
    body = rans.encode_frame(ids, lengths, np.array([4, -7]))
    got, sizes, docs = rans.decode_frame(body)
    assert np.array_equal(got, ids) and sizes.tolist() == lengths.tolist() and docs.tolist() == [4, -7]
    if n == 5000:
        part, _, _ = rans.decode_frame(body, only=range(2, 4))
        assert np.array_equal(part, ids[2048:4096]) and len(body) < 2 * n
        broken = bytearray(body)
        broken[-3] ^= 1
        with pytest.raises(ValueError):
            rans.decode_frame(bytes(broken))


def test_table_of_every_symbol():
    ids = np.arange(50257, dtype=np.uint32)
    assert np.array_equal(rans.decode_frame(rans.encode_frame(ids, np.array([50257]), np.array([0])))[0], ids)


def test_token_files(spark, tokenizer, tmp_path, monkeypatch):
    data = sorted((r for r in rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    path = public_tokenizers.path("byte_bpe_50k.json")
    rans.write_tokens(documents(spark), str(tmp_path / "t"), path, 2)
    got = sorted(map(tuple, rans.read_tokens(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    want, at = [], 0
    for r in data:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want.append((r[0], at, len(ids), zlib.crc32(array("I", ids).tobytes())))
        at += len(ids)
    assert got == want
    rans.write_tokens(empty(spark), str(tmp_path / "e"), path, 2)
    assert rans.read_tokens(spark, str(tmp_path / "e"), keep_ids=True).count() == 0


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), share * sum(sizes.values())
    for _ in range(1000):
        free = [s for s in names if target[s] < limit * sizes[s] - 1e-12]
        if left < 1e-9 or not free:
            break
        part = left / sum(w[s] for s in free)
        left = 0.0
        for s in free:
            target[s] += part * w[s]
            if target[s] > limit * sizes[s]:
                left += target[s] - limit * sizes[s]
                target[s] = limit * sizes[s]
    return target


def test_mixing_targets_and_copies(spark):
    sizes = Counter()
    for r in rows():
        sizes[r[3]] += len(split(r[1]))
    want = brute_targets(sizes)
    out = mixing.with_copies(documents(spark)).collect()
    assert len(out) == len(rows())
    source = {r[0]: r[3] for r in rows()}
    for r in out:
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]]) and r["source_size"] == sizes[source[r["doc_id"]]]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate), int(rate) + 1) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    again = mixing.with_copies(documents(spark).repartition(5)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    mixed = mixing.mixed(documents(spark))
    assert mixed.columns == documents(spark).columns and mixed.count() == sum(r["copies"] for r in out)
    assert mixing.with_copies(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


def test_mixing_comes_near_its_targets(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 50 AS int)) AS text", "CASE WHEN id % 3 = 0 THEN 'big' ELSE concat('s', id % 7) END AS source")
    found = mixing.with_copies(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.12 * r["target"] for r in found)


def brute_counts(t):
    t = t or ""
    w = split(t)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for i in (k, k + 1, k + 2)}
    full = [x for x in t.split("\n") if split(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(covered)


def test_quality_counts_and_verdicts(spark):
    want = Counter()
    for r in rows():
        n, *more = brute_counts(r[1])
        want[r[0], n, *more, n < 50 or 100 * more[3] > 50 * n] += 1
    out = quality.judged(documents(spark))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(map(tuple, out.select(*names).collect())) == want
    assert out.filter("base_failed AND kept").count() == 0
    kept = {r[0] for r in quality.passing(documents(spark)).select("doc_id").collect()}
    assert {5, 6, 9, 10, 11, 14} <= kept and not kept & {0, 1, 2, 3, 4, 13}
    assert quality.passing(documents(spark), least_words=1).filter("doc_id IN (0, 1, 2)").count() == 0
    assert quality.passing(documents(spark)).columns == documents(spark).columns
    assert quality.judged(empty(spark)).count() == 0


def test_quality_runs_no_python(spark):
    plan = quality.counts(documents(spark).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_estimate(table, rounds):
    """The same expectation maximisation over documents, a row each, in numpy."""
    votes = np.array([p for p, n in table for _ in range(n)])
    hit = np.stack([votes == v for v in (-1, 0, 1)])  # vote, document, rule
    seen = np.array([[0.75, 1.25, 3.0], [3.0, 1.25, 0.75]])  # good, bad
    log = np.log(seen / 5.0)[:, :, None] * np.ones(votes.shape[1])
    prior = np.array([0.0, 0.0])
    for _ in range(rounds):
        joint = prior[:, None] + np.einsum("cvr,vdr->cd", log, hit)
        q = np.exp(joint - joint.max(axis=0))
        q /= q.sum(axis=0)
        prior = np.log(q.sum(axis=1) + 1)
        log = np.log((seen[:, :, None] + np.einsum("cd,vdr->cvr", q, hit)) / (q.sum(axis=1) + 5)[:, None, None])
    joint = prior[:, None] + np.einsum("cvr,vdr->cd", log, hit)
    return dict(zip(map(tuple, votes.tolist()), (joint[0] - joint[1]).tolist(), strict=True))


def odds(found, p):
    prior, adds = found
    return prior + sum(a[v] for a, v in zip(adds, p, strict=True))


NOISY = [((0, 0, 1), 600), ((-1, 0, 1), 350), ((0, -1, -1), 30), ((-1, -1, -1), 20)]


@pytest.mark.parametrize("table", [NOISY, [((0, 0, 1), 900), ((-1, -1, 0), 50), ((0, -1, -1), 50)], [((1, 1), 3), ((-1, 0), 2), ((0, -1), 1)]])
def test_estimate_matches_a_plain_version(table):
    found = quality.estimate(table, rounds=60)
    want = plain_estimate(table, 60)
    assert all(abs(odds(found, p) - want[p]) < 1e-3 for p, _ in table)


def test_estimate_finds_good_rules():
    assert quality.estimate([]) == (0.0, [{-1: 0.0, 0: 0.0, 1: 0.0}] * len(quality.RULES))
    found = quality.estimate(NOISY)
    # the first rule is wrong on a third of the clean documents: its vote alone rejects none
    assert odds(found, (0, 0, 1)) > 0 and odds(found, (-1, 0, 1)) > 0 and odds(found, (0, -1, -1)) < 0 and odds(found, (-1, -1, -1)) < 0


def test_estimate_recovers_planted_accuracies():
    """Six rules on 20,000 documents, a tenth of them bad; one rule is wrong on 35 of 100."""
    rng = np.random.default_rng(8)
    bad = rng.random(20_000) < 0.1
    right, casts = np.array([0.95, 0.9, 0.85, 0.9, 0.65, 0.92]), np.array([0.9, 0.6, 0.8, 1.0, 1.0, 0.5])
    truth = np.where(bad, -1, 1)[:, None]
    votes = np.where(rng.random((20_000, 6)) < casts, np.where(rng.random((20_000, 6)) < right, truth, -truth), 0)
    table = Counter(map(tuple, votes.tolist()))
    found = quality.estimate(sorted(table.items()))
    for r in range(6):
        for v in (-1, 1):
            on = {k: np.mean(votes[bad == k, r] == v) for k in (False, True)}
            assert abs(found[1][r][v] - np.log(on[False] / on[True])) < 0.4
    verdict = np.array([odds(found, tuple(p)) >= 0 for p in votes.tolist()])
    assert np.mean(verdict != bad) > 0.98 and np.mean(verdict != (votes >= 0).all(axis=1)) > 0.3


def test_classifier_on_held_out_rows(spark, sf_dir):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = classifier.fit(docs, labels, usable=~held)
    found = classifier.scored(docs, model).filter(held).join(labels, "doc_id").collect()
    right = sum((r["score"] >= 0.3) == bool(r["quality"]) for r in found)
    assert right >= 0.93 * len(found) and all(r["score"] >= 0.3 for r in found if r["quality"] == 1)


def test_classifier_against_a_plain_version(spark):
    """Features and scores of whole texts, beyond 8 KB too, and the fit's stationary point."""
    import zstandard

    rng = random.Random(2)
    good, bad = ([f"{stem}{rng.choice('aeiou')}{rng.choice('xyz')}" for stem in stems] for stems in (("alpha", "beta", "gamma", "delta"), ("###", "$$$", "!!", "&&&")))
    text = lambda words, n: " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))
    data = [(k, text(good if k % 2 else bad, 6000 if k % 10 < 2 else 80)) for k in range(200)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(150)], "doc_id bigint, quality int")
    model = classifier.fit(docs, labels)

    def packed(piece, d):
        return len(zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False).compress(piece))

    def plain(t):
        pieces = [t[s : s + 1024] for s in range(0, len(t), 1024)]
        g, b = (sum(packed(p, d) for p in pieces) for d in (model.good, model.bad))
        share = min(1.5, min(g, b) / len(t))
        x = np.array([1.0, (b - g) / (b + g + 48), share, share * share])
        return 1 / (1 + np.exp(-x @ np.array(model.weights)))

    got = {r["doc_id"]: r["score"] for r in classifier.scored(docs, model).collect()}
    assert max(len(t) for _, t in data) > 8 * 4096
    assert all(got[k] == pytest.approx(plain(t.encode()), abs=0.02) for k, t in data)
    assert all((got[k] > 0.5) == bool(k % 2) for k in range(150, 200))
    x, y = np.column_stack((np.ones(300), np.random.default_rng(1).normal(size=(300, 2)))), np.random.default_rng(2).random(300) < 0.4
    w = np.array(classifier.logistic(x, y.astype(float)))
    slope = x.T @ (y - 1 / (1 + np.exp(-x @ w))) - np.array([1e-6, 1e-2, 1e-2]) * w
    assert np.abs(slope).max() < 1e-6


def test_training_pieces_cover_whole_texts(spark):
    rows = spark.createDataFrame([(1, 1, "shared\nown line\n" + "x" * 5000), (2, 0, "shared\n" + "y" * 300), (3, 0, "shared")], "id bigint, label int, text string")
    found = {r["id"]: r["text"] for r in classifier.own_lines(rows).collect()}
    assert found == {1: "own line\n" + "x" * 5000, 2: "y" * 300}
    pieces = classifier.training_pieces(rows.filter("id = 1")).collect()
    assert sum(len(r["piece"]) for r in pieces) == len("shared\nown line\n") + 5000


def test_dictionaries_of_many_pieces_are_trained_in_rounds(spark, monkeypatch):
    """All pieces take part: what only one group's texts hold compresses with the dictionary of the groups' dictionaries."""
    import random

    import zstandard

    rng = random.Random(2)
    phrases = ["".join(rng.choice("abcdefghij ") for _ in range(60)) for _ in range(40)]
    pieces = [" ".join(rng.choice(phrases) for _ in range(12)).encode() for _ in range(2500)]
    frame = spark.createDataFrame([(p,) for p in pieces], "piece binary").repartition(3)
    sizes = {}
    for most in (8192, 700):
        monkeypatch.setattr(classifier, "TASK_PIECES", most)
        made = zstandard.ZstdCompressionDict(classifier.trained(frame))
        sizes[most] = sum(len(zstandard.ZstdCompressor(level=1, dict_data=made).compress(p)) for p in pieces[:200])
    plain = sum(len(zstandard.ZstdCompressor(level=1).compress(p)) for p in pieces[:200])
    assert sizes[700] < 1.3 * sizes[8192] < 0.5 * plain


def test_classifier_edges(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(18)] + [(3, None, 0), (None, 1, 0)], "doc_id bigint, quality int, score int")
    model = classifier.fit(documents(spark), labels)
    out = classifier.scored(documents(spark), model)
    assert out.count() == len(rows()) and out.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    one = classifier.fit(documents(spark), labels.filter("quality = 1"))
    assert classifier.scored(documents(spark), one).filter("score > 0.5").count() == len(rows())
    nothing = classifier.fit(empty(spark), labels.limit(0))
    assert classifier.scored(documents(spark), nothing).select("score").distinct().count() == 1
    assert classifier.scored(empty(spark), model).count() == 0


def test_memo_keeps_what_is_asked_for_again():
    memo = bpe.Memo(100)
    for k in range(40):
        memo.turn()
        asked = {"often", *(f"{k}-{n}" for n in range(20))}
        memo.now.update(dict.fromkeys(new := memo.missing(asked), b""))
        assert asked <= set(memo.now) and len(memo.now) + len(memo.old) <= 150 and ("often" in new) == (k == 0)
