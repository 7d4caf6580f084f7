import hashlib
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from spanframe.functions import identity, names, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_normalisers():
    assert text.normal_form(form="NFKC", dotted_i=True, strip_format=True)("İSTANBUL​, ILIK") == "istanbul ılık"
    assert text.normal_form(form=None)("Straße_X") == "strasse x"
    assert text.normal_form(form="NFKD", strip_marks=True)("Çá") == "ca"
    assert text.normal_form(form="NFC", casefold=False, pattern=None)("  a \n b ") == "a b"


def test_columns(spark):
    assert one(spark, text.collapsed(F.lit(" a \n b "))) == "a b" and one(spark, text.ascii_folded(F.lit("ışÇé"))) == "isCe"
    assert one(spark, text.lexical(F.lit("Don't STOP—now²"))) == "don t stop now²".replace("²", "²")
    assert one(spark, text.content_tokens(F.lit("the cat 12 THE hat"), ["the"])) == ["cat", "hat"]
    assert one(spark, text.visible_length(F.lit("<i>ab</i>{\\an8}c"))) == 3 and one(spark, text.non_space_length(F.lit(" a b "))) == 2
    assert one(spark, text.is_strange(F.lit("la la la la"))) and one(spark, text.is_strange(F.lit("!!! 12"))) and not one(spark, text.is_strange(F.lit("a b c d")))
    assert one(spark, text.names_present(F.lit("Anna's and Bob"), ["Anna", "Bo", "Bob"], ["s"])) == ["Anna", "Bob"]
    assert one(spark, text.with_canonical_names(F.lit("Jon saw Jonny"), {"John": ["Jon"]})) == "John saw Jonny"
    assert one(spark, text.contains_phrase(F.lit("He said: Good-bye!"), ["good bye"])) and not one(spark, text.contains_phrase(F.lit("goodbye"), ["good bye"]))
    assert one(spark, text.rule_failures(F.lit("bless you"), F.lit("hm"), [("r", "bless", "berkat")])) == ["r"]
    assert one(spark, names.readings_of(F.lit("Jon"), {}, {"John": ["Jon"]})) == ["John", "Jon"]


def test_times(spark):
    for ms in (0, 1, 59_999, 3_600_000, 360_000_123):
        assert one(spark, text.parse_timestamp(text.format_timestamp(F.lit(ms).cast("bigint")))) == ms
    assert one(spark, text.parse_timestamp(F.lit("1:2:3,4"))) is None and one(spark, text.parse_timestamp(F.lit("02:03.004"), ".", hours=False)) == 123_004
    assert tuple(one(spark, text.clip_bounds(F.lit(100), F.lit(200), F.lit(10_000)))) == (0, 1600)


@pytest.mark.parametrize(("raw", "plain", "spaced"), [("1,234", "1234", "1234"), ("1.5", "1.5", "1.5"), ("007", "7", "7"), ("1.234.567,50", "1234567.5", "1234567.5"), ("0,0", "0", "0")])
def test_numbers(spark, raw, plain, spaced):
    assert one(spark, text.canonical_number(F.lit(raw))) == plain and one(spark, text.canonical_number(F.lit(raw), True)) == spaced


def test_number_anchors(spark):
    assert one(spark, text.number_anchors(F.lit("12 of 1,000 and 12"))) == ["12", "1000", "12"]
    assert one(spark, text.number_anchors(F.lit("1 000 days"), spaced=True)) == ["1000"]
    assert one(spark, text.money_anchors(F.lit("pay $5.50 or 7 lira, not 9"), ["$", "lira"])) == ["5.5", "7"]
    assert one(spark, text.same_multiset(F.array(F.lit("1"), F.lit("2")), F.array(F.lit("2"), F.lit("1"))))


def test_token_arrays(spark):
    arr = lambda s: F.split(F.lit(s), " ")
    assert one(spark, text.contiguous_matches(arr("a b a b a"), arr("a b"))) == [0, 2] and one(spark, text.contiguous_matches(arr("a"), arr("a b"))) == []
    assert one(spark, text.compacted_texts(F.array(*map(F.lit, ["ab", "abc", "b", "x", ""])))) == ["abc", "x"]
    assert [tuple(r) for r in one(spark, text.evenly_timed(arr("a b c"), F.lit(0), F.lit(10)))] == [("a", 0, 3), ("b", 3, 6), ("c", 6, 10)]
    assert one(spark, text.joined_words(F.array(F.lit(" a"), F.lit("'b")))) == "a'b" and one(spark, text.joined_words(F.array(F.lit("a"), F.lit("b")))) == "a b"


def dice(a, b):
    from collections import Counter

    x, y = (Counter(t[i : i + 2] for i in range(len(t) - 1)) for t in (a, b))
    return 1.0 if a == b else 0.0 if len(a) < 2 or len(b) < 2 else 2 * sum((x & y).values()) / (sum(x.values()) + sum(y.values()))


def test_similarity(spark):
    rng = random.Random(2)
    pairs = [("".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))), "".join(rng.choice("abc ") for _ in range(rng.randint(0, 12)))) for _ in range(60)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", text.bigram_dice(F.col("a"), F.col("b")).alias("d"), text.similarity(F.col("a"), F.col("b")).alias("r"), text.blended_similarity(F.col("a"), F.col("b")).alias("s")).collect()
    for r in rows:
        assert r["d"] == pytest.approx(dice(r["a"], r["b"])) and r["r"] == pytest.approx(SequenceMatcher(None, r["a"], r["b"], autojunk=False).ratio()) and 0 <= r["s"] <= 1


def test_edits_are_least_and_rebuild(spark):
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 7))] for _ in range(2))
        found = text.edits(a, b)
        out = list(a)
        for kind, i, _, _, new in reversed(found):
            out[i : i + (kind != "insert")] = [] if kind == "delete" else [new]
        assert out == b
    row = one(spark, text.edit_audit(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"), F.lit("c"), F.lit("d"))))
    assert (row["replaced"], row["deleted"], row["inserted"]) == (1, 0, 1)


def test_layout(spark):
    assert text.wrapped("short") == "short" and text.wrapped("x" * 90) is None
    lines = text.wrapped("one two three four five six seven eight nine ten").split("\n")
    assert len(lines) == 2 and max(map(len, lines)) <= 42
    assert one(spark, text.greedy_lines(F.lit("aa bb cc"), 5)) == ["aa bb", "cc"]


def test_repair(spark):
    assert text.filled_words(["a", "b", "c", "d"], [("a", 0, 10), ("d", 40, 50)], 0, 50) == [("a", 0, 10, False), ("b", 10, 25, True), ("c", 25, 40, True), ("d", 40, 50, False)]
    assert text.filled_words(["a"], [("b", 0, 1)], 0, 1) is None
    out = one(spark, text.repair_omissions(F.split(F.lit("a b"), " "), F.array(F.struct(F.lit("b").alias("token"), F.lit(5).cast("bigint").alias("start_ms"), F.lit(9).cast("bigint").alias("end_ms"))), F.lit(0), F.lit(9)))
    assert [(r["token"], r["added"]) for r in out] == [("a", True), ("b", False)]


def test_identity(spark):
    frame = spark.createDataFrame([(2, "é\"/"), (1, None)], "b int, a string")
    got = {r["b"]: r["d"] for r in frame.select("b", identity.row_digest("b", "a").alias("d")).collect()}
    assert got[2] == identity.digest({"a": "é\"/", "b": 2}) and got[1] == identity.digest({"a": None, "b": 1})
    assert identity.relation_digest(frame.withColumn("k", F.lit(1)), ["k"], ["b"], ["a", "b"]).first()["digest"] == hashlib.sha256(hashlib.sha256((got[1] + got[2]).encode()).hexdigest().encode()).hexdigest()
    import hmac

    assert one(spark, identity.hmac_tag(b"key")(F.lit("x"))) == hmac.new(b"key", b"x", "sha256").hexdigest()
