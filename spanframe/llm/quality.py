"""Quality rules under weak supervision, in DataFrame expressions throughout.

Rules look at counts of the whole text and vote good, bad or abstain. Expectation
maximisation estimates, for each rule, how often it votes each way on good and on
bad documents, from how often each pattern of votes occurs: a pattern is a row,
of which there are at most 3 to the number of rules, however many documents
there are. A document is kept if its posterior probability of being good is at
least a half; a document that fails the base rules is never kept.

No rule decides alone, and each kind of fault moves several rules: a fault that
only one rule sees can't be told from that rule's errors.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import SPACES, written

#: name, what the rule measures, and four bounds: bad below, good from, good up to, bad above; between them it abstains.
#: What is added to the sizes keeps a few words or characters from proving anything.
RULES = (
    ("symbols", "n_symbols / n_words + 10", None, None, 0.05, 0.2),
    ("alphanumeric", "n_alnum + 20 / word_chars + 20", 0.91, 0.95, None, None),
    ("bare_words", "n_bare / n_words + 10", None, None, 0.1, 0.25),
    ("lower_case", "n_lower + 20 / n_letters + 20", 0.8, 0.9, None, None),
    ("bangs", "n_bangs / n_words + 10", None, None, 0.05, 0.25),
    ("ends", "n_ends / n_words + 10", None, None, 0.3, 0.5),
    ("word_length", "word_chars + 20 / n_words + 4", 3.0, 3.8, 7.0, 7.2),
    ("repeats", "n_repeat_words / n_words + 10", None, None, 0.1, 0.3),
    ("variety", "n_distinct + 5 / n_words + 10", 0.25, 0.45, None, None),
    ("dup_lines", "n_dup_lines / n_lines + 4", None, None, 0.1, 0.4),
)
BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50
#: What is believed of any rule beforehand, in documents of each kind that it was seen on: it votes wrong on one of five. This fades as documents come in.
SEEN_RIGHT, SEEN_ABSTAIN, SEEN_WRONG = 3.0, 1.25, 0.75
ROUNDS, SETTLED = 500, 1e-9


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, wherever it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Words that stand in a run of three words found twice or more. Runs are compared by a 64-bit hash of their words."""

    def covered(grams: Column) -> Column:
        """Runs of one hash are neighbours once sorted; their places, sorted, cover three words each, less where they overlap."""

        def of_sorted(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
            places = F.sort_array(F.transform(twice, lambda x: x["i"]))
            return let(places, lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x))

        return let(F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted)

    def of_words(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        distinct = lambda g: F.size(F.array_distinct(g)) == F.size(g)
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(grams, lambda g: F.when(distinct(g), F.lit(0)).otherwise(covered(g))))

    return let(words, of_words).cast("bigint")


def counts(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_distinct, n_letters, n_alnum, n_lower, n_bare, n_bangs, n_ends (bigint), each behind prefix."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = F.btrim(text, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    full_lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    both = lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"), repeat_words(w).alias("n_repeat_words"), F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"))
    lines = lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))
    found = docs.withColumn("__w", let(words, both)).withColumn("__l", let(full_lines, lines))
    names = [F.col(f"__w.{n}").alias(prefix + n) for n in ("n_words", "word_chars", "n_repeat_words", "n_distinct")] + [F.col(f"__l.{n}").alias(prefix + n) for n in ("n_lines", "n_dup_lines")]
    single = [(n, without(p)) for n, p in (("n_symbols", r"[#*$%&|<>]"), ("n_letters", r"\p{L}++"), ("n_digits", r"\p{N}++"), ("n_lower", r"[\p{Ll}\p{Lo}\p{Lm}]++"), ("n_bangs", r"!"), ("n_ends", r"[.?!。？！]"))]
    single = {n: c.cast("bigint") for n, c in single}
    single["n_alnum"] = single["n_letters"] + single.pop("n_digits")
    single["n_bare"] = F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])")).cast("bigint")
    return found.select(*docs.columns, *names, *[c.alias(prefix + n) for n, c in single.items()])


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_letters", "n_alnum", "n_lower", "n_bare", "n_bangs", "n_ends")


def votes(prefix: str = "") -> list[Column]:
    """1 good, -1 bad, 0 abstains. A text without words gets no vote."""
    out = []
    for _, what, bad_below, good_from, good_to, bad_above in RULES:
        for name in COUNTS:
            what = re.sub(rf"\b{name}\b", prefix + name, what)
        value = F.try_divide(*map(F.expr, what.split(" / ")))
        bad = (value < bad_below if bad_below is not None else F.lit(False)) | (value > bad_above if bad_above is not None else F.lit(False))
        good = (value >= good_from if good_from is not None else F.lit(True)) & (value <= good_to if good_to is not None else F.lit(True))
        out.append(F.when(F.col(f"{prefix}n_words") == 0, 0).when(bad, -1).when(good, 1).otherwise(0))
    return out


def base_failed(prefix: str = "", least_words: int = BASE_WORDS) -> Column:
    n = F.col(f"{prefix}n_words")
    return (n < least_words) | (100 * F.col(f"{prefix}n_repeat_words") > BASE_REPEAT_PERCENT * n)


def estimate(patterns: list[tuple[tuple[int, ...], float]], rounds: int = ROUNDS) -> tuple[float, list[dict[int, float]]]:
    """(log odds of good before any vote, for each rule the log odds that each vote adds) from (votes, documents) pairs.

    Two kinds of documents, good and bad, on each of which every rule votes -1,
    0 or 1 with probabilities of its own, abstaining included. Rounds work out
    the posterior of each pattern and then the probabilities, each of which is
    the share among the documents with SEEN_* more; they end when no posterior
    moves. The start is the posterior under those beliefs alone, so a vote
    counts as right four times of five whichever rule cast it. No documents
    give no odds.
    """
    total = sum(n for _, n in patterns)
    width = len(patterns[0][0]) if patterns else len(RULES)
    if not total:
        return 0.0, [{v: 0.0 for v in (-1, 0, 1)} for _ in range(width)]
    seen = {1: {1: SEEN_RIGHT, 0: SEEN_ABSTAIN, -1: SEEN_WRONG}, -1: {-1: SEEN_RIGHT, 0: SEEN_ABSTAIN, 1: SEEN_WRONG}}
    sure = sum(seen[1].values())
    prior, adds = 0.0, [{v: math.log(seen[1][v] / seen[-1][v]) for v in (-1, 0, 1)} for _ in range(width)]
    posterior = lambda p: 1 / (1 + math.exp(-max(-500.0, min(500.0, prior + sum(a[v] for a, v in zip(adds, p, strict=True))))))
    good = [posterior(p) for p, _ in patterns]
    for _ in range(rounds):
        g = sum(q * n for q, (_, n) in zip(good, patterns, strict=True))
        b = total - g
        prior = math.log((g + 1) / (b + 1))
        for r in range(width):
            on_good, on_bad = dict(seen[1]), dict(seen[-1])
            for q, (p, n) in zip(good, patterns, strict=True):
                on_good[p[r]] += q * n
                on_bad[p[r]] += (1 - q) * n
            adds[r] = {v: math.log(on_good[v] / (g + sure)) - math.log(on_bad[v] / (b + sure)) for v in (-1, 0, 1)}
        before, good = good, [posterior(p) for p, _ in patterns]
        if max(abs(x - y) for x, y in zip(before, good, strict=True)) < SETTLED:
            break
    return prior, adds


def judged(docs: DataFrame, text_col: str = "text", keep_row: bool = False, id_col: str = "doc_id", least_words: int = BASE_WORDS) -> DataFrame:
    """Per row of docs: id_col, the counts, base_failed, posterior (of being good), kept; with keep_row also row, a struct of all columns.

    Null texts have no words. Texts of under least_words words, and those of
    which over half the words stand in repeated runs, fail the base rules; they
    take no part in the estimate. A text without words is never kept. Repeated rows are judged alike; an empty table gives
    an empty result. Columns of docs stay inside the struct, so names can't clash.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), *([F.struct(*docs.columns).alias("row")] if keep_row else []))
    counted = written(counts(rows, "__text").drop("__text").withColumn("base_failed", base_failed(least_words=least_words)), "quality")
    patterns = counted.filter(~F.col("base_failed") & (F.col("n_words") > 0)).groupBy(F.array(*votes()).alias("votes")).count().collect()  # at most 3 ** len(RULES) rows
    prior, adds = estimate([(tuple(r["votes"]), r["count"]) for r in sorted(patterns, key=lambda r: r["votes"])])
    odds = F.lit(prior)
    for vote, add in zip(votes(), adds, strict=True):
        odds = odds + F.when(vote == -1, add[-1]).when(vote == 1, add[1]).otherwise(add[0])
    # no rule has a value on a text without words
    posterior = F.when(F.col("n_words") > 0, 1 / (1 + F.exp(-odds))).otherwise(F.lit(0.0))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return counted.withColumn("posterior", posterior).select(F.col("__id").alias(id_col), *names, "posterior", (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"), *(["row"] if keep_row else []))


def passing(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least_words: int = BASE_WORDS) -> DataFrame:
    """The rows of docs that judged keeps, with their own columns.

    Rows without words (null, empty, white space) go; repeated rows stay or go
    together; columns with any names pass through; an empty table stays empty.
    """
    return judged(docs, text_col, keep_row=True, id_col=id_col, least_words=least_words).filter("kept").select("row.*")
