"""Text functions: normalisers, tokens, numbers, similarity, layout, predicates.

What the JVM has built in stays there; Unicode normal forms, case folding, sequence
matching and edit audits are Arrow UDFs. Word lists, names and rule tables are
arguments: the library holds none.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from difflib import SequenceMatcher
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, though body uses it within lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


# --- normalisers -----------------------------------------------------------------------------


@lru_cache(maxsize=None)
def normal_form(form: str | None = "NFKC", dotted_i: bool = False, strip_format: bool = False, strip_marks: bool = False, casefold: bool = True, pattern: str | None = r"[^\W_]+", joiner: str = " ") -> Callable[[str], str]:
    """A function of text: normal form, Turkish I, format characters and marks stripped, case folded, then the pattern's matches joined.

    pattern None keeps the text and only joins what white space separates.
    """
    finder = re.compile(pattern) if pattern else None

    def run(text: str) -> str:
        if form:
            text = unicodedata.normalize(form, text)
        if dotted_i:
            text = text.replace("İ", "i").replace("I", "ı")
        if strip_format:
            text = "".join(c for c in text if unicodedata.category(c) != "Cf")
        if casefold:
            text = text.casefold()
        if strip_marks:
            text = "".join(c for c in text if not unicodedata.combining(c))
        return joiner.join(finder.findall(text) if finder else text.split())

    return run


def normalized(text: Column, **options) -> Column:
    """normal_form of a column; null stays null."""
    run = normal_form(**options)

    @F.pandas_udf("string")
    def udf(values: pd.Series) -> pd.Series:
        return values.map(lambda t: None if t is None else run(t))

    return udf(text)


def collapsed(text: Column) -> Column:
    """NFC with single spaces and none at the ends."""
    return normalized(text, form="NFC", casefold=False, pattern=None)


def tokens(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def lexical(text: Column) -> Column:
    return F.array_join(tokens(text), " ")


@lru_cache(maxsize=None)
def _ascii(text: str) -> str:
    text = text.translate(str.maketrans("ıİşŞğĞçÇöÖüÜ", "iIsSgGcCoOuU"))
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def ascii_folded(text: Column) -> Column:
    """Turkish letters as ASCII ones, then no combining marks."""

    @F.pandas_udf("string")
    def udf(values: pd.Series) -> pd.Series:
        return values.map(lambda t: None if t is None else _ascii.__wrapped__(t))

    return udf(text)


def content_tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Distinct folded tokens that are no stop words and no numbers."""
    found = F.array_distinct(tokens(ascii_folded(text)))
    return F.filter(F.array_except(found, F.array(*map(F.lit, stop_words)).cast("array<string>")), lambda t: ~t.rlike(r"^\d+$"))


# --- lengths and times -----------------------------------------------------------------------

TAGS = r"<[^>]*>|\{\\[^}]*\}"


def visible_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, TAGS, ""))


def non_space_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"(?U)\s+", ""))


def chars_per_second(length: Column, start_ms: Column, end_ms: Column) -> Column:
    return F.when(end_ms > start_ms, length * 1000.0 / (end_ms - start_ms))


def required_duration(text: Column, least: int = 700, rate: float = 20.0) -> Column:
    return F.greatest(F.lit(least).cast("bigint"), F.ceil(F.length(text) / rate * 1000))


def format_timestamp(ms: Column, mark: str = ",") -> Column:
    """HH:MM:SS,mmm; hours have two digits at least."""
    part = lambda by, of=None: (F.floor(ms / by) if of is None else F.floor(ms / by) % of).cast("bigint")
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", part(3_600_000), part(60_000, 60), part(1000, 60), (ms % 1000).cast("bigint"))


def parse_timestamp(text: Column, mark: str = ",", hours: bool = True) -> Column:
    """Milliseconds of [HH:]MM:SS,mmm; null if it isn't one. hours: whether the hours must be there."""
    pattern = rf"^(\d{{2,}}):([0-5]\d):([0-5]\d){re.escape(mark)}(\d{{3}})$" if hours else rf"^(?:(\d{{1,}}):)?([0-5]\d):([0-5]\d){re.escape(mark)}(\d{{3}})$"
    group = lambda i: F.coalesce(F.regexp_extract(text, pattern, i).try_cast("bigint"), F.lit(0))
    return F.when(text.rlike(pattern), group(1) * 3_600_000 + group(2) * 60_000 + group(3) * 1000 + group(4))


# --- numbers ---------------------------------------------------------------------------------

NUMBER = r"\d+(?:[.,]\d+)*"
SPACED_NUMBER = r"\d+(?:[.,\s]\d{3})*(?:[.,]\d+)?"


def canonical_number(raw: Column, spaced: bool = False) -> Column:
    """Digits with a point before decimals. Separators in front of three digits group thousands, a last one before one or two digits (or any other number) is decimal."""
    text = F.regexp_replace(raw, r"\s+", "") if spaced else raw
    thousands = text.rlike(r"^\d{1,3}([.,]\d{3})+$")
    plain = F.regexp_replace(text, r"[.,]", "")
    decimals = F.regexp_extract(text, r"[.,](\d+)$", 1)
    whole = F.regexp_replace(F.regexp_replace(text, r"[.,]\d+$", ""), r"[.,]", "")
    bare = lambda x: F.when(F.regexp_replace(x, "^0+", "") == "", "0").otherwise(F.regexp_replace(x, "^0+", ""))
    tail = F.regexp_replace(decimals, "0+$", "")
    return F.when(thousands | ~text.rlike("[.,]"), bare(plain)).otherwise(F.concat(bare(whole), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail))))


def number_anchors(text: Column, spaced: bool = False) -> Column:
    """Canonical numbers of a text in order, repeats kept; as multisets two texts agree if the sorted arrays do."""
    return F.transform(F.regexp_extract_all(text, F.lit(SPACED_NUMBER if spaced else NUMBER), 0), lambda x: canonical_number(x, spaced))


def money_anchors(text: Column, units: Sequence[str]) -> Column:
    """Canonical numbers that stand before or behind one of the units."""
    unit = "|".join(re.escape(u) for u in units)
    found = F.regexp_extract_all(text, F.lit(rf"(?:(?:{unit})\s*{NUMBER}|{NUMBER}\s*(?:{unit}))"), 0)
    return F.transform(found, lambda x: canonical_number(F.regexp_extract(x, NUMBER, 0)))


def same_multiset(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


# --- arrays of tokens ------------------------------------------------------------------------


def contiguous_matches(haystack: Column, needle: Column) -> Column:
    """All offsets, from 0, at which needle stands in haystack; none for an empty needle."""

    def of(h: Column, n: Column) -> Column:
        last = F.size(h) - F.size(n)
        return F.when((F.size(n) == 0) | (last < 0), F.array().cast("array<int>")).otherwise(F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(h, i + 1, F.size(n)) == n))

    return let(haystack, lambda h: let(needle, lambda n: of(h, n)))


def shared_tokens(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def is_repetitive(found: Column, least: int = 20) -> Column:
    """least tokens or more of which hardly any differ."""
    return (F.size(found) >= least) & (F.size(F.array_distinct(found)) <= F.greatest(F.lit(2), F.floor(F.size(found) / 10).cast("int")))


def has_token_run(found: Column, run: int = 4) -> Column:
    """One token run times in a row."""

    def of(t: Column) -> Column:
        same = lambda i: F.forall(F.slice(t, i + 1, run - 1), lambda x: x == F.get(t, i - 1))
        return F.when(F.size(t) < run, False).otherwise(F.exists(F.sequence(F.lit(1), F.greatest(F.size(t) - run + 1, F.lit(1))), same))

    return let(found, of)


def is_strange(text: Column, least_letters: float = 0.45) -> Column:
    """Empty, mostly no letters, or one token four times in a row."""
    solid = F.regexp_replace(text, r"\s+", "")
    letters = F.length(F.regexp_replace(solid, r"[^\p{L}]", ""))
    return (solid == "") | (letters < F.length(solid) * least_letters) | has_token_run(tokens(text))


def contains_phrase(text: Column, phrases: Sequence[str]) -> Column:
    """Whether any phrase stands in the text as whole words, by normalised tokens."""
    padded = F.concat(F.lit(" "), lexical(text), F.lit(" "))
    hits = [F.contains(padded, F.lit(f" {normal_form(form=None)(p)} ")) for p in phrases if p]
    out = F.lit(False)
    for h in hits:
        out = out | h
    return out


def is_credit(text: Column, heads: Sequence[str], tails: Sequence[str]) -> Column:
    """Three tokens: one of heads, then two of tails."""
    found = tokens(text)
    return (F.size(found) == 3) & F.coalesce(F.get(found, F.lit(0)).isin(*heads) & F.get(found, F.lit(1)).isin(*tails) & F.get(found, F.lit(2)).isin(*tails), F.lit(False))


def known_false_hit(text: Column, always: Sequence[str], sometimes: Sequence[str], stage: Column, one_ms: Column, stages: Column, at_stage: str = "exact_target_crop", blank_in: Sequence[str] = ("blind_padded", "prompted_padded")) -> Column:
    """Whether a decode of a short clip is a known false hit, never null.

    Phrases of always are; those of sometimes if they came at one stage with a
    word of one millisecond, and all stages of blank_in are there and came back
    blank. stages: map of stage and text.
    """
    said = lexical(F.coalesce(text, F.lit("")))
    blank = reduce(lambda a, b: a & b, [F.coalesce(F.map_contains_key(stages, F.lit(n)), F.lit(False)) & (F.trim(F.coalesce(F.element_at(stages, n), F.lit(""))) == "") for n in blank_in])
    return said.isin(*always) | (said.isin(*sometimes) & F.coalesce(stage == at_stage, F.lit(False)) & F.coalesce(one_ms, F.lit(False)) & blank)


def names_present(text: Column, names: Sequence[str], suffixes: Sequence[str] = ()) -> Column:
    """Sorted names that stand in the text as whole words, with one of the suffixes behind an apostrophe perhaps. A pattern a name, inside the JVM: for a short list; names.names_in finds many at once."""
    tail = rf"(?:['’](?:{'|'.join(map(re.escape, suffixes))}))?" if suffixes else ""
    found = [F.when(text.rlike(rf"(?<![\p{{L}}\p{{N}}]){re.escape(n)}{tail}(?![\p{{L}}\p{{N}}])"), n) for n in sorted(set(names))]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def with_canonical_names(text: Column, variants: Mapping[str, Sequence[str]]) -> Column:
    """Variants replaced by their names as whole words, longest first; what follows an apostrophe stays."""
    pairs = sorted(((v, name) for name, found in variants.items() for v in found), key=lambda p: (-len(p[0]), p))
    for v, name in pairs:
        text = F.regexp_replace(text, rf"(?<![\p{{L}}\p{{N}}]){re.escape(v)}(?![\p{{L}}\p{{N}}])", name.replace("\\", "\\\\").replace("$", "\\$"))
    return text


def rule_failures(source: Column, target: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Names of the rules (name, source pattern, target pattern) whose source pattern is found without the target's."""
    return F.array_compact(F.array(*[F.when(source.rlike(a) & ~target.rlike(b), name) for name, a, b in rules])) if rules else F.array().cast("array<string>")


def compacted_texts(texts: Column) -> Column:
    """Ordered texts without those equal to, or contained in, the one before; a text that extends the one before replaces it."""

    def step(acc: Column, t: Column) -> Column:
        last = F.element_at(acc, -1)
        return F.when(F.size(acc) == 0, F.array(t)).when(F.contains(last, t), acc).when(F.startswith(t, last), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(t))).otherwise(F.concat(acc, F.array(t)))

    return F.aggregate(F.filter(texts, lambda t: F.trim(t) != ""), F.array().cast("array<string>"), step)


def evenly_timed(found: Column, start: Column, end: Column) -> Column:
    """Tokens with equal shares of an interval in whole milliseconds: array of (token, start_ms, end_ms)."""

    def of(n: Column) -> Column:
        at = lambda i: (start + F.floor((end - start) * i / n)).cast("bigint")
        return F.transform(found, lambda t, i: F.struct(t.alias("token"), at(i).alias("start_ms"), at(i + 1).alias("end_ms")))

    return let(F.size(found), of)


def clip_bounds(start: Column, end: Column, total: Column, padding: int = 750, least: int = 1500) -> Column:
    """(clip_start, clip_end): padded, grown to least around its middle, and shifted inside the recording."""
    a, b = start - padding, end + padding
    grow = F.greatest(F.lit(0), least - (b - a))
    a, b = a - F.floor(grow / 2), b + F.ceil(grow / 2)
    shift = F.when(a < 0, -a).when(b > total, -F.least(b - total, F.greatest(a, F.lit(0)))).otherwise(0)
    return F.struct(F.greatest(F.lit(0), a + shift).cast("bigint").alias("clip_start"), F.least(total, b + shift).cast("bigint").alias("clip_end"))


# --- similarity ------------------------------------------------------------------------------


def dice(a: str, b: str) -> float:
    """Dice coefficient of the multisets of character pairs; 1 for equal texts, 0 where one has no pair."""
    if a == b:
        return 1.0
    if len(a) < 2 or len(b) < 2:
        return 0.0
    pairs = lambda x: Counter(map(str.__add__, x, x[1:]))
    return 2.0 * (pairs(a) & pairs(b)).total() / (len(a) + len(b) - 2)


def _of_both(a: Column, b: Column, of: Callable[[str, str], object], kind: str) -> Column:
    """of two texts, null if one is null."""

    @F.pandas_udf(kind)
    def udf(x: pd.Series, y: pd.Series) -> pd.Series:
        found = [None if p is None or q is None else of(p, q) for p, q in zip(x, y, strict=True)]
        return pd.Series(found, dtype="float64" if kind == "double" else "object")

    return udf(a, b)


def bigram_dice(a: Column, b: Column) -> Column:
    """dice of columns."""
    return _of_both(a, b, dice, "double")


#: Bits of a table of equal characters at most; SequenceMatcher takes longer texts.
TABLE_BITS = 1 << 26


def matched(a: Sequence, b: Sequence, least: int = 0, enough: int | None = None) -> int:
    """Characters in SequenceMatcher's matching blocks without junk: the longest block, of equal ones the first in a, then in b, and those on either side of it.

    The table of equal characters is one whole number, a row a character of a; runs
    along diagonals come from it by shifts, doubled while any is left. Ends with
    some smaller number once least can't be reached, and with one not below enough
    once that is.
    """
    n, m = len(a), len(b)
    size = m // 8 + 1  # a free column at least, so that no run goes on in the next row
    width = 8 * size
    if n * width > TABLE_BITS:
        return sum(block.size for block in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
    masks: dict = {}
    for j, c in enumerate(b):
        masks[c] = masks.get(c, 0) | 1 << j
    rows = {c: masks.get(c, 0).to_bytes(size, "little") for c in set(a)}
    table = int.from_bytes(b"".join([rows[c] for c in a]), "little")
    if not table:
        return 0
    total, left = 0, min(n, m)
    # tables of parts of a, with the columns that count, a bit a row, and how many rows
    todo = [(table, 0, m, int.from_bytes((b"\1" + bytes(size - 1)) * n, "little"), n)]
    while todo:
        table, low, high, ones, n_rows = todo.pop()
        left -= min(n_rows, high - low)
        runs, length, now = [table], 1, table
        while longer := now & now >> length * (width + 1):
            runs.append(longer)
            now, length = longer, 2 * length
        step = length
        for shorter in runs[-2::-1]:
            step //= 2
            if longer := now & shorter >> length * (width + 1):
                now, length = longer, length + step
        i, j = divmod((now & -now).bit_length() - 1, width)
        total += length
        if enough is not None and total >= enough:
            return total
        parts = []
        if i and j > low:
            own = ones & (1 << i * width) - 1
            parts.append((table & (own << j) - (own << low), low, j, own, i))
        i, j = i + length, j + length
        if i < n_rows and j < high:
            own = ones >> i * width
            parts.append((table >> i * width & (own << high) - (own << j), j, high, own, n_rows - i))
        parts = sorted((x for x in parts if x[0]), key=lambda x: min(x[4], x[2] - x[1]))
        left += sum(min(x[4], x[2] - x[1]) for x in parts)
        if total + left < least:
            return total
        todo += parts
    return total


def ratio(a: str, b: str, junk: bool = False) -> float:
    """Matching blocks over both lengths; equal texts need no matching."""
    if a == b:
        return 1.0
    return SequenceMatcher(None, a, b, autojunk=True).ratio() if junk else 2.0 * matched(a, b) / (len(a) + len(b))


def similarity(a: Column, b: Column, junk: bool = False) -> Column:
    """SequenceMatcher's ratio; junk: its heuristic for popular characters of long texts."""
    return _of_both(a, b, lambda p, q: ratio(p, q, junk), "double")


def below(a: str, b: str, bound: float) -> bool:
    """Whether ratio is below a bound; matching ends once that is known."""
    if a == b:
        return bound > 1.0
    n = len(a) + len(b)
    wanted = max(0, math.floor(bound * n / 2) - 1)
    while 2.0 * wanted / n < bound:
        wanted += 1
    return min(len(a), len(b)) < wanted or matched(a, b, wanted, wanted) < wanted


def less_similar(a: Column, b: Column, bound: float) -> Column:
    """below of columns; null of a null text."""
    return _of_both(a, b, lambda p, q: below(p, q, bound), "boolean")


def blended(a: str, b: str, least: float = 0.0) -> float | None:
    """The better of characters with token overlap and of token order with characters, of normalised texts; tokens are multisets. None if it is below least, where that shows early."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    x, y = a.split(), b.split()
    dice = 2 * (Counter(x) & Counter(y)).total() / (len(x) + len(y))
    # no order of tokens has more in common than their multisets
    wanted = (min((least - 0.35 * dice) / 0.65, (least - 0.55 * dice) / 0.45) - 1e-9) * (len(a) + len(b)) / 2
    if min(len(a), len(b)) < wanted:
        return None
    same = matched(a, b, max(0, math.ceil(wanted)))
    if same < wanted:
        return None
    chars = 2.0 * same / (len(a) + len(b))
    first = 0.65 * chars + 0.35 * dice
    if chars > dice + 1e-9:
        return first
    order = 2.0 * matched(x, y) / (len(x) + len(y))
    return max(first, 0.55 * order + 0.45 * chars)


def blended_similarity(a: Column, b: Column, least: Column | None = None) -> Column:
    """blended of columns; null of a null text. With least, scores below it may be null."""
    clean = normal_form(form="NFC")
    if least is None:
        return _of_both(a, b, lambda p, q: blended(clean(p), clean(q)), "double")

    @F.pandas_udf("double")
    def udf(x: pd.Series, y: pd.Series, bound: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else blended(clean(p), clean(q), z) for p, q, z in zip(x, y, bound, strict=True)], dtype="float64")

    return udf(a, b, least)


def edits(a: Sequence[str], b: Sequence[str]) -> list[tuple[str, int, int, str | None, str | None]]:
    """Least edits from one token list to another: (kind, index in a, index in b, from, to); of equal ways the one that keeps, then replaces, then deletes."""
    n, m = len(a), len(b)
    cost = [[i + j if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (a[i - 1] != b[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    out, i, j = [], n, m
    while i or j:
        if i and j and a[i - 1] == b[j - 1] and cost[i][j] == cost[i - 1][j - 1]:
            i, j = i - 1, j - 1
        elif i and j and cost[i][j] == cost[i - 1][j - 1] + 1:
            i, j = i - 1, j - 1
            out.append(("replace", i, j, a[i], b[j]))
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append(("delete", i, j, a[i], None))
        else:
            j -= 1
            out.append(("insert", i, j, None, b[j]))
    return out[::-1]


def edit_audit(a: Column, b: Column) -> Column:
    """(edits, replaced, deleted, inserted) from one array of tokens to another."""

    @F.pandas_udf("edits array<struct<kind:string,i:int,j:int,old:string,new:string>>, replaced int, deleted int, inserted int")
    def udf(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = [edits(list(p) if p is not None else [], list(q) if q is not None else []) for p, q in zip(x, y, strict=True)]
        count = lambda r, kind: sum(e[0] == kind for e in r)
        return pd.DataFrame({"edits": [[dict(zip(("kind", "i", "j", "old", "new"), e, strict=True)) for e in r] for r in rows], **{name: [count(r, kind) for r in rows] for name, kind in (("replaced", "replace"), ("deleted", "delete"), ("inserted", "insert"))}})

    return udf(a, b)


# --- layout ----------------------------------------------------------------------------------


def shown(line: str) -> int:
    """Characters without tags."""
    return len(re.sub(TAGS, "", line))


def two_lines(words: Sequence[str], target: int, hard: int) -> tuple[str, str] | None:
    """The split into two lines of at most hard characters: least over target, then with the shortest longest line, then most even, then with the longer first line."""
    ranked = []
    for k in range(1, len(words)):
        pair = " ".join(words[:k]), " ".join(words[k:])
        a, b = map(shown, pair)
        if a <= hard and b <= hard:
            ranked.append((max(a - target, 0) + max(b - target, 0), max(a, b), abs(a - b), -a, k, pair))
    return min(ranked)[-1] if ranked else None


def wrapped(text: str, target: int = 42, most: int = 2, hard: int = 84) -> str | None:
    """Lines that the text brings itself stay; else one line up to target, or two. Null where a line is empty or no layout keeps to hard and most."""
    own = [re.sub(r"[ \t\f\v]+", " ", line).strip() for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    if not all(own) or len(own) > most or any(ord(c) < 32 and c not in "\n\r\t\f\v" for c in text):
        return None
    if len(own) > 1 or shown(own[0]) <= target or most == 1:
        return "\n".join(own) if all(shown(line) <= hard for line in own) else None
    pair = two_lines(own[0].split(" "), target, hard) if most == 2 else None
    return "\n".join(pair) if pair else None


def wrap_text(text: Column, target: int = 42, most: int = 2, hard: int = 84) -> Column:
    @F.pandas_udf("string")
    def udf(values: pd.Series) -> pd.Series:
        return values.map(lambda t: None if t is None else wrapped(t, target, most, hard))

    return udf(text)


def greedy_lines(text: Column, width: int = 42) -> Column:
    """Lines of words filled up to width; a longer word stands alone."""

    def step(acc: Column, w: Column) -> Column:
        last = F.element_at(acc, -1)
        return F.when(F.size(acc) == 0, F.array(w)).when(F.length(last) + 1 + F.length(w) <= width, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(last, F.lit(" "), w)))).otherwise(F.concat(acc, F.array(w)))

    return F.aggregate(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""), F.array().cast("array<string>"), step)


def joined_words(words: Column) -> Column:
    """Words as one text: those that begin with a space bring it themselves, others get one."""
    spaced = F.exists(words, lambda w: F.startswith(w, F.lit(" ")))
    return F.trim(F.when(spaced, F.array_join(words, "")).otherwise(F.array_join(words, " ")))


# --- repair ----------------------------------------------------------------------------------


def filled_words(tokens_wanted: Sequence[str], timed: Sequence[tuple[str, int, int]], start: int, end: int) -> list[tuple[str, int, int, bool]] | None:
    """Timed words with what the segment's tokens have besides, in evenly shared free time: (token, start, end, added).

    None where the timed words aren't an ordered part of the tokens, or time would run backwards.
    """
    at, places = 0, []
    for k, (word, _, _) in enumerate(timed):
        left = len(timed) - k - 1
        options = [i for i in range(at, len(tokens_wanted) - left) if tokens_wanted[i].casefold() == word.casefold()]
        if not options:
            return None
        exact = [i for i in options if tokens_wanted[i] == word]
        places.append((exact or options)[0])
        at = places[-1] + 1
    out: list[tuple[str, int, int, bool]] = []
    marks = [(-1, start, start), *[(p, s, e) for p, (_, s, e) in zip(places, timed, strict=True)], (len(tokens_wanted), end, end)]
    for (p, _, free), (q, stop, stop_end) in zip(marks, marks[1:], strict=False):
        n = q - p - 1
        room = max(stop - free, n)
        out += [(tokens_wanted[p + 1 + i], free + room * i // n, free + room * (i + 1) // n, True) for i in range(n)]
        if q < len(tokens_wanted):
            out.append((tokens_wanted[q], stop, stop_end, False))
    return None if any(b[1] < a[1] for a, b in zip(out, out[1:], strict=False)) else out


_dotted, _headless = re.compile(r"(?:[^\W\d_]\.){2,}"), re.compile(r"\.(?:[^\W\d_]\.)+")


def initialism_words(segment: str, words: Sequence[str]) -> list[str] | None:
    """words with the first letter back that an initialism with dots has lost, as in ".K." for "M.K."; None unless exactly one word lacks one, and all others are the segment's."""
    parts = segment.split()
    if len(parts) != len(words):
        return None
    plain = [unicodedata.normalize("NFKC", w).strip() for w in words]
    whole = [unicodedata.normalize("NFKC", p) for p in parts]
    differing = [k for k, (p, w) in enumerate(zip(whole, plain, strict=True)) if p.casefold() != w.casefold()]
    if len(differing) != 1:
        return None
    k = differing[0]
    letters = [re.sub(r"[\W\d_]", "", x).casefold() for x in (whole[k], plain[k])]
    if not (_dotted.fullmatch(whole[k]) and _headless.fullmatch(plain[k]) and letters[0][1:] == letters[1]):
        return None
    lead = words[k][: len(words[k]) - len(words[k].lstrip())]
    return [*words[:k], lead + parts[k], *words[k + 1 :]]


def repaired_initialisms(segment: Column, words: Column) -> Column:
    """initialism_words of columns; words that need no repair, or can't have it, stay null."""

    @F.pandas_udf("array<string>")
    def udf(s: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series([None if a is None or b is None else initialism_words(a, list(b)) for a, b in zip(s, w, strict=True)])

    return udf(segment, words)


def repair_omissions(wanted: Column, words: Column, start: Column, end: Column) -> Column:
    """filled_words of columns: wanted is an array of tokens, words an array of (token, start_ms, end_ms) structs."""

    @F.pandas_udf("array<struct<token:string,start_ms:bigint,end_ms:bigint,added:boolean>>")
    def udf(w: pd.Series, t: pd.Series, s: pd.Series, e: pd.Series) -> pd.Series:
        def one(a, b, c, d):
            found = filled_words(list(a), [(x["token"], x["start_ms"], x["end_ms"]) for x in b], c, d)
            return None if found is None else [dict(zip(("token", "start_ms", "end_ms", "added"), x, strict=True)) for x in found]

        return pd.Series([one(a, b, int(c), int(d)) for a, b, c, d in zip(w, t, s, e, strict=True)])

    return udf(wanted, words, start, end)
