"""Many names in texts: one automaton finds all of them in one pass, however many there are.

A name counts as a whole word or phrase, with one of the given suffixes behind it
perhaps. Names and variants are what a caller lists; texts and names are compared
as they are, so normalise both first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Finder:
    """Occurrences of phrases as whole words."""

    def __init__(self, phrases: Sequence[str], suffix: str | None = None):
        self.phrases = list(phrases)
        self.tail = re.compile(rf"(?:{suffix})?(?!\w)" if suffix else r"(?!\w)")
        self.automaton = ahocorasick.Automaton()
        by_phrase: dict[str, list[int]] = {}
        for k, p in enumerate(self.phrases):
            if p:
                by_phrase.setdefault(p, []).append(k)
        for p, which in by_phrase.items():
            self.automaton.add_word(p, (len(p), which))
        if by_phrase:
            self.automaton.make_automaton()
        self.suffix = suffix
        self.patterns: dict[int, re.Pattern] = {}

    def hits(self, text: str) -> Iterator[int]:
        """Numbers of phrases, once for each place."""
        if not len(self.automaton):
            return
        for last, (n, which) in self.automaton.iter(text):
            first = last + 1 - n
            before = text[first - 1] if first else " "
            if not (before.isalnum() or before == "_") and self.tail.match(text, last + 1):
                yield from which

    def replaced(self, text: str, k: int, by: str) -> str:
        """text with phrase k as another; a suffix stays."""
        if k not in self.patterns:
            self.patterns[k] = re.compile(rf"(?<!\w){re.escape(self.phrases[k])}(?P<s>{self.suffix})?(?!\w)" if self.suffix else rf"(?<!\w){re.escape(self.phrases[k])}(?P<s>)(?!\w)")
        return self.patterns[k].sub(lambda m: by + (m["s"] or ""), text)


class Variants:
    """Variants by name, in order: (name, its variants)."""

    def __init__(self, table: Sequence[tuple[str, Sequence[str]]], suffix: str | None = None):
        self.names = [name for name, _ in table]
        self.group = [g for g, (_, found) in enumerate(table) for _ in found]
        self.finder = Finder([v for _, found in table for v in found], suffix)

    def _from(self, text: str, least: int) -> int | None:
        return min((k for k in self.finder.hits(text) if k >= least), default=None)

    def replaced(self, text: str, group: int | None = None) -> str:
        """text with all variants, or those of one name, as their names: one variant after the other, in order."""
        k = -1
        while (k := self._from(text, k + 1) if group is None else min((x for x in self.finder.hits(text) if x > k and self.group[x] == group), default=None)) is not None:
            text = self.finder.replaced(text, k, self.names[self.group[k]])
        return text

    def readings(self, text: str) -> set[str]:
        """text, and all that come of replacing the variants of some names, in order. Only names that occur branch."""
        out, todo = set(), [(text, 0)]
        while todo:
            now, least = todo.pop()
            found = min((self.group[k] for k in self.finder.hits(now) if self.group[k] >= least), default=None)
            if found is None:
                out.add(now)
            else:
                todo.append((now, found + 1))
                other = self.replaced(now, found)
                if other != now:
                    todo.append((other, found + 1))
        return out


@lru_cache(maxsize=8)
def _finder(names: tuple[str, ...], suffix: str | None) -> Finder:
    return Finder(names, suffix)


@lru_cache(maxsize=8)
def _variants(table: tuple[tuple[str, tuple[str, ...]], ...], suffix: str | None) -> Variants:
    return Variants(table, suffix)


def _table(variants: Mapping[str, Sequence[str]]) -> tuple[tuple[str, tuple[str, ...]], ...]:
    return tuple((k, tuple(v)) for k, v in variants.items())


def names_in(text: Column, names: Sequence[str], suffix: str | None = None) -> Column:
    """Sorted names that stand in the text; null of a null text."""
    listed = tuple(sorted(set(names)))

    @F.pandas_udf("array<string>")
    def udf(values: pd.Series) -> pd.Series:
        finder = _finder(listed, suffix)
        return values.map(lambda t: None if t is None else [listed[k] for k in sorted(set(finder.hits(t)))])

    return udf(text)


def canonical(text: Column, variants: Mapping[str, Sequence[str]], suffix: str | None = None) -> Column:
    """The text with variants as their names."""
    table = _table(variants)

    @F.pandas_udf("string")
    def udf(values: pd.Series) -> pd.Series:
        found = _variants(table, suffix)
        return values.map(lambda t: None if t is None else found.replaced(t))

    return udf(text)


def readings_of(text: Column, required: Mapping[str, Sequence[str]], optional: Mapping[str, Sequence[str]], suffix: str | None = None) -> Column:
    """Sorted readings: required variants replaced, and any of the optional ones or not. A text has as many as its ambiguous names allow."""
    must, may = _table(required), _table(optional)

    @F.pandas_udf("array<string>")
    def udf(values: pd.Series) -> pd.Series:
        a, b = _variants(must, suffix), _variants(may, suffix)
        return values.map(lambda t: None if t is None else sorted(b.readings(a.replaced(t))))

    return udf(text)


def name_sets(text: Column, names: Sequence[str], required: Mapping[str, Sequence[str]], optional: Mapping[str, Sequence[str]], suffix: str | None = None) -> Column:
    """Sorted distinct sets of names that the text may mean: those of each reading, and these with those of the required reading."""
    listed, must, may = tuple(sorted(set(names))), _table(required), _table(optional)

    @F.pandas_udf("array<array<string>>")
    def udf(values: pd.Series) -> pd.Series:
        a, b, finder = _variants(must, suffix), _variants(may, suffix), _finder(listed, suffix)

        def sets(t: str) -> list[list[str]]:
            base = a.replaced(t)
            own = {listed[k] for k in finder.hits(base)}
            found = [{listed[k] for k in finder.hits(x)} for x in b.readings(base)]
            return sorted({tuple(sorted(s)) for f in found for s in (f, f | own)})

        return values.map(lambda t: None if t is None else [list(s) for s in sets(t)])

    return udf(text)
