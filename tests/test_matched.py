"""Similarity by shifts of one table against difflib's."""

import random
from difflib import SequenceMatcher

import pytest

from spanframe.functions import text
from spanframe.plans import queries


def pairs(n=1500):
    rng = random.Random(8)
    for _ in range(n):
        letters = rng.choice(["ab", "abcde ", "ölmnç e"])
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 70)))
        b = rng.choice([a[::-1], a[5:] + "x" + a[:5], "zzz", "".join(rng.choice(letters) for _ in range(rng.randrange(0, 70)))])
        yield a, b


def plain(a, b):
    return 1.0 if a == b else SequenceMatcher(None, a, b, autojunk=False).ratio()


def plain_blended(a, b):
    if not a or not b or a == b:
        return float(bool(a) and a == b)
    x, y = a.split(), b.split()
    chars, order = plain(a, b), plain(x, y)
    shared = sum(min(x.count(t), y.count(t)) for t in set(x))
    return max(0.65 * chars + 0.35 * 2 * shared / (len(x) + len(y)), 0.55 * order + 0.45 * chars)


def test_ratio(monkeypatch):
    for a, b in pairs():
        assert text.ratio(a, b) == plain(a, b)
        for bound in (0.0, 0.3, 0.55, 0.75, 1.0):
            assert text.below(a, b, bound) == (plain(a, b) < bound)
    monkeypatch.setattr(text, "TABLE_BITS", 100)
    assert all(text.ratio(a, b) == plain(a, b) for a, b in pairs(50))


def test_blended():
    clean = lambda t: " ".join(t.split())
    for a, b in ((clean(a), clean(b)) for a, b in pairs()):
        want = plain_blended(a, b)
        assert text.blended(a, b) == pytest.approx(want, abs=1e-12)
        for least in (0.4, 0.62):
            got = text.blended(a, b, least)
            assert got == pytest.approx(want, abs=1e-12) if got is not None else want < least


def test_matching_is_dealt_to_tasks(spark, sf_dir):
    """The rows are few bytes, so adaptive execution would join and match them in one task."""
    plan = queries.similar_turns(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
