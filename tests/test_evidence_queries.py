"""Names, repairs, numbered rows and remembered units against plain versions."""

import inspect
import random
import re

import pytest
from pyspark.sql import functions as F

from spanframe.functions import names, text
from spanframe.plans import contracts, evidence_queries, queries
from spanframe.streaming import memory
from tests.test_plain_versions import collected, turns  # noqa: F401


def form(phrase, suffix=None):
    return rf"(?<!\w){re.escape(phrase)}(?P<s>{suffix or ''})?(?!\w)"


def plain_canonical(t, variants, suffix=None):
    for name, found in variants.items():
        for v in found:
            t = re.sub(form(v, suffix), lambda m, name=name: name + (m["s"] or ""), t)
    return t


def plain_readings(t, required, optional, suffix=None):
    found = {plain_canonical(t, required, suffix)}
    for name, variants in optional.items():
        found |= {plain_canonical(x, {name: variants}, suffix) for x in found}
    return sorted(found)


def plain_names(t, listed, suffix=None):
    return {n for n in listed if re.search(form(n, suffix), t)}


def plain_sets(t, listed, required, optional, suffix=None):
    base = plain_names(plain_canonical(t, required, suffix), listed, suffix)
    return sorted({tuple(sorted(s)) for x in plain_readings(t, required, optional, suffix) for n in [plain_names(x, listed, suffix)] for s in (n, n | base)})


def test_name_sets_conversations(spark, sf_dir, turns):  # noqa: F811
    own, required, optional = evidence_queries.variant_tables(evidence_queries.listed_names(spark, sf_dir, 300))
    got = {(r["conv_id"], r["turn"]): (r["canonical"], r["readings"], r["sets"]) for r in collected(spark, sf_dir, "name_sets_conversations")}
    several = 0
    for r in turns:
        t = r["text"]
        found = plain_readings(t, required, optional)
        several += len(found) > 1
        assert got[r["conv_id"], r["turn"]] == (plain_canonical(t, required), "\n".join(found), "|".join(",".join(s) for s in plain_sets(t, own, required, optional)))
    assert several > 5


def test_readings_follow_the_definition():
    """Variants that hold each other, names that are variants of others, suffixes, repeats."""
    rng = random.Random(3)
    vocabulary = ["ali", "ali can", "can", "veli", "vel", "ay", "aye", "a"]
    for _ in range(400):
        t = rng.choice([" ", "'"]).join(rng.choice([*vocabulary, "alinin", "x_ali", "ali'nin", "vel,"]) for _ in range(rng.randint(0, 6)))
        pick = lambda: {rng.choice(vocabulary): rng.sample(vocabulary, rng.randint(1, 2)) for _ in range(rng.randint(0, 3))}
        required, optional, suffix = pick(), pick(), rng.choice([None, "nin|'nin"])
        a, b = (names.Variants(names._table(x), suffix) for x in (required, optional))
        assert a.replaced(t) == plain_canonical(t, required, suffix)
        assert sorted(b.readings(a.replaced(t))) == plain_readings(t, required, optional, suffix)
        assert {vocabulary[k] for k in names.Finder(vocabulary, suffix).hits(t)} == plain_names(t, vocabulary, suffix)


def test_a_thousand_names(spark):
    listed = [f"name{k}" for k in range(1000)] + [""]
    frame = spark.createDataFrame([("name7 and name999, not name1000 or xname3",), (None,), ("",)], "t string")
    assert [r[0] for r in frame.select(names.names_in(F.col("t"), listed)).collect()] == [["name7", "name999"], None, []]
    assert frame.select(names.names_in(F.col("t"), [])).first()[0] == []


def test_initialisms():
    assert text.initialism_words("the M.K. said", ["the", " .K.", "said"]) == ["the", " M.K.", "said"]
    assert text.initialism_words("Ｍ.K.", [".k."]) == ["Ｍ.K."]
    for words in (["the", "M.K.", "said"], ["the", ".R.", "said"], ["the", "K.", "said"], ["the", ".K."], ["a", ".K.", "said"]):
        assert text.initialism_words("the M.K. said", words) is None


@pytest.mark.parametrize("name", ["sourced_batches_orders", "return_issues_supplier", "carried_edits_part", "relation_digest_nation", "lock_issues_orders"])
def test_no_relation_in_one_task(spark, sf_dir, name):
    """Rows are numbered by ranges; what meets in one partition is a row a range."""
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window" in line and "row_number" in line:
            assert "__range" in line or "windowspecdefinition([" not in line, line


def test_sourced_numbers_over_parts(spark):
    parts = {"b": spark.range(5), "a": spark.range(10, 17), "c": spark.range(0)}
    got = sorted((r["position"], r["part"], r["line"], r["id"]) for r in contracts.sourced(parts, ["id"]).collect())
    want = [("a", k + 1, 10 + k) for k in range(7)] + [("b", k + 1, k) for k in range(5)]
    assert got == [(p, *w) for p, w in enumerate(want)]


def test_memory_outlives_a_restart(spark, tmp_path):
    """A second run with the same checkpoint reuses what the first has computed; another binding doesn't; calls stay charged."""
    source, kind = tmp_path / "in", "u string, i int, input string"

    def run(rows, bound="b", name="one", most=1 << 30):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(kind).parquet(str(source))
        found = memory.remembered(stream, ["u"], "i", bound, str.upper, most)
        return {(r["u"], r["i"]): (r["result"], r["state"]) for r in memory.drained(found, str(tmp_path / f"out-{name}"), str(tmp_path / f"cp-{name}")).collect()}

    first = run([("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, "x")])
    assert first == {("a", 1): ("X", "computed"), ("a", 2): ("X", "reused"), ("a", 3): ("Y", "computed"), ("b", 1): ("X", "computed")}
    second = run([("a", 4, "y"), ("b", 2, "z"), ("c", 1, "x")])
    assert {k: v for k, v in second.items() if k not in first} == {("a", 4): ("Y", "reused"), ("b", 2): ("Z", "computed"), ("c", 1): ("X", "computed")}
    assert {k: second[k] for k in first} == first  # nothing was done twice
    third = run([("a", 5, "y")], bound="other")
    assert third["a", 5] == ("Y", "computed")
    charged = run([("d", 1, "p"), ("d", 2, "q"), ("d", 3, "q"), ("d", 4, "r")], name="few", most=2)
    assert [charged["d", k] for k in (1, 2, 3, 4)] == [("P", "computed"), ("Q", "computed"), ("Q", "reused"), (None, "refused")]


#: Queries that are about a first few: a top-k report, a next part, a list of names that is an argument.
REPORTS = {"next_part_users"}


def test_queries_read_whole_tables():
    """No registered query of the core cuts rows or texts."""
    for name, f in queries.QUERIES.items():
        code = inspect.getsource(f)
        if name not in REPORTS:
            assert not re.search(r"\.limit\(|\.sample\(|F\.substring\(\"text\"|F\.slice\(words", code), name
