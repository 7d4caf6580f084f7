import base64
import hashlib
import itertools
from array import array
from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken

from spanframe.llm import lines, mixing, quality, simhash
from spanframe.llm.common import written
from tests.llm.fixtures import documents, empty
from tests.llm.test_text_ops import brute_counts, plain_estimate, split


def test_stages_keep_columns_and_run_on_edge_cases(spark):
    for make in (documents, empty):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns, name
            docs = out
        last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
        assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == docs.count()


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and out.select("doc_id").distinct().count() <= spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert corpus_pipeline.run(spark, sf_dir).exceptAll(out).count() == 0


def test_registered_queries(spark, sf_dir):
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and "op1_line_dedup" in __spark_entry__.oracle_sql()


# --- every stage against a plain version on its own input


def plain_counts(t):
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = brute_counts(t)
    words, n = split(t), {}
    n["n_lines"] = len([x for x in (t or "").split("\n") if split(x)])
    for name, pattern in (("n_letters", r"\p{L}"), ("n_digits", r"\p{N}"), ("n_lower", r"[\p{Ll}\p{Lo}\p{Lm}]"), ("n_bangs", "!"), ("n_ends", "[.?!。？！]")):
        n[name] = len(regex.findall(pattern, t or ""))
    bare = len([w for w in words if not regex.search(r"[\p{L}\p{N}]", w)])
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words, "n_distinct": len(set(words)), "n_bare": bare, "n_alnum": n["n_letters"] + n["n_digits"], **n}


def plain_votes(n):
    out = []
    for _, what, bad_below, good_from, good_to, bad_above in quality.RULES:
        over, under = (eval(x, {}, n) for x in what.split(" / "))  # noqa: S307 the rules' own sums
        value = over / under
        bad = bad_below is not None and value < bad_below or bad_above is not None and value > bad_above
        good = (good_from is None or value >= good_from) and (good_to is None or value <= good_to)
        out.append(0 if not n["n_words"] else -1 if bad else 1 if good else 0)
    return tuple(out)


def plain_passing(docs):
    counts = [plain_counts(r["text"]) for r in docs]
    failed = [n["n_words"] < 1 or 2 * n["n_repeat_words"] > n["n_words"] for n in counts]
    votes = [plain_votes(n) for n in counts]
    found = plain_estimate(sorted(Counter(v for v, f in zip(votes, failed, strict=True) if not f).items()), 500)
    return Counter(r["doc_id"] for r, v, f in zip(docs, votes, failed, strict=True) if not f and found[v] >= 0)


def plain_groups(docs):
    """The smallest doc_id of each group of texts that pairs of a similarity of 0.8 or more connect."""
    sets = [simhash.shingle_set(r["text"], 5) for r in docs]
    root = list(range(len(docs)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(docs)), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small >= 0.8 * large and simhash.jaccard(sets[a], sets[b]) >= 0.8:
            root[max(top(a), top(b), key=lambda k: docs[k]["doc_id"])] = min(top(a), top(b), key=lambda k: docs[k]["doc_id"])
    return Counter(docs[k]["doc_id"] for k in range(len(docs)) if root[k] == k)


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = [r.asDict() for r in docs.collect()]
    ids = lambda rows: Counter(r["doc_id"] for r in rows)
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), "plain")
        after = [r.asDict() for r in out.collect()]
        con = duckdb.connect()
        con.register("documents", pa.Table.from_pylist(before))
        if name == "quality_rules":
            assert ids(after) == plain_passing(before) and 0 < len(after) < len(before)
        elif name == "line_dedup":
            want = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, kept_sha256 FROM ({lines.OP1_SQL})").fetchall()}
            assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in after} == want and all(r["n_chars"] == len(r["text"]) for r in after)
            assert sum(r["n_chars"] for r in after) < sum(r["n_chars"] for r in before)
        elif name == "simhash_near_dedup":
            assert ids(after) == plain_groups(before) and len(after) < len(before)
        elif name == "source_mixing":
            want = con.execute(f"SELECT doc_id, taken, size FROM ({mixing.OP5_SQL})").fetchall()
            assert all(ids(after)[i] == taken // size for i, taken, size in want if size) and set(ids(after)) <= set(ids(before))
        else:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
            library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            coded = {r["doc_id"]: library.encode_ordinary(r["text"]) for r in before}
            sha = lambda b: hashlib.sha256(b).hexdigest()
            want = Counter((r["doc_id"], len(x := coded[r["doc_id"]]), sha(array("I", x).tobytes()), sha(r["text"].encode())) for r in before)
            assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after) == want
        docs, before = out, after
