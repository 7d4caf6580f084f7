"""Substring dedup: repeated windows of words, by a compacted De Bruijn graph.

A window of WINDOW words is removed wherever its words also start anywhere else.
Windows are the edges of a De Bruijn graph over the corpus. Writing down every
edge would cost many times the text, so they are kept compacted from the start:
of each window the least hash of its ANCHOR-word runs is its anchor, and
neighbouring windows with the same anchor make one path. Equal windows have equal
anchors, hence only paths of one anchor need comparing. With Spark joins:

1. An anchor that occurs once: none of its windows repeats. One that occurs more
   often, always in the same path, doesn't branch: all its windows repeat.
2. Where paths of one anchor differ, those that occur twice or more repeat whole.
3. What is left, paths that occur once beside others, are the ends of repeated
   spans and the places of edits. There one source coordinate of each path is read
   again, and its windows are compared one by one.

Anchors only bring together what may be equal. Whether paths and windows are equal
is told from their words: by the 128-bit BLAKE2 digest of their bytes, taken where
they stand in the text. A text that repeats itself at once gives one row for the
run of its equal paths, and one for each distinct window. All groups are aggregated
before they are moved, and a document's spans are gathered only with that document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import partitions, words_of, written

WINDOW = 35
ANCHOR = 12
#: Bytes of text whose words are hashed together.
CHUNK_BYTES = 1 << 20

#: A span is start << SPAN_BITS | number of windows, both in words.
SPAN_BITS = 31
_SPAN = (1 << SPAN_BITS) - 1
_U = np.uint64
SEED = 0x5EED


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """Words of a few documents; cuts says where each document's begin."""

    def __init__(self, texts: list[str | None]):
        each = [words_of(t) for t in texts]
        self.cuts = np.concatenate(([0], np.cumsum([len(w) for w in each], dtype=np.int64)))
        self.all = [w for words in each for w in words]
        self.n = len(self.all)
        self.joined = b" ".join(self.all)
        self.ends = np.cumsum(np.fromiter(map(len, self.all), np.int64, self.n) + 1)

    def anchors(self, length: int) -> np.ndarray:
        """Hashes of all runs of length words, by doubling runs of XXH64 hashes of words."""
        of = xxhash.xxh64_intdigest
        power = np.fromiter((of(w, SEED) for w in self.all), np.uint64, self.n)
        out, held, size = None, 0, 1  # out: hashes of runs of held words
        while True:
            if length & size:
                k = self.n - held - size + 1
                out = power if out is None else _mix(out[:k] * _U(0x9E3779B97F4A7C15) + power[held : held + k])
                held += size
            if held == length:
                return out[: self.n - length + 1]
            k = self.n - 2 * size + 1
            power = _mix(power[:k] * _U(0xD1342543DE82EF95) + power[size : size + k])
            size *= 2

    def digests(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """(n, 2) signed halves of the 128-bit digests of count words from start on, joined by spaces."""
        begin = np.where(start > 0, self.ends[start - 1], 0)
        end = self.ends[start + count - 1] - 1
        joined, made = memoryview(self.joined), hashlib.blake2b
        return np.frombuffer(b"".join([made(joined[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]), "<i8").reshape(-1, 2)


def paths(texts: list[str | None], window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(text, start word in it, windows, times, anchor hash, digest) of every path: neighbouring windows with one anchor. Equal paths that follow each other are one row, times says how many."""
    h = Words(texts)
    if h.n < window:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64), np.zeros((0, 2), np.int64))
    grams = h.anchors(anchor)
    wide = window - anchor + 1
    at = np.arange(h.n - window + 1)
    low, where = grams[: len(at)].copy(), at.copy()
    for k in range(1, wide):  # the leftmost least
        g = grams[k : k + len(at)]
        less = g < low
        np.copyto(low, g, where=less)
        np.copyto(where, at + k, where=less)
    doc = np.searchsorted(h.cuts, at, side="right") - 1
    ok = at + window <= h.cuts[doc + 1]
    new = np.concatenate(([True], (where[1:] != where[:-1]) | (doc[1:] != doc[:-1]) | ~ok[:-1])) & ok
    begin = np.flatnonzero(new)
    stop = np.flatnonzero(ok & np.concatenate((new[1:] | ~ok[1:], [True])))
    count = stop - begin + 1
    if not len(begin):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64), np.zeros((0, 2), np.int64))
    digest = h.digests(begin, count + window - 1)
    head = np.concatenate(([True], (doc[begin[1:]] != doc[begin[:-1]]) | (begin[1:] != begin[:-1] + count[:-1]) | (digest[1:] != digest[:-1]).any(axis=1)))
    first = np.flatnonzero(head)
    times = np.diff(np.append(first, len(head)))
    b = begin[first]
    return doc[b], b - h.cuts[doc[b]], count[first] * times, times, low[b], digest[first]


def _few(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with about CHUNK_BYTES of text."""
    begin, size = 0, 0
    for i, t in enumerate(batch.column(column)):
        size += len(t.as_buffer() or b"") if t.is_valid else 0
        if size >= CHUNK_BYTES:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < batch.num_rows:
        yield begin, batch.num_rows


def repeated_spans(rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, dealt: DataFrame | None = None) -> DataFrame:
    """rows: (doc, tie, text, ...), doc and tie never null. (doc, tie, span): windows that also start elsewhere; a span is start << SPAN_BITS | windows from there on.

    Null texts and those under a window have no spans. Rows of one doc and tie
    are one document. dealt: rows partitioned by doc and tie, if the caller has
    them so.
    """
    if not anchor < window < 256:
        raise ValueError("a window has more words than an anchor, and under 256")

    def all_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, e in _few(batch, 2):
                text, start, count, times, low, digest = paths(batch.column(2).slice(b, e - b).to_pylist(), window, anchor)
                row = pa.array(text + b)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(start << SPAN_BITS | count, pa.int64()), pa.array(times, pa.int64()), pa.array(low.view(np.int64)), pa.array(digest[:, 0]), pa.array(digest[:, 1])],
                    names=["doc", "tie", "span", "times", "anchor", "p", "q"],
                )

    path = ["anchor", "p", "q"]
    found = rows.select("doc", "tie", "text").mapInArrow(all_paths, "doc bigint, tie int, span bigint, times bigint, anchor bigint, p bigint, q bigint")
    bounds = [f(c).alias(f"{c}{k}") for c in "pq" for k, f in enumerate((F.min, F.max))]
    twice = found.groupBy("anchor").agg(F.sum("times").alias("n"), *bounds).filter("n > 1")
    # written, so that no aggregation stands in the stage of the join: then Spark can split the paths of a frequent anchor
    twice = written(twice.select("anchor", F.expr("p0 = p1 AND q0 = q1").alias("single")), "anchors")
    # written, since three branches read it with other columns each, which would else be three exchanges of all paths
    at_twice = written(found.join(twice, "anchor"), "paths")
    straight = at_twice.filter("single").select("doc", "tie", "span")
    branching = at_twice.filter("NOT single").drop("single")
    branches = branching.groupBy(*path).agg(F.sum("times").alias("n"), F.min(F.struct("doc", "tie", "span", "times")).alias("at"))
    whole = branching.join(branches.filter("n > 1").select(*path), path, "left_semi").select("doc", "tie", "span")
    unsure = branches.groupBy("anchor").agg(F.min("n").alias("least")).filter("least = 1").select("anchor")
    asked = branches.join(unsure, "anchor", "left_semi").select("at.*", "anchor", (F.col("n") == 1).alias("once"))
    by_doc = asked.groupBy("doc", "tie").agg(F.collect_list(F.struct("anchor", "span", "times", "once")).alias("asked"))  # no more than the document has words
    source = rows if dealt is None else dealt
    # every column goes along, so that this is the same exchange of texts that the caller joins the spans with
    read = source.join(by_doc, ["doc", "tie"]).select("doc", "tie", "text", "asked", *[c for c in rows.columns if c not in ("doc", "tie", "text")])

    def all_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, e in _few(batch, 2):
                h = Words(batch.column(2).slice(b, e - b).to_pylist())
                lists = batch.column(3).slice(b, e - b)
                sizes = lists.value_lengths().to_numpy()
                flat = lists.flatten()
                low, span, times, once = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                text = np.repeat(np.arange(e - b), sizes)
                count = (span & _SPAN) // np.maximum(times, 1)  # of equal paths one is enough: they aren't once
                k = np.repeat(np.arange(len(span)), count)
                at = (span >> SPAN_BITS)[k] + np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
                digest = h.digests(h.cuts[text[k]] + at, np.full(len(k), window)) if len(k) else np.zeros((0, 2), np.int64)
                # one row for each distinct window of a text
                keys, first, group = np.unique(np.column_stack((text[k], digest)), axis=0, return_index=True, return_inverse=True) if len(k) else (np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
                order = np.argsort(group.reshape(-1), kind="stable")
                order = order[once[k][order]]
                held = np.bincount(group.reshape(-1)[order], minlength=len(keys))
                spans = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(held))), pa.int32()), pa.array((at << SPAN_BITS | 1)[order], pa.int64()))
                n = np.bincount(group.reshape(-1), minlength=len(keys))
                row = pa.array(keys[:, 0] + b)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), spans, pa.array(n, pa.int64()), pa.array(low[k[first]], pa.int64()), pa.array(keys[:, 1]), pa.array(keys[:, 2])], names=["doc", "tie", "spans", "n", "anchor", "p", "q"])

    windows = read.mapInArrow(all_windows, "doc bigint, tie int, spans array<bigint>, n bigint, anchor bigint, p bigint, q bigint")
    shared = windows.groupBy(*path).agg(F.sum("n").alias("n")).filter("n > 1").select(*path)
    ends = windows.filter(F.size("spans") > 0).join(shared, path, "left_semi").select("doc", "tie", F.explode("spans").alias("span"))
    return straight.unionByName(whole).unionByName(ends)


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Per row of docs: id_col, n_words, n_removed, kept_sha256, and with keep_text also kept: the words left, joined by a space.

    Null texts have no words. Rows that repeat an id are documents of their own:
    each is elsewhere to the other, so copies lose all windows, however many
    there are. Rows without an id are treated alike, with a null id. An empty
    table gives an empty result. Further columns are not read.
    """
    text = F.col(text_col).cast("string")
    # rows are told apart by a hash of id and text and another of the text; texts are dealt out once, for both joins
    rows = docs.select(F.xxhash64(F.col(id_col), text).alias("doc"), F.hash(text).alias("tie"), text.alias("text"), F.col(id_col).cast("bigint").alias("id"))
    dealt = rows.repartition(partitions(docs.sparkSession), "doc", "tie")
    spans = repeated_spans(rows, window, dealt=dealt).groupBy("doc", "tie").agg(F.collect_list("span").alias("spans"))
    both = dealt.join(spans, ["doc", "tie"], "left").select("id", "text", "spans", "tie", "doc")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests, texts = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = words_of(text.as_py())
                n_words.append(len(words))
                if spans.is_valid and words:
                    span = spans.values.to_numpy()
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, span >> SPAN_BITS, 1)
                    np.add.at(cover, (span >> SPAN_BITS) + (span & _SPAN) + window - 1, -1)
                    left = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
                    words = [words[i] for i in left.tolist()]
                n_removed.append(n_words[-1] - len(words))
                joined = b" ".join(words)
                digests.append(hashlib.sha256(joined).hexdigest())
                if keep_text:
                    texts.append(joined)
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            if keep_text:
                columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "n_removed", "kept_sha256", "kept"][: len(columns)])

    return both.mapInArrow(kept, f"{id_col} bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * keep_text)
