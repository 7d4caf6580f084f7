"""Passages of a benchmark in documents: Wu-Manber search over words.

A pattern is a window of consecutive words of an item; an item of fewer words is
a pattern of its own length. Patterns of one length m share a table of shifts: a
block of two words that stands nowhere in them lets the search go on m - 1 words
later, one that stands j words before a pattern's end j words later. At shift 0 the
block is a pattern's end: its bucket, keyed by the pattern's first words as well,
has the patterns to compare, word for word.

Items are cut into overlapping pieces, so that a long one has no more weight than
many short ones, and pieces are dealt to blocks of a bounded number of words. A
task holds one block's tables. One block, the usual case, needs no shuffle;
more of them read the documents once each and their hits are united by document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import written

#: Words of a window.
WINDOW = 10
#: Windows of a piece of an item, and words of the pieces that one task holds at about: some 100 bytes of memory each.
PIECE_WINDOWS, BLOCK_WORDS = 1000, 500_000

#: What isn't part of a word: the ASCII characters that are neither digits nor letters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_plain = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, with A-Z in lower case."""
    return text.translate(_plain).split() if text else []


def word_array(text: Column) -> Column:
    """words_of inside the JVM; null has no words."""
    return F.filter(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BREAKS), lambda w: w != "")


class Patterns:
    """Tables of the patterns of one length m."""

    def __init__(self, m: int):
        self.m, self.block = m, min(2, m)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[int]]]]] = defaultdict(dict)

    def add(self, words: list[bytes], item: int) -> None:
        """All windows of words as patterns of item."""
        m, b, seen = self.m, self.block, set()
        if len(words) < m:
            return
        for i in range(b - 1, len(words)):
            end = tuple(words[i - b + 1 : i + 1])
            self.shift[end] = min(self.shift.get(end, m), max(0, m - 1 - i))
            if i < m - 1:
                continue
            window = tuple(words[i - m + 1 : i + 1])
            if window in seen:
                continue
            seen.add(window)
            same = self.buckets[end].setdefault(window[:b], [])
            for known, items in same:
                if known == window:
                    if items[-1] != item:
                        items.append(item)
                    break
            else:
                same.append((window, [item]))

    def found(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(start, items) of each occurrence, by start."""
        m, b, n = self.m, self.block, len(words)
        shift, buckets, skip, at = self.shift.get, self.buckets, m - b + 1, m - 1
        while at < n:
            end = (words[at - 1], words[at]) if b == 2 else (words[at],)
            far = shift(end, skip)
            if far:
                at += far
                continue
            start = at - m + 1
            for window, items in buckets[end].get(tuple(words[start : start + b]), ()):
                if tuple(words[start : at + 1]) == window:
                    yield start, items
                    break
            at += 1


class Searcher:
    """Pieces (item number, words joined by spaces) of a block, searched in documents."""

    def __init__(self, pieces: Iterable[tuple[int, bytes]], window: int = WINDOW):
        same: dict[bytes, bytes] = {}
        self.by_length: dict[int, Patterns] = {}
        for item, joined in pieces:
            words = [same.setdefault(w, w) for w in joined.split()]
            m = min(window, len(words))
            if m:
                self.by_length.setdefault(m, Patterns(m)).add(words, item)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[int]]:
        """(united runs of hit words as (start, end), numbers of the items found)."""
        spans, items = [], set()
        for m, patterns in self.by_length.items():
            for start, which in patterns.found(words):
                items.update(which)
                if spans and spans[-1][0] <= start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(spans[-1][1], start + m))
                else:
                    spans.append((start, start + m))
        runs: list[tuple[int, int]] = []
        for start, end in sorted(spans):
            if runs and start <= runs[-1][1]:
                runs[-1] = (runs[-1][0], max(runs[-1][1], end))
            else:
                runs.append((start, end))
        return runs, sorted(items)


def pieces_of(items: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text", piece_windows: int = PIECE_WINDOWS) -> DataFrame:
    """(item string, piece string, n_words): the items' words in overlapping pieces, which have the same windows; no piece twice."""
    cut = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), word_array(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - window), F.lit(piece_windows))
    pieces = cut.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s + 1, piece_windows + window - 1))).alias("p"))
    return pieces.select("item", F.array_join("p", " ").alias("piece"), F.size("p").alias("n_words")).distinct()


RUNS = "array<struct<start:int,end:int>>"


def _search(docs: DataFrame, block: list[tuple[str, str]], window: int, keys: str, all_rows: bool) -> DataFrame:
    """docs: key columns and the text as binary, last. Gives the keys, n_words, runs, items; without all_rows only of documents that are hit."""
    names = sorted({i for i, _ in block})
    number = {i: k for k, i in enumerate(names)}
    tables = docs.sparkSession.sparkContext.broadcast((names, [(number[i], p.encode("utf-8", "surrogatepass")) for i, p in block]))
    run_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, pieces = tables.value
        searcher = Searcher(pieces, window)
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                counts, runs, items = [], [], []
                for text in part.column(part.num_columns - 1):
                    words = words_of(text.as_py())
                    r, i = searcher.hits(words)
                    counts.append(len(words))
                    runs.append([{"start": a, "end": b} for a, b in r])
                    items.append([names[k] for k in i])
                out = pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(counts, pa.int64()), pa.array(runs, run_type), pa.array(items, pa.list_(pa.string()))],
                    names=[*part.schema.names[:-1], "n_words", "runs", "items"],
                )
                yield out if all_rows else out.filter(pa.array([bool(r) for r in runs], pa.bool_()))

    return docs.mapInArrow(search, f"{keys}, n_words bigint, runs {RUNS}, items array<string>")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of docs: row (a struct of its columns), n_words, runs (hit words as half-open runs of word numbers), items (sorted ids, as strings).

    Null and empty texts have no words and no hits; an item without words finds
    nothing, one without an id counts under the empty string; rows that repeat
    an item's id count once. Repeated documents get the same result each. Empty
    documents give an empty result, an empty benchmark rows without hits.
    Columns of docs stay inside the struct, so names can't clash.
    """
    spark = docs.sparkSession
    pieces = written(pieces_of(items, window, item_col, item_text_col), "benchmark")
    total = pieces.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))
    row, text = F.struct(*docs.columns).alias("row"), F.col(text_col).cast("string").cast("binary").alias("__text")

    def block(k: int) -> list[tuple[str, str]]:
        """Pieces dealt by a hash; of a bounded number of words, as pieces are short."""
        return sorted(map(tuple, pieces.filter(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)) == k).select("item", "piece").collect()))

    if blocks == 1:
        slim = docs.select(row, text)
        return _search(slim, block(0), window, f"row {slim.schema['row'].dataType.simpleString()}", True)
    whole = written(docs.select(row, F.monotonically_increasing_id().alias("__row"), text), "searched")
    hits = [written(_search(whole.select("__row", "__text"), block(k), window, "__row bigint", False), "hits") for k in range(blocks)]
    found = hits[0]
    for more in hits[1:]:
        found = found.unionByName(more)
    found = found.groupBy("__row").agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("r"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    closes = lambda done, r: F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.get(done, F.size(done) - 1)["start"].alias("start"), F.greatest(F.get(done, F.size(done) - 1)["end"], r["end"]).alias("end"))))
    united = F.aggregate("r", F.array().cast(RUNS), lambda done, r: F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= r["start"]), closes(done, r)).otherwise(F.concat(done, F.array(r))))
    joined = whole.select("row", "__row", F.size(word_array(F.col("__text").cast("string"))).cast("bigint").alias("n_words")).join(found.select("__row", united.alias("runs"), "items"), "__row", "left")
    return joined.select("row", "n_words", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of docs without any hit, with their own columns; nulls, repeats and empty tables as in contaminated."""
    return contaminated(docs, items, **options).filter(F.size("runs") == 0).select("row.*")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of contaminated's result: id_col, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, r: a + (r["end"] - r["start"]))
    return found.select(F.col(f"row.{id_col}").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256")).withColumn("contaminated", F.col("n_hit") > 0)


OP12_SQL = r"""
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS pattern
  FROM (SELECT item, w, least(10, len(w)) AS m, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)),
windows AS (
  SELECT row_no, i, m, array_to_string(w[i:i + m - 1], ' ') AS pattern
  FROM (SELECT row_no, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM cut JOIN (SELECT DISTINCT m FROM patterns) ON len(w) >= m)),
hits AS (SELECT row_no, i, m, item FROM windows JOIN patterns USING (m, pattern)),
hit_words AS (SELECT row_no, count(DISTINCT word_no) AS n_hit FROM (SELECT row_no, unnest(range(i, i + m)) AS word_no FROM (SELECT DISTINCT row_no, i, m FROM hits)) GROUP BY row_no),
hit_items AS (SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT row_no, item FROM hits) GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN hit_words USING (row_no) LEFT JOIN hit_items USING (row_no)
"""
