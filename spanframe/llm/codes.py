"""Vectors as codes: each part of a vector becomes the number of the nearest entry of its codebook.

Components become integers, so equal parts are equal keys. Each position's parts
are grouped to distinct values with weights, Lloyd's rounds run over these alone,
and the codes and errors of the distinct values are joined back to the vectors.
Codebooks are all that the driver holds: their size is a matter of parameters.
Sums are integers, and so the result doesn't hang on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: A key with at least one of so many rows is joined by broadcast; there are at most so many such keys in each position.
HOT_SHARE = 1000


def usable(vector: Column) -> Column:
    """Neither null nor empty, and all components finite."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def saturation(width: int) -> int:
    """The largest integer of a component for which the squared distance of two vectors of width components fits 62 bits."""
    return min(2**30, int((2**62 / max(1, width)) ** 0.5) // 2)


def joined(rows: DataFrame, known: DataFrame, keys: Sequence[str], count: str, total: int) -> DataFrame:
    """rows joined with known by keys, null keys equal; known has a row a key and the number of rows that have it.

    Keys that hold one of HOT_SHARE rows or more are joined by broadcast, and there can't be many; the others by shuffle.
    """
    hot = known.filter(F.col(count) * HOT_SHARE >= total)
    rest = known.filter(F.col(count) * HOT_SHARE < total)
    same = lambda a, b: [a[k].eqNullSafe(b[f"__k_{k}"]) for k in keys]
    named = lambda df: df.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    out = []
    for side in (F.broadcast(named(hot)), named(rest)):
        on = same(rows, side)
        out.append(rows.join(side, on).drop(*[f"__k_{k}" for k in keys]))
    return out[0].unionByName(out[1])


def nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest entry, the lower of equal ones; squared distance) of each row, in 64-bit integers."""
    far = np.zeros((len(part), len(entries)), np.int64)
    for j in range(part.shape[1]):
        far += (part[:, j, None] - entries[None, :, j]) ** 2
    code = far.argmin(axis=1)
    return code, far[np.arange(len(part)), code]


def _by_position(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, its rows, their parts, codes, errors); a few thousand rows at a time."""
    for s in range(0, batch.num_rows, 8192):
        rows = batch.slice(s, 8192)
        pos = rows.column(0).to_numpy()
        part = np.asarray(rows.column(1).flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(pos), -1)
        for p in np.unique(pos):
            at = np.flatnonzero(pos == p)
            code, error = nearest(part[at], books[p])
            yield int(p), at + s, part[at], code, error


def codebooks(distinct: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """books (positions, entries, components) after rounds of weighted Lloyd over distinct (pos, part, n); entries that no part is nearest to stay."""

    def sums_of(books: np.ndarray):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, object)
            for batch in batches:
                weight = batch.column(2).to_numpy()
                for p, at, part, code, _ in _by_position(batch, books):
                    np.add.at(count[p], code, weight[at])
                    # 64 bits where the rows' sum can't exceed them, else Python's integers
                    small = int(np.abs(part).max()) * int(weight[at].sum()) < 2**62
                    here = np.zeros(books.shape[1:], np.int64 if small else object)
                    np.add.at(here, code, part.astype(here.dtype) * weight[at].astype(here.dtype)[:, None])
                    total[p] += here.astype(object)
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_pydict({
                "pos": pa.array(p.astype(np.int32)), "entry": pa.array(e.astype(np.int32)), "n": pa.array(count[p, e]),
                "sums": pa.array([[str(x) for x in total[a, b]] for a, b in zip(p, e, strict=True)], pa.list_(pa.string())),
            })

        return sums

    for _ in range(rounds):
        found = distinct.select("pos", "part", "n").mapInArrow(sums_of(books), "pos int, entry int, n bigint, sums array<string>")
        width = books.shape[2]
        # one row an entry: at most positions x entries
        rows = found.groupBy("pos", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(j)).cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)]).collect()
        books = books.copy()
        for r in rows:
            books[r["pos"], r["entry"]] = [int(r[f"s{j}"]) // r["n"] for j in range(width)]
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(per kept row: id_col, label_col, codes (array<int>, one a part), error, label_error; the codebooks).

    Rows with a null or empty vector, or one with a null or non-finite component,
    are dropped. The first kept row by id sets the width; rows of another width, and
    all rows if it is no multiple of parts, are dropped too. Codebooks start from
    the smallest ids, each once: of rows that share an id the smallest vector;
    a null id counts as the largest. Fewer ids make smaller codebooks. Integers
    saturate (see saturation). Repeated rows get the same codes each and count
    each in label_error, which is null where its sum exceeds a long. No kept
    rows give an empty result. Further columns are not read.
    """
    spark = rows.sparkSession
    v = F.col("v")
    kept = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")).filter(usable(v))
    order = [F.col("id").asc_nulls_last(), v.asc()]
    first = kept.orderBy(*order).limit(1).collect()
    width = len(first[0]["v"]) if first else 0
    label = rows.schema[label_col].dataType.simpleString()
    if width == 0 or width % parts:
        return spark.createDataFrame([], f"`{id_col}` bigint, `{label_col}` {label}, codes array<int>, error bigint, label_error bigint"), np.zeros((parts, 0, 0), np.int64)
    most = float(saturation(width))
    whole = F.transform(v, lambda x: F.least(F.lit(most), F.greatest(F.lit(-most), F.floor(SCALE * F.least(F.lit(most), F.greatest(F.lit(-most), x))).cast("double"))).cast("int"))
    numbered = written(kept.filter(F.size(v) == width).select("id", "label", whole.alias("q"), F.monotonically_increasing_id().alias("row")), "integers")
    # the start: a row an id, of which the smallest are taken
    start = numbered.groupBy("id").agg(F.min("q").alias("q")).orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()
    each = width // parts
    books = np.array([r["q"] for r in start], np.int64).reshape(len(start), parts, each).transpose(1, 0, 2)

    cut = numbered.select("row", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("q", p * each + 1, each))).alias("pos", "part"))
    distinct = written(cut.groupBy("pos", "part").agg(F.count("*").alias("n")), "parts")
    books = codebooks(distinct, books, rounds)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for _, at, _, c, e in _by_position(batch, books):
                code[at], error[at] = c, e
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code), pa.array(error)], names=["pos", "part", "n", "code", "error"])

    codes = written(distinct.mapInArrow(coded, "pos int, part array<int>, n bigint, code int, error bigint"), "codes")
    total = numbered.count()
    back = joined(cut, codes, ["pos", "part"], "n", total)
    per_row = back.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]).alias("codes"), F.sum("error").alias("error"))
    out = written(numbered.select("row", "id", "label").join(per_row, "row").drop("row"), "coded")
    sums = written(out.groupBy("label").agg(F.count("*").alias("__n"), F.sum(F.col("error").cast("decimal(38,0)")).alias("__sum")), "labels")
    longs = F.when(F.col("__sum") <= F.lit(2**63 - 1).cast("decimal(38,0)"), F.col("__sum")).cast("bigint")
    named = joined(out, sums, ["label"], "__n", total)
    return named.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "codes", "error", longs.alias("label_error")), books


def digests(found: DataFrame, books: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """Per row of compressed's result: id_col, code (two hex digits a part), error, label_error, codebooks_sha256."""
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return found.select(id_col, code.alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def _sql() -> str:
    assign = """
a{k} AS (
  SELECT pos, part, n, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.pos, p.part, p.n, b.entry, list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts p JOIN b{k} b ON p.pos = b.pos) GROUP BY pos, part, n),"""
    update = """
s{k} AS (SELECT pos, entry, j, sum(n * part[j])::HUGEINT AS s, sum(n)::HUGEINT AS n FROM a{k}, (SELECT unnest(range(1, 1 + (SELECT max(len(part)) FROM parts))) AS j) GROUP BY pos, entry, j),
u{k} AS (SELECT pos, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS part FROM s{k} GROUP BY pos, entry),
b{n} AS (SELECT b.pos, b.entry, coalesce(u.part, b.part) AS part FROM b{k} b LEFT JOIN u{k} u ON u.pos = b.pos AND u.entry = b.entry),"""
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER () AS row_no, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT row_no, pos, q[pos * len(q) // {PARTS} + 1:(pos + 1) * len(q) // {PARTS}] AS part FROM kept, (SELECT unnest(range(0, {PARTS})) AS pos)),
parts AS (SELECT pos, part, count(*) AS n FROM cut GROUP BY pos, part),
first_rows AS (SELECT row_no, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}),
b0 AS (SELECT pos, entry, part FROM cut JOIN first_rows USING (row_no)),{"".join((assign + update).format(k=k, n=k + 1) for k in range(ROUNDS))}{assign.format(k=ROUNDS)}
coded AS (
  SELECT row_no, string_agg(format('{{:02x}}', entry), '' ORDER BY pos) AS code, sum(d)::BIGINT AS error FROM cut JOIN a{ROUNDS} USING (pos, part) GROUP BY row_no),
books AS (
  SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (row_no), books
"""


OP11_SQL = _sql()
