"""Near-duplicate vectors by cosine: spherical k-means cells, blocked products inside cells.

A vector's home is the cell whose centroid it is nearest to. It is also put into
every cell whose border it is near enough to: if u is the unit vector from the
other centroid to its own, its product with u is at most sqrt((1 - t) / 2). Two
vectors of cosine t or more are at most sqrt(2 (1 - t)) apart, and a border between
their homes has one on each side, so one of them is within half of that of the
border: every link is found, whatever the centroids are. Only the number of
cells that a vector is put into depends on the data.

Equal vectors are compared once and counted by their number. Vectors are packed
in blocks of whole cells, at most about BLOCK_ROWS of them, a row a block; blocks
meet as a Cartesian product of that small table with itself, so no copy of a
vector is shuffled for the cells that it visits. A task works out which vectors
visit which cells of the other block, multiplies those in single precision, looks
again at what is next to the threshold in double, and returns a count for each
vector and a forest of its links, so groups of any size stay bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from spanframe.llm.common import written
from spanframe.llm.components import connected_components, forest

#: Vectors of the sample that centroids are fitted on, at most about so many; chosen by a hash of the vector.
SAMPLE_ROWS = 20_000
#: Distinct vectors for which there is one cell, and the most cells.
CELL_ROWS, MOST_CELLS = 500, 2048
#: Vectors of a block at most, about, and the least number of blocks of a table that isn't small.
BLOCK_ROWS, LEAST_BLOCKS = 16_384, 24
#: Products looked at at once.
PRODUCTS = 1 << 20
ROUNDS = 8


def spherical_kmeans(points: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors. Cells that lose all their vectors keep their centroid."""
    rng = np.random.default_rng(seed)
    centroids = points[np.sort(rng.choice(len(points), min(cells, len(points)), replace=False))].copy()
    for _ in range(rounds):
        home = np.concatenate([np.argmax(points[s : s + 4096] @ centroids.T, axis=1) for s in range(0, len(points), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, points)
        norm = np.linalg.norm(sums, axis=1)
        ok = norm > 1e-9
        centroids[ok] = sums[ok] / norm[ok, None]
    return np.unique(centroids, axis=0)


def _matrix(column) -> np.ndarray:
    """Rows of a list column of equal lengths as doubles."""
    n = len(column)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _numbers(rows: DataFrame, vector_col: str) -> Column:
    """The vector as doubles; floats stay floats, which are half as large and the same numbers."""
    return F.col(vector_col) if rows.schema[vector_col].dataType == ArrayType(FloatType()) else F.col(vector_col).cast("array<double>")


def distinct_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(v, rep, n): each usable vector once, with its smallest id and its number of rows."""
    v = _numbers(rows, vector_col)
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return rows.filter(usable & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))


def near_vectors(rows: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: id_col, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold a null, NaN or infinite
    component, and rows without an id, link with nothing: n_links 0, themselves
    as component. Vectors of different lengths never link. Repeated rows of one
    vector link with each other, so they count in n_links; rows that also share
    their id get the same result each. An empty table gives an empty result.
    Further columns are not read.
    """
    spark = rows.sparkSession
    own = rows.select(F.col(id_col).cast("bigint").alias(id_col), _numbers(rows, vector_col).alias("v"))
    groups = written(distinct_vectors(rows, id_col, vector_col), "vectors")
    sizes = groups.groupBy(F.size("v").alias("width")).count().collect()  # a row for each length of vectors
    edges, counts = spark.createDataFrame([], "a bigint, b bigint"), groups.select("rep", (F.col("n") - 1).alias("links"))
    for width, n in sorted(map(tuple, sizes)):
        found = written(_links(groups.filter(F.size("v") == width), n, threshold), "links")
        edges = edges.unionByName(found.filter("b IS NOT NULL").select("a", "b"))
        counts = counts.unionByName(found.filter("b IS NULL").select(F.col("a").alias("rep"), "links"))
    parts = connected_components(edges, "vectors")
    totals = counts.groupBy("rep").agg(F.sum("links").alias("links"))
    known = groups.select("v", "rep").join(totals, "rep").join(parts, F.col("rep") == F.col("node"), "left").select("v", "links", F.coalesce("component", "rep").alias("component"))
    out = own.join(known, "v", "left")
    component = F.when(F.col(id_col).isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce("component", id_col))
    return out.select(id_col, F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col(id_col) == component, F.lit(True)).alias("kept"))


def _links(groups: DataFrame, n: int, threshold: float) -> DataFrame:
    """(a, b, links): with b null, links of vector a; else an edge of a forest. groups: n vectors of one length."""
    margin = float(np.sqrt((1 - threshold) / 2)) + 1e-9
    sample = groups.filter(F.expr(f"pmod(xxhash64(v), {n}) < {SAMPLE_ROWS}")).select("v").toArrow().column("v").combine_chunks()
    cells = int(np.clip(n // CELL_ROWS, 1, MOST_CELLS))
    centroids = spherical_kmeans(_unit(_matrix(sample)), cells) if len(sample) else np.zeros((1, 0))
    if not len(sample):  # a few vectors, none of them in the sample: one cell holds them all
        centroids = None

    def at_home(batch: pa.RecordBatch) -> np.ndarray:
        found = [np.zeros(0, np.int64)]
        for s in range(0, batch.num_rows, 2048):
            x = _unit(_matrix(batch.column(0).slice(s, 2048)))
            found.append((x @ centroids.T).argmax(axis=1) if centroids is not None else np.zeros(len(x), np.int64))
        return np.concatenate(found)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, times = np.unique(at_home(batch), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(times, pa.int64())], names=["home", "times"])

    # a row a cell
    sizes = dict(map(tuple, groups.select("v").mapInArrow(homes, "home int, times bigint").groupBy("home").agg(F.sum("times")).collect()))
    block_rows = max(1, min(BLOCK_ROWS, -(-n // LEAST_BLOCKS)))
    first, parts, block, held = {}, {}, 0, 0
    for cell in sorted(sizes):
        if held and held + sizes[cell] > block_rows:
            block, held = block + 1, 0
        # a larger cell is cut by a hash of ids
        first[cell], parts[cell], held = block, -(-sizes[cell] // block_rows), held + sizes[cell]
        if parts[cell] > 1:
            block, held = block + parts[cell], 0
    n_blocks = block + 1
    first_of, parts_of = (np.array([of.get(cell, default) for cell in range(max(sizes, default=0) + 1)]) for of, default in ((first, 0), (parts, 1)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, rep = at_home(batch), batch.column(1).to_numpy()
            at = first_of[home] + ((rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts_of[home]
            x = batch.column(0)
            raw = x.flatten().to_numpy(zero_copy_only=False)
            flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(raw) // max(1, len(x)) * raw.itemsize), len(x), [None, pa.py_buffer(np.ascontiguousarray(raw).tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(rep), batch.column(2), pa.array(home.astype(np.int32)), flat.cast(pa.binary())], names=["block", "rep", "n", "home", "x"])

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("home", "ascending"), ("rep", "ascending")])
        columns = {c: [table.column(c).to_numpy().tobytes()] for c in ("rep", "n", "home")}
        return pa.table({"block": table.column("block").slice(0, 1), **{c: pa.array(v, pa.binary()) for c, v in columns.items()}, "x": pa.array([b"".join(table.column("x").to_pylist())], pa.binary())})

    kind = np.float32 if groups.schema["v"].dataType == ArrayType(FloatType()) else np.float64
    vectors_of = groups.select("v", "rep", "n").mapInArrow(dealt, "block int, rep bigint, n bigint, home int, x binary")
    blocks = written(vectors_of.repartition(n_blocks, "block").groupBy("block").applyInArrow(packed, "block int, rep binary, n binary, home binary, x binary"), "blocks")

    def unpacked(batch: pa.RecordBatch, side: str, k: int) -> tuple:
        rep, weight, home, x = (np.frombuffer(batch.column(f"{side}_{c}")[k].as_buffer(), t) for c, t in (("rep", np.int64), ("n", np.int64), ("home", np.int32), ("x", kind)))
        x = _unit(x.astype(np.float64).reshape(len(rep), -1))
        cells, starts = np.unique(home, return_index=True)
        return rep, weight, x, x.astype(np.float32), cells, np.append(starts, len(rep))

    def visits(a: tuple, b: tuple) -> np.ndarray:
        """Whether a vector of a visits a cell of b, by vector and cell."""
        x, cells, others = a[2], a[4], b[4]
        if centroids is None:
            return np.ones((len(x), len(others)), bool)
        mine, theirs = centroids[cells], centroids[others]
        between = margin * np.sqrt(np.maximum(0, 2 - 2 * (mine @ theirs.T)))
        of = np.repeat(np.arange(len(cells)), np.diff(a[5]))
        return np.einsum("ij,ij->i", x, mine[of])[:, None] - x @ theirs.T <= between[of]

    def near(a: tuple, p: np.ndarray, b: tuple, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows, p of a and q of b, at the threshold or above."""
        slack = 1.2e-7 * (a[2].shape[1] + 8)  # more than single precision loses
        y = b[3][q]
        step = max(1, PRODUCTS // max(1, len(q)))
        for s in range(0, len(p), step):
            rows = p[s : s + step]
            product = a[3][rows] @ y.T
            if not product.size or product.max() < threshold - slack:
                continue
            i, j = np.nonzero(product >= threshold - slack)
            unsure = product[i, j] < threshold + slack
            if unsure.sum() > 4096:
                i, j = np.nonzero(a[2][rows] @ b[2][q].T >= threshold)
            elif unsure.any():
                ok = ~unsure
                ok[unsure] = np.einsum("ij,ij->i", a[2][rows[i[unsure]]], b[2][q[j[unsure]]]) >= threshold
                i, j = i[ok], j[ok]
            yield rows[i], q[j]

    def linked(a: tuple, b: tuple, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sums, x, y): links of the rows of a and, behind them unless it is the same block, of b, and a forest of these."""
        n_a = len(a[0])
        shift = 0 if same else n_a
        weight = a[1] if same else np.concatenate((a[1], b[1]))
        total, sums, known, held = len(weight), np.zeros(len(weight)), [], 0
        there, back = visits(a, b), visits(b, a)
        # whether any vector of one cell visits the other
        any_there, any_back = np.logical_or.reduceat(there, a[5][:-1], axis=0), np.logical_or.reduceat(back, b[5][:-1], axis=0)
        for g, cell in enumerate(a[4]):
            mine = np.arange(a[5][g], a[5][g + 1])
            for h in np.flatnonzero(any_there[g] | any_back[:, g] | (b[4] == cell)):
                other = np.arange(b[5][h], b[5][h + 1])
                if same and h < g:
                    continue
                if b[4][h] == cell:
                    pairs = [(mine, other)]
                else:
                    goes = there[mine, h]
                    pairs = [(mine[goes], other), (mine[~goes], other[back[other, g]])]
                for p, q in pairs:
                    for x, y in near(a, p, b, q) if len(p) and len(q) else ():
                        if same and h == g:
                            x, y = x[x < y], y[x < y]
                        y = y + shift
                        sums += np.bincount(x, weight[y], total) + np.bincount(y, weight[x], total)
                        known.append((x, y))
                        held += len(x)
                        if held > 2 * PRODUCTS:
                            known = [forest(*map(np.concatenate, zip(*known, strict=True)), total)]
                            held = 0
        return sums.astype(np.int64), *(forest(*map(np.concatenate, zip(*known, strict=True)), total) if known else (np.zeros(0, int), np.zeros(0, int)))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column("l_block")[k] == batch.column("r_block")[k]
                a = unpacked(batch, "l", k)
                b = a if same else unpacked(batch, "r", k)
                sums, x, y = linked(a, b, same)
                rep = a[0] if same else np.concatenate((a[0], b[0]))
                some = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate((rep[some], rep[x])), pa.int64()),
                    pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(rep[y], pa.int64())]),
                    pa.array(np.concatenate((sums[some], np.zeros(len(x), np.int64))), pa.int64()),
                ], names=["a", "b", "links"])

    left, right = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "lr")
    i, j = F.col("l_block"), F.col("r_block")
    # each pair once, dealt evenly over both halves of the product
    meet = (i == j) | ((i < j) & ((i + j) % 2 == 0)) | ((i > j) & ((i + j) % 2 == 1))
    return left.hint("shuffle_replicate_nl").join(right, meet).mapInArrow(compared, "a bigint, b bigint, links bigint")
