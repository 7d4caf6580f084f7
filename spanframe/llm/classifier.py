"""Quality by compression: zstandard dictionaries of good and of bad text.

A text is cut into pieces of PIECE_BYTES, all of which are compressed with both
dictionaries. The difference of the two sizes over their sum, and how well the
text compresses at all, are calibrated to a probability by logistic regression on
labelled rows that no dictionary has seen.

The bound of fitting is a parameter of this module: SAMPLE_ROWS labelled rows of each
class at most, chosen by a hash of the id; half of them make the dictionaries, half
the calibration. Sampled texts are read whole. A dictionary is trained on all pieces
of the sampled texts of its class: TASK_PIECES of them at once, and where there are
more on the dictionaries of such groups, in turn. The calibration measures whole
texts, and every document is scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import written

SAMPLE_ROWS = 2000
PIECE_BYTES = 1024
#: Size of a dictionary, and how many pieces one task trains one on.
DICT_BYTES, TASK_PIECES = 64 << 10, 8192
LEVEL = 1
#: Compressed bytes by which a short text's difference is drawn to 0.
SHRINK = 48


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def features(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[float, ...]:
    """(constant, normalised difference, compressed share, the same squared); of an empty text all but the constant are 0."""
    if not text:
        return 1.0, 0.0, 0.0, 0.0
    g = b = 0
    for s in range(0, len(text), PIECE_BYTES):
        piece = text[s : s + PIECE_BYTES]
        g += len(good.compress(piece))
        b += len(bad.compress(piece))
    share = min(1.5, min(g, b) / len(text))
    return 1.0, (b - g) / (b + g + SHRINK), share, share * share


def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    made = []
    for data in (good, bad):
        d = zstandard.ZstdCompressionDict(data)
        d.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; of too few or too small samples their own bytes, which serve as a raw one."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICT_BYTES:] or b"\0" * 8


def own_lines(rows: DataFrame) -> DataFrame:
    """rows: (id, label, text), one a document. The same without the lines that several of the documents hold: they say nothing of quality."""
    each = rows.select("id", "label", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    once = each.groupBy("line").agg(F.count_distinct("id").alias("n")).filter("n = 1").select("line")
    left = each.join(once, "line", "left_semi").groupBy("id", "label").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("l"))  # a document's lines
    return left.select("id", "label", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def training_pieces(rows: DataFrame) -> DataFrame:
    """rows: (id, label, text). (label, piece): all pieces of whole texts, without those of white space alone."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py().encode("utf-8", "surrogatepass")
                pieces = [p for s in range(0, len(data), PIECE_BYTES) if (p := data[s : s + PIECE_BYTES]).strip()]
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(pieces), pa.int32()), pa.array(pieces, pa.binary())], names=["label", "piece"])

    return rows.select("label", "text").mapInArrow(cut, "label int, piece binary")


def trained(pieces: DataFrame) -> bytes:
    """The dictionary of all pieces: (piece). More than TASK_PIECES are dealt by hash to groups, whose dictionaries, cut in pieces, stand for them; rounds go on until one task can hold what is left."""

    def some(table: pa.Table) -> pa.Table:
        made = dictionary(sorted(bytes(p) for p in table.column("piece").to_pylist()))
        return pa.table({"piece": pa.array([made[s : s + PIECE_BYTES] for s in range(0, len(made), PIECE_BYTES)], pa.binary())})

    order = [F.xxhash64("piece"), F.col("piece")]
    while (n := pieces.count()) > TASK_PIECES:
        groups = -(-n // TASK_PIECES)
        salted = pieces.withColumn("group", F.pmod(F.xxhash64("piece", F.monotonically_increasing_id()), F.lit(groups)))
        pieces = written(written(salted, "grouped").groupBy("group").applyInArrow(some, "piece binary"), "pieces")
    return dictionary([bytes(r[0]) for r in pieces.orderBy(*order).collect()])  # TASK_PIECES * PIECE_BYTES at most


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[float, ...]:
    """Newton's method; columns but the first are penalised a little."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def _measured(rows: DataFrame, good: bytes, bad: bytes, id_type: str, weights: tuple[float, ...] | None) -> DataFrame:
    """rows: (id, text). With weights (id, score), else (id, f)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _compressors(good, bad)
        for batch in batches:
            found = [features((t.as_py() or "").encode("utf-8", "surrogatepass"), *pair) for t in batch.column(1)]
            if weights is None:
                value = pa.array([list(f) for f in found], pa.list_(pa.float64()))
            else:
                odds = [sum(a * b for a, b in zip(f, weights, strict=True)) for f in found]
                value = pa.array([1 / (1 + math.exp(-max(-500.0, min(500.0, o)))) for o in odds], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), value], names=["id", "value"])

    return rows.mapInArrow(run, f"id {id_type}, value {'double' if weights is not None else 'array<double>'}")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", usable: Column | None = None) -> Model:
    """Learns from rows of docs that labels (id_col, label_col 0 or 1) names and usable admits.

    Null texts and labels other than 0 and 1 are not learned from. A class
    without rows leaves a dictionary of zeros and a score that is the share of
    the other class.
    """
    named = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (usable if usable is not None else F.lit(True)))
    named = named.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")).distinct()
    order = F.xxhash64(F.lit("sample"), F.col("__id"))
    few = named.filter("__label = 1").orderBy(order, "__id").limit(SAMPLE_ROWS).unionByName(named.filter("__label = 0").orderBy(order, "__id").limit(SAMPLE_ROWS))
    few = F.broadcast(written(few, "labelled"))  # 2 * SAMPLE_ROWS rows at most
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("__id")), F.lit(2))
    # rows that repeat an id would break the bound
    chosen = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull()).join(few, F.col("__doc") == F.col("__id"))
    chosen = written(chosen.groupBy("__id", "__label").agg(F.min("text").alias("text")).withColumn("half", half), "labelled-texts")
    learned = own_lines(chosen.filter("half = 0").select(F.col("__id").alias("id"), F.col("__label").alias("label"), "text"))
    pieces = written(training_pieces(learned), "pieces")
    made = [trained(pieces.filter(F.col("label") == label).select("piece")) for label in (1, 0)]
    measured = _measured(chosen.filter("half = 1").select(F.struct("__id", "__label").alias("id"), "text"), *made, chosen.select(F.struct("__id", "__label").alias("id")).schema["id"].dataType.simpleString(), None)
    rows = sorted(measured.select("id.__label", "id.__id", "value").collect(), key=lambda r: (r[0], r[1]))
    y = np.array([r[0] for r in rows], float)
    if len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(*made, (math.log(share / (1 - share)), 0.0, 0.0, 0.0))
    return Model(*made, logistic(np.array([r[2] for r in rows]), y))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) for every row. Null and empty texts get the score of an empty text; repeated rows score alike."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return _measured(rows, model.good, model.bad, docs.schema[id_col].dataType.simpleString(), model.weights).select(F.col("id").alias(id_col), F.col("value").alias("score"))
