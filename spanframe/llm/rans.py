"""Token ids in files, coded by a static range asymmetric numeral system.

A frame is what one row of the file holds: up to FRAME_IDS ids of consecutive
documents. Its frequency table is shared by all its blocks; a block is
BLOCK_IDS ids, coded by two interleaved states, and can be decoded alone from
its checkpoint: the states, and where its words begin. Every block has a crc32.
Blocks of a frame are coded side by side, two numpy lanes for each.

File: Parquet rows (part, frame, part_start, n_docs, n_ids, body), in ascending
document order by (part, frame). Spark's own writers and readers move them, so
any store that Spark reaches will do and a task that is run again leaves no
half-written file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanframe.llm import bpe
from spanframe.llm.common import partitions

BLOCK_IDS = 1024
FRAME_IDS = 1 << 21
#: Ids below are counted in a table, others by sorting.
COUNTED_IDS = 1 << 22
MAGIC = b"SFR1"
LOW = np.uint64(1 << 31)
_HEAD = "<4sBIIII"  # magic, bits, symbols, blocks, ids, documents


def shared_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """symbols, their index for each id, frequencies that sum to 1 << bits, bits."""
    if int(ids.max()) < COUNTED_IDS:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        place = np.zeros(len(counts), np.uint32)
        place[symbols] = np.arange(len(symbols))
        index, counts = place[ids], counts[symbols]
    else:
        symbols, index, counts = np.unique(ids, return_inverse=True, return_counts=True)
    bits = max(12, int(len(symbols) - 1).bit_length() + 3)
    freq = np.maximum(1, counts * ((1 << bits) - len(symbols)) // len(ids)).astype(np.int64)
    freq[np.argmax(freq)] += (1 << bits) - freq.sum()  # what rounding left; never below 1: each share was rounded down and has room for 1
    return symbols.astype(np.uint32), index.astype(np.uint32), freq.astype(np.uint32), bits


def _by_steps(grid: np.ndarray) -> np.ndarray:
    """Blocks of ids by steps: in a step each of the two states takes an id of every block."""
    return np.ascontiguousarray(grid.T).reshape(-1, 2, len(grid))


def _by_blocks(steps: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(steps.reshape(BLOCK_IDS, -1).T)


def encode_frame(ids: np.ndarray, lengths: np.ndarray, doc_ids: np.ndarray) -> bytes:
    """The body of a frame. ids: all ids of its documents; lengths: ids of each document."""
    n = len(ids)
    head = lambda bits, s, b: struct.pack(_HEAD, MAGIC, bits, s, b, n, len(lengths))
    docs = zlib.compress(lengths.astype("<u4").tobytes() + doc_ids.astype("<i8").tobytes(), 1)
    if not n:
        return head(0, 0, 0) + struct.pack("<I", len(docs)) + docs
    symbols, index, freq, bits = shared_table(ids)
    start = np.concatenate(([0], np.cumsum(freq[:-1], dtype=np.uint64))).astype(np.uint64)
    blocks = -(-n // BLOCK_IDS)
    grid = np.zeros(blocks * BLOCK_IDS, np.intp)
    grid[:n] = index
    grid = _by_steps(grid.reshape(blocks, BLOCK_IDS))
    f64, rest = freq.astype(np.uint64), np.uint64(1 << bits) - freq
    states = np.full((2, blocks), LOW, np.uint64)
    words, full = np.zeros(grid.shape, np.uint32), np.zeros(grid.shape, bool)
    last = n - (blocks - 1) * BLOCK_IDS
    for i in range(len(grid) - 1, -1, -1):
        symbol, x = grid[i], states
        f = f64[symbol]
        np.greater_equal(x, f << np.uint64(63 - bits), out=full[i])
        if 2 * i + 2 > last:  # the last block may be short
            full[i, max(0, last - 2 * i) :, -1] = False
        words[i] = x
        x = x >> (full[i] * np.uint64(32))
        states = x + x // f * rest[symbol] + start[symbol]
        if 2 * i + 2 > last:
            states[max(0, last - 2 * i) :, -1] = LOW
    begin = np.concatenate(([0], np.cumsum(full.sum((0, 1))))).astype("<u4")
    crcs = np.array([zlib.crc32(ids[b * BLOCK_IDS : (b + 1) * BLOCK_IDS].astype("<u4").tobytes()) for b in range(blocks)], "<u4")
    table = zlib.compress(np.diff(symbols.astype("<u4"), prepend=np.uint32(0)).tobytes() + freq.astype("<u4").tobytes(), 1)
    flat = _by_blocks(words)[_by_blocks(full)].astype("<u4", copy=False)
    return b"".join((head(bits, len(symbols), blocks), struct.pack("<I", len(docs)), docs, struct.pack("<I", len(table)), table, states.astype("<u8").tobytes(), begin.tobytes(), crcs.tobytes(), flat.tobytes()))


def decode_frame(body: bytes, only: range | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, lengths and document ids of a frame; with only, the ids of that run of blocks. Checks every block's crc32."""
    magic, bits, n_symbols, blocks, n, n_docs = struct.unpack_from(_HEAD, body)
    if magic != MAGIC:
        raise ValueError("not a frame")
    at = struct.calcsize(_HEAD)

    def packed() -> bytes:
        nonlocal at
        (size,) = struct.unpack_from("<I", body, at)
        out = zlib.decompress(body[at + 4 : at + 4 + size])
        at += 4 + size
        return out

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    docs = packed()
    lengths, doc_ids = np.frombuffer(docs, "<u4", n_docs), np.frombuffer(docs, "<i8", n_docs, 4 * n_docs)
    if not n:
        return np.zeros(0, np.uint32), lengths, doc_ids
    table = packed()
    symbols = np.cumsum(np.frombuffer(table, "<u4", n_symbols), dtype=np.uint32)
    freq = np.frombuffer(table, "<u4", n_symbols, 4 * n_symbols)
    states, begin, crcs = take("<u8", 2 * blocks).reshape(2, blocks), take("<u4", blocks + 1), take("<u4", blocks)
    words = take("<u4", int(begin[-1]))
    chosen = np.arange(blocks)[slice(None) if only is None else slice(only.start, only.stop)]
    x2, at_word = states[:, chosen].copy(), begin[chosen].astype(np.int64)
    words = np.concatenate((words, np.zeros(2, "<u4")))
    start = np.concatenate(([0], np.cumsum(freq[:-1], dtype=np.uint64))).astype(np.uint64)
    of_slot = np.repeat(np.arange(n_symbols, dtype=np.uint32), freq)
    f64, up, mask = freq.astype(np.uint64), np.uint64(bits), np.uint64((1 << bits) - 1)
    sizes = np.minimum(BLOCK_IDS, n - chosen * BLOCK_IDS)
    grid = np.zeros((BLOCK_IDS // 2, 2, len(chosen)), np.uint32)
    for i in range(-(-int(sizes.max(initial=0)) // 2)):
        slot = x2 & mask
        symbol = of_slot[slot.view(np.int64)].astype(np.intp)
        grid[i] = symbol
        x = f64[symbol] * (x2 >> up) + slot - start[symbol]
        low = x < LOW
        if 2 * i + 2 > sizes[-1]:  # the last block may be short
            low[max(0, sizes[-1] - 2 * i) :, -1] = False
        x2 = np.where(low, (x << np.uint64(32)) | words[np.stack((at_word, at_word + low[0]))], x)
        at_word += low[0]
        at_word += low[1]
    grid = _by_blocks(grid)
    ids = symbols[grid.reshape(-1)[: int(sizes.sum())]] if len(chosen) else np.zeros(0, np.uint32)
    for k, b in enumerate(chosen):
        if zlib.crc32(ids[k * BLOCK_IDS : (k + 1) * BLOCK_IDS].astype("<u4").tobytes()) != crcs[b]:
            raise ValueError(f"block {b}: checksum differs")
    return ids, lengths, doc_ids


FILE_SCHEMA = "part int, frame int, part_start bigint, n_docs bigint, n_ids bigint, body binary"


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text with the tokenizers library and writes its ids, an end id behind each document, to path.

    Documents are in ascending order of id_col, null first, equal ids in the
    order of a hash of their texts; the range partitioning also cuts within
    rows of one id. Null texts are empty: the end id alone. An empty table
    gives a file of no frames. Further columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions(docs.sparkSession), "id", "tie").sortWithinPartitions("id", "tie").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder, end = TaskContext.get().partitionId(), bpe.tokenizers_encoder(tokenizer_file), np.array([end_id], "<u4").tobytes()
        frame, before = 0, 0
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0

        def closed() -> pa.RecordBatch:
            nonlocal frame, before, ids, names, held
            lengths, all_ids = np.array([len(x) // 4 for x in ids]), np.frombuffer(b"".join(ids), "<u4")
            n_docs, ids = len(ids), []
            # the smallest bigint stands for a null id
            body = encode_frame(all_ids, lengths, np.array([-(1 << 63) if x is None else x for x in names], np.int64))
            row = {"part": [part], "frame": [frame], "part_start": [before], "n_docs": [n_docs], "n_ids": [len(all_ids)], "body": [body]}
            frame, before, names, held = frame + 1, before + len(all_ids), [], 0
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("frame", pa.int32()), ("part_start", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("body", pa.binary())]))

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, texts in bpe.chunks(x.as_py() for x in batch.column(1)):
                for k, coded in enumerate(encoder.texts(texts)):
                    ids.append(coded + end)
                    names.append(doc_ids[first + k])
                    held += len(coded) // 4 + 1
                    if held >= FRAME_IDS:
                        yield closed()
        if ids:
            yield closed()

    rows.mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and with keep_ids the ids as binary.

    Where a part begins follows from the sizes of those before it: one row a
    part, of which there are as many as the writer had shuffle partitions.
    Frames are decoded in parallel.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    bases = sizes.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    frames = files.join(F.broadcast(bases), "part").select((F.col("base") + F.col("part_start")).alias("start"), "body")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, lengths, doc_ids = decode_frame(body.as_py())
                data, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                own = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [
                    pa.array(doc_ids, pa.int64(), mask=doc_ids == -(1 << 63)),
                    pa.array(starts + begin, pa.int64()),
                    pa.array(lengths.astype(np.int64), pa.int64()),
                    pa.array(map(zlib.crc32, own), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(own, pa.binary())] * keep_ids, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + keep_ids])

    return frames.mapInArrow(run, schema)
