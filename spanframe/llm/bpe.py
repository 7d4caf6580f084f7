"""Byte-level BPE: encoding and decoding of whole texts.

Texts are split where no pre-token of the usual byte-level pattern can
straddle: in front of a space that stands behind a character other than white
space, and between a letter and an ASCII character that is none. Arrow numbers
the pieces of many texts by their distinct ones; each of these is then encoded
by the tokenizer's own library; pieces recur, so a worker keeps what it has
encoded, in a table of bounded size, and Arrow puts the ids of each text
together. A long text needs no more memory than its pieces.

Null and empty texts have no ids. Other columns pass through untouched where
an operator keeps them; an operator's own columns replace like-named ones.
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of a worker's table of encoded pieces, of 0.15 to 0.25 KB each: two workers have to stand beside an executor's full heap.
MEMO_ENTRIES = {"tiktoken": 250_000, "tokenizers": 600_000}
#: Characters of text that are encoded together.
CHUNK_CHARS = 2 << 20
#: Words in one string that the library gets.
JOINED = 256

#: Last bytes of white space beyond ASCII, and bytes in front of them.
_white_last, _white_before = np.zeros(256, bool), np.zeros(256, bool)
_white_last[[0x85, *range(0x80, 0x8B), 0x8E, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_white_before[[0xC2, 0x9A, 0x80, 0x81, 0xA0]] = True

def _ids_bytes(ids) -> bytes:
    return array("I", ids).tobytes()


def _binary(ends: np.ndarray, data) -> pa.Array:
    """Values of data between neighbouring ends."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


class Memo:
    """A table in two generations, of about most entries: when the new one has half as many, it becomes the old one, and what is asked for again moves on."""

    def __init__(self, most: int):
        self.most = most
        self.now: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def turn(self) -> None:
        if len(self.now) > self.most // 2:
            self.old, self.now = self.now, {}

    def missing(self, keys: set[bytes]) -> set[bytes]:
        """Those of keys that it doesn't hold; all others are in now."""
        new = keys.difference(self.now)
        held = [k for k in new if k in self.old]
        self.now.update(zip(held, map(self.old.__getitem__, held), strict=True))
        new.difference_update(held)
        return new


def cuts(data: np.ndarray) -> np.ndarray:
    """Where UTF-8 bytes may be cut: no pre-token goes on there, whatever stands on either side.

    Letters are those of ranges that every version of Unicode has as letters; what may be white space beyond ASCII counts as such.
    """
    ascii_letter = ((data | 32) - np.uint8(97)) < 26
    letter = ascii_letter.copy()  # at a letter's last byte
    lead = np.flatnonzero((data - np.uint8(0xC3)) < 7)  # U+00C0 to U+024F
    first, last = data[lead], data[lead + 1]
    letter[lead + 1] = np.where(first == 0xC3, (last != 0x97) & (last != 0xB7), (first != 0xC9) | (last < 0x90))
    space = data == 32
    cut = np.zeros(len(data), bool)
    cut[1:] = (letter[:-1] & (data[1:] < 128) & ~ascii_letter[1:]) | (space[1:] & ((data[:-1] - np.uint8(33)) < 94))
    high = np.flatnonzero(space[2:] & (data[1:-1] >= 128)) + 2
    cut[high] |= ~(_white_last[data[high - 1]] & _white_before[data[high - 2]])
    return cut


class PieceEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    many: encodes a list of strings to a list of id sequences, each string by
    itself. spaced: for each id, whether its token begins with a space. Pieces of
    a space and what isn't white space are sent to the library in long strings,
    and since only their first tokens begin with a space, the ids can be dealt to
    them again.
    """

    def __init__(self, many: Callable[[list[str]], list], spaced: np.ndarray, most: int):
        self.many, self.spaced = many, spaced
        self.pieces = Memo(most)

    def _encode(self, strings: list[str]) -> list[bytes]:
        return [_ids_bytes(x) for x in self.many(strings)] if strings else []

    def _learn(self, new: list[bytes]) -> None:
        words, others, now = [], [], self.pieces.now
        for p in new:
            text = p.decode()
            (words if text[:1] == " " and text.split() == [text[1:]] else others).append((p, text))
        now.update(zip((p for p, _ in others), self._encode([t for _, t in others]), strict=True))
        runs = [words[s : s + JOINED] for s in range(0, len(words), JOINED)]
        for run, ids in zip(runs, self.many(["".join(t for _, t in run) for run in runs]) if runs else [], strict=True):
            ids = np.array(ids, np.uint32)
            at = np.flatnonzero(self.spaced[ids])
            if len(at) != len(run) or at[0]:
                now.update(zip((p for p, _ in run), self._encode([t for _, t in run]), strict=True))
                continue
            data, ends = ids.astype("<u4").tobytes(), [*(4 * at[1:]).tolist(), 4 * len(ids)]
            now.update(zip((p for p, _ in run), [data[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))

    def texts(self, texts: list[str]) -> list[bytes]:
        self.pieces.turn()
        _, ends, data = pa.array(texts, pa.large_string()).buffers()
        ends = np.frombuffer(ends, np.int64, len(texts) + 1)
        if not ends[-1]:
            return [b""] * len(texts)
        cut = cuts(np.frombuffer(data, np.uint8, ends[-1]))
        cut[ends[ends < ends[-1]]] = True
        starts = np.append(np.flatnonzero(cut), ends[-1])
        found = _binary(starts, data).dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.pieces.now.get, distinct))
        if absent := {p for p, x in zip(distinct, ids, strict=True) if x is None}:
            self._learn(list(self.pieces.missing(absent)))
            ids = [self.pieces.now[p] if x is None else x for p, x in zip(distinct, ids, strict=True)]
        id_ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
        coded = _binary(id_ends, b"".join(ids)).take(found.indices)
        own = np.frombuffer(coded.buffers()[1], np.int64, len(starts))[np.searchsorted(starts, ends)]
        return _binary(own, coded.buffers()[2]).to_pylist()


def tiktoken_encoding(path: str):
    """An encoding of the tiktoken library from a local rank file."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_made: dict[tuple[str, str], tuple] = {}


def tiktoken_encoder(path: str) -> tuple[PieceEncoder, object]:
    """A worker makes each once."""
    if ("tiktoken", path) not in _made:
        encoding = tiktoken_encoding(path)
        spaced = np.array([encoding.decode_single_token_bytes(i)[:1] == b" " for i in range(encoding.n_vocab)])
        _made["tiktoken", path] = PieceEncoder(lambda strings: list(map(encoding.encode_ordinary, strings)), spaced, MEMO_ENTRIES["tiktoken"]), encoding
    return _made["tiktoken", path]


def tokenizers_encoder(path: str) -> PieceEncoder:
    if ("tokenizers", path) not in _made:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        space = tokenizer.pre_tokenizer.pre_tokenize_str(" a")[0][0][0]  # how the vocabulary writes a space
        spaced = np.array([tokenizer.id_to_token(i).startswith(space) for i in range(tokenizer.get_vocab_size())])
        many = lambda strings: [x.ids for x in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        _made["tokenizers", path] = (PieceEncoder(many, spaced, MEMO_ENTRIES["tokenizers"]),)
    return _made["tokenizers", path][0]


def chunks(texts: Iterable[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of runs of about CHUNK_CHARS; null is empty."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= CHUNK_CHARS:
            yield first, run
            first, run, size = i + 1, [], 0
    if run:
        yield first, run


def encode_decode(docs: DataFrame, rank_file: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per row: id_col, n_tokens, ids_sha256, decoded_sha256 (hex digests), and with keep_ids the ids as binary and the decoded bytes.

    Rows stay as they are dealt: no shuffle. Repeated rows give repeated
    results, null and empty texts no tokens and the digests of no bytes, an
    empty table an empty result. Further columns are not read.
    """
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids binary, decoded binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, encoding = tiktoken_encoder(rank_file)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for first, texts in chunks(x.as_py() for x in batch.column(1)):
                coded = encoder.texts(texts)
                plain = [encoding.decode_bytes(array("I", x).tolist()) if x else b"" for x in coded]
                columns = [
                    batch.column(0).slice(first, len(texts)),
                    pa.array([len(x) // 4 for x in coded], pa.int64()),
                    pa.array(map(sha, coded), pa.string()),
                    pa.array(map(sha, plain), pa.string()),
                ]
                if keep_ids:
                    columns += [pa.array(coded, pa.binary()), pa.array(plain, pa.binary())]
                names = [batch.schema.names[0], "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
