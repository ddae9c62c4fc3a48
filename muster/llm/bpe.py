"""Byte-level BPE encoding and decoding.

The rank file gives a byte-level vocabulary. The tokenizers library merges it: bytes are mapped to printable
characters, each rank becomes its merges, and each piece of text that the pattern splits off is encoded by itself.
A piece is encoded once per worker and then looked up, since words repeat. Encoding runs on Arrow batches; the ids
come with the characters that each token covers. Decoding reverses the byte table; a token may hold a part of a
character, so bytes are joined first and turned into characters last.

Null and empty text: no ids, and decoding gives no bytes. Long texts are encoded whole; repeated rows are encoded
alike. Other columns of the input are left as they are; a column named like an output is replaced by it.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import chunks, column_bytes

#: Most pieces that a worker remembers; beyond it the memory starts anew, so it stays bounded on any input.
REMEMBERED = 300_000
OFFSETS = "array<struct<start:int,end:int>>"


@lru_cache(1)
def byte_table() -> dict[int, str]:
    """Printable bytes stand for themselves, the others for characters from 256 on, in order."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one rank file, kept by a worker."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        table, known = byte_table(), ranks(path)
        spelled = {token: "".join(map(table.__getitem__, token)) for token in known}
        merges = [
            (spelled[token[:i]], spelled[token[i:]])
            for token, rank in sorted(known.items(), key=lambda x: x[1])
            for i in range(1, len(token))
            if known.get(token[:i], rank) < rank and known.get(token[i:], rank) < rank
        ]
        vocabulary = {spelled[token]: rank for token, rank in known.items()}
        self.model = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True, cache_capacity=0))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.split = regex.compile(pattern).findall
        back = {character: byte for byte, character in table.items()}
        tokens = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, rank in vocabulary.items():
            tokens[rank] = bytes(back[c] for c in token)
        self.lengths = np.array([len(t) for t in tokens], np.int32)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(tokens), np.uint8)
        self.pieces: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and each text's bounds in them. A piece's ids are kept as the bytes of an int32 array."""
        split = [self.split(text) if text else () for text in texts]
        new = set(chain.from_iterable(split)).difference(self.pieces)
        if len(self.pieces) + len(new) > REMEMBERED:
            self.pieces.clear()
            new = set(chain.from_iterable(split))
        some = list(new)
        for at in range(0, len(some), 4096):
            part = some[at : at + 4096]
            for piece, got in zip(part, self.model.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.pieces[piece] = array("i", got.ids).tobytes()
        found = [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in split]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) // 4 for x in found], out=bounds[1:])
        return np.frombuffer(b"".join(found), np.int32), bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and each list's bounds in them."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)):
            raise ValueError("an id that the vocabulary doesn't hold")
        lengths = self.lengths[ids]
        end = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(lengths, out=end[1:])
        shift = np.repeat((self.starts[ids] - end[:-1]).astype(np.int32), lengths)
        return self.table[shift + np.arange(end[-1], dtype=np.int32)], end[bounds]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The characters that each token touches; of a split character, every token that holds a part has it."""
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        end = np.cumsum(self.lengths[ids])
        start = end - self.lengths[ids]
        return character[start], character[end - 1] + 1


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _texts(column: pa.Array, most: int = 1 << 20) -> Iterator[list[str | None]]:
    """The column's texts, in parts of about so many bytes."""
    size = np.cumsum(column_bytes(column))
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield column.slice(at, end - at).to_pylist()
        at = end


def _list(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)


def _joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _encoded(path: str, pattern: str, with_offsets: bool):
    kind = pa.list_(pa.int32())
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(column: pa.Array) -> pa.Array:
        own, out, spans = codec(path, pattern), [], []
        for texts in _texts(column):
            ids, bounds = own.encode(texts)
            out.append(_list(pa.array(ids), bounds))
            if with_offsets:
                both = [own.offsets(t, ids[a:b]) for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True) if b > a]
                start, end = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in both)]).astype(np.int32) for i in (0, 1))
                spans.append(_list(pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["start", "end"]), bounds))
        if not with_offsets:
            return _joined(out, kind)
        return pa.StructArray.from_arrays([_joined(out, kind), _joined(spans, span)], ["ids", "offsets"])

    return run


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", offsets: str | None = None) -> DataFrame:
    """Adds the token ids of the text, and under the name offsets the characters that each token covers."""
    f = _encoded(path, pattern, offsets is not None)
    if offsets is None:
        return df.withColumn(out, F.arrow_udf(f, "array<int>")(F.col(text)))
    both = F.arrow_udf(f, f"ids array<int>, offsets {OFFSETS}")(F.col(text))
    inner = "__encoded"
    return df.withColumn(inner, both).withColumn(out, F.col(f"{inner}.ids")).withColumn(offsets, F.col(f"{inner}.offsets")).drop(inner)


def _decoded(path: str, pattern: str):
    def run(column: pa.Array) -> pa.Array:
        own, out = codec(path, pattern), []
        if column.null_count:
            column = pc.fill_null(column, pa.scalar([], column.type))
        for at in range(0, len(column), 256):
            part = column.slice(at, 256)
            bounds = part.offsets.to_numpy().astype(np.int64)
            raw, ends = own.decode(part.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]], bounds - bounds[0])
            out.append(pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary()))
        return _joined(out, pa.binary())

    return run


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that the ids stand for. A null list has none; an unknown id is an error."""
    return F.arrow_udf(_decoded(path, pattern), "binary")(ids)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds the decoded text; bytes that form no character become U+FFFD."""
    broken = F.arrow_udf(lambda b: pa.array([x.decode("utf-8", "replace") for x in b.to_pylist()], pa.string()), "string")
    return df.withColumn(out, broken(decoded(F.col(ids), path, pattern)))


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Per row: number of tokens, SHA-256 of the ids and SHA-256 of what they decode to; with ids, the ids too.

    One worker encodes and decodes, so the vocabulary is held once."""
    kind = f"key {df.schema[key].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoded(path, pattern, False), _decoded(path, pattern)
        for batch in chunks(batches, "text", 1 << 20):
            found = encoder(batch.column("text"))
            columns = [batch.column("key"), pc.list_value_length(found).cast(pa.int64()), _sha256(_commas(found)), _sha256(decoder(found)), *[found] * ids]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in kind.split(", ")])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, kind).withColumnRenamed("key", key)


def _commas(ids: pa.Array) -> pa.Array:
    """Each list as decimal numbers with commas between."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string())), ",")


def _sha256(column: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column], pa.string())
