"""What the corpus operators share: table access, shared storage, bounded chunks of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from muster.functions.shared import written  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds one row, or at most so many bytes of its text column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        lengths = np.nan_to_num(column_bytes(column))
        at = 0
        total = np.concatenate([[0], np.cumsum(lengths)])
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(total, total[at] + most_bytes, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def column_bytes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and each row's bounds in them; a null has none."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Base of the word hash, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_POWERS: dict[int, np.ndarray] = {}


def power(base: int, n: int) -> np.ndarray:
    """powers(), remembered up to a bounded length."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        if n > 1 << 22:
            return powers(base, n)
        _POWERS[base] = powers(base, max(n, 1 << 20))
    return _POWERS[base][:n]


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all rows, split at ASCII white space: first byte, end, 64-bit hash, and each row's bounds among them."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), np.zeros(len(bounds), np.int64)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    first = ~space
    opens = first.copy()
    opens[1:] &= space[:-1]
    cuts = bounds[(bounds > 0) & (bounds < n)]
    opens[cuts] = first[cuts]
    closes = first.copy()
    closes[:-1] &= space[1:]
    closes[cuts - 1] = first[cuts - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power(BASE, n), out=total[1:])
    value = (total[end] - total[start]) * power(BASE_INVERSE, n)[start]
    return start, end, mixed(value ^ (end - start).astype(np.uint64)), np.searchsorted(start, bounds)
