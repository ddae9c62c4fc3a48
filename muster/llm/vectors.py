"""Rows of vectors: which take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Scaled components beyond this count as this; whole numbers below EXACT are exact in doubles.
LARGEST, EXACT = float(1 << 90), float(1 << 53)


def usable(df: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """(key, vector as array of doubles) of the rows that take part: key and vector not null, no null or non-finite
    component, and, unless `zero`, not all zero. Vectors shorter than the longest are filled up with zeros."""
    x = F.col("vector")
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("vector")).where(F.col("key").isNotNull() & x.isNotNull())
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(~F.coalesce(bad, F.lit(True)))
    if not zero:
        rows = rows.where(F.exists(x, lambda v: v != 0))
    least, most = rows.agg(F.min(F.size(x)), F.max(F.size(x))).first()
    if least != most or not most:
        rows = rows.withColumn("vector", F.concat(x, F.array_repeat(F.lit(0.0), F.lit(max(1, most or 0)) - F.size(x))))
    return rows


def whole(component: Column, scale: int) -> Column:
    """floor(scale * component) in a double, which holds it exactly; beyond LARGEST it is that."""
    fit = F.greatest(F.least(component * scale, F.lit(LARGEST)), F.lit(-LARGEST))
    return F.when(F.abs(fit) < EXACT, F.floor(fit).cast("double")).otherwise(fit)


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of equal length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), flat.dtype)


def lists(m: np.ndarray) -> pa.Array:
    rows, width = m.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width, pa.int32()), pa.array(np.ascontiguousarray(m).reshape(-1)))


def sample(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and vectors of at most so many rows, those with the smallest hash of their key."""
    got = rows.orderBy(F.xxhash64("key", F.lit("fit")), "key", "vector").limit(most).select("key", "vector").toArrow()
    return got.column(0).to_numpy(), matrix(got.column(1).combine_chunks()) if got.num_rows else np.zeros((0, 0))
