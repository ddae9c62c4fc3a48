"""Compression of vectors to codes: each part of a vector becomes the index of its nearest entry in that part's codebook.

Components are taken as integers floor(scale * x), and codebooks are trained by rounds of k-means in integers. Rounds after
the first don't measure every distance again: with each part are kept, in a table, the b entries that were next after its
own, in order, each with a lower bound of its distance, and one outer bound for all further entries (the adaptive bounds
of Drake and Hamerly). When entries move, bounds shrink by as much as they moved. The distance to the own entry is exact;
entries whose bound is below it are uncertain, and only these are verified, in whole numbers, ties to the lower index. If
the outer bound fails too, all entries are. A task adapts b to what its rows needed: it keeps lists so long that the
outer bound would have done for COVERED of the parts. Lists steer the work, never the result.

A round is one pass over the table before it, and one grouping of sums per entry, added up in each task first. The
driver holds the codebooks alone (entries x components, whatever the number of rows). A table is removed when the next
one is written, so two are on disk at most.

Bounds are held as 16-bit logarithms, rounded down. Sums and distances are exact: in doubles while they are below 2^53,
as Python integers beyond.

Vectors that are null or hold null or non-finite components are dropped; no other row is. Vectors whose length is no
multiple of the number of parts, or less than that of the longest, are filled up with zeros; empty ones are all zeros.
Components beyond 2^90 after scaling count as 2^90, errors beyond 2^63 - 1 as that. Fewer rows than entries give a
codebook of as many. A null key comes after all others. Rows with one key are rows of their own, ordered by their vectors
where they start a codebook; repeated rows get the same code. No rows give no rows. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions.shared import forget
from muster.llm.common import written
from muster.llm.vectors import EXACT
from muster.llm.vectors import whole as whole_of

#: Parts of a vector, entries of a codebook, rounds of training.
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Entries next after the own one that are listed at first (as a share of all) and at least, and the share of parts that they shall do for.
LISTED, FEWEST, COVERED = 0.25, 2, 0.95
LONG = (1 << 63) - 1
#: Bytes of vectors that are worked on at a time.
PIECE = 4 << 20
#: Bounds lose this share when they are taken, which is more than rounding adds.
SLACK = 1e-9


def integers(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(key, label, x): the rows that take part, components as whole numbers in doubles."""
    v = F.col("x")
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x")).where(v.isNotNull())
    rows = rows.where(~F.coalesce(F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(True)))
    return rows.withColumn("x", F.transform(v, lambda c: whole_of(c, scale)))


def padded(column: pa.Array, length: int) -> np.ndarray:
    """The lists as rows of that length, zeros behind."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == length).all():
        return flat.reshape(len(column), length)
    out = np.zeros((len(column), length))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def whole(m: np.ndarray) -> np.ndarray:
    """As Python integers."""
    return np.frompyfunc(int, 1, 1)(m)


def as_bounds(distance: np.ndarray) -> np.ndarray:
    """Distances as 16-bit logarithms that are not above them; infinity is the greatest."""
    with np.errstate(invalid="ignore"):
        out = np.floor(256 * np.log2(1 + distance * (1 - SLACK)))
    return np.where(np.isfinite(out), np.clip(out - 1, 0, 65534), 65535).astype(np.uint16)


def from_bounds(held: np.ndarray) -> np.ndarray:
    return np.where(held == 65535, np.inf, np.exp2(held / 256.0) - 1)


@dataclass
class Book:
    """One part's codebook: entries as Python integers and as doubles, and how far each moved in the last round."""

    entries: np.ndarray
    moved: np.ndarray

    def __post_init__(self) -> None:
        self.plain = self.entries.astype(float)
        self.most = float(np.abs(self.plain).max(initial=0))

    def next(self, sums: dict[int, tuple[int, list[int]]]) -> Book:
        """With each entry at the floor of its parts' mean; one without parts stays."""
        entries = self.entries.copy()
        for entry, (n, total) in sums.items():
            entries[entry] = [t // n for t in total]
        far = ((entries - self.entries) ** 2).sum(1)
        return Book(entries, np.sqrt(far.astype(float)) * (1 + SLACK))

    def fits(self, x: np.ndarray) -> bool:
        """Whether doubles hold all distances of these rows exactly."""
        return x.shape[1] * (float(np.abs(x).max(initial=0)) + self.most) ** 2 < EXACT

    def all(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to each entry, exact."""
        if self.fits(x):
            return (x * x).sum(1)[:, None] + (self.plain * self.plain).sum(1)[None] - 2 * (x @ self.plain.T)
        return np.stack([((whole(row)[None] - self.entries) ** 2).sum(1) for row in x]) if len(x) else np.zeros((0, len(self.entries)), object)

    def some(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Squared distances of each row to its own entries (rows x number), exact."""
        if self.fits(x):
            return ((x[:, None, :] - self.plain[which]) ** 2).sum(2)
        return ((whole(x)[:, None, :] - self.entries[which]) ** 2).sum(2) if len(x) else np.zeros(which.shape, object)

    def ranked(self, x: np.ndarray, listed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """From all distances: the nearest entry, its squared distance, those listed after it, and their bounds with the outer one."""
        d = self.all(x)
        own = d.argmin(1)
        rows = np.arange(len(x))
        far = np.sqrt(d.astype(float))
        far[rows, own] = -1
        order = np.argpartition(far, min(listed + 1, far.shape[1] - 1), 1)[:, : listed + 2]
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(far, order, 1), 1, kind="stable"), 1)[:, 1:]
        low = np.take_along_axis(far, order, 1) * (1 - SLACK)
        if low.shape[1] == listed:  # no further entries
            low = np.append(low, np.full((len(x), 1), np.inf), 1)
        return own, d[rows, own], order[:, :listed], low

    def revised(self, x: np.ndarray, own: np.ndarray, near: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ranked(), from what was known before the entries moved; and how many bounds failed for each row."""
        listed = near.shape[1]
        low = np.append(low[:, :listed] - self.moved[near], low[:, listed:] - self.moved.max(initial=0), 1)
        low = np.minimum.accumulate(low[:, ::-1], 1)[:, ::-1]
        near, own = near.copy(), own.copy()
        d = self.some(x, own[:, None])[:, 0]
        failed = (low <= (np.sqrt(d.astype(float)) * (1 + SLACK))[:, None]).sum(1)
        for z in range(1, listed + 1):
            at = np.flatnonzero(failed == z)
            if not len(at):
                continue
            which = np.append(own[at, None], near[at, :z], 1)
            exact = self.some(x[at], which)
            by_index = np.argsort(which, 1, kind="stable")
            order = np.take_along_axis(by_index, np.argsort(np.take_along_axis(exact, by_index, 1), 1, kind="stable"), 1)
            which, exact = np.take_along_axis(which, order, 1), np.take_along_axis(exact, order, 1)
            own[at], d[at], near[at, :z] = which[:, 0], exact[:, 0], which[:, 1:]
            low[at, :z] = np.sqrt(exact[:, 1:].astype(float)) * (1 - SLACK)
        at = np.flatnonzero(failed > listed)
        if len(at):
            own[at], d[at], near[at], low[at] = self.ranked(x[at], listed)
        return own, d, near, np.minimum.accumulate(low[:, ::-1], 1)[:, ::-1], failed


def pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Slices of bounded size."""
    step = max(1, PIECE // (8 * max(1, length)))
    for batch in batches:
        yield from (batch.slice(i, step) for i in range(0, batch.num_rows, step))


def _state(batch: pa.RecordBatch, x: np.ndarray, codes: np.ndarray, near: list[bytes], low: list[bytes], errors: np.ndarray) -> pa.RecordBatch:
    width = x.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(x.reshape(-1)))
    columns = [batch.column("key"), batch.column("label"), lists, pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())]
    errors = np.minimum(errors, LONG).astype(np.int64) if errors.dtype == object else errors.astype(np.int64)
    return pa.RecordBatch.from_arrays([*columns, pa.array(near, pa.binary()), pa.array(low, pa.binary()), pa.array(errors)], ["key", "label", "x", "codes", "near", "low", "error"])


def assigned(rows: DataFrame, books: list[Book], length: int) -> DataFrame:
    """The first assignment, from all distances: key, label, x, codes, near (part by part), low and error."""
    width, count = length // len(books), len(books[0].entries)
    listed = min(count - 1, max(FEWEST, round(LISTED * count)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, length):
            x = padded(batch.column("x"), length)
            found = [book.ranked(x[:, p * width : (p + 1) * width], listed) for p, book in enumerate(books)]
            codes, errors = np.stack([f[0] for f in found], 1), sum(f[1] for f in found)
            near, low = np.stack([f[2] for f in found], 1).astype(np.uint8), as_bounds(np.stack([f[3] for f in found], 1))
            yield _state(batch, x, codes, [r.tobytes() for r in near], [r.tobytes() for r in low], errors)

    return rows.mapInArrow(run, _schema(rows))


def _schema(rows: DataFrame) -> str:
    key, label = (rows.schema[c].dataType.simpleString() for c in ("key", "label"))
    return f"key {key}, label {label}, x array<double>, codes binary, near binary, low binary, error bigint"


def reassigned(state: DataFrame, books: list[Book], length: int) -> DataFrame:
    """The next assignment after the entries moved; lists are cut to the length that the task's rows needed so far."""
    parts, width = len(books), length // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.zeros(1 << 8, np.int64)
        for batch in pieces(batches, length):
            every = batch.column("near").to_pylist()
            sizes = np.array([len(n) for n in every]) // parts
            for listed in np.unique(sizes).tolist():
                same = batch.take(pa.array(np.flatnonzero(sizes == listed)))
                x = padded(same.column("x"), length)
                n = len(x)
                codes = np.frombuffer(b"".join(same.column("codes").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                near = np.frombuffer(b"".join(same.column("near").to_pylist()), np.uint8).reshape(n, parts, listed).astype(np.int64)
                low = from_bounds(np.frombuffer(b"".join(same.column("low").to_pylist()), np.uint16).reshape(n, parts, listed + 1))
                found = [book.revised(x[:, p * width : (p + 1) * width], codes[:, p], near[:, p], low[:, p]) for p, book in enumerate(books)]
                for f in found:
                    needed += np.bincount(f[4], minlength=1 << 8)
                enough = int(np.searchsorted(np.cumsum(needed), COVERED * needed.sum()))
                keep = min(listed, max(FEWEST, enough))
                codes, errors = np.stack([f[0] for f in found], 1), sum(f[1] for f in found)
                near = np.stack([f[2][:, :keep] for f in found], 1).astype(np.uint8)
                low = as_bounds(np.stack([f[3][:, : keep + 1] for f in found], 1))
                yield _state(same, x, codes, [r.tobytes() for r in near], [r.tobytes() for r in low], errors)

    return state.mapInArrow(run, state.schema)


def summed(state: DataFrame, parts: int, entries: int, length: int) -> list[dict[int, tuple[int, list[int]]]]:
    """For each part and entry: its number of parts and their sums by component. Tasks add up their rows first; the
    grouping then has a row for each component of the codebooks and task."""
    width = length // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), object)
        for batch in pieces(batches, length):
            x = padded(batch.column("x"), length)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(x), parts)
            exact = float(np.abs(x).max(initial=0)) * len(x) < EXACT
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                for j in range(width):
                    column = x[:, p * width + j]
                    if exact:
                        total[p, :, j] += whole(np.bincount(codes[:, p], column, entries))
                    else:
                        np.add.at(total[p, :, j], codes[:, p], whole(column))
        p, e = np.nonzero(count)
        at = np.repeat(np.arange(len(p)), width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p[at].astype(np.int32)), pa.array(e[at].astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(p))), pa.array(count[p, e][at]), pa.array([Decimal(t) for t in total[p, e].reshape(-1)], pa.decimal128(38, 0))],
            ["part", "entry", "place", "n", "total"],
        )

    sums = state.select("x", "codes").mapInArrow(run, "part int, entry int, place int, n bigint, total decimal(38,0)")
    found = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()  # as many rows as the codebooks have components
    out: list[dict[int, tuple[int, list[int]]]] = [{} for _ in range(parts)]
    for r in sorted(found, key=lambda r: (r["part"], r["entry"], r["place"])):
        out[r["part"]].setdefault(r["entry"], (r["n"], []))[1].append(int(r["total"]))
    return out


def compressed(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per row: key, code (two hex digits a part), error (squared distance of the vector to its entries), label_error (the
    sum of errors over the rows of the label), codebooks_sha256 (over all final entries, component by component)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    rows = integers(df, key, vector, label, scale)
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return rows.select(F.col("key").alias(key), F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    length = max(1, -(-longest // parts)) * parts
    firsts = rows.orderBy(F.asc_nulls_last("key"), "x").limit(entries).select("x").toArrow()
    start = whole(padded(firsts.column(0).combine_chunks(), length)).reshape(-1, parts, length // parts)
    books = [Book(start[:, p], np.zeros(len(start))) for p in range(parts)]
    state = written(assigned(rows, books, length), "codes")
    for _ in range(rounds):
        sums = summed(state, parts, len(start), length)
        books = [book.next(sums[p]) for p, book in enumerate(books)]
        before, state = state, written(reassigned(state, books, length), "codes")
        forget(before)
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book.entries for c in entry).encode()).hexdigest()
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("bigint")
    totals = state.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    joined = state.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("key").alias(key), F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
