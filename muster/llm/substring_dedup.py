"""Substring dedup by recompression: words that an earlier document already holds in a long repeat are removed.

Recompression rewrites a sequence of words in rounds. A round names what lies inside each run of one symbol, and then
each pair of a left and a right symbol (sides fall by a hash of the symbol). A name is a 64-bit hash of what it stands
for, so names are global without a table: equal substrings get equal symbols in any document, but for a few at their
ends, which depend on what is beside. Which symbols are certain in a window, whatever surrounds it, is followed round
by round. Each window takes as its anchor the longest certain symbol of the highest round that has one (ties by name).
Windows in a row with one anchor are a span, about 17 windows of 50 words after 6 rounds.

Spark then narrows down, a grouping each time, from symbols to words:
1. Anchors that two documents share are kept; a window that repeats has the same anchor in both.
2. Spans of shared anchors are grouped by a 128-bit hash of all their words. All but the span of the smallest id repeat
   it, and are removed as a whole. That settles the inside of repeats with a row a span, not a row a window.
3. An anchor with different spans is the end of a repeat (or a shorter one). One document for each such span has its
   windows compared one by one, by a 128-bit digest of their words, so that repeats reach as far as they hold.

Every document's whole text is read; nothing is capped, so a passage that a third of all documents holds is found like
any other, by groupings that combine before they shuffle. Texts move once, to the documents that need them.

Null and empty texts: no words, nothing removed. Documents shorter than a window keep all words. Rows are told apart by
id and text: those with the same id, of equal or of other texts, don't remove from each other; a null id neither removes
nor is removed from. Repeated rows come back as often as they came. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import BASE, BASE_INVERSE, chunks, mixed, power, words, written

WINDOW = 50
#: Rounds of recompression.
ROUNDS = 6

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def named_runs(symbol: np.ndarray, row: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray):
    """What lies between the first and the last symbol of a run becomes one symbol. The ends stay, so a window loses
    nothing at its edge unless it begins or ends within a run."""
    n = len(symbol)
    few = high - low < 2
    same = np.zeros(n + 1, bool)  # as the one before
    same[1:-1] = (symbol[1:] == symbol[:-1]) & (row[1:] == row[:-1])
    if not same.any():
        return symbol, row, start, np.where(few, 0, low), np.where(few, 0, high)
    begins = np.flatnonzero(~same[:-1])
    run = np.cumsum(~same[:-1]) - 1
    first, last = begins[run], np.append(begins[1:], n)[run] - 1
    inner = same[:-1] & same[1:]
    head = inner.copy()
    head[1:] &= ~inner[:-1]
    at = np.flatnonzero(head)
    length = (last - first - 1)[at]
    symbol = symbol.copy()
    symbol[at] = np.where(length > 1, mixed(symbol[at] * _A + length.astype(np.uint64) * _B), symbol[at])
    keep = ~inner | head
    place = np.cumsum(keep) - 1
    begin, end = last[np.minimum(low, n - 1)], first[np.maximum(high - 1, 0)]
    none = few | (end < begin)
    low, high = np.where(none, 0, place[begin]), np.where(none, 0, place[end] + 1)
    return symbol[keep], row[keep], start[keep], low, high


def named_pairs(symbol: np.ndarray, row: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, r: int):
    """Each left symbol with a right one behind it becomes one symbol."""
    n = len(symbol)
    right = (mixed(symbol + np.uint64((r + 1) * int(_B) & (1 << 64) - 1)) >> np.uint64(40)) & np.uint64(1) == 1
    second = np.zeros(n, bool)
    second[1:] = right[1:] & ~right[:-1] & (row[1:] == row[:-1])
    some = low < high
    low = low + right[np.minimum(low, n - 1)]  # it may belong to a left one outside
    high = high - ~right[np.maximum(high - 1, 0)]
    some &= low < high
    place = np.append(0, np.cumsum(~second))  # new symbols before each old one
    at = np.flatnonzero(second) - 1
    name = symbol.copy()
    name[at] = mixed(symbol[at] * _A + mixed(symbol[at + 1] + _B))
    low, high = (np.where(some, place[np.clip(x, 0, n)], 0) for x in (low, high))
    return name[~second], row[~second], start[~second], low, high


def recompressed(symbol: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int) -> list[tuple[np.ndarray, ...]]:
    """For each round, the words themselves first: names, first words, and the range of symbols that are certain in each
    window (low to high, in words at first; empty where none is)."""
    start = np.arange(len(symbol))
    out = [(symbol, start, low, high)]
    for r in range(rounds):
        symbol, row, start, low, high = named_pairs(*named_runs(symbol, row, start, low, high), r)
        out.append((symbol, start, low, high))
    return out


def greatest(rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of each range the place of its greatest rank, the first of equal ones; by maxima over powers of two."""
    table, step, longest = [np.arange(len(rank))], 1, int((high - low).max(initial=1))
    while 2 * step <= longest:
        a, b = table[-1][:-step], table[-1][step:]
        table.append(np.where(rank[a] >= rank[b], a, b))
        step *= 2
    out = np.empty(len(low), np.int64)
    power_of = np.frexp((high - low).astype(float))[1] - 1
    for j, best in enumerate(table):
        own = np.flatnonzero(power_of == j)
        a, b = best[low[own]], best[high[own] - (1 << j)]
        out[own] = np.where(rank[a] >= rank[b], a, b)
    return out


def spans_of(hashes: np.ndarray, bounds: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of these documents' spans: first and last window (by first word), anchor's name, and 128 bits over the words."""
    n = len(hashes)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    windows = np.flatnonzero(np.arange(n) + window <= bounds[1:][row]) if n else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    if not len(windows):
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint64)
    name, at, todo = np.zeros(len(windows), np.uint64), np.zeros(len(windows), np.int64), np.ones(len(windows), bool)
    for level, (symbol, start, low, high) in reversed(list(enumerate(recompressed(hashes, row, windows, windows + window, rounds)))):
        own = np.flatnonzero(todo & (low < high))
        if len(own):
            length = np.minimum(np.diff(np.append(start, n)), 255).astype(np.uint64)
            best = greatest(length << np.uint64(56) | symbol >> np.uint64(8), low[own], high[own])
            name[own], at[own], todo[own] = symbol[best], start[best] * (rounds + 1) + level, False
    opens = np.ones(len(windows), bool)
    opens[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
    begin = np.flatnonzero(opens)
    low, high = windows[begin], windows[np.append(begin[1:], len(windows)) - 1]
    back = power(BASE_INVERSE, n)[low]
    total = []
    for values in (hashes, mixed(hashes ^ _B)):
        upto = np.append(np.uint64(0), np.cumsum(values * power(BASE, n)))
        total.append(mixed((upto[high + window] - upto[low]) * back))
    return low, high, name[begin], *total


def normal(text: str | None) -> bytes:
    """The text's words with one space between."""
    return b" ".join(text.encode().split()) if text else b""


def parsed(docs: DataFrame, window: int, rounds: int) -> DataFrame:
    """Per row (key, tid, text): number of words, SHA-256 of the words, and its spans, as lists of equal length."""
    kind = "key bigint, tid bigint, n_words bigint, sha string, low array<int>, high array<int>, name array<bigint>, a array<bigint>, b array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            plain = [normal(t) for t in batch.column("text").to_pylist()]
            sizes = np.concatenate([[0], np.cumsum([len(p) for p in plain])]).astype(np.int64)
            _, _, hashes, bounds = words(np.frombuffer(b"".join(plain), np.uint8), sizes)
            low, high, *names = spans_of(hashes, bounds, window, rounds)
            cut = np.searchsorted(low, bounds)
            ends = pa.array(cut.astype(np.int32))
            first = bounds[np.searchsorted(bounds, low, "right") - 1]
            lists = [(low - first).astype(np.int32), (high - first).astype(np.int32), *(x.astype(np.int64) for x in names)]
            columns = [batch.column("key"), batch.column("tid"), pa.array(np.diff(bounds), pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in plain], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in lists)], [x.split()[0] for x in kind.split(", ")])

    return docs.select("key", "tid", "text").mapInArrow(run, kind)


def _merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Positions first to last of sorted ranges, as ranges that don't overlap."""
    low, high = None, None
    for a, b in sorted(spans):
        if low is None:
            low, high = a, b
        elif a > high + 1:
            yield low, high
            low, high = a, b
        else:
            high = max(high, b)
    if low is not None:
        yield low, high


def compared(candidates: DataFrame, window: int) -> DataFrame:
    """(digest, key, tid, low, high) of the windows in the candidates' open spans; windows that follow each other with the
    same words are one row."""
    names = ["digest", "key", "tid", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            rows: list[tuple] = []
            for key, tid, text, spans in zip(*(batch.column(c).to_pylist() for c in ("key", "tid", "text", "spans")), strict=True):
                plain = normal(text)
                begin, end, _, _ = words(np.frombuffer(plain, np.uint8), np.array([0, len(plain)]))
                begin, end, before, last = begin.tolist(), end.tolist(), None, -2
                for p in (p for low, high in sorted((s["low"], s["high"]) for s in spans if s["open"]) for p in range(low, high + 1)):
                    digest = hashlib.blake2b(plain[begin[p] : end[p + window - 1]], digest_size=16).digest()
                    if digest == before and p == last + 1:
                        rows[-1] = (*rows[-1][:4], p)
                    else:
                        rows.append((digest, key, tid, p, p))
                    before, last = digest, p
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names)

    return candidates.select("key", "tid", "text", "spans").mapInArrow(run, "digest binary, key bigint, tid bigint, low int, high int")


def cleaned(hits: DataFrame, window: int, texts: bool) -> DataFrame:
    """(key, tid, removed, kept, kept_text) of documents with spans and further windows that are removed."""
    names = ["key", "tid", "removed", "kept", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            out = []
            for key, tid, text, spans, more in zip(*(batch.column(c).to_pylist() for c in ("key", "tid", "text", "spans", "more")), strict=True):
                found = normal(text).split(b" ")
                kept, done, gone = [], 0, 0
                for first, last in _merged([(s["low"], s["high"] + window - 1) for s in [*(s for s in spans if not s["open"]), *(more or ())]]):
                    kept += found[done:first]
                    gone += last + 1 - first
                    done = last + 1
                rest = b" ".join(kept + found[done:])
                out.append((key, tid, gone, hashlib.sha256(rest).hexdigest(), rest.decode() if texts else None))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names)

    return hits.select("key", "tid", "text", "spans", "more").mapInArrow(run, "key bigint, tid bigint, removed bigint, kept string, kept_text string")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, rounds: int = ROUNDS, texts: bool = False) -> DataFrame:
    """Per row: key, n_words, n_removed, kept_sha256 of the kept words with one space between; with texts, kept_text too."""
    base = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(text).alias("tid"), F.col(text).alias("text"))
    rows = written(parsed(base, window, rounds), "parsed")
    held = rows.where("key is not null").select("key", "tid", F.explode(F.arrays_zip("low", "high", "name", "a", "b")).alias("x")).select("key", "tid", "x.*")
    # groupings are written before they are joined: a join of plain shuffles is one whose hot keys adaptive execution splits
    kinds = (F.min("a") < F.max("a")) | (F.min("b") < F.max("b"))
    shared = held.groupBy("name").agg(F.min("key").alias("first"), F.max("key").alias("last"), kinds.alias("ends")).where("first < last").select("name", "ends")
    spans = written(held.join(written(shared, "shared"), "name"), "spans")
    owners = written(spans.groupBy("name", "a", "b").agg(F.min("key").alias("owner")), "owners")
    decided = spans.join(owners, ["name", "a", "b"]).where("key > owner or ends").select("key", "tid", F.struct("low", "high", (F.col("key") <= F.col("owner")).alias("open")).alias("span"))
    windows = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + F.when(s["open"], F.lit(0)).otherwise(s["high"] - s["low"] + 1))
    lists = decided.groupBy("key", "tid").agg(F.collect_set("span").alias("spans")).withColumn("gone", windows)
    meta = rows.select("key", "tid", "n_words", "sha")
    lists = written(lists.join(meta.select("key", "tid", "n_words").distinct(), ["key", "tid"]).select("key", "tid", "spans", (F.col("gone") == F.col("n_words") - (window - 1)).alias("whole")), "lists")
    candidates = written(base.join(lists.where("not whole"), ["key", "tid"]), "candidates")
    opened = written(compared(candidates.where(F.exists("spans", lambda s: s["open"])), window), "windows")
    firsts = opened.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").select("digest", "first")
    more = opened.join(written(firsts, "firsts"), "digest").where("key > first").groupBy("key", "tid").agg(F.collect_set(F.struct("low", "high")).alias("more"))
    found = cleaned(candidates.join(more, ["key", "tid"], "left"), window, texts)
    found = (found if texts else found.drop("kept_text")).dropDuplicates(["key", "tid"])
    out = meta.join(lists.select("key", "tid", "whole"), ["key", "tid"], "left").join(found, ["key", "tid"], "left")
    copy = F.coalesce("whole", F.lit(False))
    columns = [
        F.col("key").alias(key),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    ]
    if not texts:
        return out.select(*columns)
    plain = F.array_join(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""), " ")
    whole = base.select("key", "tid", plain.alias("plain")).dropDuplicates(["key", "tid"])
    joined = out.join(whole.withColumnRenamed("key", "__key").withColumnRenamed("tid", "__tid"), F.col("key").eqNullSafe(F.col("__key")) & (F.col("tid") == F.col("__tid")), "left")
    return joined.select(*columns, F.when(copy, F.lit("")).otherwise(F.coalesce("kept_text", "plain")).alias("kept_text"))
