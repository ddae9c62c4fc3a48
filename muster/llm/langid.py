"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Text is lower-cased, whatever is no letter becomes one space, and the 1- to GRAMS-grams of characters are hashed into
BUCKETS features, weighted by log(1 + count) and by the inverse document frequency over all rows that may be learned
from, and scaled to length one. The regression is trained by follow-the-regularised-leader with elastic-net penalties
on a bounded sample (PER_LANGUAGE rows of each language on average, MOST in all, or LEAST for each language if that is
more, chosen by a hash of the row's key). Of each language two thirds of its sampled rows are trained on, one at least; the
others are kept for the temperature that calibrates the scores. So every language that a row may be learned from with is
learned, be it by a single row. The driver holds the languages' names and counts, and, while it trains, two numbers for
each language and feature; the tasks get the weights that aren't zero, by broadcast.

Null texts and texts without a letter are `und` with score 0. Rows with a null language are not learned from; with
nothing to learn from, every text is `und`. Repeated rows are predicted alike; long texts are read whole. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import chunks, written

#: Features, longest n-gram, and the sample's bounds.
BUCKETS, GRAMS = 1 << 14, 3
PER_LANGUAGE, MOST, LEAST = 1000, 8000, 40


@lru_cache(1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> np.ndarray | None:
    """How often each feature occurs in the text; None if it has no letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = letters()[codes]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    plain = np.where(letter, codes, np.uint32(32))[keep]
    plain = np.concatenate([[np.uint32(32)], plain, [np.uint32(32)]]).astype(np.uint32)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    rolled, found = np.zeros(len(plain), np.uint32), []
    for n in range(1, min(GRAMS, len(plain)) + 1):
        rolled = rolled[: len(plain) - n + 1] * np.uint32(0x01000193) + plain[n - 1 :]
        x = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
        found.append((x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> shift)
    return np.bincount(np.concatenate(found), minlength=BUCKETS)


class Weights:
    """The weights that aren't zero, feature by feature (the intercept last): languages and values from start[f] on."""

    def __init__(self, dense: np.ndarray) -> None:
        self.classes = len(dense)
        feature, self.language = np.nonzero(dense.T)
        self.value = dense.T[feature, self.language]
        self.start = np.searchsorted(feature, np.arange(dense.shape[1] + 1))

    def __getitem__(self, at: tuple[int, int]) -> float:
        """The weight of a language and a feature."""
        own = slice(*self.start[[at[1] % (len(self.start) - 1), at[1] % (len(self.start) - 1) + 1]])
        return float(self.value[own][self.language[own] == at[0]].sum())

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Of each language, for a row's features and their values."""
        at, x = np.append(at, len(self.start) - 2), np.append(x, 1.0)
        low, sizes = self.start[at], self.start[at + 1] - self.start[at]
        own = np.repeat(low - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
        return np.bincount(self.language[own], self.value[own] * np.repeat(x, sizes), self.classes)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: Weights
    temperature: float

    def vector(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(found)
        x = np.log1p(found[at]) * self.idf[at]
        norm = np.sqrt((x * x).sum())
        return at, x / norm if norm else x

    def predict(self, text: str | None) -> tuple[str, float]:
        found = counts(text) if self.languages else None
        if found is None:
            return "und", 0.0
        z = self.weights.logits(*self.vector(found)) / self.temperature
        p = np.exp(z - z.max())
        best = int(z.argmax())
        return self.languages[best], float(p[best] / p.sum())


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Per-coordinate follow-the-regularised-leader with L1 and L2 penalties; weights by class, the intercept last."""
    z, n = np.zeros((classes, BUCKETS + 1)), np.zeros((classes, BUCKETS + 1))

    def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for (at, x), label in zip(rows, y, strict=True):
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            zs, ns = z[:, at], n[:, at]
            w = solved(zs, ns)
            s = w @ x
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label] -= 1
            g = p[:, None] * x
            z[:, at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[:, at] = ns + g * g
    return solved(z, n)


def tempered(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least loss on rows that weren't trained on."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).mean())

    return min(np.geomspace(0.02, 20, 120), key=loss)


def train(docs: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the rows that `allowed` lets through; other rows' texts and languages are not read."""
    known = docs.where(allowed & F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    languages = sorted(sizes)
    most = max(MOST, LEAST * len(languages))
    per = min(PER_LANGUAGE, most // max(1, len(languages)))
    shares = docs.sparkSession.createDataFrame([(name, min(1.0, per / n)) for name, n in sizes.items()], "lang string, share double")
    place = (F.xxhash64("key").bitwiseAND(F.lit((1 << 40) - 1))) / F.lit(float(1 << 40))
    marked = known.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).join(F.broadcast(shares), "lang")  # a row for each language
    marked = marked.select(F.col("key").cast("string").alias("key"), "text", "lang", (place < F.col("share")).alias("chosen"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, n = np.zeros(BUCKETS, np.int64), 0
        names = ["key", "lang", "at", "n"]
        for batch in chunks(batches, "text"):
            rows = []
            for k, t, la, chosen in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "lang", "chosen")), strict=True):
                found = counts(t)
                if found is None:
                    continue
                frequency += found > 0
                n += 1
                if chosen:
                    at = np.flatnonzero(found)
                    rows.append((k, la, at, found[at]))
            if rows:
                k, la, at, c = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(la, pa.string()), pa.array(at, pa.list_(pa.int64())), pa.array(c, pa.list_(pa.int64()))], names)
        if n:
            at = np.append(np.flatnonzero(frequency), BUCKETS)
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([None], pa.string()), pa.array([at], pa.list_(pa.int64())), pa.array([np.append(frequency, n)[at]], pa.list_(pa.int64()))], names)

    seen = written(marked.mapInArrow(run, "key string, lang string, at array<bigint>, n array<bigint>"), "langid")
    totals = seen.where("lang is null").select(F.explode(F.arrays_zip("at", "n")).alias("x")).groupBy("x.at").agg(F.sum("x.n").alias("n")).collect()
    frequency = np.zeros(BUCKETS + 1)
    for r in totals:
        frequency[r["at"]] = r["n"]
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    sample = seen.where("lang is not null").orderBy(F.xxhash64("key", F.lit("order")), "key", "lang").limit(most).select("lang", "at", "n").toArrow()
    if not sample.num_rows:
        return Model([], idf, Weights(np.zeros((0, BUCKETS + 1))), 1.0)
    found = []
    for at, n in zip(sample.column("at"), sample.column("n"), strict=True):
        at = at.values.to_numpy().astype(np.int32)
        x = np.log1p(n.values.to_numpy()) * idf[at]
        found.append((at, x / np.sqrt((x * x).sum())))
    place_of = {name: i for i, name in enumerate(languages)}
    y = np.array([place_of[name] for name in sample.column("lang").to_pylist()])
    order = np.argsort(y, kind="stable")
    place, size = np.empty(len(y), np.int64), np.bincount(y, minlength=len(languages))
    place[order] = np.arange(len(y)) - np.repeat(np.cumsum(size) - size, size)  # of a row among those of its language
    taught = place < np.maximum(1, size[y] * 2 // 3)
    own, rest = np.flatnonzero(taught).tolist(), np.flatnonzero(~taught).tolist()
    weights = Weights(ftrl([found[i] for i in own], y[own], len(languages)))
    logits = np.array([weights.logits(*found[i]) for i in rest]).reshape(-1, len(languages))
    return Model(languages, idf, weights, tempered(logits, y[rest]))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row, from its text alone."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in chunks(batches, "text", 1 << 20):
            got = [own.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["key", "lang_pred", "score"])

    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, lang_pred string, score double")
    return found.withColumnRenamed("key", key)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; rows that are held out are not learned from."""
    model = train(docs, ~held_out(F.col("doc_id")))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
