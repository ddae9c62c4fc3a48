"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features: densities of a given and of a learned lexicon (words and word beginnings), second-person words near hits,
capitals, punctuation, and obfuscation (digits or signs inside words, spelled-out letters, hits after undoing them).

Training takes a bounded sample of the labelled rows (SAMPLE rows, those with the smallest hash of their id, one per
group of near copies, that with the smallest id). The same rows give the same scores however they are partitioned. Half
of the sample teaches the lexicon: distributed counts, per class, of the texts that hold a word or a word's beginning.
The other half gives features, of which 70 % train the trees and 30 % the calibration; so neither the trees nor the
calibration see features that were fitted to their own rows. Scoring reads every whole text.

Null and empty texts get the score of all-zero features; repeated rows are scored alike and kept or dropped together.
Labels that are null are not used; a document labelled twice counts as toxic if one label says so. With labelled rows
of one class only, every score is that class (0 or 1); without any labelled rows it is 0.5. Only the key and the text are read, so other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import chunks, written
from muster.llm.ngram_join import gram_sets

#: Most labelled rows that training takes.
SAMPLE = 20_000
#: Tasks that work on the sample.
SPREAD = 24
#: Most terms of the learned lexicon, and the log-odds that a term needs.
TERMS, LEAST_ODDS = 400, 2.5
#: Share of the toxic texts that a term is in at least.
SUPPORT = 0.01
#: Lengths of the word beginnings that the lexicon may hold.
BEGINNINGS = (4, 5, 6)
#: The given lexicon: common insults of four languages.
INSULTS = frozenset(
    "idiot idiots moron morons loser losers scum stupid pathetic worthless trash clown clowns disgusting dumb jerk filth garbage vermin creep "
    "dummkopf trottel arschloch abschaum versager widerlich dreck schwein wertlos erbärmlich blöd "
    "imbécile crétin ordure minable dégueulasse pourriture débile abruti connard salaud "
    "imbécil estúpido estúpida basura escoria inútil patético patética payaso asqueroso tonto cabrón".split()
)
#: Second-person words of the same languages.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos ti tú usted ustedes vosotros tus su".split())
#: Signs that stand for letters.
SIGNS = str.maketrans("013457@$!|", "oieastasil", "*.-_+")
LETTERS = re.compile(r"[^\W\d_]+")
BROKEN = re.compile(r"[^\W\d_]+(?:[0-9@$!|*._+\-]+[^\W\d_]+)+")
CAPITAL_WORDS = re.compile(r"\b[^\W\d_a-zà-ÿ]{3,}\b")
SPELLED = re.compile(r"(?<!\w)(?:[^\W\d_][ .*_\-]){2,}[^\W\d_](?!\w)")
FEATURES = (
    "insult_density", "insult_hits", "learned_density", "learned_hits", "learned_kinds", "best_term", "near_second_person", "second_person",
    "capitals", "capital_words", "punctuation", "exclamations", "signs", "digits", "broken_rate", "broken_hits", "spelled_rate", "spelled_hits",
    "words", "word_length", "distinct",
)


@lru_cache(1)
def character_kinds() -> list[int]:
    """Of each character of the first 64 k: 1 capital, 2 punctuation, 3 exclamation or question mark, 4 other sign, 5 digit, 0 else."""
    out = [0] * (1 << 16)
    for i in range(1 << 16):
        c = chr(i)
        out[i] = 1 if c.isupper() else 5 if c.isdigit() else 3 if c in "!?¡¿" else 2 if c in ".,;:'\"()[]-–—«»…" else 4 if i > 32 and not c.isalnum() and not c.isspace() else 0
    return out


#: What is kept of a token: sums over a text's tokens give its features.
(WORDS, INSULT, LEARNED, WEIGHT, YOU, LETTER, CAPITAL, CAPITAL_WORD, PUNCTUATION, EXCLAMATION, SIGN, DIGIT, BROKEN_WORD, BROKEN_HIT, SINGLE, LENGTH) = range(16)
#: Most tokens that a worker remembers; beyond it the memory starts anew. Longer tokens are worked out each time.
REMEMBERED, LONGEST = 100_000, 64


class Tokens:
    """Features of texts under one learned lexicon. What a token adds is worked out once, since tokens repeat."""

    def __init__(self, terms: dict[str, float]) -> None:
        self.terms = terms
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, 16))

    def weight(self, word: str) -> float:
        """The weight of the word, or of its heaviest known beginning; 0 if the lexicon has neither."""
        return max([self.terms.get(word, 0.0), *(self.terms.get(f"{word[:k]}*", 0.0) for k in BEGINNINGS if len(word) >= k)])

    def row(self, token: str) -> list[float]:
        low = token.lower()
        capitals = 0 if low == token else sum(map(str.isupper, token))
        if low.isalpha():
            weight = self.weight(low)
            return [1, low in INSULTS, weight > 0, weight, low in SECOND_PERSON, len(low), capitals, capitals == len(token) > 2, 0, 0, 0, 0, 0, 0, len(low) == 1, len(token)]
        found = LETTERS.findall(low)
        weights = [self.weight(w) for w in found]
        kinds = character_kinds()
        kind = [kinds[ord(c)] if c < "\uffff" else 4 for c in token]
        undone = [w.translate(SIGNS) for w in BROKEN.findall(low)] if found else []
        return [
            len(found), sum(w in INSULTS for w in found), sum(w > 0 for w in weights), max(weights, default=0.0), sum(w in SECOND_PERSON for w in found), sum(map(len, found)),
            capitals, len(CAPITAL_WORDS.findall(token)) if capitals > 2 else 0, kind.count(2), kind.count(3), kind.count(4), kind.count(5),
            len(undone), sum(w in INSULTS or self.weight(w) > 0 for w in undone), 0, len(token),
        ]

    def places(self, tokens: list[str]) -> np.ndarray:
        new = set(tokens).difference(self.place)
        if new and len(self.place) + len(new) > REMEMBERED:
            self.place.clear()
            new = set(tokens)
        for token in new:
            at = len(self.place)
            if at == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[at] = self.row(token)
            self.place[token] = at
        return np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens))

    def features(self, text: str | None) -> list[float]:
        """The features of one text, in the order of FEATURES."""
        tokens = text.split() if text else []
        if not tokens:
            return [0.0] * len(FEATURES)
        long = [t for t in tokens if len(t) > LONGEST]
        at = self.places([t for t in tokens if len(t) <= LONGEST] if long else tokens)
        rows = self.rows[at]
        if long:
            rows = np.concatenate([rows, [self.row(t) for t in long]])
        total = rows.sum(0)
        n, characters = max(1.0, total[WORDS]), len(text)
        marked = np.flatnonzero((rows[:, INSULT] > 0) | (rows[:, LEARNED] > 0))
        kinds = len(np.unique(at[rows[: len(at), LEARNED] > 0])) if total[LEARNED] else 0
        near = 0
        if total[YOU] and len(marked):
            who = np.flatnonzero(rows[:, YOU] > 0)
            near = int((np.searchsorted(who, marked + 5, "right") > np.searchsorted(who, marked - 5)).sum())
        spelled = 0, 0
        single = np.flatnonzero(rows[:, SINGLE])
        if (single[2:] - single[:-2] == 2).any():
            runs = [x for x in SPELLED.findall(text.lower())]
            whole = ["".join(LETTERS.findall(x)) for x in runs]
            spelled = len(runs), sum(w in INSULTS or self.weight(w) > 0 for w in whole)
        return [
            total[INSULT] / n, min(total[INSULT], 20), total[LEARNED] / n, min(total[LEARNED], 50), kinds, rows[:, WEIGHT].max(), near / n * 100, total[YOU] / n,
            total[CAPITAL] / characters, total[CAPITAL_WORD] / n, total[PUNCTUATION] / characters, total[EXCLAMATION] / characters, total[SIGN] / characters, total[DIGIT] / characters,
            total[BROKEN_WORD] / n, total[BROKEN_HIT], spelled[0] / n, spelled[1],
            np.log1p(total[WORDS]), total[LETTER] / n, len(set(tokens)) / len(tokens),
        ]


@dataclass
class Model:
    """Terms of the learned lexicon, the trees (feature, threshold, value by node) and the calibration's steps."""

    terms: dict[str, float] = field(default_factory=dict)
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.5]))

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(feature[node], 0)] > threshold[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated; a small share of the plain logistic score keeps the order of rows within a step."""
        raw = self.raw(x)
        return 0.998 * np.interp(raw, *self.steps) + 0.002 / (1 + np.exp(-raw))


def boosted(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 48, least: int = 20, ridge: float = 1.0, gain: float = 4.0) -> Model:
    """Newton boosting of the logistic loss on histograms of the features' quantiles; a split must win `gain`."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Model(start=float(np.log(share / (1 - share))))
    out = np.full(len(y), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-out))
        grad, hess = y - p, p * (1 - p)
        size = 2 ** (depth + 1) - 1
        feature, threshold, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        node = np.zeros(len(y), np.int64)
        for k in range(2**depth - 1):
            own = np.flatnonzero(node == k)
            if len(own) < 2 * least:
                continue
            g, h = grad[own], hess[own]
            best = (gain, -1, 0)
            whole = g.sum() ** 2 / (h.sum() + ridge)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[own, f]
                gl = np.cumsum(np.bincount(b, g, len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h, len(e) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                won = gl**2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge) - whole
                won[(nl < least) | (len(own) - nl < least)] = 0
                at = int(won.argmax())
                if won[at] > best[0]:
                    best = (won[at], f, at)
            if best[1] >= 0:
                feature[k], threshold[k] = best[1], edges[best[1]][best[2]]
                node[own] = 2 * k + 1 + (binned[own, best[1]] > best[2])
        total_g, total_h = np.bincount(node, grad, size), np.bincount(node, hess, size)
        value[:] = rate * total_g / (total_h + ridge)
        value[feature >= 0] = 0
        out += value[node]
        model.trees.append((feature, threshold, value))
    return model


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to y by squares (pool adjacent violators), as points to interpolate."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum, count, first, last
    for v, t in zip(raw[order], y[order], strict=True):
        blocks.append([t, 1, v, v])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = last
    xs = [v for b in blocks for v in ((b[2], b[3]) if b[3] > b[2] else (b[2],))]
    ys = [b[0] / b[1] for b in blocks for _ in range(2 if b[3] > b[2] else 1)]
    return np.array(xs), np.clip(np.array(ys), 0, 1)


def learned(sample: DataFrame) -> dict[str, float]:
    """Words and word beginnings ('abcd*') that toxic texts hold far oftener, by smoothed log-odds."""
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return {}
    word = F.filter(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")), lambda w: F.length(w) > 2)
    starts = [F.transform(F.filter(word, lambda w: F.length(w) >= k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*"))) for k in BEGINNINGS]
    terms = sample.select("y", F.explode(F.array_distinct(F.concat(word, *starts))).alias("term"))
    counted = terms.groupBy("term").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
    odds = F.log((F.col("p") + 0.5) / F.lit(pos + 1.0)) - F.log((F.col("q") + 0.5) / F.lit(neg + 1.0))
    best = counted.where(F.col("p") >= max(3, round(SUPPORT * pos))).withColumn("w", odds).where(F.col("w") >= LEAST_ODDS)
    return {r["term"]: float(r["w"]) for r in best.orderBy((F.col("p") * F.col("w")).desc(), "term").limit(TERMS).collect()}


def _featured(terms: dict[str, float], keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tokens(terms)
        for batch in chunks(batches, "text"):
            rows = [own.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(rows, pa.list_(pa.float64()))], [*keep, "x"])

    return run


def sampled(docs: DataFrame, labels: DataFrame, allowed: Column | None, most: int) -> DataFrame:
    """At most so many labelled rows (doc_id, text, y) as a table; of texts with one smallest 5-gram hash (copies, near
    or exact) one, or the lexicon would learn what a group of copies has in common."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")  # at most `most` rows of two numbers

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            least = [int(g[0]) if len(g) else 0 for g in gram_sets(batch, "text", 5)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "text", "y")), pa.array(np.array(least, np.uint64).astype(np.int64))], ["doc_id", "text", "y", "gram"])

    marked = texts.select("doc_id", "text", "y").mapInArrow(sketched, "doc_id bigint, text string, y int, gram bigint")
    one = marked.groupBy("gram").agg(F.min(F.struct("doc_id", "text", "y")).alias("row")).select("row.*")
    return written(one.repartition(SPREAD, "doc_id"), "toxic-sample")


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, most: int = SAMPLE) -> Model:
    """A model from the labels (doc_id, toxic) that `allowed`, a condition on doc_id, lets through."""
    sample = sampled(docs, labels, allowed, most)
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(10))
    terms = learned(sample.where(half < 5))
    rows = sample.where(half >= 5).mapInArrow(_featured(terms, ["doc_id", "y"]), "doc_id bigint, y int, x array<double>").collect()
    if len(rows) < 40:
        rows += sample.where(half < 5).mapInArrow(_featured(terms, ["doc_id", "y"]), "doc_id bigint, y int, x array<double>").collect()
    rows.sort(key=lambda r: (hash_of(r["doc_id"]), r["doc_id"], r["y"], r["x"]))
    y = np.array([r["y"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return Model(terms, steps=(np.array([0.0]), np.array([float(y[0]) if len(y) else 0.5])))
    x = np.array([r["x"] for r in rows])
    cut = round(0.7 * len(y))
    if len(set(y[:cut])) < 2 or len(set(y[cut:])) < 2:
        cut = len(y)
    model = boosted(x[:cut], y[:cut], least=int(np.clip(cut // 50, 3, 20)))
    model.terms = terms
    held = slice(cut, None) if cut < len(y) else slice(None)
    model.steps = isotonic(model.raw(x[held]), y[held])
    return model


def hash_of(key: int) -> int:
    """An order of rows that has nothing to do with their ids."""
    return (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 20


def scored(model: Model, batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches, bounded in bytes of text, with the score of each row."""
    own = Tokens(model.terms)
    for batch in chunks(batches, text, 1 << 20):
        x = np.array([own.features(t.as_py()) for t in batch.column(text)], float).reshape(-1, len(FEATURES))
        yield batch, model.score(x)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in scored(model, batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["key", "score"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, score double").select(F.col("key").alias(key), "score")


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether the row is of that part of the keys: CRC-32 of the key as text, modulo the number of parts."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; rows that are held out are not learned from."""
    model = train(docs, labels, ~held_out(F.col("doc_id"), 4, 2))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents whose score is below the threshold, all columns as they were; all of them where labels of both
    classes are missing, since then nothing tells toxic documents from others."""
    model = train(docs, labels, ~held_out(F.col("doc_id"), 4, 2))
    if not model.trees:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in scored(model, batches, "text"):
            yield batch.filter(pa.array(found < threshold))

    return docs.mapInArrow(run, docs.schema)
