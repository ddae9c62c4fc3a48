"""Quality of texts: a convolutional network over their bytes, in numpy.

FILTERS learned filters of WIDTH bytes are applied at every byte of a text. A filter is a table of a weight for each byte
value at each place, so no embedding is needed; for speed, tables of two neighbouring places are added up to one by byte
pair. The text is cut into blocks of BLOCK bytes; two neighbouring blocks are a chunk, so that chunks overlap by half and
cover the whole text, however long. A chunk's value of a filter is its greatest in the chunk, cut off at zero; a text's are
the mean and the greatest over its chunks. One logistic unit makes a probability of them.

Training takes a bounded sample of the labelled rows (SAMPLE rows, those with the smallest hash of their id), four fifths
for Adam steps through the greatest places, a fifth for the choice of the epoch and for a slope and an intercept that
calibrate the probability. Of a sampled text with more than BLOCKS blocks, BLOCKS / 2 chunks spread over the whole text
teach, so that the driver holds a bounded number of bytes. Scoring reads every byte of every text.

Null and empty texts get the score of a text without bytes (all filters at zero). Texts shorter than a filter are filled
up with zero bytes. Repeated rows are scored alike. Labels that are null are not used; a document labelled twice is good
if one label says so. With labelled rows of one class only, every score is that class (0 or 1); without any it is 0.5.
Only the key and the text are read, so other columns don't matter; null keys are scored, but teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import chunks, utf8
from muster.llm.toxicity import hash_of, held_out

#: Filters, bytes of a filter (even), bytes of a block.
FILTERS, WIDTH, BLOCK = 16, 6, 256
#: Most labelled rows that training takes, and most blocks of one of them.
SAMPLE, BLOCKS = 4096, 64
#: Rounds over the sample, texts of a step, length of a step, penalty on the weights.
EPOCHS, BATCH, RATE, PENALTY = 5, 32, 0.02, 1e-5
#: Bytes that are filtered at a time.
SEGMENT = 1 << 15


@dataclass
class Model:
    """Weights by place, byte and filter; the filters' offsets; the last unit's weights and offset; slope and intercept."""

    tables: np.ndarray
    offset: np.ndarray
    last: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0

    def pairs(self) -> list[np.ndarray]:
        """For every two places one table by byte pair."""
        return [(self.tables[j][:, None, :] + self.tables[j + 1][None, :, :]).reshape(1 << 16, -1) for j in range(0, WIDTH, 2)]

    def logits(self, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
        z = np.concatenate([mean, most], 1).astype(np.float64) @ self.last + self.bias
        return self.slope * z + self.intercept

    def score(self, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(mean, most), -700, 700)))


@dataclass
class Constant:
    """The model where labels of both classes are missing."""

    value: float


def block_maxima(raw: np.ndarray, bounds: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The filters' greatest values in each block of all texts (raw bytes and each text's bounds), and each text's bounds
    among the blocks. A text without bytes has none."""
    sizes = np.diff(bounds)
    counts = -(-sizes // BLOCK)
    cut = np.append(0, np.cumsum(counts))
    out = np.empty((cut[-1], tables[0].shape[1]), np.float32)
    gap = WIDTH - 1
    at = 0
    while at < len(sizes):  # texts that fill a segment, or pieces of one that is longer
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SEGMENT, "right")) - 1)
        for low in range(0, max(1, int(sizes[at])) if end == at + 1 else 1, SEGMENT):
            if end == at + 1:
                texts = [raw[bounds[at] + low : min(bounds[at] + low + SEGMENT + gap, bounds[at + 1])]]
                lengths = [min(SEGMENT, int(sizes[at]) - low)]
            else:
                texts = [raw[bounds[i] : bounds[i + 1]] for i in range(at, end)]
                lengths = sizes[at:end].tolist()
            plain = np.zeros(sum(map(len, texts)) + gap * len(texts) + 1, np.uint16)
            starts, own, place = [], [], 0
            for text, n in zip(texts, lengths, strict=True):
                plain[place : place + len(text)] = text
                blocks = range(place, place + n, BLOCK)
                starts += [*blocks, place + n]  # what follows a text is cut off
                own += [True] * len(blocks) + [False]
                place += len(text) + gap
            pair = plain[:-1] << np.uint16(8) | plain[1:]
            n = len(plain) - gap
            z = tables[0].take(pair[:n], 0)
            for j in range(1, len(tables)):
                z += tables[j].take(pair[2 * j : 2 * j + n], 0)
            keep = np.array(own)
            if keep.any():
                starts = np.array(starts)
                first = int(cut[at]) + low // BLOCK
                out[first : first + int(keep.sum())] = np.maximum.reduceat(z, starts[starts < n], 0)[keep[: int((starts < n).sum())]]
        at = end
    return out, cut


def pooled(maxima: np.ndarray, cut: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and greatest over each text's chunks; zeros for a text without blocks."""
    mean, most = np.zeros((2, len(cut) - 1, maxima.shape[1]), np.float32)
    value = np.maximum(maxima + offset, 0)
    counts = np.diff(cut)
    some = np.flatnonzero(counts)
    if not len(some):
        return mean, most
    chunk = np.maximum(value, np.append(value[1:], value[-1:], 0))  # a block and the next one
    lone = counts[some] == 1
    last = cut[some + 1] - 1
    chunk[last[~lone]] = 0  # a text of n blocks has n - 1 chunks; one of a single block has that
    chunk[last[lone]] = value[last[lone]]
    total = np.add.reduceat(chunk, cut[some], 0, dtype=np.float64)
    mean[some] = total / np.maximum(counts[some] - 1, 1)[:, None]
    most[some] = np.maximum.reduceat(chunk, cut[some], 0)
    return mean, most


def blocks_of(raw: np.ndarray) -> tuple[bytes, bool]:
    """A text's blocks, each with the bytes that a filter reads beyond it; all of them in order (True), or those of chunks
    spread over the whole text, two by two (False)."""
    count = -(-len(raw) // BLOCK)
    plain = np.zeros(count * BLOCK + WIDTH - 1, np.uint8)
    plain[: len(raw)] = raw
    which = np.arange(count)
    if count > BLOCKS:
        first = np.linspace(0, count - 2, BLOCKS // 2).astype(np.int64)
        which = np.stack([first, first + 1], 1).reshape(-1)
    return plain[which[:, None] * BLOCK + np.arange(BLOCK + WIDTH - 1)].tobytes(), count <= BLOCKS


@dataclass
class Taught:
    """Sampled texts: their blocks, how many bytes of each block count, each text's chunks (pairs of blocks) and bounds."""

    blocks: np.ndarray
    lengths: np.ndarray
    first: list[np.ndarray]
    second: list[np.ndarray]
    y: np.ndarray

    @staticmethod
    def of(rows: list[tuple[bytes, bool, int, int]]) -> Taught:
        """From (blocks, all in order, bytes of the text, label)."""
        held, lengths, first, second, at = [], [], [], [], 0
        for data, whole, size, _ in rows:
            blocks = np.frombuffer(data, np.uint8).reshape(-1, BLOCK + WIDTH - 1)
            n = len(blocks)
            own = np.full(n, BLOCK)
            if n:
                own[-1] = size - (-(-size // BLOCK) - 1) * BLOCK
            held.append(blocks)
            lengths.append(own)
            a = at + (np.arange(max(n - 1, min(n, 1))) if whole else np.arange(0, n, 2))
            first.append(a)
            second.append(np.minimum(a + 1, at + n - 1) if n else a)
            at += n
        return Taught(np.concatenate(held), np.concatenate(lengths), first, second, np.array([r[3] for r in rows], float))

    def forward(self, model: Model, which: np.ndarray, tables: list[np.ndarray]):
        """Mean and greatest of the chunks of these texts, and what the way back needs."""
        texts = [i for i in which.tolist()]
        own = np.unique(np.concatenate([np.concatenate([self.first[i], self.second[i]]) for i in texts]).astype(np.int64))
        blocks = self.blocks[own].astype(np.uint16)
        pair = blocks[:, :-1] << np.uint16(8) | blocks[:, 1:]
        z = tables[0][pair[:, :BLOCK]]
        for j in range(1, len(tables)):
            z += tables[j][pair[:, 2 * j : 2 * j + BLOCK]]
        z[np.arange(BLOCK)[None] >= self.lengths[own][:, None]] = -np.inf
        place = z.argmax(1)
        value = np.take_along_axis(z, place[:, None], 1)[:, 0] + model.offset
        mean, most = np.zeros((2, len(texts), value.shape[1]))
        back = []
        for n, i in enumerate(texts):
            a, b = np.searchsorted(own, self.first[i]), np.searchsorted(own, self.second[i])
            if not len(a):
                back.append(None)
                continue
            better = np.where(value[b] > value[a], b[:, None], a[:, None])
            chunk = np.maximum(np.take_along_axis(value, better, 0), 0)
            mean[n], top = chunk.mean(0), chunk.argmax(0)
            most[n] = chunk[top, np.arange(chunk.shape[1])]
            back.append((better, chunk > 0, top))
        return mean, most, (own, blocks, place, back)


class Adam:
    """Steps by first and second moments."""

    def __init__(self, rate: float) -> None:
        self.rate, self.n, self.moments = rate, 0, {}

    def step(self, name: str, value: np.ndarray, grad: np.ndarray) -> np.ndarray:
        m, v = self.moments.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        self.moments[name] = m, v
        return value - self.rate * (m / (1 - 0.9**self.n)) / (np.sqrt(v / (1 - 0.999**self.n)) + 1e-8)


def gradients(model: Model, taught: Taught, which: np.ndarray, tables: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Of the mean logistic loss over these texts, by the names of the model's fields."""
    mean, most, (own, blocks, place, back) = taught.forward(model, which, tables)
    x = np.concatenate([mean, most], 1)
    p = 1 / (1 + np.exp(-(x @ model.last + model.bias)))
    error = (p - taught.y[which]) / len(which)
    filters = mean.shape[1]
    value = np.zeros((len(own), filters))
    each = np.arange(filters)
    for e, found in zip(error, back, strict=True):
        if found is None:
            continue
        better, alive, top = found
        flow = np.where(alive, e * model.last[None, :filters] / len(better), 0)
        flow[top, each] += np.where(alive[top, each], e * model.last[filters:], 0)
        np.add.at(value, (better, each[None]), flow)
    tables_of = np.zeros((WIDTH, 256, filters))
    at = np.flatnonzero(value.any(1))
    for j in range(WIDTH):
        index = blocks[at[:, None], place[at] + j].astype(np.int64) * filters + each
        tables_of[j] = np.bincount(index.reshape(-1), value[at].reshape(-1), 256 * filters).reshape(256, filters)
    return {"tables": tables_of, "offset": value.sum(0), "last": error @ x, "bias": np.array(error.sum())}


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve with the least penalised loss, by Newton steps."""
    x = np.stack([z, np.ones_like(z)], 1)
    w, pull = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (p - y) + (w - pull))
    return max(float(w[0]), 1e-3), float(w[1])


def loss_of(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean())


def fitted(taught: Taught, seed: int = 5) -> Model:
    """Trained on the first four fifths of the texts; the rest picks the epoch and calibrates."""
    rng = np.random.default_rng(seed)
    model = Model(rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, 2 * FILTERS))
    n = len(taught.y)
    cut = n * 4 // 5
    if len(set(taught.y[:cut])) < 2 or len(set(taught.y[cut:])) < 2:
        cut = n
    model.bias = float(np.log((taught.y[:cut].mean() + 1e-3) / (1 - taught.y[:cut].mean() + 1e-3)))
    held, adam, best = np.arange(cut, n) if cut < n else np.arange(n), Adam(RATE), (np.inf, model)
    epochs = max(EPOCHS, min(60, 5000 // max(1, cut)))  # so that few rows get enough steps
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(cut)
        for batch in (order[i : i + BATCH] for i in range(0, cut, BATCH)):
            adam.n += 1
            grads = gradients(model, taught, batch, model.pairs())
            tables = adam.step("tables", model.tables, grads["tables"] + PENALTY * model.tables).astype(np.float32)
            offset = adam.step("offset", model.offset, grads["offset"]).astype(np.float32)
            model = Model(tables, offset, adam.step("last", model.last, grads["last"] + PENALTY * model.last), float(adam.step("bias", np.array(model.bias), grads["bias"])))
        z = held_logits(model, taught, held)
        found = loss_of(z, taught.y[held])
        if found < best[0]:
            best = found, model
    z = held_logits(best[1], taught, held)
    slope, intercept = calibrated(z, taught.y[held])
    return replace(best[1], slope=slope, intercept=intercept)


def held_logits(model: Model, taught: Taught, which: np.ndarray) -> np.ndarray:
    tables = model.pairs()
    parts = [taught.forward(model, which[i : i + BATCH], tables)[:2] for i in range(0, len(which), BATCH)]
    return np.concatenate([model.logits(mean, most) for mean, most in parts])


def sampled(docs: DataFrame, labels: DataFrame, allowed: Column | None, most: int) -> list[tuple[bytes, bool, int, int]]:
    """(blocks, all in order, bytes, label) of at most so many labelled rows, in an order of their own."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    known = known.groupBy("doc_id").agg((F.max("quality") == 1).cast("int").alias("y")).orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").limit(most)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")  # at most `most` rows of two numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            raw, bounds = utf8(batch.column("text"))
            found = [blocks_of(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = [batch.column("doc_id"), pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.bool_()), pa.array(np.diff(bounds), pa.int64()), batch.column("y")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "data", "whole", "size", "y"])

    got = texts.mapInArrow(run, "doc_id bigint, data binary, whole boolean, size bigint, y int").dropDuplicates(["doc_id", "data"]).toArrow()
    rows = list(zip(*(got.column(c).to_pylist() for c in ("doc_id", "data", "whole", "size", "y")), strict=True))
    rows.sort(key=lambda r: (hash_of(r[0]), r[0], r[1]))
    return [r[1:] for r in rows[:most]]


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, most: int = SAMPLE) -> Model | Constant:
    """A model from the labels (doc_id, quality) that `allowed`, a condition on doc_id, lets through."""
    rows = sampled(docs, labels, allowed, most)
    classes = {r[3] for r in rows}
    if len(classes) < 2:
        return Constant(float(classes.pop()) if classes else 0.5)
    return fitted(Taught.of(rows))


def score(docs: DataFrame, model: Model | Constant, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, from all bytes of its text."""
    kind = docs.schema[key].dataType.simpleString()
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if isinstance(model, Constant):
        return plain.select(F.col("key").alias(key), F.lit(model.value).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.pairs()
        for batch in chunks(batches, "text", 1 << 20):
            maxima, cut = block_maxima(*utf8(batch.column("text")), tables)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.score(*pooled(maxima, cut, model.offset)))], ["key", "score"])

    return plain.mapInArrow(run, f"key {kind}, score double").select(F.col("key").alias(key), "score")


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; rows that are held out are not learned from."""
    apart = held_out(F.col("doc_id"), 5, 0)
    model = train(docs, labels, ~apart)
    return score(docs, model).select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
