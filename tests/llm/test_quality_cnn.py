from __future__ import annotations

import zlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from muster.llm import quality_cnn as q

DOCS = "doc_id long, text string, lang string, source string, score double, key string"
LABELS = "doc_id long, quality int, toxic int, text string, key string"


def model(seed=1, filters=3):
    rng = np.random.default_rng(seed)
    return q.Model(rng.normal(size=(q.WIDTH, 256, filters)).astype(np.float32), rng.normal(size=filters).astype(np.float32), rng.normal(size=2 * filters), 0.3, 1.2, -0.1)


def plain_score(m, text: bytes) -> float:
    """Every filter at every byte, chunk by chunk."""
    filters = len(m.offset)
    size = q.BLOCK
    blocks = [range(i, min(i + size, len(text))) for i in range(0, len(text), size)]
    padded = text + bytes(q.WIDTH)
    at = lambda t, f: sum(float(m.tables[j, padded[t + j], f]) for j in range(q.WIDTH))
    chunks = [[*a, *b] for a, b in zip(blocks, blocks[1:], strict=False)] or blocks
    value = [[max(0.0, max(at(t, f) for t in c) + float(m.offset[f])) for f in range(filters)] for c in chunks]
    x = [sum(v[f] for v in value) / len(value) if value else 0.0 for f in range(filters)] + [max((v[f] for v in value), default=0.0) for f in range(filters)]
    z = m.slope * (sum(a * b for a, b in zip(x, m.last, strict=True)) + m.bias) + m.intercept
    return 1 / (1 + np.exp(-z))


@pytest.mark.parametrize("segment", [64, 1 << 10, q.SEGMENT])
def test_scores_equal_a_plain_network(monkeypatch, segment):
    monkeypatch.setattr(q, "BLOCK", 16)
    monkeypatch.setattr(q, "SEGMENT", segment)
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 1, 5, 15, 16, 17, 31, 32, 33, 64, 65, 200, 0, 1100, 3)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    m = model()
    maxima, cut = q.block_maxima(np.frombuffer(b"".join(texts), np.uint8), bounds, m.pairs())
    assert m.score(*q.pooled(maxima, cut, m.offset)) == pytest.approx([plain_score(m, t) for t in texts], abs=1e-5)


def test_training_sees_what_scoring_sees():
    m = model(3)
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(32, 127, n).astype(np.uint8)) for n in (0, 3, 256, 257, 5000, 16000)]
    taught = q.Taught.of([(*q.blocks_of(np.frombuffer(t, np.uint8)), len(t), 1) for t in texts])
    mean, most, _ = taught.forward(m, np.arange(len(texts)), m.pairs())
    assert m.score(mean, most) == pytest.approx([plain_score(m, t) for t in texts], abs=1e-4)
    long = bytes(rng.integers(32, 127, 100_000).astype(np.uint8))
    data, whole = q.blocks_of(np.frombuffer(long, np.uint8))
    held = np.frombuffer(data, np.uint8).reshape(-1, q.BLOCK + q.WIDTH - 1)
    assert not whole and len(held) == q.BLOCKS
    assert bytes(held[0, : q.BLOCK]) == long[: q.BLOCK] and bytes(held[-1, : 100_000 % q.BLOCK]) == long[-(100_000 % q.BLOCK) :]


def test_gradients_equal_differences():
    m = model(5)
    m.tables = m.tables.astype(np.float64)
    m.offset = m.offset.astype(np.float64)
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 101, n).astype(np.uint8)) for n in (3, 300, 700, 0)]
    taught = q.Taught.of([(*q.blocks_of(np.frombuffer(t, np.uint8)), len(t), y) for t, y in zip(texts, (1, 0, 1, 0), strict=True)])
    which = np.arange(4)

    def loss(m):
        mean, most, _ = taught.forward(m, which, m.pairs())
        return q.loss_of(np.concatenate([mean, most], 1) @ m.last + m.bias, taught.y)

    grads = q.gradients(m, taught, which, m.pairs())
    for name, at in [("tables", (0, 97, 0)), ("tables", (3, 99, 1)), ("tables", (5, 100, 2)), ("offset", (1,)), ("last", (0,)), ("last", (4,))]:
        up, down = (getattr(m, name).copy() for _ in range(2))
        up[at] += 1e-5
        down[at] -= 1e-5
        assert grads[name][at] == pytest.approx((loss(replace(m, **{name: up})) - loss(replace(m, **{name: down}))) / 2e-5, abs=1e-6)
    assert float(grads["bias"]) == pytest.approx((loss(replace(m, bias=m.bias + 1e-5)) - loss(replace(m, bias=m.bias - 1e-5))) / 2e-5, abs=1e-6)


def test_calibration_finds_the_curve():
    rng = np.random.default_rng(7)
    z = rng.normal(0, 3, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * z + 0.7)))).astype(float)
    assert q.calibrated(z, y) == pytest.approx((0.5, 0.7), abs=0.05)


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(300)]
    out = []
    for i in range(n):
        good = i % 3 != 0
        body = [words[k] for k in rng.integers(0, 300, rng.integers(5, 400))]
        out.append((i, " ".join(body if good else [f"{w}###" if k % 4 == 0 else w for k, w in enumerate(body)]), int(good)))
    return out


def held(i, parts=5):
    return zlib.crc32(str(i).encode()) % parts == 0


def test_quality_on_held_out_rows_and_odd_ones(spark):
    rows = texts(300)
    odd = [(1000, None), (1001, ""), (1002, "x"), (1003, "fine words here " * 60_000 + "bad### worse### " * 40), (None, "some words"), (7, rows[7][1]), (7, rows[7][1])]
    docs = spark.createDataFrame([(i, t, "l", "s", 0.1, "k") for i, t, _ in rows] + [(i, t, None, None, 0.1, "k") for i, t in odd], DOCS)
    labels = [(i, y, 0, "t", "k") for i, _, y in rows] + [(1, None, 1, "t", "k"), (None, 1, 1, "t", "k"), (2, 0, 0, "t", "k"), (5555, 0, 0, "t", "k")]
    found = q.predictions(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in found}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert all(r.held_out == held(r.doc_id) for r in found if r.doc_id is not None)
    apart = [(by_id[i].predicted, y) for i, _, y in rows if held(i)]
    assert len(apart) > 40 and np.mean([p == y for p, y in apart]) > 0.95
    assert len({r.score for r in found if r.doc_id == 7}) == 1 and by_id[1000].score == by_id[1001].score
    # labels that are held out teach nothing, and the end of a long text counts
    turned = [(i, 1 - y if held(i) else y, *rest) for i, y, *rest in labels if i is not None and y is not None]
    again = {r.doc_id: r.score for r in q.predictions(docs, spark.createDataFrame(turned, LABELS)).collect()}
    assert again == {i: r.score for i, r in by_id.items()}
    cut = docs.withColumn("text", docs.text.substr(1, 960_000)).where("doc_id = 1003")
    m = q.train(docs, spark.createDataFrame(turned, LABELS), ~q.held_out(F.col("doc_id"), 5, 0))
    assert q.score(cut, m).first().score != by_id[1003].score


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(1, 1, 0, "t", "k")], 1.0), ([(1, 0, 0, "t", "k")], 0.0)])
def test_without_labels_of_both_classes(spark, labels, score):
    docs = spark.createDataFrame([(1, "a b", "l", "s", 0.1, "k"), (2, None, "l", "s", 0.1, "k")], DOCS)
    assert {r.score for r in q.predictions(docs, spark.createDataFrame(labels, LABELS)).collect()} == {score}
    assert q.predictions(docs.limit(0), spark.createDataFrame(labels, LABELS)).collect() == []


def test_quality_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = [(r.score, truth[r.doc_id]) for r in q.predictions(docs, labels).collect() if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y in found if y == 1], [s for s, y in found if y == 0]
    assert np.mean([s > b for s in good for b in bad]) > 0.95
