from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from muster.llm import ann, exact_topk

SCHEMA = "vec_id long, embedding array<float>, label int, score double, key string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, "k") for i, v in rows], SCHEMA)


def usable(rows, zero):
    fit = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return [(i, v) for i, v in fit if zero or any(v)]


def best(scores, k=5):
    """Of (score, id): the best score of each id, and of these the first k."""
    of: dict = {}
    for s, i in scores:
        of[i] = max(s, of.get(i, s))
    return [(n + 1, i, s) for n, (s, i) in enumerate(sorted(((s, i) for i, s in of.items()), key=lambda x: (-x[0], x[1]))[:k])]


def brute(fit, every, score):
    found: dict = {}
    for i, v in fit:
        if i % every == 0:
            found.setdefault(i, []).extend((score(v, w), j) for j, w in fit if j != i)
    return {i: best(x) for i, x in found.items()}


def brute_dot(rows, every):
    return brute([(i, [math.floor(256 * x) for x in v]) for i, v in usable(rows, True)], every, lambda v, w: sum(a * b for a, b in zip(v, w, strict=True)))


def brute_cos(rows, every):
    fit = [(i, np.array(v)) for i, v in usable(rows, False)]
    return brute(fit, every, lambda v, w: float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))))


def odd_rows(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(60)]  # equal vectors
    rows += [(n + 100, None), (n + 101, [None] * dim), (n + 102, [float("nan")] * dim), (n + 103, [float("inf")] * dim), (n + 105, [0.0] * dim)]
    return rows


def collected(df):
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_exact_topk_equals_brute_force(spark):
    rows = odd_rows(700, 6)
    assert collected(exact_topk.search(table(spark, rows), F.col("vec_id") % 5 == 0)) == brute_dot(rows, 5)


def test_exact_topk_over_many_small_blocks(spark, monkeypatch):
    for name, n in (("BLOCK", 16), ("BLOCKS", 3), ("QUERIES", 20), ("PIVOTS", 5)):
        monkeypatch.setattr(exact_topk, name, n)
    rows = odd_rows(400, 3, 2)
    assert collected(exact_topk.search(table(spark, rows), F.col("vec_id") % 5 == 0)) == brute_dot(rows, 5)


def test_exact_topk_large_components(spark):
    rows = [(i, [1e15 * (i % 7 - 3), 1.5e15, float(i)]) for i in range(40)]
    fit = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    small = [(i, [v[0] / 1e10, 2.0, v[2]]) for i, v in rows]
    assert collected(exact_topk.search(table(spark, small), F.col("vec_id") % 5 == 0)) == brute_dot(small, 5)
    x = np.array([v for _, v in fit], float)
    assert exact_topk.products(x[:2], x)[0][1] == sum(a * b for a, b in zip(fit[0][1], fit[1][1], strict=True))


def test_scores_beyond_doubles_and_longs(spark):
    """Rows are ranked by their exact scores, which are shown as far as a long goes; shorter vectors end in zeros."""
    schema = "vec_id long, embedding array<double>, label int, score double, key string"
    rows = [(i, [1e17 * (i % 3 - 1), 3.5, float(i)]) for i in range(30)] + [(40 + i, [1e8 * (i % 4), float(2**30 + i), -1.0]) for i in range(30)] + [(80, [2.5]), (81, []), (85, [1e300, -1e300, 0.5])]
    found = exact_topk.search(spark.createDataFrame([(i, v, 1, 0.5, "k") for i, v in rows], schema), F.col("vec_id") % 5 == 0)
    limit = 1 << 90
    fit = [(i, [max(-limit, min(limit, math.floor(256 * x) if abs(x) < 1e290 else int(math.copysign(limit, x)))) for x in v] + [0] * (3 - len(v))) for i, v in rows]
    expected = {}
    for i, v in fit:
        if i % 5 == 0:
            exact = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in fit if j != i)[:5]
            expected[i] = [(n + 1, j, max(-(2**63), min(2**63 - 1, -s))) for n, (s, j) in enumerate(exact)]
    got = collected(found)
    assert {i: [(n, s) for n, _, s in t] for i, t in got.items()} == {i: [(n, s) for n, _, s in t] for i, t in expected.items()}
    assert got == expected


def test_ann_in_small_slices_and_ragged_vectors(spark, monkeypatch):
    rows = odd_rows(600, 8, 3) + [(2000 + i, [float(i % 7), 1.0, float(i % 3)]) for i in range(40)]
    monkeypatch.setattr(ann, "ASKED", 7)
    found = collected(ann.search(table(spark, rows), F.col("vec_id") % 20 == 0))
    truth = brute_cos([(i, [*v, *[0.0] * (8 - len(v))] if v is not None else None) for i, v in rows], 20)
    assert found.keys() == truth.keys()
    assert sum(len({j for _, j, _ in truth[i]} & {j for _, j, _ in found[i]}) for i in truth) >= 0.9 * sum(map(len, truth.values()))


def test_few_rows_and_empty_tables(spark):
    for search in (exact_topk.search, ann.search):
        assert search(table(spark, []), F.col("vec_id") % 50 == 0).count() == 0
        two = collected(search(table(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0])]), F.col("vec_id") % 50 == 0))
        assert [x[:2] for x in two[0]] == [(1, 1)]
        assert search(table(spark, [(0, [1.0, 2.0])]), F.col("vec_id") % 50 == 0).count() == 0


def test_ann_scores_are_exact_and_recall_is_high(spark):
    rows = odd_rows(3000, 24, 5)
    found, truth = collected(ann.search(table(spark, rows), F.col("vec_id") % 20 == 0)), brute_cos(rows, 20)
    assert found.keys() == truth.keys()
    exact = {i: {j: s for _, j, s in t} for i, t in truth.items()}
    hits = sum(len(exact[i].keys() & {j for _, j, _ in t}) for i, t in found.items())
    assert hits / sum(map(len, truth.values())) >= 0.9
    for i, t in found.items():
        assert [n for n, *_ in t] == [1, 2, 3, 4, 5]
        for _, j, s in t:
            if j in exact[i]:
                assert s == pytest.approx(exact[i][j], abs=1e-15)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_ann_recall_on_the_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found, truth = collected(ann.search(df, F.col("vec_id") % 50 == 0)), brute_cos(rows, 50)
    hits = sum(len({j for _, j, _ in truth[i]} & {j for _, j, _ in found[i]}) for i in truth)
    assert hits / sum(map(len, truth.values())) >= 0.9


def test_ann_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(0, 400)] + [(1000 + i, [float(i % 5), 1.0, float(i % 3), 2.0]) for i in range(100)]
    found = collected(ann.search(table(spark, rows), F.col("vec_id") % 50 == 0))
    assert [j for _, j, _ in found[0]] == [1, 2, 3, 4, 5]
    assert [j for _, j, _ in found[50]] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_ids(spark, seed):
    """Repeated rows, several vectors under one id, and both of the query's own id."""
    rng = np.random.default_rng(seed)
    v = lambda: rng.normal(size=4).tolist()
    one, seven = v(), v()
    rows = [(0, one)] * 10 + [(7, seven)] * 200 + [(i, v()) for i in range(1, 7)] + [(10, v()), (10, v()), (10, one), (20, one), (20, [-x for x in one]), (3, v())]
    assert collected(exact_topk.search(table(spark, rows), F.col("vec_id") % 5 == 0)) == brute_dot(rows, 5)
    found, truth = collected(ann.search(table(spark, rows), F.col("vec_id") % 5 == 0)), brute_cos(rows, 5)
    assert {i: [x[:2] for x in t] for i, t in found.items()} == {i: [x[:2] for x in t] for i, t in truth.items()}


def test_queries_go_only_to_shards_in_their_range(spark, monkeypatch):
    """Clustered rows: a query reaches few of the shards, and the answer is that of all rows."""
    for name, n in (("BLOCK", 32), ("BLOCKS", 1), ("PIVOTS", 8)):
        monkeypatch.setattr(exact_topk, name, n)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(8, 4)) * 10
    rows = [(i, (centres[i % 8] + rng.normal(size=4) * 0.1).tolist()) for i in range(800)]
    sent = []
    plain = exact_topk.written
    monkeypatch.setattr(exact_topk, "written", lambda df, name="table": sent.append((name, plain(df, name))) or sent[-1][1])
    assert collected(exact_topk.search(table(spark, rows), F.col("vec_id") % 50 == 0)) == brute_dot(rows, 50)
    tables = dict(sent)
    assert tables["sent"].count() < 0.7 * 16 * tables["annuli"].select("shard").distinct().count()
