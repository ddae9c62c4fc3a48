from __future__ import annotations

import random
from collections import defaultdict

import pytest

from muster.llm import ngram_join
from muster.llm.components import components

SCHEMA = "doc_id long, text string, class_id string"


def grams(text: str | None) -> frozenset:
    words = (text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets = [(i, grams(t)) for i, t, *_ in rows]
    near = defaultdict(set)
    for a in range(len(sets)):
        for b in range(len(sets)):
            x, y = sets[a][1], sets[b][1]
            if a != b and x and y and len(x & y) >= 0.8 * len(x | y):
                near[a].add(b)
    label = {}
    for a in range(len(sets)):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        label[a] = min(sets[b][0] for b in seen)
    return sorted((sets[a][0], label[a], len(near[a])) for a in range(len(sets)))


def make(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = (rows[rng.randrange(len(rows))][1] or "x").split()
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        rows.append((i * 7 % 1009, " ".join(words), "x"))
    return rows


def test_equals_brute_force(spark):
    rows = make(1, 150) + [(5000, None, "x"), (5001, "", "x"), (5002, " \n", "x"), (5003, "a b", "x"), (5004, "a b", "x"), (5005, "a b c", "x"), (5006, "word " * 30_000, "x")]
    found = ngram_join.join(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 8)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(90)] = f"n{i}"
        rows.append((i, " ".join(words), "x"))
    found = ngram_join.join(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_kept_keeps_columns_and_one_row_of_a_class(spark):
    rows = [(3, "a b c d e f", "p"), (1, "a b c d e f", "q"), (2, "other words are here now", "r"), (None, "a b c d e f", "s"), (4, None, "t"), (5, None, "u")]
    kept = ngram_join.kept(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "class_id"]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.class_id) for r in kept.collect()) == [(False, 1, "q"), (False, 2, "r"), (False, 4, "t"), (False, 5, "u"), (True, 0, "s")]


def test_empty_table_and_repeated_rows(spark):
    assert ngram_join.join(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "x")]
    found = sorted((r.doc_id or -1, r.class_id or -1, r.n_links) for r in ngram_join.join(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == [(-1, -1, 0), (1, 1, 1), (1, 1, 1)]


def test_two_texts_under_one_id_lose_no_link(spark):
    rng = random.Random(8)
    a, b = ([rng.choice([f"w{i}" for i in range(400)]) for _ in range(60)] for _ in range(2))
    rows = [(5, " ".join(a), "x"), (5, " ".join(b), "y"), (6, " ".join([*a, "z"]), "x"), (7, " ".join([*b, "z"]), "x"), (5, " ".join(a), "x")]
    found = ngram_join.join(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect())) == brute(rows)
    kept = sorted((r.doc_id, r.text) for r in ngram_join.kept(spark.createDataFrame(rows, SCHEMA)).collect())
    assert kept == sorted([(5, " ".join(a)), (5, " ".join(b))])


def test_repeated_rows_and_clashing_columns(spark):
    schema = "doc_id long, text string, own int, tid string, times int, row string, sid int"
    rows = [(2, "a b c d e f", 1, "t", 2, "r", 3)] * 5 + [(1, "a b c d e f", 1, "t", 2, "r", 3)] * 3 + [(3, " ", 0, "", 0, "", 0)] * 2
    docs = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, ngram_join.kept(docs).collect())) == [rows[5], rows[8], rows[8]]
    assert sorted(map(tuple, ngram_join.join(docs).collect())) == [(1, 1, 7)] * 3 + [(2, 1, 7)] * 5 + [(3, 3, 0)] * 2


def missed(steps, counts, threshold=0.8, trees=24):
    out = (1 - threshold**ngram_join.FLOOR) ** (trees - len(counts))
    for _, d in steps[-1]:
        out *= 1 - threshold**d
    return out


def test_prefixes_shorten_until_the_recall():
    alone = ngram_join.standing({}, 24, 0.8, 0.9999)
    assert alone == [[]] and missed(alone, {}) < 1e-4
    few = {t: [5] for t in range(24)}
    assert ngram_join.standing(few, 24, 0.8, 0.9999) == [[(t, 4) for t in range(24)]]
    hot = {t: [60, 50, 40, 30, 10] if t < 4 else [5] for t in range(24)}
    assert ngram_join.standing(hot, 24, 0.8, 0.9999) == [[(t, 8 if t < 4 else 4) for t in range(24)]]  # the others are enough
    hot = {t: [3000, 900, 300, 100, 20] for t in range(24)}
    steps = ngram_join.standing(hot, 24, 0.8, 0.9999)
    assert [s[0][1] for s in steps] == [8, 8, 7, 5, 4][-len(steps) :] or [s[0][1] for s in steps] == sorted((s[0][1] for s in steps), reverse=True)
    assert missed(steps, hot) <= 1e-4 < missed(steps[:-1], hot)
    one = {t: [10**9] * 5 for t in range(24)}
    assert ngram_join.standing(one, 24, 0.8, 0.9999)[-1] == [(t, 4) for t in range(24)]


def test_partners_stand_in_the_same_node():
    rng = random.Random(4)
    for _ in range(200):
        shared = sorted((rng.randint(2, 5000) for _ in range(5)), reverse=True)
        depth = rng.randint(1, 5)  # of the five nodes, both paths have so many
        a = {0: shared[:depth] + sorted((rng.randint(1, shared[depth - 1]) for _ in range(5 - depth)), reverse=True)}
        b = {0: shared[:depth] + sorted((rng.randint(1, shared[depth - 1]) for _ in range(5 - depth)), reverse=True)}
        for x, y in zip(ngram_join.standing(a, 24, 0.8, 2.0), ngram_join.standing(b, 24, 0.8, 2.0), strict=False):
            if min(x[0][1], y[0][1]) - ngram_join.FLOOR < depth:
                assert x == y


def test_recall_on_the_documents(spark):
    """Every true link of the tables, found by listing what documents share an n-gram."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r.doc_id: grams(r.text) for r in docs.collect()}
    holders = defaultdict(list)
    for i, own in sets.items():
        for g in own:
            holders[g].append(i)
    common = defaultdict(int)
    for who in holders.values():
        for x in range(len(who)):
            for y in range(x):
                common[who[y], who[x]] += 1
    links = defaultdict(int)
    for (x, y), n in common.items():
        if n >= 0.8 * (len(sets[x]) + len(sets[y]) - n):
            links[x] += 1
            links[y] += 1
    found = {r.doc_id: r.n_links for r in ngram_join.join(docs).collect()}
    assert sum(found.values()) >= 0.99 * sum(links.values()) > 0
    assert all(n <= links[i] for i, n in found.items())


def test_components_on_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (100, 101)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {found[i] for i in range(41)} == {0}
    assert {found[i] for i in range(100, 140)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_low_thresholds_get_trees_or_an_error(spark):
    assert ngram_join.trees_for(0.8, 0.9999, 24) == 24 and ngram_join.trees_for(0.5, 0.9999, 24) == 143 and ngram_join.trees_for(1.0, 0.9999, 3) == 3
    for threshold, recall in ((0.3, 0.9999), (0.0, 0.9), (0.8, 1.0)):
        with pytest.raises(ValueError):
            ngram_join.trees_for(threshold, recall, 24)
    rng = random.Random(5)
    base = [[f"w{rng.randrange(900)}" for _ in range(120)] for _ in range(12)]
    texts = []
    for words in base:
        for _ in range(4):
            own = words[:]
            for _ in range(rng.randint(0, 9)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    grams = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    links = [sum(i != j and len(a & b) >= 0.5 * len(a | b) for j, b in enumerate(grams)) for i, a in enumerate(grams)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.n_links for r in ngram_join.join(docs, threshold=0.5).collect()}
    assert sum(found.values()) >= 0.99 * sum(links) and all(found[i] <= n for i, n in enumerate(links)) and sum(links) > 40
