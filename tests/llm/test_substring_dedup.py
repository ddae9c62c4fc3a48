from __future__ import annotations

import hashlib
import random

import pytest

from muster.llm import substring_dedup

SCHEMA = "doc_id long, text string, spans string, key string"


def brute(rows, window):
    docs = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    first = {}
    for i, words in docs:
        for p in range(len(words) - window + 1):
            k = tuple(words[p : p + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, words in docs:
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if i is not None and first[tuple(words[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((-1 if i is None else i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(spark, rows, **how):
    got = substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA), **how)
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect())


def make(seed: int, n: int, letters: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(letters)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(20, 140))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.45:
                words += rng.choice(passages)
            elif kind < 0.55:
                words += [rng.choice(vocabulary)] * rng.randint(1, 130)
            elif kind < 0.65:
                words += rng.choice([["a", "b"], ["a", "b", "c"]]) * rng.randint(10, 50)
            else:
                words += [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        rows.append((rng.randrange(10_000) * 100 + i, rng.choice([" ", "\n", "  "]).join(words), "x", "y"))
    return rows


@pytest.mark.parametrize("letters", [2, 300])
def test_equals_brute_force(spark, letters):
    rows = make(letters, 60, letters)
    rows += [(7, None, "x", "y"), (8, "", "x", "y"), (9, "z " * 49, "x", "y"), (10, "z " * 50, "x", "y"), (11, "z " * 20_000, "x", "y"), (None, "z " * 60, "x", "y"), (12, "é ö " * 70, "x", "y"), (13, "é ö " * 71, "x", "y")]
    assert found(spark, rows) == brute(rows, 50)


def test_repeated_rows_do_not_remove_from_each_other(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(5, text, "x", "y"), (5, text, "x", "y"), (6, text, "x", "y")]
    assert found(spark, rows) == brute(rows, 50)


def test_empty_table_and_texts(spark):
    assert found(spark, []) == []
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "x", "y"), (2, f"head {text} tail", "x", "y"), (3, None, "x", "y"), (4, text, "x", "y")]
    got = substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA), texts=True)
    assert {r.doc_id: r.kept_text for r in got.collect()} == {1: text, 2: "head tail", 3: "", 4: ""}


def test_texts_under_one_id_are_told_apart(spark):
    a, b, c, d = ([f"{x}{i}" for i in range(n)] for x, n in (("a", 80), ("b", 80), ("c", 60), ("d", 90)))
    rows = [(i, " ".join(w), "x", "y") for i, w in ((1, a), (2, b), (5, a + c), (5, d + b), (5, a + c), (6, c), (6, d[5:] + c))]
    assert found(spark, rows) == brute(rows, 50)


def test_spans_cover_each_window_once():
    import numpy as np

    rng = np.random.default_rng(5)
    bounds = np.array([0, 0, 30, 79, 400, 1000])
    hashes = rng.integers(1, 4, 1000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    low, high, *_ = substring_dedup.spans_of(hashes, bounds, 50, substring_dedup.ROUNDS)
    got = [p for a, b in zip(low, high, strict=True) for p in range(a, b + 1)]
    assert got == [p for a, b in zip(bounds[:-1], bounds[1:], strict=True) for p in range(a, b - 49)]


def test_a_window_has_one_anchor_wherever_it_is():
    import numpy as np

    rng = np.random.default_rng(6)
    for letters in (2, 3, 500):
        draw = lambda n: rng.integers(1, letters + 1, n).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)  # noqa: B023, E731
        for _ in range(150):
            window = draw(50)
            if rng.random() < 0.3:
                window[: rng.integers(1, 50)] = window[0]
            names = set()
            for _ in range(4):
                left, right = draw(rng.integers(0, 40)), draw(rng.integers(0, 40))
                if rng.random() < 0.5:
                    left[-rng.integers(0, 20) :], right[: rng.integers(0, 20)] = window[0], window[-1]
                text = np.concatenate([left, window, right])
                low, high, name, *_ = substring_dedup.spans_of(text, np.array([0, len(text)]), 50, substring_dedup.ROUNDS)
                at = int(np.searchsorted(low, len(left), "right")) - 1
                assert low[at] <= len(left) <= high[at]
                names.add(int(name[at]))
            assert len(names) == 1
