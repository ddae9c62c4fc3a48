from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from muster.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, key string, x int, code string, error long"


def brute(rows, parts, entries, rounds, scale=256):
    """Every distance in every round, in Python integers."""
    kept = [(i, [math.floor(scale * c) for c in v], la) for i, v, la in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = -(-max(1, *(len(v) for _, v, _ in kept)) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), la) for i, v, la in kept]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))
    books = [[cut[n][p] for n in order[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found, strict=True) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = assign()
    errors = [min(sum(d for d, _ in f), 2**63 - 1) for f in found]
    by_label = {}
    for (_, _, la), e in zip(kept, errors, strict=True):
        by_label[la] = by_label.get(la, 0) + e
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, min(by_label[la], 2**63 - 1), sha) for (i, _, la), f, e in zip(kept, found, errors, strict=True)), key=key)


def coded(spark, rows, parts=16, entries=64, rounds=2):
    frame = spark.createDataFrame([(i, v, la, "k", 1, "c", 7) for i, v, la in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in vector_codes.compressed(frame, parts=parts, entries=entries, rounds=rounds).collect()]
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    return [(i, (centres[i % 9] + 0.3 * rng.normal(size=dim)).tolist(), i % 4 if i % 7 else None) for i in range(n)]


def odd(dim):
    bad = [(900, None, 1), (901, [None] * dim, 1), (902, [float("nan")] * dim, 1), (903, [1.0] * (dim - 1) + [float("inf")], 2)]
    return bad + [(904, [0.0] * dim, None), (None, [0.5] * dim, 2), (3, [0.25] * dim, 2), (3, [0.25] * dim, 2), (905, [1.0, -1.0], 3), (906, [], 9)]


@pytest.mark.parametrize(("dim", "parts", "entries", "rounds"), [(32, 16, 64, 2), (24, 4, 20, 5), (7, 3, 9, 3)])
def test_codes_equal_brute_force(spark, monkeypatch, dim, parts, entries, rounds):
    monkeypatch.setattr(vector_codes, "PIECE", 8 * dim * 50)
    rows = vectors(400, dim, dim) + odd(dim)
    assert coded(spark, rows, parts, entries, rounds) == brute(rows, parts, entries, rounds)


def test_ties_and_repeated_rows(spark):
    rows = [(i, [float(i % 3), 0.0, float(i % 2), 1.0], 0) for i in range(150)] + [(5, [1.0, 1.0, 1.0, 1.0], None)] * 3
    assert coded(spark, rows, 2, 8, 3) == brute(rows, 2, 8, 3)


def test_huge_components(spark):
    rows = [(i, [1e17 * (i % 5 - 2), 1e9 + i, 3e7 * i, float(i)], i % 2) for i in range(30)]
    assert coded(spark, rows, 2, 4, 2) == brute(rows, 2, 4, 2)


def test_fewer_rows_than_entries_and_none(spark):
    assert coded(spark, vectors(5, 8, 1), 4) == brute(vectors(5, 8, 1), 4, 64, 2)
    assert coded(spark, []) == [] == coded(spark, [(1, None, 1)])
    for rows in ([(1, [1.0, 2.0], 3)], [(1, [1.0] * 16, 3), (1, [1.0] * 16, None)], [(None, [], None)]):
        assert coded(spark, rows) == brute(rows, 16, 64, 2)


def test_bounds_hold_and_spare_distances():
    """After the entries moved, bounds stay below the true distances, most parts need no list, and codes are exact."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-300, 300, (40, 4))
    x = (centres[rng.integers(0, 40, 3000)] + rng.integers(-9, 10, (3000, 4))).astype(float)
    book = vector_codes.Book(vector_codes.whole(x[:40]), np.zeros(40))
    own, _, near, low = book.ranked(x, 5)
    low = vector_codes.from_bounds(vector_codes.as_bounds(low))
    for _ in range(8):
        sums = {e: (int((own == e).sum()), [int(c) for c in x[own == e].sum(0)]) for e in np.unique(own).tolist()}
        book = book.next(sums)
        own, d, near, low, failed = book.revised(x, own, near, low)
        every = ((x[:, None] - book.plain[None]) ** 2).sum(2)
        assert (own == every.argmin(1)).all() and (d == every.min(1)).all()
        far = np.sqrt(every)
        assert (low[:, :5] <= np.take_along_axis(far, near, 1)).all()
        rest = far.copy()
        np.put_along_axis(rest, near, np.inf, 1)
        rest[np.arange(len(x)), own] = np.inf
        assert (low[:, 5] <= rest.min(1)).all() and (np.diff(low, axis=1) >= 0).all()
    assert (failed == 0).mean() > 0.5 and (failed > 5).mean() < 0.1  # once entries move little


def test_bounds_are_rounded_down():
    far = np.concatenate([[0.0, 1e-9, 1.0, np.inf], np.geomspace(1e-3, 1e30, 5000)])
    held = vector_codes.from_bounds(vector_codes.as_bounds(far))
    assert (held <= far).all() and (held[4:] >= 0.98 * far[4:] - 0.01).all() and held[3] == np.inf
