from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from muster.llm import mixing, queries

SCHEMA = "doc_id long, text string, lang string, source string, tokens int, domain string, epoch int"


def make(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(i, " ".join("w" for _ in range(rng.randint(0, 30))) if rng.random() > 0.05 else None, rng.choice(["en", "en", "de", None]), rng.choice(["src0"] * 6 + ["src3", "src11", "src17", "zz", None]), 1, "d", 0) for i in range(n)]


def leaf_of(row):
    domain = next((d for d, own in queries.MIX_DOMAINS.items() if row[3] in own), "other")
    return domain, row[2] or "", row[3] or ""


def poured(budget, children):
    """Shares by weight with capacities: fill whoever is full first, again and again."""
    share, left = {}, dict(children)
    while left:
        total = sum(w for w, _ in left.values())
        full = [c for c, (w, cap) in left.items() if w > 0 and cap * total <= budget * w]
        if not full:
            base = {c: budget * w // total if total else 0 for c, (w, _) in left.items()}
            over = budget - sum(base.values()) if total else 0
            for c in sorted(c for c in left if left[c][0] > 0)[:over]:
                base[c] += 1
            return share | base
        one = min(full, key=lambda c: (left[c][1] / left[c][0], c))
        share[one] = left[one][1]
        budget -= left.pop(one)[1]
    return share


def brute(rows, epochs, budget=None):
    docs = defaultdict(list)
    for r in rows:
        n = len((r[1] or "").encode().split())
        if n:
            docs[leaf_of(r)].append((r[0], n))
    size = {leaf: sum(n for _, n in d) for leaf, d in docs.items()}
    weight = lambda level, name: queries.MIX_WEIGHTS.get(level, {}).get(name, queries.MIX_DEFAULT)
    under = lambda prefix: sum(s for leaf, s in size.items() if leaf[: len(prefix)] == prefix) * epochs
    total = min(sum(size.values()) if budget is None else budget, sum(size.values()) * epochs)
    shares = {(): total}
    for depth, level in enumerate(mixing.LEVELS):
        for parent in {leaf[:depth] for leaf in size}:
            names = {leaf[depth] for leaf in size if leaf[:depth] == parent}
            got = poured(shares[parent], {c: (weight(level, c), under((*parent, c))) for c in names})
            shares |= {(*parent, c): s for c, s in got.items()}
    out = []
    for leaf, d in docs.items():
        whole, rest = divmod(shares[leaf], size[leaf])
        out += [(i, *leaf, e, n, n) for e in range(whole) for i, n in d]
        for i, n in sorted(d, key=lambda x: hashlib.md5(f"muster:{whole}:{x[0]}".encode()).hexdigest()):
            if rest > 0:
                out.append((i, *leaf, whole, n, min(n, rest)))
            rest -= n
    return sorted(out)


def mixed(spark, rows, **how):
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), queries.mix_domain(), queries.MIX_WEIGHTS, queries.MIX_DEFAULT, queries.MIX_EPOCHS, **how)
    return sorted((r.doc_id, r.domain, r.language, r.origin, r.epoch, r.tokens, r.taken) for r in got.collect())


@pytest.mark.parametrize(("seed", "budget"), [(1, None), (2, 900), (3, 10**9), (4, 1), (5, 0)])
def test_equals_brute_force(spark, seed, budget):
    rows = make(seed, 250)
    found = mixed(spark, rows, budget=budget)
    assert found == brute(rows, queries.MIX_EPOCHS, budget)
    if budget is not None and budget < 10_000:
        assert sum(x[-1] for x in found) == budget


def test_equals_the_sql(spark):
    rows = make(9, 300)
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "tokens", "domain", "epoch"]).astype(object).where(lambda d: d.notna(), None)  # noqa: F841
    sql = duckdb.sql(queries.mix_sql("(SELECT CAST(doc_id AS BIGINT) AS doc_id, text, lang, source FROM frame)")).fetchall()
    assert sorted(sql) == mixed(spark, rows)


def test_carried_rows_and_empty_table(spark):
    rows = make(6, 120)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs, queries.mix_domain(), queries.MIX_WEIGHTS, queries.MIX_DEFAULT, queries.MIX_EPOCHS, carry=docs.columns)
    assert got.columns == docs.columns
    by_id = {r[0]: r for r in rows}
    assert all(tuple(r) == by_id[r.doc_id] for r in got.collect())
    assert sorted(r.doc_id for r in got.collect()) == sorted(x[0] for x in brute(rows, queries.MIX_EPOCHS))
    assert mixed(spark, []) == []
    assert mixed(spark, [(1, None, "en", "src0", 1, "d", 0), (2, " ", "en", "src0", 1, "d", 0)]) == []


def test_repeated_rows_count(spark):
    rows = [(1, "a b c", "en", "src0", 1, "d", 0)] * 3
    assert len(mixed(spark, rows)) == 3


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(make(1, 20), SCHEMA)
    plan = mixing.mix(docs, queries.mix_domain(), queries.MIX_WEIGHTS)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None
