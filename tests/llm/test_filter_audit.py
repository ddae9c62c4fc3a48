from __future__ import annotations

import re
from itertools import permutations

import pytest

from muster.llm import filter_audit

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, a string, key string"
LABELS = "doc_id long, quality int, toxic int, text string"


def brute(docs, labels):
    """Every order walked over every document."""
    plain = [(i, t or "", s or "") for i, t, s in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}

    def failures(i, t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out = {"A"} if len(words) < 200 else set()
        out |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        out |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        out |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        return out | ({"E"} if i is not None and any(j is not None and j < i and u == t for j, u, _ in plain) else set())

    failed = [(i, s, failures(i, t)) for i, t, s in plain]
    out = {}
    for part in {s for _, _, s in plain}:
        own = [(i, f) for i, s, f in failed if s == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                shapley[x] += len(gone)
                redundant, alone = sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own)
                out[part, "".join(order), step + 1] = [len(left), len(gone), redundant, alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for key in (k for k in out if k[0] == part):
            out[key].append(shapley[key[1][key[2] - 1]])
    return out


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(i, t, None, s, 1, "x", "y", "z") for i, t, s in docs], DOCS)
    rows = filter_audit.audited(frame, spark.createDataFrame([(i, q, t, "x") for i, q, t in labels], LABELS)).collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert len(out) == len(rows)
    return out


def fixture():
    long = " ".join(f"w{i}" for i in range(220))
    texts = [long, "few words", "few words", None, "", "a " * 300, f"{long} DAMAGED###", "LOUD " * 250, f"{long} É", f"{long} b|b", "a " * 300, long, long, "\x0b\x0c\x1c"]
    docs = [(i, t, f"s{i % 3}" if i % 5 else None) for i, t in enumerate(texts)]
    docs += [(None, long, "s1"), (None, "few words", ""), (3, "few words", "s2"), (0, long, "s1"), (0, long, "s0"), (-7, "LOUD " * 250, "s1"), (90, " ".join("x" * 9000 for _ in range(3)), "s9")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(12)] + [(None, 1, 1), (3, None, None), (4, None, 1), (5, 1, 0), (5, 0, 1), (777, 1, 1)]
    return docs, labels


def test_audit_equals_every_order_walked(spark):
    docs, labels = fixture()
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_audit_of_one_hot_text_and_no_labels(spark):
    docs = [(i, "the same text", "hot") for i in range(500)] + [(1000 + i, f"text {i}", f"s{i % 7}") for i in range(200)]
    assert audited(spark, docs, []) == brute(docs, [])


def test_audit_of_no_documents(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}


@pytest.mark.parametrize("n", [1, 3])
def test_audit_of_other_filters(spark, n):
    """The general operator: any number of filters, shapley sums to n! times what all of them remove."""
    rows = spark.range(64).selectExpr("'p' as part", *(f"id % {k + 2} = 0 as {f}" for k, f in enumerate("xyz"[:n])), "id > 9 as lost")
    found = filter_audit.audit(rows, "xyz"[:n], ["lost"]).collect()
    orders = len(list(permutations(range(n))))
    assert len(found) == orders * n
    last = [r for r in found if r.step == n]
    assert {64 - r.kept for r in last} == {sum(any(i % (k + 2) == 0 for k in range(n)) for i in range(64))}
    assert sum({r.filter_order[r.step - 1]: r.shapley for r in found}.values()) == orders * (64 - last[0].kept)
