from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from muster.llm import langid, toxicity

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, score double, key string"
TINY = {"aa": "the and with of that this is", "bb": "der und die mit ist nicht das", "cc": "que de los para una con por"}


def documents(n: int, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(TINY))
        words = [rng.choice(TINY[lang].split()) for _ in range(rng.randint(3, 60))]
        out.append((i, " ".join(words), lang, "s", 0.5, "k"))
    return out


def test_language_of_held_out_rows(spark):
    rows = documents(400) + [(1000, None, "aa", "s", 0.0, "k"), (1001, "", None, "s", 0.0, "k"), (1002, "12 !? 34", "bb", "s", 0.0, "k"), (1003, "x" * 200_000, None, "s", 0.0, "k")]
    found = {r.doc_id: r for r in langid.predictions(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(found) == len(rows)
    for i, text, lang, *_ in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= found[i].score <= 1
        if i < 1000:
            assert found[i].lang_pred == lang
    assert [found[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert found[1003].lang_pred in TINY


def test_language_has_nothing_to_learn(spark):
    empty = langid.predictions(spark.createDataFrame([], DOCS))
    assert empty.count() == 0
    rows = [(i, "some words", None, "s", 0.0, "k") for i in range(5)]
    assert {r.lang_pred for r in langid.predictions(spark.createDataFrame(rows, DOCS)).collect()} == {"und"}


def test_held_out_languages_do_not_matter(spark):
    rows = documents(200, 4)
    changed = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else la, *rest) for i, t, la, *rest in rows]
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in langid.predictions(spark.createDataFrame(x, DOCS)).collect()} for x in (rows, changed))
    assert a == b


def test_ftrl_penalties_leave_most_weights_at_zero():
    rng = np.random.default_rng(2)
    rows, y = [], []
    for _ in range(200):
        label = int(rng.integers(2))
        at = np.unique(np.concatenate([[10 + label], rng.integers(100, 2000, 20)]))
        rows.append((at, np.full(len(at), 1 / np.sqrt(len(at)))))
        y.append(label)
    w = langid.ftrl(rows, np.array(y), 2, l1=0.5)
    assert (w != 0).mean() < 0.05
    assert w[0, 10] > 0 > w[1, 10] and w[1, 11] > 0 > w[0, 11]


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 500)
    logits = rng.normal(size=(500, 3)) + 2 * np.eye(3)[y]
    assert 4 < langid.tempered(10 * logits, y) / langid.tempered(logits, y) < 25


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_language_accuracy_on_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.95


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.predictions(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    hit = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    wrong = sum(r.predicted for r in held if not r.toxic) / sum(1 - r.toxic for r in held)
    assert hit > 0.6 and wrong < 0.05


def test_toxicity_edges(spark):
    schema = "doc_id long, text string, toxic string, score double"
    rng = random.Random(6)
    plain = lambda: [rng.choice([f"word{k}" for k in range(300)]) for _ in range(30)]
    rows = [(i, " ".join(plain() + (["you", "idiot", "you", "moron"] if i % 4 == 0 else [])), "x", 0.1) for i in range(200)]
    rows += [(900, None, "x", 0.0), (901, "", "x", 0.0), (902, "word " * 60_000, "x", 0.0), (903, "you  i d i o t", "x", 0.0), (904, "1d10t", "x", 0.0)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(200)] + [(7, None), (None, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.predictions(docs, labels).collect()}
    assert len(found) == len(rows)
    assert found[4].predicted == 1 and found[5].predicted == 0
    assert found[900].score == found[901].score
    none = toxicity.predictions(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {none[0].score}
    assert toxicity.predictions(docs.where("false"), labels).count() == 0
    kept = toxicity.kept(docs, labels)
    assert kept.columns == docs.columns and not {4, 8} & {r.doc_id for r in kept.collect()} and {5, 900} <= {r.doc_id for r in kept.collect()}


def test_features_see_obfuscation_and_address():
    own = toxicity.Tokens({"lowei*": 4.0})
    at = {name: i for i, name in enumerate(toxicity.FEATURES)}
    plain, spelled, broken, prefix = (own.features(t) for t in ("a calm day", "you i d i o t", "what an 1d!ot and st*pid m.o.r.o.n", "loweische worte"))
    assert plain[at["insult_hits"]] == plain[at["broken_hits"]] == 0
    assert spelled[at["spelled_hits"]] == 1
    assert broken[at["broken_hits"]] >= 1
    assert prefix[at["learned_hits"]] == 1 and prefix[at["best_term"]] == 4.0
    near, far = own.features("you idiot"), own.features("you " + "word " * 30 + "idiot")
    assert near[at["near_second_person"]] > 0 == far[at["near_second_person"]]


def test_isotonic_equals_the_pooled_means():
    xs, ys = toxicity.isotonic(np.array([1.0, 2.0, 3.0, 4.0]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert np.interp([1, 2, 3, 4], xs, ys).tolist() == [0.0, 0.5, 0.5, 1.0]
    assert (np.diff(ys) >= 0).all()


def test_scores_do_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.union(docs.where("doc_id < 20"))  # repeated rows
    one = sorted((r.doc_id, r.score) for r in toxicity.predictions(docs, labels).collect())
    other = sorted((r.doc_id, r.score) for r in toxicity.predictions(docs.repartition(7, "source").sortWithinPartitions("text"), labels.repartition(3)).collect())
    assert one == other
    again = {}
    for i, score in one:
        assert again.setdefault(i, score) == score
    kept = toxicity.kept(docs, labels)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, score in one if score < 0.3]


def test_every_language_is_learned(spark):
    """More languages than any fixed number: each is predicted for its own texts, and repeated rows are predicted alike."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(220):
        word = letters[k % 26] * 3 + letters[k // 26] * 4
        rows += [(k * 20 + i, " ".join([word] * (3 + i % 4)), f"l{k:03d}", "s", 0.0, "k") for i in range(12)]
    rows += rows[:5]
    found = langid.predictions(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert len({r.lang_pred for r in found}) > 210
    assert len({(r.doc_id, r.lang_pred, r.score) for r in found}) == len(truth)


def test_languages_with_one_row_are_learned(spark):
    """Thirteen languages with one allowed row each beside large ones: each row is predicted as what it is, and null ids teach."""
    rows = documents(120, seed=9)
    letters = "bcdfghjklmnpq"
    allowed = [i for i in range(5000, 5400) if zlib.crc32(str(i).encode()) % 3 != 1]
    for k, c in enumerate(letters):
        rows.append((allowed[k], f"{c}a{c}o{c} {c}e{c} {c}u{c}i " * 6, f"z{c}", "s", 0.0, "k"))
    rows.append((None, "öäü öüä üäö " * 9, "zz", "s", 0.0, "k"))
    found = {r.doc_id: r for r in langid.predictions(spark.createDataFrame(rows, DOCS)).collect()}
    assert [found[allowed[k]].lang_pred for k in range(13)] == [f"z{c}" for c in letters]
    assert found[None].lang_pred == "zz" and found[None].held_out is False


def test_sparse_weights_equal_dense_ones():
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(5, 41)) * (rng.random((5, 41)) < 0.3)
    own = langid.Weights(dense)
    for n in (0, 1, 7, 40):
        at = np.sort(rng.choice(40, n, replace=False))
        x = rng.random(n)
        assert own.logits(at, x) == pytest.approx(dense[:, at] @ x + dense[:, -1])
    assert all(own[c, j] == dense[c, j] for c in range(5) for j in range(-1, 40))
    assert len(own.value) == (dense != 0).sum()


def test_ftrl_equals_the_plain_formula():
    rng = np.random.default_rng(12)
    rows = [(np.sort(rng.choice(50, 5, replace=False)), rng.random(5)) for _ in range(30)]
    y = rng.integers(0, 3, 30)
    z, n = {}, {}

    def weight(c, j):
        s = z.get((c, j), 0.0)
        return 0.0 if abs(s) <= 0.05 else -(s - (0.05 if s > 0 else -0.05)) / ((1.0 + n.get((c, j), 0.0) ** 0.5) / 0.7 + 0.2)

    for _ in range(2):
        for (at, x), label in zip(rows, y, strict=True):
            pairs = [*zip(at.tolist(), x.tolist(), strict=True), (langid.BUCKETS, 1.0)]
            w = {(c, j): weight(c, j) for c in range(3) for j, _ in pairs}
            e = [np.exp(sum(w[c, j] * v for j, v in pairs)) for c in range(3)]
            for c in range(3):
                for j, v in pairs:
                    g = (e[c] / sum(e) - (c == label)) * v
                    old = n.get((c, j), 0.0)
                    z[c, j] = z.get((c, j), 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / 0.7 * w[c, j]
                    n[c, j] = old + g * g
    got = langid.ftrl(rows, y, 3, epochs=2, alpha=0.7, beta=1.0, l1=0.05, l2=0.2)
    for c in range(3):
        for j in [*range(50), langid.BUCKETS]:
            assert got[c, j] == pytest.approx(weight(c, j), abs=1e-9)


def test_trees_equal_a_walk_and_lower_the_loss():
    rng = np.random.default_rng(13)
    x = rng.normal(size=(400, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = toxicity.boosted(x, y, trees=20)

    def walk(row):
        out = model.start
        for feature, threshold, value in model.trees:
            k = 0
            while feature[k] >= 0:
                k = 2 * k + (2 if row[feature[k]] > threshold[k] else 1)
            out += value[k]
        return out

    raw = model.raw(x)
    assert raw == pytest.approx([walk(r) for r in x])
    assert ((raw > 0) == (y > 0)).mean() > 0.95
    feature, threshold, _ = model.trees[0]
    p = y.mean()
    gains = {}
    for f in range(4):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 49)[1:-1])):
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= 20:
                gain = sum(((y - p)[s].sum()) ** 2 / (p * (1 - p) * s.sum() + 1) for s in (left, ~left)) - (y - p).sum() ** 2 / (p * (1 - p) * len(y) + 1)
                gains[f, float(cut)] = gain
    best = max(gains, key=gains.get)
    assert (feature[0], threshold[0]) == pytest.approx(best) if gains[best] > 4 else feature[0] == -1


def test_languages_equal_a_plain_model(spark):
    """Grams cut one by one, document frequencies counted over all allowed rows, TF-IDF and softmax in plain loops."""
    rows = [*documents(300, seed=3), (901, "Ünd DER -- die\tmit 12 ist", None, "s", 0.0, "k"), (902, "a", "aa", "s", 0.0, "k"), (903, None, "aa", "s", 0.0, "k"), (904, "the and " * 4000, "aa", "s", 0.0, "k")]
    docs = spark.createDataFrame(rows, DOCS)

    def bucket(gram: str) -> int:
        h = 0
        for c in gram:
            h = (h * 0x01000193 + ord(c)) % 2**32
        h = (h ^ h >> 15) * (0x85EBCA6B + 2 * len(gram)) % 2**32
        return ((h ^ h >> 13) * 0xC2B2AE35 % 2**32) >> 18

    def grams(text: str | None) -> dict[int, int]:
        plain = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        words = plain.split()
        if not words:
            return {}
        cut, out = [], {}  # of a run of other signs its first is left if it follows a letter
        for i, c in enumerate(plain):
            if c != " " or (i and plain[i - 1] != " "):
                cut.append(c)
        whole = " " + "".join(cut) + " "
        for n in (1, 2, 3):
            for i in range(len(whole) - n + 1):
                b = bucket(whole[i : i + n])
                out[b] = out.get(b, 0) + 1
        return out

    model = langid.train(docs, ~langid.held_out(docs.doc_id))
    taught = [grams(r[1]) for r in rows if r[2] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    taught = [g for g in taught if g]
    frequency = {}
    for g in taught:
        for b in g:
            frequency[b] = frequency.get(b, 0) + 1
    idf = lambda b: np.log((1 + len(taught)) / (1 + frequency.get(b, 0))) + 1
    found = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for i, text, *_ in rows:
        own = grams(text)
        if not own:
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
            continue
        x = {b: np.log(1 + n) * idf(b) for b, n in own.items()}
        norm = sum(v * v for v in x.values()) ** 0.5
        z = [(sum(model.weights[c, b] * v / norm for b, v in x.items()) + model.weights[c, -1]) / model.temperature for c in range(len(model.languages))]
        p = [np.exp(v - max(z)) for v in z]
        assert found[i].lang_pred == model.languages[z.index(max(z))]
        assert found[i].score == pytest.approx(max(p) / sum(p), abs=1e-9)


def test_features_equal_plain_counts(spark):
    terms = {"tepid": 3.0, "lowe*": 4.0}
    at = {name: i for i, name in enumerate(toxicity.FEATURES)}
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r.text and r.text.strip()]
    texts += ["YOU are a TEPID loweish idiot, you idiot!", "x" * 500 + " you idiot"]
    own = toxicity.Tokens(terms)
    for text in texts:
        got = own.features(text)
        words = toxicity.LETTERS.findall(text.lower())
        known = [w for w in words if w in terms or w[:4] + "*" in terms and len(w) >= 4]
        n = max(1, len(words))
        expected = {
            "insult_density": sum(w in toxicity.INSULTS for w in words) / n,
            "learned_density": len(known) / n,
            "second_person": sum(w in toxicity.SECOND_PERSON for w in words) / n,
            "capitals": sum(c.isupper() for c in text) / len(text),
            "exclamations": sum(c in "!?¡¿" for c in text) / len(text),
            "digits": sum(c.isdigit() for c in text) / len(text),
            "words": np.log1p(len(words)),
            "word_length": sum(map(len, words)) / n,
            "distinct": len(set(text.split())) / len(text.split()),
        }
        assert {k: got[at[k]] for k in expected} == pytest.approx(expected)


def plain_features(text, terms):
    """All features of a text without a token of over 64 signs, one by one, with patterns of the test's own."""
    import regex

    tokens = (text or "").split()
    if not tokens:
        return dict.fromkeys(toxicity.FEATURES, 0.0)
    undo = str.maketrans("013457@$!|", "oieastasil", "*.-_+")
    weight = lambda w: max([terms.get(w, 0.0)] + [terms.get(w[:k] + "*", 0.0) for k in (4, 5, 6) if len(w) >= k])
    rows = []
    for token in tokens:
        low = token.lower()
        plain = low.isalpha()
        words = [low] if plain else regex.findall(r"\p{L}+", low)
        kinds = "" if plain else "".join("p" if c in ".,;:'\"()[]-–—«»…" else "e" if c in "!?¡¿" else "d" if c.isdigit() else "" if c.isalnum() or c.isspace() or ord(c) <= 32 else "s" for c in token if not c.isupper())
        capitals = sum(c.isupper() for c in token)
        undone = [] if plain or not words else [w.translate(undo) for w in regex.findall(r"\p{L}+(?:[0-9@$!|*._+\-]+\p{L}+)+", low)]
        shouted = int(capitals == len(token) > 2) if plain else len(toxicity.CAPITAL_WORDS.findall(token)) if capitals > 2 else 0
        rows.append((token, words, kinds, capitals, undone, shouted, plain and len(low) == 1))
    n = max(1, sum(len(r[1]) for r in rows))
    every = [w for r in rows for w in r[1]]
    insults = sum(w in toxicity.INSULTS for w in every)
    learned = sum(weight(w) > 0 for w in every)
    marked = [i for i, r in enumerate(rows) if any(w in toxicity.INSULTS or weight(w) > 0 for w in r[1])]
    you = [i for i, r in enumerate(rows) if any(w in toxicity.SECOND_PERSON for w in r[1])]
    hits = lambda ws: sum(w in toxicity.INSULTS or weight(w) > 0 for w in ws)
    spelled = []
    if any(all(r[6] for r in rows[i : i + 3]) for i in range(len(rows) - 2)):
        spelled = ["".join(regex.findall(r"\p{L}", m)) for m in regex.findall(r"(?<!\w)(?:\p{L}[ .*_\-]){2,}\p{L}(?!\w)", text.lower())]
    undone = [w for r in rows for w in r[4]]
    values = [
        insults / n, min(insults, 20), learned / n, min(learned, 50), len({r[0] for r in rows if any(weight(w) > 0 for w in r[1])}), max(max((weight(w) for w in r[1]), default=0.0) for r in rows),
        sum(any(abs(i - j) <= 5 for j in you) for i in marked) / n * 100, sum(w in toxicity.SECOND_PERSON for w in every) / n,
        sum(r[3] for r in rows) / len(text), sum(r[5] for r in rows) / n, *("".join(r[2] for r in rows).count(k) / len(text) for k in "pesd"),
        len(undone) / n, hits(undone), len(spelled) / n, hits(spelled), np.log1p(len(every)), sum(map(len, every)) / n, len(set(tokens)) / len(tokens),
    ]
    return dict(zip(toxicity.FEATURES, values, strict=True))


def test_all_features_equal_plain_ones(spark):
    terms = {"tepid": 3.0, "lowe*": 4.0, "thor": 2.6}
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r.text and max(map(len, r.text.split()), default=0) <= 64]
    texts += ["YOU are a T3P1D loweish IDIOT, you 1d10t!", "i d i o t and s.c.u.m you", "a b c l o w e", "No!!! ¿Qué? $$$ @you «x» … 12", "tepid", "You're L0SER lo-ser TRASH;", "\x0b"]
    own = toxicity.Tokens(terms)
    for text in texts:
        assert dict(zip(toxicity.FEATURES, own.features(text), strict=True)) == pytest.approx(plain_features(text, terms)), text


def test_toxicity_equals_a_plain_model(spark):
    """Sample, halves, lexicon, features, the trees' walk, pooled means and the score of every document, in plain loops; the
    trees themselves are held against their formula above."""
    import pyarrow as pa
    import regex
    from pyspark.sql import functions as F

    from muster.llm.ngram_join import gram_sets

    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    marks = {}
    for r in labels.collect():
        if r.toxic is not None and r.doc_id in texts and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            marks[r.doc_id] = max(marks.get(r.doc_id, 0), r.toxic)
    ids = sorted(marks)
    grams = gram_sets(pa.RecordBatch.from_arrays([pa.array([texts[i] for i in ids])], ["text"]), "text", 5)
    firsts = {}
    for i, g in zip(ids, grams, strict=True):
        firsts.setdefault(int(g[0]) if len(g) else 0, i)
    half = {r.doc_id: r.h for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(10)).alias("h")).collect()}
    chosen = sorted(firsts.values())
    teach, rest = [i for i in chosen if half[i] < 5], [i for i in chosen if half[i] >= 5]
    assert len(rest) >= 40
    pos, counted = sum(marks[i] for i in teach), {}
    for i in teach:
        words = {w for w in regex.split(r"[^\p{L}]+", texts[i].lower()) if len(w) > 2}
        for term in words | {w[:k] + "*" for w in words for k in (4, 5, 6) if len(w) >= k}:
            c = counted.setdefault(term, [0, 0])
            c[1 - marks[i]] += 1
    odds = {t: np.log((p + 0.5) / (pos + 1)) - np.log((n + 0.5) / (len(teach) - pos + 1)) for t, (p, n) in counted.items() if p >= max(3, round(0.01 * pos))}
    best = sorted((t for t, w in odds.items() if w >= 2.5), key=lambda t: (-counted[t][0] * odds[t], t))[:400]
    model = toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id"), 4, 2))
    assert model.terms == pytest.approx({t: odds[t] for t in best})
    rest.sort(key=lambda i: ((i * 0x9E3779B97F4A7C15 % 2**64) >> 20, i))
    x = [list(plain_features(texts[i], model.terms).values()) for i in rest]
    y = [float(marks[i]) for i in rest]
    cut = round(0.7 * len(y))
    trees = toxicity.boosted(np.array(x[:cut]), np.array(y[:cut]), least=int(np.clip(cut // 50, 3, 20)))

    def raw(row):
        out = trees.start
        for feature, threshold, value in trees.trees:
            k = 0
            while feature[k] >= 0:
                k = 2 * k + (2 if row[feature[k]] > threshold[k] else 1)
            out += value[k]
        return out

    points = sorted(((raw(r), i) for i, r in enumerate(x[cut:])), key=lambda p: p[0])
    blocks = [[v, v, y[cut + i], 1] for v, i in points]
    at = 0
    while at < len(blocks) - 1:
        (a, _, s, n), (_, d, t, m) = blocks[at], blocks[at + 1]
        if s / n >= t / m:
            blocks[at : at + 2] = [[a, d, s + t, n + m]]
            at = max(0, at - 1)
        else:
            at += 1
    xs = [v for a, b, *_ in blocks for v in ([a, b] if b > a else [a])]
    ys = [s / n for a, b, s, n in blocks for _ in ([a, b] if b > a else [a])]
    found = {r.doc_id: r for r in toxicity.predictions(docs, labels).collect()}
    for i, text in texts.items():
        if max(map(len, text.split()), default=0) > 64:
            continue
        z = raw(list(plain_features(text, model.terms).values()))
        expected = 0.998 * np.interp(z, xs, ys) + 0.002 / (1 + np.exp(-z))
        assert found[i].score == pytest.approx(expected, abs=1e-9) and found[i].predicted == int(expected >= 0.3)
