from __future__ import annotations

import random

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_ngram_join import brute
from test_pii import check_planted, planted

import corpus_pipeline
from muster.llm import bpe, mixing, ngram_join, pii, queries, toxicity
from muster.llm.common import written

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], DATA), "test-stage"))
    return out


def test_stages_keep_the_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in stages[0].schema]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "pii", "mixing", "tokens"]


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    scores = toxicity.predictions(stages[0], spark.read.parquet(f"{DATA}/labels.parquet"))
    assert stages[1].exceptAll(stages[0]).count() == 0
    assert {r.doc_id for r in stages[1].collect()} == {r.doc_id for r in scores.where("predicted = 0").collect()}


def test_one_of_each_class_stays(stages):
    classes = {r.doc_id: r.class_id for r in ngram_join.join(stages[1]).collect()}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(classes.values()))
    assert {r.n_links for r in ngram_join.join(stages[2]).collect()} == {0}


def test_private_data_is_gone(stages):
    before, after = ({r.doc_id: r for r in df.collect()} for df in (stages[2], stages[3]))
    assert before.keys() == after.keys()
    for i, r in before.items():
        found = pii.detect(r.text)
        assert (r.text == after[i].text) == (not found)
        assert after[i].n_chars == len(after[i].text)
        for a, b, *_ in found:
            assert r.text[a:b] not in after[i].text


def test_the_mix_is_that_of_the_operator(stages):
    taken = mixing.mix(stages[3], queries.mix_domain(), queries.MIX_WEIGHTS, queries.MIX_DEFAULT, queries.MIX_EPOCHS, seed=queries.MIX_SEED)
    assert sorted(r.doc_id for r in stages[4].collect()) == sorted(r.doc_id for r in taken.collect())
    assert stages[4].distinct().exceptAll(stages[3].distinct()).count() == 0


def test_tokens_decode_to_the_texts(stages):
    texts = stages[4].select(F.sha2("text", 256).alias("decoded_sha256"))
    found = stages[5].select("decoded_sha256")
    assert texts.exceptAll(found).count() == found.exceptAll(texts).count() == 0
    assert all(len(r.ids) == r.n_tokens for r in stages[5].collect())


def test_stages_equal_brute_force(stages, tmp_path):
    """Near duplicates by all pairs, the mix by its SQL, tokens by the library's own encoder."""
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({label for _, label, _ in brute(rows)})

    stages[3].write.parquet(str(tmp_path / "docs"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/docs/*.parquet'")
    taken = con.sql(f"SELECT doc_id FROM ({queries.ORACLE_SQL['op7_mixing']})").fetchall()
    assert sorted(r.doc_id for r in stages[4].collect()) == sorted(i for (i,) in taken)

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(path), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in stages[4].collect()}
    for r in stages[5].collect():
        assert list(r.ids) == plain.encode_ordinary(texts[r.doc_id])


def test_planted_private_data_is_replaced_by_the_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = planted()
    frame = spark.createDataFrame([(i, "".join(t for _, t in p), "en", "src1", 0) for i, p in docs], schema)
    found = corpus_pipeline.with_surrogates(spark, frame, DATA).collect()
    check_planted(docs, {r.doc_id: r.text for r in found})
    assert all(r.n_chars == len(r.text) for r in found)


def test_planted_toxic_documents_go_and_clean_ones_stay(spark, tmp_path):
    """Insults that the given lexicon lacks, learned from labels: every document that holds several goes, all others stay."""
    rng = random.Random(8)
    plain, bad = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re") for b in ("ber", "din", "sol", "tav", "wen")], ["grzmork", "flubnit", "skarvex"]
    rows = []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(30, 90))]
        if i % 4 == 0:
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "en", "src1", 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = corpus_pipeline.without_toxic(spark, frame, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in left) == [i for i in range(400) if i % 4]
    assert {tuple(r) for r in left} <= set(rows)


def test_run_gives_what_the_stages_give(spark, stages):
    got = corpus_pipeline.run(spark, DATA)
    assert got.exceptAll(stages[5]).count() == stages[5].exceptAll(got).count() == 0


def test_odd_rows_pass_the_stages(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, names that the stages use themselves; and no rows."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, odd string, tid int, times int, sid int, key string, epoch int"
    extra = (0.5, "o", 1, 2, 3, "k", 4)
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, words, "en", "src1", 300, *extra)] * 3 + [(2, words + " more", None, None, None, *extra), (3, None, "en", "src1", 0, *extra), (4, "", "en", "src1", 0, *extra), (None, "an id is missing here", "en", "src1", 1, *extra)]
    rows += [(5, "mail a.b@c.example.com " * 3000, "de", "src2", 9, *extra), (6, "quite another text of its own", "fr", "src3", 9, *([None] * 7))]
    labels = spark.read.parquet(f"{DATA}/labels.parquet").where("doc_id < 0")
    for name, some in (("odd", rows), ("none", [])):
        path = str(tmp_path / name)
        spark.createDataFrame(some, schema).write.parquet(f"{path}/documents.parquet")
        labels.write.parquet(f"{path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()}
    assert kept == {1, None, 5, 6}
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
