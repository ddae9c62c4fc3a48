from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from muster.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "Hello  world\n\n\tit's 1234 naïve ☃ 👩‍👩‍👧 क्षि \u0085 x", "a" * 3000, "  " * 500, "ß!?" * 400]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


def test_ids_are_those_of_tiktoken(spark, reference):
    rng = random.Random(5)
    pool = "abc'stLL09.!? \n\té☃　​😀ि<|endoftext|>"
    texts = TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    for r in bpe.digests(df, PATH, public_tokenizers.PATTERN, ids=True).collect():
        text = texts[r.doc_id] or ""
        assert r.ids == reference.encode_ordinary(text)
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_and_offsets(spark):
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    coded = bpe.encode(df, PATH, public_tokenizers.PATTERN, offsets="at")
    for r in bpe.decode(coded, PATH, public_tokenizers.PATTERN, out="back").collect():
        text = r.text or ""
        assert r.back == text
        assert len(r.at) == len(r.ids)
        if text:
            assert r.at[0].start == 0 and r.at[-1].end == len(text)
        assert all(a.start <= b.start <= a.end for a, b in zip(r.at, r.at[1:]))


def test_split_characters_and_unknown_ids(spark):
    own = bpe.codec(PATH, public_tokenizers.PATTERN)
    ids, _ = own.encode(["☃"])
    half = spark.createDataFrame([(1, ids.tolist()[:-1])], "doc_id long, ids array<int>")
    assert "�" in bpe.decode(half, PATH, public_tokenizers.PATTERN).first().text
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), PATH, public_tokenizers.PATTERN).collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(df, PATH, public_tokenizers.PATTERN).count() == 0
