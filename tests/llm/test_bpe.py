"""Ids against the vocabulary's own library, and the exact round trip."""

import base64

import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F

from registra.llm.bpe import VOCABULARY, BytePairs


@pytest.fixture(scope="module")
def reference():
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", None, "   ", "Hello world", "it's WE'LL  12½ ٣٤ ⅷ", "a\r\n\r\n b\tc\x85 d　e ", "<p>naïve façade</p> &amp;", "🙂🏽‍🚀 ☕ ਰੰਗਲਾ ਢਾਬਾ 金穗小厨", "a" * 700, "Zabdeldaf Zabdeldaf zabdeldaf", "<|endoftext|>", "\x00\x01 é", "word " * 500, "\U0001df00\U0001df01 \u0c5d\u0c5d1 \U00010570x \U0001e4d0\U0001e4d1 \U0001d2c0\U0001d2c1", "l'été d'où 1\u00a0234\u202f5  \u3000 x\u2028\u2029y \x1c\x1f z", "漢字" * 40 + "かな ㍿"]


def test_ids_and_round_trip(spark, reference):
    codec = BytePairs()
    df = spark.createDataFrame([(i if i % 4 else None, t, "clash") for i, t in enumerate(TEXTS)] + [(7, "again", "clash"), (7, "again", "clash")], "doc_id bigint, text string, _words string")
    got = codec.encode(df).withColumn("back", codec.decode(F.col("ids"))).collect()
    want = sorted((-1 if d is None else d, reference.encode_ordinary(t or ""), t or "") for d, t, _ in (tuple(r) for r in df.collect()))
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids), r.back) for r in got) == want


def test_words_of_random_bytes(spark, reference):
    """Merging in the engine against the vocabulary's own library, on words that are no pieces."""
    import random

    rnd = random.Random(8)
    texts = ["".join(rnd.choices(rnd.choice(["ab", "abcdefgh", "éüßñ", "żółćе漢", "aA"]), k=rnd.randrange(2, 60))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: list(r.ids) for r in BytePairs().encode(df).collect()}
    assert got == {i: reference.encode_ordinary(t) for i, t in enumerate(texts)}


def test_the_literal_without_the_plan(spark, reference, monkeypatch):
    """Where the session's plan cannot be reached the constants stay expressions, with the same result."""
    monkeypatch.setattr(BytePairs, "_literal", staticmethod(lambda value: value))
    codec = BytePairs()
    df = spark.createDataFrame([(1, "Zabdeldaf été"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: (list(r.ids), r.back) for r in codec.encode(df).withColumn("back", codec.decode(F.col("ids"))).collect()}
    assert got == {1: (reference.encode_ordinary("Zabdeldaf été"), "Zabdeldaf été"), 2: ([], "")}


def test_empty_table(spark):
    assert BytePairs().encode(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
