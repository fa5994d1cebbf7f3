import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from cases import documents, odd_documents, prose
from pyspark.sql import functions as F

from trendloom.llm import byte_pairs as bp
from trendloom.llm.queries import QUERIES, TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bp.read_ranks(PATH))


@pytest.fixture(scope="module")
def vocabulary():
    return bp.read_vocabulary(PATH, public_tokenizers.PATTERN)


def check(spark, rows, vocabulary, reference):
    df = documents(spark, rows).withColumns({c: F.lit(1) for c in ("ids", "decoded")})
    encoded = bp.encode(df, vocabulary)
    got = bp.decode(encoded, vocabulary)
    assert encoded.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    want = [(r[0], reference.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows]
    assert sorted(((r[0], list(r[1]), bytes(r[2])) for r in got.collect()), key=repr) \
        == sorted(want, key=repr)


def test_equals_the_tokenizer(spark, vocabulary, reference):
    rng = random.Random(1)
    chars = [lambda: chr(rng.randrange(32, 127)), lambda: chr(rng.randrange(0x3000)),
             lambda: chr(rng.randrange(0x1F300, 0x1F700)), lambda: rng.choice(" \t\n\r\x1c\x85")]
    rows = [(i, "".join(rng.choice(chars)() for _ in range(rng.randrange(120))))
            for i in range(400)]
    rows += [(1000 + i, text) for i, text in enumerate([
        "don't we'll I'M x's", "  two  blanks ", "a\n\n b", "<unk><|endoftext|>▁x", "ſ İ ǅ",
        "1234567890" * 50, "a" * 5_000, "漢字" * 900, " " * 3_000, "\x00"])]
    check(spark, rows, vocabulary, reference)


def test_odd_rows(spark, vocabulary, reference):
    check(spark, odd_documents(), vocabulary, reference)
    assert bp.encode(documents(spark, [(1, "a")]).where("false"), vocabulary).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in bp.decode(nothing, vocabulary).orderBy("doc_id").collect()] \
        == [None, b""]


def test_small_caches_change_nothing(spark, vocabulary, reference, monkeypatch):
    monkeypatch.setattr(bp, "CACHED", 3)
    monkeypatch.setattr(bp, "CACHED_CHARS", 4)
    rng = random.Random(2)
    check(spark, [(i, prose(rng, 40)) for i in range(30)], vocabulary, reference)


def test_tokens_that_merging_does_not_reach(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 300, b"xy": 301}
    own = bp.Vocabulary(ranks, r"\w+|\W+")
    reference = tiktoken.Encoding("x", pat_str=own.pattern, mergeable_ranks=ranks, special_tokens={})
    assert own.whole == {} or set(own.whole) == {"abc"}
    check(spark, [(1, "abc abcd xyz"), (2, "ab")], own, reference)
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256}
    own = bp.Vocabulary(ranks, r"\w+|\W+")
    reference = tiktoken.Encoding("x", pat_str=own.pattern, mergeable_ranks=ranks, special_tokens={})
    assert set(own.whole) == {"abc"}
    check(spark, [(1, "abc abcd abc")], own, reference)


def test_a_vocabulary_lacks_bytes():
    with pytest.raises(ValueError):
        bp.serialized({b"a": 0})


def test_query(spark, reference):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(
        f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_byte_pairs"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = reference.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
