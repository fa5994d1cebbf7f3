"""The phrase index against plain substring tests."""

import random

import pytest
from pyspark.sql import functions as F

from trendloom.operators import phrases


def brute_force(texts, table):
    return sorted(((i, *row) for i, text in texts for row in table
                   if text is not None and row[1] and row[1] in text), key=str)


def case(spark, rng, n_texts=60, n_phrases=300):
    alphabet = "abAB é漢"
    texts = [(i, "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 3, 40, 200]))))
             for i in range(n_texts)] + [(-1, None), (-2, "ML")]
    table = [(f"t{i % 7}", "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))))
             for i in range(n_phrases)] + [("x", None), ("x", ""), ("y", "ML"), ("z", "ML")]
    return (texts, table, spark.createDataFrame(texts, "id long, body string"),
            spark.createDataFrame(table, "topic string, phrase string"))


@pytest.mark.parametrize("held", [1_000_000, 10])
def test_equals_contains(spark, monkeypatch, held):
    """With an index that every task holds, and with one that is shuffled."""
    monkeypatch.setattr(phrases, "INDEX_ROWS", held)
    texts, table, docs, words = case(spark, random.Random(held))
    got = phrases.phrase_matches(docs, "id", "body", words, rows=50)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(texts, table)


def test_each_phrase_is_under_its_rarest_gram(spark):
    docs = spark.createDataFrame([(1, "abcdxx"), (2, "abcdyy"), (3, "bcde"), (4, None)],
                                 "id long, body string")
    words = spark.createDataFrame([("abcde",), ("abcd",), ("xy",), (None,), ("",)], "phrase string")
    index = phrases.phrase_index(docs, "body", words)
    assert sorted(map(tuple, index.collect())) == [("abcd", "abcd"), ("bcde", "abcde"), ("xy", "xy")]


def test_large_dictionary(spark):
    """100,000 phrases."""
    rng = random.Random(9)
    texts = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(50))) for i in range(40)]
    table = [("t", f"w{i} w{rng.randrange(3000)}") for i in range(100_000)]
    table += [("t", " ".join(text.split()[5:8])) for _, text in texts]
    got = phrases.phrase_matches(spark.createDataFrame(texts, "id long, body string"), "id", "body",
                                 spark.createDataFrame(table, "topic string, phrase string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(texts, table)


def test_topics(spark):
    docs = spark.createDataFrame([(1, "AI and ML here"), (2, "none"), (3, None)], "id long, body string")
    words = spark.createDataFrame([("B", "AI "), ("A", "ML"), ("A", "and"), ("C", "xyz")],
                                  "topic string, phrase string")
    got = phrases.tagged_topics(docs, "id", "body", words)
    assert {r["id"]: r["topics"] for r in got.collect()} == {1: ["A", "B"], 2: [], 3: []}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "id long, body string")
    words = spark.createDataFrame([("t", "a")], "topic string, phrase string")
    assert phrases.phrase_matches(docs.limit(0), "id", "body", words).count() == 0
    assert phrases.phrase_matches(docs, "id", "body", words.limit(0)).count() == 0
    assert phrases.tagged_topics(docs, "id", "body", words.where("false")).select(
        F.size("topics")).first()[0] == 0
