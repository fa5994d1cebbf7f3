"""What is read, cleaned and moved once."""

import datetime
from collections import Counter

from pyspark.sql import functions as F

from trendloom.operators import joins, terms
from trendloom.plans import queries

SF = "/root/testdata/sf0.001"
DOCS = [("a", ["x", "y", "x", ""]), ("b", []), ("c", None), ("d", ["y", None, "é", "y"])]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_of_documents_are_counted_by_batches(spark):
    docs = spark.createDataFrame(DOCS, "id string, tokens array<string>")
    rows = terms.doc_terms(docs, ["id"], "tokens")
    wanted = {(i, len(t), w, n) for i, t in DOCS if t for w, n in Counter(t).items() if w}
    found = [tuple(r) for r in rows.collect()]
    assert set(found) == wanted and len(found) == len(wanted)
    assert "lambdafunction" not in plan(rows)
    more = terms.doc_terms(docs, ["id"], "tokens", with_docs=True).collect()
    assert sorted(r["id"] for r in more if r["term"] is None) == ["a", "b", "c", "d"]
    assert {tuple(r) for r in more if r["term"] is not None} == wanted


def test_documents_of_windows_are_counted_with_their_terms(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [("t", start + datetime.timedelta(seconds=30 * i), DOCS[i % 4][1], str(i))
            for i in range(12)]
    docs = spark.createDataFrame(rows, "topic string, ts timestamp, tokens array<string>, id string")
    stats = terms.pair_stats(docs.withColumn("slide", F.lit(0)), "topic", "slide", "tokens",
                             with_docs=True)
    assert plan(stats).count("Scan ExistingRDD") == 1
    of_terms, n_docs = terms.terms_and_docs(stats, "topic", "slide")
    assert [tuple(r) for r in n_docs.collect()] == [("t", 0, 12)]
    found = {r["term"]: (r["df"], [e["id"] for e in r["best"]]) for r in of_terms.collect()}
    assert found == {"x": (3, ["0", "4", "8"]), "é": (3, ["11", "3", "7"]),
                     "y": (6, ["11", "3", "7", "0", "4"])}


def test_lengths_of_joined_texts(spark):
    texts = [None, "", "ab", "é ü"]
    rows = spark.createDataFrame([(a, b, c) for a in texts for b in texts for c in texts],
                                 "a string, b string, c string")
    wrong = rows.withColumn("x", joins.content_length("a")).withColumn(
        "y", joins.content_length("b", "c")).where(
        ~joins.joined_length("x", "y").eqNullSafe(F.length(joins.all_content("a", "b", "c")).cast(
            "bigint")))
    assert wrong.count() == 0


def test_url_join_moves_no_texts(spark, monkeypatch):
    sides = []
    join = joins.url_join
    monkeypatch.setattr(joins, "url_join", lambda *a, **k: sides.append(a) or join(*a, **k))
    queries.QUERIES["url_join"](spark, SF)
    moved = {c for side in sides[0] for c in side.columns}
    assert not moved & {"text", "content", "description"}


def test_topics_clean_the_articles_once(spark):
    docs = queries._news_tokens_c(spark, SF)
    assert "ArrowEvalPython" not in plan(docs) and "lambdafunction" not in plan(docs)
