"""Feeds and jobs at size: texts move once, batches are not kept, rows as before."""

import pytest
from pyspark.sql import functions as F

from trendloom.operators import rates
from trendloom.operators.latest import UpsertStore
from trendloom.operators.tweets import process_tweets
from trendloom.plans import bindings
from trendloom.schemas import S, struct
from trendloom.sources import sinks
from trendloom.streaming import jobs


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def tables(spark, tmp_path):
    """Documents and pages with keys that repeat or are NULL."""
    docs = [(0, "zero", "en", "s", 4), (1, "one", "en", "s", 3), (1, "uno", "es", "t", 3),
            (None, "none", "en", "s", 4), (5, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    pages = [(0, "u0"), (1, "u1"), (1, "u1b"), (None, "un")]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(
        f"{tmp_path}/pages.parquet")
    spark.sql("""SELECT id AS event_id, timestamp_ntz'2024-01-01' AS ts, id AS user_id
        FROM range(12)""").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_texts_move_once(spark, tables, no_broadcast):
    for feed in (bindings.tweets(spark, tables).select("id", "text", "url"),
                 bindings.news(spark, tables).select("doc_id", "description", "url")):
        top = [line for line in plan_of(feed) if "SortMergeJoin" in line or "Exchange" in line]
        assert "SortMergeJoin" in top[0] and "doc_id" in top[0]


def test_feed_rows_with_repeated_keys(spark, tables):
    news = bindings.news(spark, tables).select("doc_id", "url").collect()
    assert sorted(map(str, map(tuple, news))) == sorted(map(str, [
        (0, "u0"), *[(1, "u1"), (1, "u1b")] * 2, (None, None), (5, "u1"), (5, "u1b")]))
    ids = [(r["id"], r["url"], r["text"] is None) for r in bindings.tweets(spark, tables).collect()]
    want = []
    for n in range(12):
        urls = {0: ["u0"], 1: ["u1", "u1b"]}.get(n % 4, [None])
        texts = {0: [False], 1: [False, False]}.get(n % 5, [True])
        want += [(n, url, text) for url in urls for text in texts]
    assert sorted(map(str, ids)) == sorted(map(str, want))


def messages(spark):
    good = """{"id": "1", "text": "Big data", "entities": {"urls": [{"expanded_url": "http://a.b/%s"}]}}"""
    rows = [("1", good % "x"), ("2", good % "y"), ("2", "{bad"), (None, good % "x"), ("4", "{}")]
    return spark.createDataFrame(rows, "key string, value string").withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp"))


def test_redirects_move_no_payload(spark, no_broadcast):
    table = spark.createDataFrame([("http://a.b/x", "http://c.d/z")], "url string, location string")
    whole = process_tweets(messages(spark), redirects=table)
    plan = whole.select("key", "code", "enriched")._jdf.queryExecution().optimizedPlan()
    while "Join" not in plan.nodeName():
        plan = plan.children().head()
    names = {plan.output().apply(i).name() for i in range(plan.output().size())}
    assert "tweet" not in names and "value" not in names
    got = {(r["key"], r["code"], str(r["tweet"]["entities"]["urls"] if r["tweet"]["entities"] else None),
            str(r["enriched"]["url_details"]["full_url"])) for r in whole.collect()}
    x, y = "[Row(expanded_url='http://a.b/x')]", "[Row(expanded_url='http://a.b/y')]"
    z = "[Row(expanded_url='http://c.d/z')]"
    assert got == {("1", 1, z, "['http://c.d/z']"), ("2", 1, y, "['http://a.b/y']"),
                   ("2", -102, "None", "None"), (None, 1, x, "['http://a.b/x']"),
                   ("4", whole.where("key = '4'").first()["code"], "None", "None")}
    assert whole.columns == process_tweets(messages(spark)).columns


def test_messages_in_one_pass(spark):
    processed = process_tweets(messages(spark))
    want = sinks.routed_messages(processed).unionByName(sinks.cleaned_messages(processed))
    got = sinks.all_messages(processed)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_batches_are_not_kept(spark, tmp_path):
    kept = []
    store = UpsertStore(spark, str(tmp_path / "s"), struct(id=S), ["id"], ["id"])
    store.write_batch = lambda batch, batch_id: kept.append(
        len(spark.sparkContext._jsc.getPersistentRDDs()))
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    messages(spark).write.parquet(str(tmp_path / "in"))
    stream = process_tweets(spark.readStream.schema("key string, value string, timestamp timestamp")
                            .parquet(str(tmp_path / "in")))
    jobs.run(jobs.etl(stream, store, lambda rows, batch_id: rows.count(), str(tmp_path / "c")))
    assert kept == [before]


def test_single_batch_is_read_as_it_lies(spark, tmp_path):
    store = UpsertStore(spark, str(tmp_path / "s"), struct(id=S, at=S), ["id"], ["at"])
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "1")], "id string, at string")
    store.write_batch(rows, 0)
    assert "Window" not in "".join(plan_of(store.read()))
    assert sorted(map(str, store.read().collect())) == sorted(map(str, [("a", "2"), (None, "1")])) or \
        {tuple(r) for r in store.read().collect()} == {("a", "2"), (None, "1")}
    store.write_batch(spark.createDataFrame([("a", "3")], "id string, at string"), 1)
    assert {tuple(r) for r in store.read().collect()} == {("a", "3"), (None, "1")}


def test_first_rows_move_no_others(spark, no_broadcast):
    rows = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("u", 1, "a"), (None, 1, "n"),
                                  ("v", None, "c"), ("v", 3, "d")], "url string, id long, text string")
    got = rates.first_rows(rows, "url", ["id"])
    assert {tuple(r) for r in got.collect()} == {("u", 1, "a"), (None, 1, "n"), ("v", None, "c")}
    assert got.count() == 3
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in plan_of(got))
