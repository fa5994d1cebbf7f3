"""Joins with hot keys, shares, rankings, TF-IDF, vocabulary, upserts, sinks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trendloom.operators import domains, joins, latest, rates, terms, topics, vocabulary
from trendloom.operators.numbering import numbered
from trendloom.schemas import NEWS, I, S, struct
from trendloom.sources import readers, sinks
from trendloom.streaming import metrics


@pytest.mark.parametrize("how,both", [
    ("inner", False), ("left", False), ("left_semi", False), ("inner", True)])
def test_skew_join_equals_plain_join(spark, how, both):
    rng = random.Random(5)
    left = [(i, "hot" if i % 3 == 0 else None if i % 31 == 0 else f"k{rng.randrange(400)}")
            for i in range(3000)]
    right = [("hot", j) for j in range(3)] + [(f"k{j}", j) for j in range(0, 500, 2)] + [(None, 9)]
    if both:  # k2 is hot on the right only, "hot" on both sides
        right += [("k2", -j) for j in range(300)] + [("hot", -j) for j in range(150)]
    a = spark.createDataFrame(left, "id int, key string")
    b = spark.createDataFrame(right, "key string, v int")
    got = joins.skew_join(a, b, "key", ["id"], how, rows=100, right_spread=["v"] if both else None)
    want = a.join(b, "key", how)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_hot_keys_get_parts_by_weight(spark):
    a = spark.range(10000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"))
    counts = a.groupBy("key").agg(F.count("*").alias("n"))
    hot = joins.hot_keys(counts, "key", "n", "parts", 100)
    assert [tuple(row) for row in hot.collect()] == [(0, 34)]
    assert joins.hot_keys(counts, "key", "n", "parts", 4000).count() == 0
    joined = joins.skew_join(a, spark.range(5).withColumnRenamed("id", "key"), "key", ["id"],
                             rows=100)
    assert joined.count() == a.where("key < 5").count()


def test_right_side_of_an_outer_join_is_not_split(spark):
    a = spark.range(3).withColumnRenamed("id", "key")
    with pytest.raises(ValueError):
        joins.skew_join(a, a, "key", ["key"], "left", right_spread=["key"])


def test_replacements(spark):
    rows = spark.createDataFrame(
        [(1, ["a", "b", "a", None]), (2, []), (3, None), (4, ["x"]), (5, ["b", "c"])],
        "id int, urls array<string>")
    table = spark.createDataFrame([("a", "A"), ("b", "B"), ("z", "Z"), (None, "N")],
                                  "url string, location string")
    got = {r["id"]: r["urls"] for r in joins.resolve_redirects(rows, table).collect()}
    assert got == {1: ["A", "B", "A", None], 2: [], 3: None, 4: ["x"], 5: ["B", "c"]}


def test_url_join(spark):
    tweets = spark.createDataFrame([(1, "a"), (2, "a,b"), (3, "c"), (4, None)], "id int, url string")
    news = spark.createDataFrame([(10, "a"), (11, "a"), (12, "b"), (13, None)],
                                 "doc_id int, url string")
    pairs = {(row["id"], row["doc_id"]) for row in joins.url_join(tweets, news).collect()}
    assert pairs == {(1, 10), (1, 11)}
    every = joins.url_join(tweets, news, explode_urls=True).collect()
    assert {(row["id"], row["doc_id"]) for row in every} == {(1, 10), (1, 11), (2, 10), (2, 11), (2, 12)}
    assert joins.url_join_counts(tweets, news).first() == (1, 2)
    assert joins.url_join_counts(tweets.where("id > 3"), news).first() == (0, 0)


def test_shares_sum_to_one_and_ties_go_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k string")
    rows = rates.share_by(df, "k").collect()
    assert math.isclose(sum(row["relative_rank"] for row in rows), 1)
    assert [row["k"] for row in rates.top_shares(df.dropna(), "k", 3).collect()] == ["c", "a", "b"]


def test_rate_has_no_total_without_day(spark):
    df = spark.createDataFrame([("d", "x"), ("d", ""), (None, "x")], "day string, k string")
    got = {(r["day"], r["k"]): (r["total"], r["relative_count"])
           for r in rates.rate_by_day(df, "day", "k").collect()}
    assert got == {("d", "x"): (2, .5), ("d", ""): (2, .5), (None, "x"): (None, None)}


def test_top_per_day(spark):
    rows = [("d", s) for s in "aabbcde"]
    top = rates.top_per_day(spark.createDataFrame(rows, "day string, s string"), "day", "s")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert sorted((r["row_number"], r["s"], r["count"]) for r in top.collect()) == [
        (1, "a", 2), (2, "b", 2), (3, "c", 1)]


def tokens(spark, *docs):
    return spark.createDataFrame([(i, doc) for i, doc in enumerate(docs)], "id int, t array<string>")


def test_doc_terms(spark):
    rows = terms.doc_terms(tokens(spark, ["b", "a", "b"], [], None, [""]), ["id"], "t").collect()
    assert sorted(map(tuple, rows)) == [(0, 3, "a", 1), (0, 3, "b", 2)]


def test_doc_terms_need_no_shuffle(spark):
    plan = terms.doc_terms(tokens(spark, ["a"]), ["id"], "t")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_tfidf(spark):
    docs = tokens(spark, ["a", "a", "b"], ["b", "c"])
    got = {(r["id"], r["term"]): r for r in terms.tfidf(docs, "id", "t").collect()}
    assert math.isclose(got[0, "a"]["tf"], 2 / 3) and math.isclose(got[0, "a"]["idf"], math.log10(2))
    assert got[0, "b"]["idf"] == 0 and got[0, "b"]["df"] == 2
    assert round(got[0, "a"]["tfidf"], 9) == 0.200686664
    assert all(0 <= r["tf"] <= 1 for r in got.values())
    pairs = terms.top_pairs(terms.tfidf(docs, "id", "t"), "id", 2).collect()
    assert [(r["id"], r["term"]) for r in pairs] == [(0, "a"), (1, "c")]


def test_an_empty_document_counts(spark):
    rows = terms.tfidf(tokens(spark, ["x"], []), "id", "t").collect()
    assert [(r["term"], r["idf"]) for r in rows] == [("x", math.log10(2))]


def test_top_terms_equal_the_definition(spark):
    rng = random.Random(3)
    docs = [[rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(rng.randrange(9))]
            for _ in range(60)]
    count = {}
    for doc in docs:
        for t in doc:
            count[t] = count.get(t, 0) + 1
    pool = sorted(count, key=lambda t: (-count[t], t))[:10]
    df = {t: sum(t in doc for doc in docs) for t in pool}
    score = {t: round(max(math.log10(len(docs) / df[t]) * (doc.count(t) / len(doc))
                          for doc in docs if t in doc), 9) for t in pool}
    want = sorted(pool, key=lambda t: (-score[t], t))[:5]
    got = terms.top_terms(tokens(spark, *docs), "t", 10, 5).collect()
    assert [r["term"] for r in got] == want
    assert [r["score"] for r in got] == pytest.approx([score[t] for t in want])


def test_window_must_hold_whole_slides():
    with pytest.raises(ValueError):
        terms.window_starts(None, 100, 30)


def test_golden_invariants_of_term_counts(spark):
    from trendloom.functions.text import clean_tokens_d
    text = "Machine learning (ML) at AI labs, NLP: human caf\\u00e9 https://u.x rt the ok human"
    df = spark.createDataFrame([(text,)], "x string").select(
        clean_tokens_d(F.col("x"), drop="u").alias("t"))
    counts = terms.term_counts(df, "t").orderBy(F.desc("n"), "term").collect()
    assert all(r["term"].isalpha() and "u" not in r["term"] for r in counts)
    assert {r["term"] for r in counts if len(r["term"]) <= 3} <= {"ai", "ml", "nlp"}
    assert [r["n"] for r in counts] == sorted((r["n"] for r in counts), reverse=True)


def test_lemmas(spark):
    lemmas = spark.createDataFrame([("mice", "mouse"), ("are", "be")], "form string, lemma string")
    docs = spark.createDataFrame([(1, "Mice are here, mice"), (2, ""), (3, None)], "id int, x string")
    out = vocabulary.clean_with_lemmas(docs, "id", "x", lemmas, "w").orderBy("id").collect()
    # "are" becomes "be", which is a stop word.
    assert [r["w"] for r in out] == [["mouse", "mouse"], [], None]
    counts = spark.createDataFrame([("mice", 2), ("mouse", 3), ("cat", 1)], "term string, n bigint")
    assert {tuple(r) for r in vocabulary.lemma_counts(counts, lemmas).collect()} == {
        ("mouse", 5, 2), ("cat", 1, 1)}


def test_bag_of_words_equals_vectors(spark):
    docs = tokens(spark, ["a", "b", "a"], ["b"], ["b", "c"], [])
    vocab = topics.fit_vocabulary(docs, "t", vocab_size=2, min_df=1)
    assert [tuple(r) for r in vocab.orderBy("term_index").collect()] == [(0, "b"), (1, "a")]
    bag = topics.bag_of_words(docs, "id", "t", vocab).collect()
    vectors = topics.vectorizer(vocab, "t").transform(docs).collect()
    for row in vectors:
        want = dict(zip(row["raw_features"].indices.tolist(), row["raw_features"].values.tolist()))
        assert {r["term_index"]: r["n"] for r in bag if r["id"] == row["id"]} == want


def digamma(x):
    shift = sum(1 / (x + i) for i in range(20))
    z = x + 20
    return math.log(z) - 1 / (2 * z) - 1 / (12 * z * z) + 1 / (120 * z ** 4) - shift


def test_fold_in_equals_plain_rounds(spark):
    bag = spark.createDataFrame(
        [(1, "a", 3), (1, "b", 1), (1, "unknown", 9), (2, "c", 2), (3, "unknown", 1)],
        "id int, term string, n bigint")
    weights = {"a": [0.7, 0.1], "b": [0.2, 0.3], "c": [0.1, 0.6]}
    model = spark.createDataFrame(list(weights.items()), "term string, weights array<double>")
    mixtures = topics.fold_in(bag, "id", model, 8, 0.2)
    got = {r["id"]: r["shares"] for r in mixtures.collect()}
    assert set(got) == {1, 2}
    for doc, counts in ((1, {"a": 3, "b": 1}), (2, {"c": 2})):
        g = [0.2 + sum(counts.values()) / 2] * 2
        for _ in range(8):
            e = [math.exp(digamma(x)) for x in g]
            g = [0.2 + sum(n * weights[t][k] * e[k] / sum(w * x for w, x in zip(weights[t], e))
                           for t, n in counts.items()) for k in range(2)]
        assert got[doc] == pytest.approx([x / sum(g) for x in g], abs=1e-6)
    likely = topics.term_likelihood(bag, "id", model, mixtures).first()
    assert likely["n_terms"] == 6
    want = sum(n * math.log(sum(w * s for w, s in zip(weights[t], got[d]))) for d, t, n in
               ((1, "a", 3), (1, "b", 1), (2, "c", 2))) / 6
    assert likely["log_likelihood"] == pytest.approx(want)


def test_fitted_topics_explain_held_out_terms(spark):
    """Two kinds of documents: a fitted model gives the terms of new ones a likelihood that no
    model without topics has, and puts each kind into a topic of its own."""
    rng = random.Random(8)
    kinds = [[f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)]]
    draw = lambda i: [rng.choice(kinds[i % 2]) for _ in range(20)]
    train = tokens(spark, *[draw(i) for i in range(60)])
    model, words = topics.fit_topics(train, "t", k=2, max_iter=30, min_df=1)
    matrix = topics.topic_matrix(model, words, spark)
    new = tokens(spark, *[draw(i) for i in range(20)])
    bag = topics.bag_of_words(new, "id", "t", topics.fit_vocabulary(train, "t", min_df=1))
    mixtures = topics.fold_in(bag, "id", matrix)
    best = {r["id"]: r["shares"].index(max(r["shares"])) for r in mixtures.collect()}
    assert len({best[i] for i in best if i % 2}) == 1 and len(set(best.values())) == 2
    flat = topics.term_likelihood(bag, "id", matrix, mixtures.withColumn(
        "shares", F.array(F.lit(0.5), F.lit(0.5)))).first()["log_likelihood"]
    assert topics.term_likelihood(bag, "id", matrix, mixtures).first()["log_likelihood"] > flat + 0.3


def test_rule_lemmas(spark):
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "term string")
    forms = words("cats", "boxes", "wolves", "women", "ponies", "glasses", "bus", "this", "s", "cats",
                  "geese", "churches", None)
    lexicon = words("cat", "box", "wolf", "woman", "pony", "glass", "bus", "church", "churche",
                    "glasses", None)
    irregular = spark.createDataFrame([("geese", "goose"), ("geese", "goose"), ("bus", "bus")],
                                      "form string, lemma string")
    want = {("cats", "cat"), ("boxes", "box"), ("wolves", "wolf"), ("women", "woman"),
            ("ponies", "pony"), ("glasses", "glass"), ("churches", "church")}
    got = vocabulary.rule_lemmas(forms, lexicon)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    got = vocabulary.rule_lemmas(forms, lexicon, irregular)
    assert sorted(map(tuple, got.collect())) == sorted(want | {("geese", "goose")})
    assert vocabulary.rule_lemmas(forms, words(None)).count() == 0


def test_lda_topics(spark):
    docs = tokens(spark, *([["cat", "dog", "cat"], ["sun", "moon"]] * 10))
    run = lambda: topics.lda_topics(docs, "t", k=2, max_iter=5, min_df=1, n_terms=2)
    rows = run().collect()
    assert sorted((r["topic"], r["rank"]) for r in rows) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert {r["term"] for r in rows} <= {"cat", "dog", "sun", "moon"}


def test_upsert_store(spark, tmp_path):
    schema = struct(id=S, v=I)
    store = latest.UpsertStore(spark, str(tmp_path / "store"), schema, ["id"], ["v"])
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    state = lambda: {tuple(r) for r in store.read().collect()}
    assert state() == set()
    store.write_batch(rows(("a", 1), ("a", 2), ("b", 1)), 0)
    store.write_batch(rows(("b", 5), ("c", 1)), 1)
    assert state() == {("a", 2), ("b", 5), ("c", 1)}
    store.write_batch(rows(("b", 5), ("c", 1)), 1)  # replay
    assert state() == {("a", 2), ("b", 5), ("c", 1)}
    store.compact()
    assert state() == {("a", 2), ("b", 5), ("c", 1)}
    store.write_batch(rows(("c", 7), ("a", 0)), 2)
    assert state() == {("a", 2), ("b", 5), ("c", 7)}
    store.compact()
    store.compact()
    assert state() == {("a", 2), ("b", 5), ("c", 7)}


def test_tables_and_files(spark, tmp_path):
    news = spark.createDataFrame([("a", None, "text", "2019-01-01T0", "src", "t", "u")], NEWS)
    path = str(tmp_path / "news")
    news.write.json(path)
    assert readers.scan_news(spark, path).collect() == news.collect()
    spark.sql("CREATE DATABASE IF NOT EXISTS newsdb")
    sinks.save_table(news.withColumn("day", F.lit("d1")), "newsdb.newsdata", "day")
    assert readers.scan_table(spark, "newsdb.newsdata").count() == 1
    described = {r["col_name"] for r in readers.describe_table(spark, "newsdb.newsdata").collect()}
    assert {"publishedAt", "day"} <= described
    assert "newsdb" in {r[0] for r in readers.list_databases(spark).collect()}
    counts = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "term string, n bigint")
    out = str(tmp_path / "counts")
    sinks.write_term_counts(counts, out, top=2)
    assert [tuple(r) for r in spark.read.schema("term string, n bigint").json(out).collect()] == [
        ("b", 3), ("c", 3)]
    sinks.write_term_counts(counts, out)
    assert spark.read.schema("term string, n bigint").json(out).count() == 3


def test_quarantine(spark, tmp_path):
    lines = ['{"title": "a", "url": "u"}', '{"title": "b"', "", "no json", '{"title": {"x": 1}}',
             "[]", '{"other": 1}', "   ", '{"title": null}']
    (tmp_path / "in.json").write_text("\n".join(lines))
    good, broken = readers.quarantine(spark, str(tmp_path / "in.json"), NEWS, str(tmp_path / "out"))
    assert good.columns == NEWS.names
    assert sorted(map(str, (r["title"] for r in good.collect()))) == [
        "None", "None", "a", '{"x":1}']
    assert sorted(r["_line"] for r in broken.collect()) == ["[]", "no json", '{"title": "b"']
    assert all(r["_file"].endswith("in.json") for r in broken.collect())
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_broken" in plan


def test_empty_windows_are_filled(spark):
    counts = spark.createDataFrame([(0, 2), (600, 1), (2400, 4)], "window_start bigint, n bigint")
    rows = metrics.fill_empty(counts, 600).orderBy("window_start").collect()
    assert [tuple(r) for r in rows] == [(0, 2), (600, 1), (1200, 0), (1800, 0), (2400, 4)]
    far = spark.createDataFrame([(0, 1), (600 * 25_000, 1)], "window_start bigint, n bigint")
    filled = metrics.fill_empty(far, 600)
    assert filled.count() == 25_001 and filled.agg(F.sum("n")).first()[0] == 2


def test_windows_are_pruned_exactly(spark):
    """With and without the bound, the same terms win, ties and sparse slides included."""
    rng = random.Random(3)
    rows = [("t", 60 * rng.randrange(30), f"w{int(rng.paretovariate(0.5)) % 90}", rng.randrange(1, 4),
             1, rng.random()) for _ in range(1500)] + [("u", 600, "only", 1, 1, 0.5)]
    stats = terms.merge_stats(spark.createDataFrame(
        rows, "topic string, slide bigint, term string, n bigint, df bigint, max_tf double"),
        "topic", "slide")
    laid = terms.in_chunks(stats, "topic", 300, 60)
    bounds = terms.window_bounds(laid, "topic", 300, 60, 5)
    kept = terms.within_reach(laid, bounds, "topic", 300, 60)
    assert kept.count() < laid.count()
    counts = stats.groupBy("topic", "slide").agg(F.lit(50).cast("bigint").alias("n_docs"))
    start = F.explode(terms.window_starts(F.col("slide"), 300, 60))
    merged = terms.merge_stats(stats.withColumn("window_start", start), "window_start", "topic")
    want = terms.with_window_bounds(terms.top_terms_by_group(
        merged, terms.window_docs(counts, "topic", 300, 60), ["window_start", "topic"], 5, 3), 300)
    got = terms.top_terms_of_slides(stats, counts, "topic", 300, 60, 5, 3)
    assert sorted(got.collect()) == sorted(want.collect())


def test_kafka_and_console_writers(spark):
    rows = spark.createDataFrame([("t", "k", "v")], "topic string, key string, value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.kafka_writer(rows, "broker:9092").save()  # the connector is not on the classpath
    query = sinks.console_writer(spark.readStream.format("rate").load(), "append").start()
    query.stop()
    assert query.exception() is None


@pytest.mark.parametrize("group", [None, ["g"]])
def test_numbers_are_gapless_and_repeatable(spark, group):
    rng = random.Random(6)
    rows = [(rng.randrange(40), rng.choice(["a", "b", None])) for _ in range(500)] + [(7, "a")] * 300
    df = spark.createDataFrame(rows, "v int, g string").repartition(6)
    got = numbered(df, [F.desc("v")], "n", group, start=0)
    assert got.columns == ["v", "g", "n"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert group or "Window" not in plan
    first, again = got.collect(), got.collect()
    assert sorted(first, key=str) == sorted(again, key=str)
    groups = {}
    for v, g, n in first:
        groups.setdefault(g if group else 0, []).append((n, -v))
    for members in groups.values():
        members.sort()
        assert [n for n, _ in members] == list(range(len(members)))
        assert [v for _, v in members] == sorted(v for _, v in members)
    assert numbered(df.limit(0), ["v"]).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark):
    tweets = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 50 != 1, F.concat(F.lit("u"), F.col("id") % 400)).alias("url"))
    news = spark.range(900).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 90 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 450)).alias("url"))
    joins.save_for_join({"b_tweets": tweets, "b_news": news}, "url", 8, rows=500)
    assert {r[0] for r in spark.table("b_tweets_hot").select("url").distinct().collect()} == {"hot"}
    assert spark.table("b_tweets").where("url = 'hot'").count() == 0
    got = joins.url_join_tables(spark, "b_tweets", "b_news")
    want = tweets.join(news, "url").select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    even = spark.table("b_tweets").join(spark.table("b_news").hint("merge"), "url")
    assert "Exchange" not in even._jdf.queryExecution().executedPlan().toString()


SUFFIXES = ["com", "uk", "co.uk", "*.ck", "!www.ck", "*.kobe.jp", "jp", "!city.kobe.jp", ""]


@pytest.mark.parametrize("host,domain", [
    ("www.example.com", "example.com"), ("example.com", "example.com"), ("com", "com"),
    ("a.b.co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("x.uk", "x.uk"), ("a.b.c.ck", "b.c.ck"),
    ("c.ck", "c.ck"), ("www.ck", "www.ck"), ("a.www.ck", "www.ck"), ("a.b.kobe.jp", "a.b.kobe.jp"),
    ("x.a.b.kobe.jp", "a.b.kobe.jp"), ("city.kobe.jp", "city.kobe.jp"),
    ("q.city.kobe.jp", "city.kobe.jp"), ("local.unknown", "local.unknown"),
    ("a.local.unknown", "local.unknown"), ("User@WWW.Example.COM:80", "example.com"),
    ("example.com.", "example.com"), ("", "")])
def test_registrable_domains(spark, host, domain):
    rules = spark.createDataFrame([(rule,) for rule in SUFFIXES], "rule string")
    rows = spark.createDataFrame([(1, host), (2, None), (3, host)], "id int, host string")
    got = domains.with_domain(rows, "host", rules, ["id"])
    assert sorted((r["id"], r["domain"]) for r in got.collect()) == [
        (1, domain), (2, None), (3, domain)]
