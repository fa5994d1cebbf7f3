"""Only n-grams that phrases are kept under become rows."""

from trendloom.operators import phrases


def test_known_grams_leave_the_text(spark, tmp_path):
    rows = [(1, "big data \U0001F600x"), (2, "bi"), (3, None), (4, ""), (5, "big big dat"), (5, "ai")]
    texts = spark.createDataFrame(rows, "id long, text string")
    wanted = spark.createDataFrame([("big ",), ("ai",), ("\U0001F600x",)], "gram string")
    got = phrases.known_grams(texts, "text", wanted, [2, 4], "id")
    assert sorted((r["id"], sorted(r["_grams"])) for r in got.collect()) == [
        (1, ["big ", "\U0001F600x"]), (2, []), (3, []), (4, []), (5, ["ai"]), (5, ["big "])]


def test_broken_texts_are_searched(spark):
    texts = spark.sql("SELECT 1L AS id, concat(cast(X'FF41' AS string), 'big data') AS text")
    table = spark.createDataFrame([("ig dat", 1), ("none", 2)], "phrase string, n int")
    found = phrases.phrase_matches(texts, "id", "text", table)
    assert [tuple(r) for r in found.select("id", "n").collect()] == [(1, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan
