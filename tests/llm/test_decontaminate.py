import random

import pytest
from cases import documents, odd_documents, prose
from pyspark.sql import functions as F

from trendloom.llm import decontaminate as d

ITEM = ("Yesterday morning Tom bought 12 apples and Ann bought 30 pears at the old market. "
        "How many more pears than apples were bought if Tom ate 5 of his fruit?")


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, texts, items):
    docs = documents(spark, list(enumerate(texts)))
    return {(r.doc_id, r.item_id): r for r in d.contamination(
        docs, benchmark(spark, list(enumerate(items)))).collect()}


@pytest.mark.parametrize("text,want", [
    ("We met Bob, (Ann) and 5 kg of 1,000.", "we met \x02 \x02 and \x01 \x03 of \x01"),
    ("Stop. The end: It is -- Really so", "stop the end it is -- \x02 so"),
    ("", ""), (None, ""), ("don't  DON'T", "don't don't"), ("a \x01\x02 b", "a \x04\x04 b"),
    ("twelve eggs. Two kg", "\x01 eggs \x01 \x03"), ("it was Tom's idea", "it was \x02 idea")])
def test_template(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(d.template(
        d.lined_up(F.col("t"))).alias("t")).first()
    assert row.t.split() == want.split()


def test_copies_are_caught(spark):
    rng = random.Random(1)
    before, after = prose(rng, 50), prose(rng, 70)
    other = ITEM.replace("Tom", "Bill").replace("Ann", "Sue").replace("12", "7").replace("30", "41")
    mixed_up = ITEM.replace("Tom", "Bill", 1).replace("12", "7")
    edited = ITEM.replace("apples and", "red apples and").replace("were", "had been")
    part = " ".join(ITEM.split()[:10])
    got = found(spark, [f"{before}. {ITEM} {after}", f"{before}. {other.upper().lower()} {after}",
                        f"{before}. {other} {after}", f"{before}. {edited}", f"{before} {part}",
                        before, mixed_up], [ITEM, prose(rng, 30), "too short"])
    assert not got[0, 0].slots_changed and got[0, 0].covered_words == len(ITEM.split())
    assert got[2, 0].slots_changed and got[2, 0].covered_words == len(ITEM.split())
    assert (3, 0) in got and (4, 0) not in got and (5, 0) not in got
    # Tom stands for two names: the passage is not one re-parameterised question.
    assert (6, 0) not in got
    assert {item for _, item in got} == {0}


def test_blocks_of_windows(spark, monkeypatch):
    rng = random.Random(2)
    items = [prose(rng, 30) for _ in range(12)]
    texts = [f"{prose(rng, 20)} {item} {prose(rng, 20)}" for item in items]
    want = {(i, i) for i in range(12)}
    assert set(found(spark, texts, items)) == want
    monkeypatch.setattr(d, "BLOCK_WINDOWS", 50)
    assert set(found(spark, texts, items)) == want


def test_odd_rows(spark):
    rows = odd_documents()
    docs = documents(spark, rows).withColumns({"item_id": F.lit(1), "hash": F.lit("h"),
                                               "_words": F.lit(None)})
    items = benchmark(spark, [(None, rows[5][1][:300]), (2, None), (3, ""), (3, ""),
                              (4, rows[0][1]), (4, rows[0][1])]).withColumn("doc_id", F.lit(1))
    got = d.contamination(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(5, None), (6, None), (1, 4)}
    left = d.decontaminated(docs, got)
    assert left.columns == docs.columns and left.count() == len(rows) - 3


def test_empty_tables(spark):
    docs, items = documents(spark, []), benchmark(spark, [])
    assert d.contamination(docs, benchmark(spark, [(1, ITEM)])).count() == 0
    some = documents(spark, [(1, ITEM)])
    got = d.contamination(some, items)
    assert got.count() == 0 and d.decontaminated(some, got).count() == 1


def test_no_python(spark):
    plan = d.contamination(documents(spark, [(1, ITEM)]), benchmark(spark, [(1, ITEM)]))
    plan = plan._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
