"""Sliding windows by dyadic nodes, and windows that close."""

import random

import pytest
from pyspark.sql import functions as F

from trendloom.operators import terms
from trendloom.streaming import jobs
from trendloom.streaming.watermark import ClosedWindows

SCHEMA = "topic string, slide bigint, term string, n bigint, df bigint, max_tf double"
PAIRS = "topic string, slide bigint, term string, df bigint, best array<struct<less_tf:double,id:string>>"


def stats_of(spark, spans, slide=60, n=800):
    rng = random.Random(spans)
    rows = {(rng.choice("tu"), slide * rng.randrange(-200, 400), f"w{int(rng.paretovariate(0.6)) % 30}")
            for _ in range(n)}
    return spark.createDataFrame([(*r, rng.randrange(1, 9), rng.randrange(1, 4), rng.random())
                                  for r in sorted(rows)], SCHEMA)


def fanned_out(stats, window, slide):
    start = F.explode(terms.window_starts(F.col("slide"), window, slide))
    return terms.merge_stats(stats.withColumn("window_start", start), "topic", "window_start")


@pytest.mark.parametrize("spans", [1, 2, 3, 5, 8, 10, 13])
@pytest.mark.parametrize("rows", [1_000_000, 20])
def test_windows_of_nodes_equal_the_fan_out(spark, spans, rows):
    """Whole topics and chunks in one place, or dealt out by term."""
    stats = stats_of(spark, spans)
    laid = terms.in_chunks(stats, "topic", 60 * spans, 60, rows)
    assert (laid.agg(F.max("_part")).first()[0] > 0) == (rows == 20)
    got = terms.by_windows(laid, "topic", 60 * spans, 60, terms.merge_stats)
    want = fanned_out(stats, 60 * spans, 60)
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


@pytest.mark.parametrize("spans", [1, 4, 5, 10, 30])
def test_a_window_reads_each_slide_once_and_few_nodes(spark, spans):
    window, slide = 60 * spans, 60
    slides = spark.range(0, 64).select((F.col("id") * slide).alias("slide"))
    nodes = slides.select("slide", F.inline(terms._nodes(window, slide)))
    levels = nodes.agg(F.countDistinct("level")).first()[0]
    assert levels == spans.bit_length()
    read = nodes.select("*", F.explode(terms._readers(window, slide)).alias("start")).where(
        f"start BETWEEN 0 AND {(64 - spans) * slide}")
    per_slide = read.groupBy("start").agg(F.count("*").alias("n"), F.countDistinct("slide").alias("d"),
                                          F.countDistinct("level", "node").alias("nodes"))
    for row in per_slide.collect():
        assert row["n"] == row["d"] == spans and row["nodes"] <= 2 * levels


def test_only_two_shuffles_move_statistics(spark):
    """Per-slide rows move to their chunk; windows are made there."""
    stats = stats_of(spark, 5)
    merged = terms.by_windows(terms.in_chunks(stats, "topic", 300, 60), "topic", 300, 60,
                              terms.merge_stats)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(topic") <= 2 and "_key" in plan


def test_pairs_equal_the_fan_out(spark):
    rng = random.Random(2)
    rows = []
    for slide in range(0, 60 * 90, 60):
        for term in rng.sample("abcdef", 3):
            best = sorted((-rng.randrange(1, 9) / 10, str(rng.randrange(99))) for _ in range(3))
            rows.append(("t", slide, term, 3, best))
    stats = spark.createDataFrame(rows, PAIRS)
    start = F.explode(terms.window_starts(F.col("slide"), 300, 60))
    want = terms.merge_pairs(stats.withColumn("window_start", start), "topic", "window_start")
    got = terms.by_windows(terms.in_chunks(stats, "topic", 300, 60), "topic", 300, 60,
                           terms.merge_pairs)
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


ROWS = "k string, ts timestamp"


def closed(spark, tmp_path):
    return ClosedWindows(spark, str(tmp_path / "t"), spark.createDataFrame([], ROWS).schema, "ts",
                         300, 100, 200, ["k"])


def deliver(spark, tmp_path, table, seconds):
    rows = spark.createDataFrame([("a", s) for s in seconds], "k string, s long").select(
        "k", F.timestamp_seconds("s").alias("ts"))
    rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    jobs.run(table.start(stream, str(tmp_path / "c")))


def starts(table):
    seconds = F.unix_seconds(F.col("window_start").cast("timestamp"))
    return sorted(tuple(r) for r in table.windows().select(seconds, "n").collect())


def test_windows_close_once_and_late_rows_are_kept(spark, tmp_path):
    table = closed(spark, tmp_path)
    deliver(spark, tmp_path, table, [1000, 1010, 1500, None])
    # The latest time is 1500: windows that end by 1300 are closed.
    assert starts(table) == [(800, 2), (900, 2), (1000, 2)]
    # A new table object and query, as after a restart. 1090 is late; so is no row of 1190,
    # whose last window ends at 1400.
    table = closed(spark, tmp_path)
    deliver(spark, tmp_path, table, [1090, 1190, 2000])
    assert starts(table) == [(800, 2), (900, 2), (1000, 2), (1100, 1), (1300, 1), (1400, 1), (1500, 1)]
    late = table.late()
    assert sorted(str(r[0]) for r in late.select(F.unix_seconds("ts")).collect()) == ["1090", "None"]
    assert sorted(map(str, late.groupBy("k").count().collect())) == ["Row(k='a', count=2)"]
    counts = table.late_counts()
    assert {(r["slide"], r["k"], r["n"]) for r in counts.collect()} == {(None, "a", 1), (1000, "a", 1)}


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    table = closed(spark, tmp_path)
    rows = spark.createDataFrame([("a", 1000), ("a", 1500)], "k string, s long").select(
        F.lit(None).cast(table.window_schema).alias("closed"),
        F.struct("k", F.timestamp_seconds("s").alias("ts")).alias("row"))
    for batch_id in (0, 1, 2, 2, 2):
        table.write_batch(rows, batch_id)
    # Batch 1 works under what batch 0 saw, batch 2 drops what had closed before batch 1 ended.
    assert table._mark(2) == (1300, 1500)
    assert {(r["batch_id"], r["ts"].timestamp() - 0) for r in table.late().where(
        "ts IS NOT NULL").collect()} == {(2, rows.select(F.col("row.ts")).first()[0].timestamp())}
