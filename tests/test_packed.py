"""Term counts of documents in packed blocks, and windows made of them."""

import datetime
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trendloom.operators import packed, terms
from trendloom.streaming import jobs

START = datetime.datetime(1970, 1, 1, 0, 3)
SCHEMA = "topic string, ts timestamp, tokens array<string>, id string"


def some_docs(n=400):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        tokens = [f"w{int(rng.paretovariate(0.5)) % 60}é" for _ in range(rng.randrange(12))]
        tokens = rng.choice([tokens, tokens, tokens, [*tokens, "", None], [], None])
        at = None if i % 50 == 49 else START + datetime.timedelta(
            seconds=rng.choice([-1, 1]) * rng.randrange(9000) + 86_400 * rng.randrange(3))
        rows.append((rng.choice(["t", "u", None]), at, tokens, rng.choice([None, *map(str, range(40))])))
    return rows


def window_docs_of(rows, window, slide):
    """(topic, start) -> documents, by every slide's windows."""
    found = defaultdict(list)
    for topic, ts, tokens, doc_id in rows:
        if topic is not None and ts is not None:
            at = int((ts - datetime.datetime(1970, 1, 1)).total_seconds()) // slide * slide
            for start in range(at - window + slide, at + 1, slide):
                found[topic, start].append((tokens or [], doc_id))
    return found


def by_hand(rows, window, slide, pool, k):
    """Ranked terms and ranked pairs."""
    best, pairs = set(), []
    for (topic, start), docs in window_docs_of(rows, window, slide).items():
        n, df, tf, scored = Counter(), Counter(), Counter(), []
        counts = [Counter(t for t in tokens if t) for tokens, _ in docs]
        for (tokens, _), own in zip(docs, counts):
            for term, times in own.items():
                n[term] += times
                df[term] += 1
                tf[term] = max(tf[term], times / len(tokens))
        idf = {term: math.log10(len(docs) / df[term]) for term in df}
        held = sorted(n, key=lambda t: (-n[t], t))[:pool]
        ranked = sorted(held, key=lambda t: (-round(idf[t] * tf[t], 9), t))[:k]
        best |= {(topic, start, r, t, round(idf[t] * tf[t], 9)) for r, t in enumerate(ranked, 1)}
        for (tokens, doc_id), own in zip(docs, counts):
            scored += [(-round(idf[t] * x / len(tokens), 9), t, (doc_id is not None, doc_id or ""))
                       for t, x in own.items()]
        pairs += [(topic, start, r, t, d[1] if d[0] else None, -s)
                  for r, (s, t, d) in enumerate(sorted(scored)[:k], 1)]
    return best, pairs


def given(df):
    start = F.unix_seconds(F.col("window_start").cast("timestamp")).alias("start")
    return [tuple(r) for r in df.select("topic", start, "rank", *[
        c for c in ("term", "id", "score") if c in df.columns]).collect()]


@pytest.mark.parametrize("window,slide,parts,held", [
    (300, 60, 1, 1 << 22), (300, 60, 4, 50), (180, 180, 2, 1 << 22), (7200, 3600, 1, 300)])
def test_windows_of_blocks(spark, monkeypatch, window, slide, parts, held):
    """Terms dealt out or not, blocks of many or few documents, NULLs and times before 1970."""
    monkeypatch.setattr(packed, "HELD", held)
    monkeypatch.setattr(terms, "parts_of", lambda docs: parts)
    rows = some_docs()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    best, pairs = by_hand(rows, window, slide, 6, 3)
    got = given(terms.windowed_top_terms(docs, "topic", "ts", "tokens", window, slide, 6, 3))
    close = lambda found: sorted(
        ((*r[:-1], round(abs(r[-1]), 7)) for r in found), key=str)
    assert close(got) == close(best)
    got = given(terms.windowed_top_pairs(docs, "topic", "ts", "tokens", window, slide, 3))
    assert close(got) == close(pairs)


def test_blocks_keep_what_they_are_made_of():
    ids, words = pa.array(["a", None, "", "é"]), pa.array(["", "x", "ü" * 300])
    numbers = [np.array(v) for v in ([0, 1, 300, 2], [1, 70_000, 0, 5], [1, 2, 0], [3, 0, 2], [9, 1, 1])]
    slides, lengths, counts, docs, n = numbers
    for own in (ids, None):
        got = packed.opened(packed.block(slides, lengths, own, words, counts, docs, n))
        assert [x.tolist() for i, x in enumerate(got) if i not in (2, 3)] == [
            x.tolist() for x in numbers]
        assert got[3].to_pylist() == words.to_pylist()
        assert got[2] is None if own is None else got[2].to_pylist() == own.to_pylist()


def test_terms_of_documents_move_as_blocks(spark):
    """One small row per topic and stretch of time of a task, not one per document and term."""
    docs = spark.range(3000, numPartitions=2).select(
        F.lit("t").alias("topic"), F.timestamp_seconds(F.col("id") * 7).alias("ts"),
        F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(
            F.lit("word"), F.pmod(F.xxhash64("id", i), F.lit(900)))).alias("tokens"), "id")
    blocks = packed.packed(docs, "topic", terms.slide_start(F.col("ts"), 300), "tokens", 1500, 300)
    rows = blocks.select(F.length("block")).collect()
    assert len(rows) <= 8 and sum(r[0] for r in rows) < 3.5 * 3000 * 40


def test_a_trend_batch_is_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    rows = spark.createDataFrame(some_docs(60), SCHEMA)
    table = jobs.TrendTable(spark, str(tmp_path / "t"), 600, 300, every=1)
    for i in (0, 1):
        table.write_batch(rows.mapInArrow(counted, rows.schema), i)
    assert seen.value == 2 * 60
    assert {r[0] for r in table.reports().select("batch_id").distinct().collect()} == {0, 1}
