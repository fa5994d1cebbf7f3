import math
import random

import pytest
from pyspark.sql import functions as F

from trendloom.llm import maxscore as ms

SCHEMA = "vec_id long, embedding array<double>"


def brute_force(rows, asked, k=5):
    def terms(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]
    fine = [(i, terms(v)) for i, v in rows if i is not None and terms(v) is not None]
    queries = {}
    for i, v in asked:
        if i is not None and terms(v) is not None:
            queries[i] = max(queries.get(i, []), terms(v))
    out = []
    for q, a in queries.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q)
        # A score that 64 bits cannot hold is NULL at its right rank.
        out += [(q, n + 1, i, -s if -1 << 63 <= -s < 1 << 63 else None)
                for n, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=lambda r: r[:3])


def check(spark, rows, asked, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"terms": F.lit(1), "shard": F.lit("s")})
    queries = spark.createDataFrame(asked, SCHEMA)
    got = ms.search(df, queries, **more)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"),
                          ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:3]) == brute_force(rows, asked, more.get("k", 5))


@pytest.mark.parametrize("shard_rows,block", [(16_384, 2_048), (300, 7)])
def test_brute_force(spark, shard_rows, block):
    rng = random.Random(shard_rows)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(1500)]
    rows += [(2000 + i, rows[3][1]) for i in range(400)]  # many ties
    check(spark, rows, rows[::50], shard_rows=shard_rows, block_queries=block)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, -2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 0.0]),
            (6, []), (7, [0.5]), (8, [1.0, -2.0, 3.0]), (9, [1e30, -1e30]), (None, [1.0, 1.0]),
            (10, [0.0, 0.0]), (7, [0.5]), (7, [0.25]), (11, [-0.001, 0.001])]
    check(spark, rows, rows)


def test_large_components(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-5000, 5000) for _ in range(40)]) for i in range(60)]
    check(spark, rows, rows[:9], k=3)


def test_few_rows_and_empty_tables(spark):
    check(spark, [(1, [1.0])], [(1, [1.0]), (2, [2.0])])
    check(spark, [], [(1, [1.0])])
    check(spark, [(1, [1.0])], [])
    check(spark, [], [])


def test_repeated_keys_in_a_long_table(spark):
    """The query's own rows, however many, take no places of others."""
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(40)]
    rows += [(20, [3 * x for x in rows[20][1]])] * 9 + [(10, rows[10][1])] * 3
    check(spark, rows, rows[10:21])


def plain(rows, asked, k):
    """Exact (query_id, rank, vec_id, score) over repeated-free finite rows; NULL past 64 bits."""
    terms = {i: [int(x) * 256 if abs(x) >= 2 ** 53 else math.floor(256 * x) for x in v]
             for i, v in rows}
    out = []
    for q, _ in asked:
        scored = sorted((-sum(x * y for x, y in zip(terms[q], b)), i)
                        for i, b in terms.items() if i != q)
        out += [(q, n + 1, i, -s if -2 ** 63 <= -s < 2 ** 63 else None)
                for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [16_384, 30])
def test_components_are_not_cut(spark, shard_rows):
    rng = random.Random(shard_rows)
    sizes = [0.2, 5e3, 1e6, 3e9, 1e17, 1e30, 1e300, 1.7e308]
    rows = [(i, [rng.uniform(-1, 1) * sizes[i % 23 % 8] for _ in range(12)]) for i in range(120)]
    asked = rows[:23]
    got = ms.search(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(asked, SCHEMA),
                    k=4, shard_rows=shard_rows)
    assert sorted(map(tuple, got.collect())) == plain(rows, asked, 4)


def test_scores_past_the_old_limit(spark):
    rows = [(1, [1.0, 0.0]), (2, [5000.0, 0.0]), (3, [6000.0, 0.0]), (4, [4096.0, 9e3])]
    got = ms.search(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows[:1], SCHEMA))
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [
        (3, 256 * 256 * 6000), (2, 256 * 256 * 5000), (4, 256 * 256 * 4096)]
