import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import LOWER, documents, odd_documents, prose
from pyspark.sql import functions as F

from trendloom.llm import resampling as rs

TARGET = "id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets(text, run=2):
    own = words(text)
    return [zlib.crc32(" ".join(own[i:i + k]).encode()) % 10_000
            for k in range(1, run + 1) for i in range(len(own) - k + 1)]


def counts(texts, run=2):
    return Counter(b for text in texts for b in buckets(text, run))


def brute_force(rows, target, percent=25, least=20):
    s, t = counts(r[1] for r in rows), counts(target)
    total, wanted = sum(s.values()), sum(t.values())
    out = []
    for key, text, *_ in rows:
        own = buckets(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (total + 10_000)
                                           / ((s[b] + 1) * (wanted + 10_000)))) for b in own]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        out.append([key, len(own), weight, score, len(words(text)) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (
        -r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = percent * len(able) // 100
    ranks = {}
    for i, r in enumerate(able[:drawn], 1):
        ranks.setdefault(id(r), i)
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()),
                  key=repr)


@pytest.mark.parametrize("run", [1, 2, 4])
def test_counts_by_lines(spark, run):
    rng = random.Random(run)
    texts = ["".join(rng.choice("abZ09 \n\n-é漢.") for _ in range(rng.choice([0, 3, 40, 400])))
             for _ in range(60)] + ["one\ntwo\n\n three", "one\ntwo\n\n three", "\n", "word", None]
    got = rs.feature_counts(documents(spark, enumerate(texts)), run=run).collect()
    assert {r["bucket"]: r["n"] for r in got} == dict(counts(texts, run))


def test_checksums_of_long_words():
    text = "x" * 64 + " " + "y" * 65 + " z " + "é" * 300
    for data, starts, lengths, owner, _, _ in rs._texts(pa.array([text])):
        got = [b for _, _, bs in rs.runs_of(data, starts, lengths, owner, 3, 10_000) for b in bs]
        assert sorted(got) == sorted(buckets(text, 3))


def test_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(prose(rng, rng.randrange(14), 60) for _ in range(4))) for i in range(300)]
    target = [prose(rng, 50, 20) for _ in range(5)]
    got = rs.resample(documents(spark, rows), spark.createDataFrame(enumerate(target), TARGET))
    assert result(got) == brute_force(rows, target)
    assert got.where("rank IS NOT NULL").count() > 40


def test_odd_rows(spark):
    rows = odd_documents()
    extra = documents(spark, rows).withColumns({
        c: F.lit("x") for c in ("row_key", "n", "rank", "bucket", "weight", "_row", "line")})
    target = spark.createDataFrame([(1, None), (2, ""), (3, "some plain text")], TARGET)
    ranks = rs.resample(extra, target, percent=50)
    assert result(ranks) == brute_force(rows, [None, "", "some plain text"], percent=50)
    drawn = rs.drawn_documents(extra, ranks)
    assert drawn.columns == extra.columns
    assert drawn.count() == ranks.where("rank IS NOT NULL").count() == 1


def test_repeated_rows_are_drawn_as_often_as_ranked(spark):
    rng = random.Random(4)
    text = prose(rng, 30)
    rows = [(1, text)] * 9 + [(i, prose(rng, 30)) for i in range(2, 5)]
    ranks = rs.resample(documents(spark, rows), spark.createDataFrame([(1, text)], TARGET))
    assert result(ranks) == brute_force(rows, [text])
    assert rs.drawn_documents(documents(spark, rows), ranks).count() == 3


def test_empty_tables(spark):
    empty = documents(spark, [(1, "a")]).where("false")
    target = spark.createDataFrame([], TARGET)
    assert rs.resample(empty, target).count() == 0
    rows = [(1, "a b"), (2, None)]
    assert result(rs.resample(documents(spark, rows), target)) == brute_force(rows, [])
    assert rs.gains(rs.feature_counts(empty), rs.feature_counts(target, "text")).tolist() \
        == np.zeros(10_000).tolist()
