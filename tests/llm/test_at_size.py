"""Memory of the hashing helpers and jobs of what the driver reads."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from trendloom.llm import jaccard_join, quality, storage
from trendloom.llm.hashing import batch_shingles, shingle_hashes, word_hashes


@pytest.fixture
def no_iterator(spark, monkeypatch):
    """An iterator over a DataFrame starts one job for each partition."""
    def refused(self, *args, **kwargs):
        raise AssertionError("one job per partition")

    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", refused)


def test_bitmaps_take_one_job(spark, no_iterator):
    keys = spark.createDataFrame([(-5,), (0,), (7,), (None,), (1 << 40,)], "key long")
    bits = storage.key_bits(keys.where("key IS NOT NULL"), "key").value
    asked = np.array([-5, 0, 7, 1 << 40, 8, 1 << 20])
    assert storage.has_bits(bits, asked).tolist() == [True] * 4 + [False] * 2


def test_levels_take_one_job_and_any_form(spark, no_iterator, monkeypatch):
    texts = ["a b c d e f", "a b c d e g", "", None, "x y", " ".join(map(str, range(3000)))]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    sparse = jaccard_join._order(docs, 5)
    monkeypatch.setattr(jaccard_join, "SPARSE", 1 << 30)
    assert (sparse == jaccard_join._order(docs, 5)).all()
    want = np.zeros(1 << jaccard_join.ORDER_BITS, np.int64)
    for text in filter(None, texts):
        data = np.frombuffer(text.encode(), np.uint8)
        hashes, _ = shingle_hashes(*word_hashes(data, np.array([0, len(data)])), 5)
        np.add.at(want, (hashes >> np.uint64(64 - jaccard_join.ORDER_BITS)).astype(np.int64), 1)
    at = np.flatnonzero(want)
    assert (np.flatnonzero(sparse) == at).all()
    assert (sparse[at] == (jaccard_join.STEPS * np.log2(want[at] + 1.0)).astype(np.uint8)).all()


def test_hashing_is_bounded_in_memory():
    texts = pa.array(["some words of a text, 12 of them or a few more; " * 20] * 4000)
    tracemalloc.start()
    assert sum(len(tokens) for _, tokens in batch_shingles(texts, 5)) > 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20


def test_quality_bounds_its_batches(spark):
    before = spark.conf.get(storage.BATCH_CONF)
    spark.conf.unset(storage.BATCH_CONF)
    try:
        quality.score(spark.createDataFrame([(1, "a")], "doc_id long, text string"),
                      np.zeros((1 << 4) + 1))
        assert int(spark.conf.get(storage.BATCH_CONF).rstrip("b")) <= storage.BATCH_BYTES
    finally:
        spark.conf.set(storage.BATCH_CONF, before)
