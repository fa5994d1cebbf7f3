import random

import numpy as np
import pytest
from cases import documents, odd_documents, prose, words
from pyspark.sql import functions as F

from trendloom.llm import mixing as m


def targets(rows, weights=m.WEIGHTS, share=1.5, most=2.0):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, free = share * sum(sizes.values()), {}, list(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * level >= most * sizes[s]]
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
            free.remove(s)
    return sizes, target


def check(rows, got, slack):
    sizes, target = targets(rows)
    assert len(got) == len(rows)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert all(r.target == pytest.approx(target[s]) for r in own)
        assert abs(sum(r.size * r.times for r in own) - target[s]) <= slack
    assert all(0 <= r.times <= 2 for r in got)


def corpus(n=3000):
    rng = random.Random(2)
    sources = ["z", "b", "é", None, "a", "B"]
    return [(i, prose(rng, rng.choice([1, 20, 60, 300])), "en",
             sources[0] if rng.random() < 0.4 else rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("block", [4096, 64])
def test_words_come_near_the_targets(spark, block):
    rows = corpus()
    got = m.mix(documents(spark, rows), block=block).collect()
    check(rows, got, 300)
    sizes, target = targets(rows)
    for s in sizes:  # texts are balanced as well as words
        own = [r for r in got if r.source == s]
        assert abs(sum(r.times for r in own) - len(own) * target[s] / sizes[s]) <= 3


def test_reruns_agree(spark):
    docs = documents(spark, corpus(500))
    one, two = ({r.doc_id: r.times for r in m.mix(d, block=64).collect()}
                for d in (docs, docs.repartition(7)))
    assert one == two


def test_odd_rows(spark):
    rows = odd_documents()
    docs = documents(spark, rows).withColumns({"chance": F.lit(1), "unit": F.lit("u"),
                                               "_source": F.lit(None), "_row": F.lit(0)})
    mixed = m.mix(docs)
    check(rows, mixed.collect(), 30_000)
    out = m.repeated(docs, mixed)
    assert out.columns == docs.columns
    assert out.count() == sum(r.times for r in mixed.collect())


def test_empty_table(spark):
    docs = documents(spark, [])
    assert m.mix(docs).count() == 0 and m.repeated(docs, m.mix(docs)).count() == 0


def test_only_empty_texts(spark):
    assert {r.times for r in m.mix(documents(spark, [(1, ""), (2, None)])).collect()} == {0}


def test_flight_keeps_words_and_texts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 50, 700):
        sizes, chances = rng.integers(0, 500, n), rng.random(n)
        out = m.fly(sizes, chances, np.random.default_rng(n), False)
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(chances.sum(), abs=1e-6)
        assert out @ sizes == pytest.approx(chances @ sizes, abs=1e-3)
        landed = m.fly(sizes, chances, np.random.default_rng(n), True)
        assert set(landed) <= {0.0, 1.0}


def test_chances_are_kept_on_average():
    chances, sizes = np.array([0.2, 0.5, 0.7, 0.9, 0.3]), np.array([3, 1, 4, 1, 5])
    draws = [m.fly(sizes, chances, np.random.default_rng(i), False) for i in range(3000)]
    assert np.abs(np.mean(draws, axis=0) - chances).max() < 0.04
