import random

import numpy as np
import pytest
from cases import documents, odd_documents, prose, shingles
from pyspark.sql import functions as F

from trendloom.llm import jaccard_join as jj
from trendloom.llm.components import components
from trendloom.llm.hashing import U, mix


def brute_force(rows):
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= 80 * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), 1 << 62), r[0])
    return sorted([(r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0])
                   for i, r in enumerate(rows)], key=repr), len(
        {root(i) for i in range(len(rows)) if sets[i]}) + sum(not s for s in sets)


def found(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=repr)


def test_brute_force(spark):
    rng = random.Random(3)
    bases = [prose(rng, rng.choice([3, 6, 30, 80, 200]), 300).split() for _ in range(30)]
    passage = prose(rng, 60, 300).split()
    rows = []
    for i in range(250):
        own = list(rng.choice(bases)) + passage * (i % 7 == 0)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            own[rng.randrange(len(own))] = f"w{rng.randrange(300)}"
        rows.append((i * 3 + 1, " ".join(own).title() if i % 5 == 0 else "  ".join(own)))
    rows += [(5000, None), (5001, ""), (5001, ""), (None, "a b c"), (None, "a b c"),
             (7, rows[0][1]), (7, rows[0][1]), (8, "A b C")]
    want, classes = brute_force(rows)
    docs = documents(spark, rows).withColumns({"token": F.lit(1), "gid": F.lit("x"),
                                               "node": F.lit(None), "_row_key": F.lit(2)})
    got = jj.jaccard_classes(docs)
    assert found(got) == want
    kept = jj.keep_one(docs, got)
    assert kept.columns == docs.columns and kept.count() == classes


def test_dense_and_sparse_chains(spark):
    """Each text is near the next one only: links that no star shows."""
    rng = random.Random(4)
    own, rows = prose(rng, 100, 10**6).split(), []
    for i in range(40):
        rows.append((100 - i, " ".join(own)))
        own[(i * 37) % 100] = f"new{i}"
    want, _ = brute_force(rows)
    assert found(jj.jaccard_classes(documents(spark, rows))) == want


def test_odd_rows(spark):
    rows = odd_documents()
    want, classes = brute_force(rows)
    docs = documents(spark, rows)
    got = jj.jaccard_classes(docs)
    assert found(got) == want and jj.keep_one(docs, got).count() == classes


def test_clashing_columns(spark):
    names = ("node", "gid", "n", "component", "row_key", "_row", "_row_key", "token", "prefix")
    docs = documents(spark, odd_documents()).withColumns({c: F.lit("x") for c in names})
    want, classes = brute_force(odd_documents())
    got = jj.jaccard_classes(docs)
    assert found(got) == want
    one = jj.keep_one(docs, got)
    assert one.columns == docs.columns and one.count() == classes


def test_empty_table(spark):
    docs = documents(spark, [])
    got = jj.jaccard_classes(docs)
    assert got.count() == 0 and jj.keep_one(docs, got).count() == 0


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(1, 2), (2, 1), (1, 2), (None, 3)], [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(50)] + [(60 + i, 61 + i) for i in range(0, 20, 2)]])
def test_components(spark, links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {x: root(x) for x in parent}
    assert got.count() == len(parent)


def test_two_members_are_settled_and_large_groups_are_not(spark):
    """Shingles of two groups of one member each do not go into the later rounds."""
    index = spark.createDataFrame(
        [(1, 10, 0, False), (1, 11, 0, False), (2, 10, 1, False), (2, 12, 1, False),
         (3, 10, 2, True), (3, 11, 2, True), (3, 13, 2, True)],
        "token long, gid long, pos int, more boolean")
    large = spark.createDataFrame([(12,), (99,)], "gid long")
    got = jj._unsettled(index, large)
    assert sorted((r.token, r.gid) for r in got.collect()) == [
        (2, 10), (2, 12), (3, 10), (3, 11), (3, 13)]


def test_signatures_of_long_sets_tell(spark):
    """Long sets that share a half are told apart, similar ones of other lengths are not."""
    rng = np.random.default_rng(5)

    def row(tokens):
        fine = jj._signature(tokens, jj._fine_bits(len(tokens)))
        return len(tokens), (jj._signature(tokens).tolist(), fine.tolist())
    tokens = np.unique(mix(rng.integers(0, 1 << 60, 4200).astype(U)))
    rows = []
    for other in (np.append(tokens[:2100], tokens[2100:] + U(1)), tokens[:3700], tokens[:4090]):
        rows.append((*row(tokens), *row(np.unique(other))))
    kind = "struct<words: array<long>, fine: array<long>>"
    pairs = spark.createDataFrame(rows, f"n long, s {kind}, m long, t {kind}")
    got = pairs.select(jj._alike("n", "s", "m", "t", 80).alias("may")).collect()
    assert [r.may for r in got] == [False, True, True]


def test_classes_are_bridged_by_few_pairs(spark, monkeypatch):
    """Two large classes under common shingles cost one pair more, not one for each member."""
    rng, verified, verify = random.Random(6), [], jj._verified
    base, rows = prose(rng, 200, 10**6).split(), []
    for i in range(2):
        for j in range(30):
            own = list(base)
            own[5 + i * 60:13 + i * 60] = [f"class{i}w{k}" for k in range(8)]
            own[150 + j % 30] = f"member{i}x{j}"
            rows.append((100 * i + j, " ".join(own)))

    def counted(pairs, *more):
        verified.append(pairs.count())
        return verify(pairs, *more)
    monkeypatch.setattr(jj, "_verified", counted)
    want, _ = brute_force(rows)
    assert found(jj.jaccard_classes(documents(spark, rows))) == want
    assert sum(verified[1:]) <= 30, verified


def test_further_links_join_classes(spark):
    classes = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)],
                                    "node long, component long")
    links = spark.createDataFrame([(2, 6), (6, 7), (0, 9), (20, 21)], "a long, b long")
    got = {r.node: r.component for r in jj._joined(classes, links).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 7: 1, 8: 0, 9: 0, 0: 0, 20: 20, 21: 20}


def test_only_rows_that_may_go_are_moved(spark):
    """Texts of rows that stay alone in their class are not shuffled, however many there are."""
    rng = random.Random(7)
    rows = [(i, prose(rng, 40, 10**6)) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(5)] + [(7, rows[7][1])]
    docs = documents(spark, rows)
    classes = jj.jaccard_classes(docs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        kept = jj.keep_one(docs, classes)
        assert sorted(r.doc_id for r in kept.collect()) == list(range(300))
        moved = {}
        real = jj.rows_by_bits
        try:
            jj.rows_by_bits = lambda df, bits, inside: moved.setdefault(
                inside, real(df, bits, inside))
            jj.keep_one(docs, classes)
        finally:
            jj.rows_by_bits = real
        assert moved[True].count() <= 20 and moved[False].count() >= 290
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
