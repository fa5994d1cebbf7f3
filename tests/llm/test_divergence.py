import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import LOWER, documents, odd_documents, prose
from pyspark.sql import functions as F

from trendloom.llm import divergence as dv


def brute_force(rows, least=30, best=50):
    counts, docs, lang_counts = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in (tuple(r) + (None,) * 4 for r in rows):
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        lang_counts[lang].update(terms)
    kept = {lang: sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
            for lang in docs}

    def shares(own, lang):
        total = sum(own[t] for t in kept[lang]) + 5 * len(kept[lang])
        return {t: 1 + 10 ** 9 * (own[t] + 5) // total for t in kept[lang]}

    out = []
    for lang, source in counts:
        p = shares(counts[lang, source], lang)
        pairs = [(-sum(abs(p[t] - q[t]) for t in p), other.encode(), other)
                 for l, other in counts if l == lang and other != source
                 for q in [shares(counts[l, other], l)]]
        q = shares(lang_counts[lang], lang)
        terms = [(q[t] - p[t], t.encode(), t) for t in p
                 if counts[lang, source][t] > 0 and p[t] > q[t]]
        out += [(lang, source, "pair", item, -v, i) for i, (v, _, item) in
                enumerate(sorted(pairs), 1)]
        out += [(lang, source, "term", item, -v, i) for i, (v, _, item) in
                enumerate(sorted(terms)[:best], 1)]
    return sorted(out)


def result(df):
    assert df.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"),
                         ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(map(tuple, df.collect()))


def corpus(n, sources, rng, vocabulary=120):
    terms = ["".join(rng.choice("abcdéßz漢") for _ in range(rng.randrange(1, 6)))
             for _ in range(vocabulary)]
    rows = []
    for i in range(n):
        source = rng.randrange(sources)
        own = terms[source % 7 * 5:]
        rows.append((i, " ".join(rng.choice(own) for _ in range(rng.randrange(30))) + " X-1y",
                     rng.choice(["en", "de", None]), f"s{source}"))
    return rows


def test_brute_force(spark):
    rows = corpus(400, 6, random.Random(1))
    assert result(dv.audit(documents(spark, rows))) == brute_force(rows)


@pytest.mark.parametrize("width,chunk", [(2, 1), (3, 2), (5, 64)])
def test_many_blocks_and_chunks(spark, monkeypatch, width, chunk):
    monkeypatch.setattr(dv, "PENDING", 50)
    rows = corpus(300, 9, random.Random(width), 60)
    got = dv.audit(documents(spark, rows), least_docs=8, bits=width, chunk=chunk)
    assert result(got) == brute_force(rows, 8)


def test_odd_rows(spark):
    rows = odd_documents() + [(20, "b", None, ""), (21, "c", "", None)]
    extra = documents(spark, rows).withColumns({c: F.lit("x") for c in (
        "term", "n", "id", "v", "_source", "block", "whole", "places")})
    for least in (1, 30):
        assert result(dv.audit(extra, least_docs=least)) == brute_force(rows, least)


def test_language_without_kept_terms(spark):
    rows = [(1, "a b", "en", "x"), (2, None, "en", "y"), (3, "c", "de", "x")]
    assert result(dv.audit(documents(spark, rows))) == [
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_empty(spark):
    assert dv.audit(documents(spark, [(1, "a")]).where("false")).count() == 0


def test_equal_subtrees_are_one_node():
    counts = np.array([[1, 2, 1, 2, 0, 0, 0, 0], [1, 2, 1, 2, 0, 0, 0, 0], [0] * 8])
    values, levels, roots, leaves = dv.hash_consed(counts)
    assert values.tolist() == [0, 1, 2] and roots[0] == roots[1] != roots[2]
    assert [len(left) for left, _ in levels] == [2, 2, 2]
    walk, a, b, times = dv.leaf_pairs(levels, len(values), roots[[0]], roots[[2]])
    assert sorted(zip(values[a], values[b], times)) == [(0, 0, 4), (1, 0, 2), (2, 0, 2)]


def test_walks_equal_position_by_position():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3, (6, 64)) * (rng.random((6, 64)) < 0.3)
    values, levels, roots, _ = dv.hash_consed(counts)
    x, y = np.triu_indices(6, 1)
    walk, a, b, times = dv.leaf_pairs(levels, len(values), roots[x], roots[y])
    got = Counter()
    for w, i, j, n in zip(walk, values[a], values[b], times):
        got[w, i, j] += n
    assert got == Counter((w, i, j) for w, (p, q) in enumerate(zip(x, y))
                          for i, j in zip(counts[p], counts[q]))


def test_shares_are_exact():
    rng = random.Random(5)
    for _ in range(300):
        total = rng.randrange(5, 9 * 10 ** 15)
        count = rng.randrange(total - 4)
        assert dv.shares(np.array([count]), np.array([total]))[0] == 1 + 10 ** 9 * (count + 5) // total


def test_long_text(spark):
    rows = [(i, prose(random.Random(i), 20_000, 50), "en", f"s{i % 2}") for i in range(4)]
    rows = [(i, re.sub(r"\d", lambda m: chr(97 + int(m[0])), t), *r) for i, t, *r in rows]
    assert result(dv.audit(documents(spark, rows), least_docs=2)) == brute_force(rows, 2)
