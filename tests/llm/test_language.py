import numpy as np
from cases import documents, odd_documents
from pyspark.sql import functions as F

from trendloom.llm import language as lang

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lang.predict(docs, *lang.fit(docs))
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.93
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(0)
    inputs, units = rng.integers(0, 5, (6, 3)), 4
    table = rng.standard_normal((3 * units, 256)).astype(np.float32)
    inner = rng.standard_normal((3 * units, units)).astype(np.float32)
    target = rng.standard_normal((6, units, 3)).astype(np.float32)

    def loss(t, i):
        return float((lang._direction(inputs, t, i).astype(float) * target).sum())
    kept = []
    lang._direction(inputs, table, inner, kept)
    d_table, d_inner = lang._backward(target, inputs, inner, kept)
    for grads, weights, call in ((d_table, table, lambda w: loss(w, inner)),
                                 (d_inner, inner, lambda w: loss(table, w))):
        for at in [(r, c) for r in range(3 * units) for c in range(4)]:
            up, down = weights.copy(), weights.copy()
            up[at] += 1e-2
            down[at] -= 1e-2
            assert abs((call(up) - call(down)) / 2e-2 - grads[at]) < 2e-2 + 0.02 * abs(grads[at])


def test_segments_cover_whole_texts():
    data = np.frombuffer(bytes(range(1, 200)), np.uint8)
    segments, lengths, text = lang.segmented(data, np.array([0, 0, 64, 65, 199]), 64)
    assert lengths.tolist() == [64, 1, 64, 64, 6] and text.tolist() == [1, 2, 3, 3, 3]
    assert b"".join(s[:n].tobytes() for s, n in zip(segments, lengths)) == data.tobytes()


def test_odd_rows(spark):
    rows = odd_documents() + [(20, "12 34 !?", "en", "a"), (21, "x", None, None)]
    docs = documents(spark, rows).withColumns({"order": F.lit(1), "held_out": F.lit("x"),
                                               "lang_pred": F.lit(None), "piece": F.lit(2)})
    langs, weights = lang.fit(docs)
    assert set(langs) <= {"en", "de", "fr"}
    got = lang.predict(docs, langs, weights).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (2, 3, 4, 20) or (
            r.doc_id is None and r.score == 0)) and 0 <= r.score <= 1
    assert all(r.held_out is not None for r in got)


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert lang.predict(docs, *lang.fit(docs)).count() == 0
    some = documents(spark, [(1, "text without a language")])
    row = lang.predict(some, *lang.fit(some)).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
