from collections import Counter

import pytest
from cases import documents, odd_documents, shingles
from test_jaccard_join import brute_force
from test_mixing import targets

import corpus_pipeline as cp

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(cp.STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs.collect(), spark.read.parquet(path).collect()))
        docs = spark.read.parquet(path)
    return out


def test_classifier_keeps_clean_documents(spark, stages):
    before, after = stages[0]
    kept = {r.doc_id for r in after}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in good) >= 0.99 * len(good)
    assert sum(d not in kept for d in bad) >= 0.9 * len(bad)
    assert set(map(tuple, after)) <= set(map(tuple, before))


def test_one_of_each_class_stays(stages):
    before, after = stages[1]
    rows, classes = brute_force([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {r[2] for r in rows} and len(after) == classes
    assert set(map(tuple, after)) <= set(map(tuple, before))


def test_contaminated_documents_go(spark, stages):
    before, after = stages[2]
    kept = {r.doc_id for r in after}
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in before:
        own = shingles(r.text)
        share = max(len(own & item) / len(item) for item in items)
        assert share < 0.6 or r.doc_id not in kept
        assert share > 0.2 or r.doc_id in kept


def test_mixture(stages):
    before, after = stages[3]
    sizes, target = targets([(r.doc_id, r.text, r.lang, r.source) for r in before])
    times, rows = Counter(r.doc_id for r in after), {r.doc_id: r for r in before}
    assert max(times.values()) <= 2 and {tuple(r) for r in after} <= {tuple(r) for r in before}
    for source in sizes:
        taken = sum(len(rows[d].text.split()) * n for d, n in times.items()
                    if rows[d].source == source)
        assert abs(taken - target[source]) <= 0.1 * target[source] + 100


def test_shards(stages):
    before, after = stages[4]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    sizes = Counter(r.shard for r in after)
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 1


def test_run_gives_the_last_stage(spark, stages):
    assert Counter(map(tuple, cp.run(spark, SF).collect())) == Counter(map(tuple, stages[4][1]))


@pytest.mark.parametrize("rows", [odd_documents(), []])
def test_odd_and_empty_inputs(spark, rows):
    docs = documents(spark, rows)
    for i, (_, stage) in enumerate(cp.STAGES):
        docs = stage(spark, docs, SF)
        if i < len(cp.STAGES) - 1:
            assert docs.columns == cp.COLUMNS
    docs.count()
