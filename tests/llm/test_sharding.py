from collections import Counter
from zlib import crc32

from cases import documents, odd_documents
from pyspark.sql import functions as F

from trendloom.llm import sharding as s


def check(rows, got, shards):
    sizes = Counter(r.shard for r in got)
    full = [sizes[i] for i in range(shards)]
    assert len(got) == len(rows) and max(full) - min(full) <= 1
    for i in range(shards):
        assert sorted(r.slot for r in got if r.shard == i) == list(range(full[i]))
    want = Counter((r[0], len((r[1] or "").encode()) + 16,
                    None if r[1] is None else crc32(r[1].encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} <= {("rows", None)}


def test_shards_match_the_mixture(spark):
    rows = [(i, f"text {i}", "en", "hot" if i % 3 else f"s{i % 7}") for i in range(1500)]
    got = s.shard_documents(documents(spark, rows), 10).collect()
    check(rows, got, 10)
    share = Counter(r[3] for r in rows)
    for shard in range(10):
        own = Counter(r.source for r in got if r.shard == shard)
        for source, n in share.items():
            assert abs(own[source] - n / 10) <= 1.5, (shard, source)


def test_reruns_and_layout_agree(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}") for i in range(300)]
    docs = documents(spark, rows)
    one, two = ({r.doc_id: (r.shard, r.slot) for r in s.shard_documents(d, 7).collect()}
                for d in (docs, docs.repartition(9)))
    assert one == two


def test_odd_rows(spark):
    rows = odd_documents()
    docs = documents(spark, rows).withColumns({"shard": F.lit(9), "_bucket": F.lit("b"),
                                               "position": F.lit(None)})
    for shards in (1, 4, 40):
        check(rows, s.shard_documents(docs, shards).collect(), shards)


def test_empty_table(spark):
    assert s.shard_documents(documents(spark, []), 40).count() == 0


def test_no_python(spark):
    plan = s.shard_documents(documents(spark, odd_documents()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
