import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from trendloom.llm import warc as w
from trendloom.session import work_dir

FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 666\r\nContent-Length: 4\r\n\r\nfake"
        "\r\n\r\n")


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def brute_force(rows, least=0):
    bodies = [(page, html or "") for page, _, html in rows]
    out = []
    for page, body in bodies:
        same = [p for p, b in bodies if b == body and p is not None]
        first = max(same, default=None)
        several = sum(b == body for _, b in bodies) > 1
        again = (several and len(body.encode()) >= least and first is not None and page != first)
        out.append((page, len(body.encode()), digest(body), "revisit" if again else "response",
                    first if again else None))
    return sorted(out, key=repr)


def check(spark, rows, least=0):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {"digest": F.lit("clash"), "value": F.lit(1), "first": F.lit(None)})
    path = work_dir(spark, "test-warc")
    w.write_archives(w.records(pages.repartition(2), revisit_least=least), path)
    got = w.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(rows, least)


ROWS = [
    (1, "http://a", "<html>one</html>"), (2, "http://b", None), (3, None, ""), (4, "x\r\ny", "é漢🎉"),
    (5, "u", "<html>one</html>"), (6, "u", "one\r\n\r\ntwo\r\n\r\n"), (None, "u", "keyless"),
    (None, "u", "é漢🎉"), (7, "u", w.MAGIC), (8, "u", f"a{FAKE}b{FAKE}"), (9, "u", FAKE * 3),
    (10, "u", f"x{w.MAGIC}Content-Length: 999999\r\n\r\n"), (11, "u", "tail" + w.MAGIC[:5]),
    (12, "u", w.MAGIC + w.MAGIC), (13, "u", "y" * 100_000), (5, "u", "<html>one</html>"),
    (14, "u", f"{w.MAGIC}Content-Length: x\r\n\r\n\r\n\r\n"), (15, "u", FAKE[:-4]),
    (16, "WARC/1.1\r\nContent-Length: 1\r\n\r\n", "url with magic")]


@pytest.mark.parametrize("split", ["128m", "1000", "77"])
def test_round_trip_with_magic_in_payloads(spark, split):
    """Files cut anywhere, also inside a magic."""
    conf = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    rows = [r for r in ROWS if split != "77" or len(r[2] or "") < 1000]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        check(spark, rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_small_payloads_are_not_revisited(spark):
    check(spark, ROWS, least=10)


def test_long_chain(spark):
    rows = [(i, "u", f"page {i}" + FAKE * (i % 3 == 0)) for i in range(400)]
    check(spark, rows)


def test_empty_table(spark):
    check(spark, [])


def test_broken_tail_is_left_out(spark):
    path = work_dir(spark, "test-warc")
    good = "WARC/1.1\r\nX-Page-Id: 1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab"
    broken = "WARC/1.1\r\nX-Page-Id: 2\r\nContent-Length: many\r\n\r\nab"
    spark.createDataFrame([(good,), (broken,), (good,)], "value string").coalesce(1).write.option(
        "lineSep", w.END).text(path)
    assert [r.page_id for r in w.read_archives(spark, path).collect()] == [1]
