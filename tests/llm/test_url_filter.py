import re

import pytest
from pyspark.sql import functions as F

from trendloom.llm import url_filter as u

URLS = ["https://www.Example.com/en/1", "http://example.com/en/x?y#z", "http://a.b.example.com/en/",
        "http://notexample.com/en/", "https://x.net/es/1", "https://net/fr/", "http://example.com",
        "http://example.com?/en/", "example.com/en/", None, "", "://", "http://", "x://com//en",
        "http://example.com:80/en/", "http://u@example.com/en/", "http://EXAMPLE.COM/EN/",
        "a://b://example.com/en/", "http://www.example.com/en/", "http://ex.net/esx/",
        "http://bücher.com/ä", "http://x.org/a/login/", "http://x.org/cgi-bin/y", "http://h\n.com/"]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in rules:
        own, slash, prefix = rule.pattern.partition("/")
        at = own == "*" or host == own or host.endswith("." + own)
        form = ".*".join(re.escape(p) for p in (slash + prefix).split("*"))
        if at and re.match(form, path, re.S) and (slash or path[:1] in ("", "/")):
            fits.append(rule)
    best = min(fits, key=lambda r: (-len(r.pattern), r), default=None)
    return host, path, best


def check(spark, urls, rules, fallback=()):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns(
        {"host": F.lit(1), "_tokens": F.lit("t"), "rule": F.lit(None)})
    for r in u.judge(pages, rules, fallback).collect():
        host, path, best = plain(urls[r.page_id], rules)
        _, _, second = plain(urls[r.page_id], fallback)
        verdict = best.verdict if best else second.verdict if second else "allow"
        assert (r.host, r.path, r.rule, r.verdict) == (
            host, path, best and best.pattern, verdict), urls[r.page_id]


def test_given_rules(spark):
    check(spark, URLS + URLS[:3], u.RULES, u.FALLBACK)


@pytest.mark.parametrize("rules", [
    [], [u.Rule("*/", "block")], [u.Rule("example.com", "block"), u.Rule("com", "allow")],
    [u.Rule("*/*/x-y_z", "block"), u.Rule("com/en/1", "allow"), u.Rule("com/(en", "block")],
    [u.Rule("bücher.com/ä", "block"), u.Rule("com/e", "block"), u.Rule("com/e", "allow")]])
def test_other_rules(spark, rules):
    check(spark, URLS + ["http://a.com/q/x-y_z1", "http://a.com/(en", "http://com/e"], rules)


def test_only_candidates_run(spark):
    rules = [u.Rule(f"site{i}.com/", "block") for i in range(500)]
    pages = spark.createDataFrame([(1, "http://a.site7.com/x"), (2, "http://other.com/")],
                                  "page_id long, url string")
    got = {r.page_id: r for r in u.judge(pages, rules).collect()}
    assert (got[1].rule, got[1].candidates) == ("site7.com/", 1) and got[2].candidates == 0


def test_rules_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(u, "BLOCK_RULES", 2)
    check(spark, URLS, u.RULES)


def test_empty_table_and_plan(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    got = u.judge(pages)
    plan = got._jdf.queryExecution().toString()
    assert got.count() == 0
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
