"""URL filters by pattern rules, in DataFrame functions only.

Every rule is indexed under one literal token of its pattern, the one that the fewest other
rules share. The tokens of a URL fetch the rules indexed under them, and only these candidates
run their regular expressions. A URL is judged inside its own row: no join and no shuffle, so
neither a common host nor a common token gathers rows.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from collections import Counter
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
BLOCK_RULES = 10_000  # rules that a task holds at once; more rules take further looks
INDEX_TYPE = ("array<array<struct<token: string, rules: array<struct<rank: int, rule: string, "
              "verdict: string, regex: string>>>>>")


class Rule(NamedTuple):
    """``pattern`` is a host, then a path prefix: ``example.com/en/``. It fits the host and its
    subdomains where the path starts with the prefix. The host ``*`` is any host, and ``*`` in
    the path any run of characters."""

    pattern: str
    verdict: str  # allow or block


RULES = (
    Rule("com/", "allow"), Rule("example.com/en/", "block"), Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"), Rule("net/fr/", "block"),
)
# For URLs that no rule above fits: paths that rarely hold prose.
FALLBACK = (
    Rule("*/cgi-bin/", "block"), Rule("*/wp-login.", "block"), Rule("*/*/login/", "block"),
    Rule("*/*/cart/", "block"), Rule("*/*/checkout/", "block"), Rule("*/tag/", "block"),
)
DEFAULT = "allow"


def _lower(text: str) -> str:
    return text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def _regex(rule: Rule) -> str:
    """The pattern on host and path written together; a host has no slash."""
    host, slash, path = rule.pattern.partition("/")

    def literal(text: str) -> str:
        return re.sub("([!-/:-@\\[-`{-~])", r"\\\1", text)

    parts = ".*".join(literal(part) for part in (slash + path).split("*"))
    begin = "[^/]*" if host == "*" else rf"(?:[^/]*\.)?{literal(_lower(host))}"
    return rf"(?s)^{begin}{parts}" if slash else rf"(?s)^{begin}(?:/|\z)"


def _tokens(rule: Rule) -> list[str]:
    """The pattern's literal tokens that must be whole tokens of any URL it fits."""
    host, slash, path = rule.pattern.partition("/")
    found = [] if host == "*" else re.findall("[a-z0-9]+", _lower(host))
    pieces = (slash + path).split("*")
    for i, piece in enumerate(pieces):
        for token in re.finditer("[a-z0-9]+", _lower(piece)):
            opens = token.start() > 0 or i == 0  # after a literal separator
            closes = token.end() < len(piece)  # before one; a prefix may go on
            if opens and closes:
                found.append(token.group())
    return found


def rule_index(rules: Sequence[Rule]) -> Column:
    """The rules as a constant: buckets of (token, rules). A rule without a usable token is
    under the empty token, which every URL has. The longest pattern ranks first."""
    tokens = [_tokens(rule) for rule in rules]
    usage = Counter(token for of in tokens for token in set(of))
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].pattern), rules[i], i))
    rank = {i: place for place, i in enumerate(order)}
    held: dict[str, list[dict]] = {}
    for i, (rule, own) in enumerate(zip(rules, tokens)):
        token = min(own, key=lambda t: (usage[t], -len(t), t), default="")
        held.setdefault(token, []).append({
            "rank": rank[i], "rule": rule.pattern, "verdict": rule.verdict,
            "regex": _regex(rule)})
    buckets: list[list[dict]] = [[] for _ in range(BUCKETS)]
    for token, own in held.items():
        buckets[zlib.crc32(token.encode()) % BUCKETS].append({"token": token, "rules": own})
    return F.from_json(F.lit(json.dumps(buckets)), INDEX_TYPE)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case.
    Path: from there up to ``?``, ``#`` or the end. Both are empty for NULL or no ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _candidates(tokens: Column, rules: Sequence[Rule]) -> Column:
    index = rule_index(rules)
    return F.flatten(F.transform(tokens, lambda token: F.flatten(F.transform(
        F.filter(F.get(index, (F.crc32(token.cast("binary")) % BUCKETS).cast("int")),
                 lambda entry: entry["token"] == token),
        lambda entry: entry["rules"]))))


def _best(target: Column, tokens: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, or NULL."""
    best = None
    ordered = sorted(rules, key=lambda r: -len(r.pattern))
    for start in range(0, max(1, len(ordered)), BLOCK_RULES):
        fitting = F.filter(_candidates(tokens, ordered[start:start + BLOCK_RULES]),
                           lambda rule: F.rlike(target, rule["regex"]))
        first = F.array_min(fitting)  # the struct's first field is the rank
        best = first if best is None else F.coalesce(best, first)
    return best


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, fallback: Sequence[Rule] = FALLBACK,
          default: str = DEFAULT, key: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern, candidates) per row.

    ``rule`` is the longest of ``rules`` that fits, else NULL; of equally long ones the
    alphabetically first. ``verdict`` is the rule's; without one that of the longest fitting
    ``fallback`` pattern (``pattern``), else ``default``. ``candidates`` counts the rules whose
    regular expressions ran. NULL URLs and such without ``://`` have an empty host and path,
    which only rules without any literal could fit. Repeated rows and NULL keys stay. Other
    columns are not read.
    """
    host, path = host_and_path(F.col(url).cast("string"))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), host.alias("host"),
                        path.alias("path"))
    lowered = F.translate(F.concat("host", "path"), string.ascii_uppercase,
                          string.ascii_lowercase)
    # The empty token is kept once: rules without a token are under it.
    rows = rows.withColumn("_tokens", F.array_union(
        F.array(F.lit("")), F.split(lowered, "[^a-z0-9]+")))
    target, tokens = F.concat("host", "path"), F.col("_tokens")
    rows = rows.select("page_id", "host", "path", "_tokens",
                       _best(target, tokens, rules).alias("_rule"),
                       _best(target, tokens, fallback).alias("_pattern"))
    return rows.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_pattern.verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("_rule").isNull(), F.col("_pattern.rule")).alias("pattern"),
        F.size(_candidates(tokens, rules)).alias("candidates"))
