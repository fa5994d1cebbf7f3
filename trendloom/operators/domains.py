"""Registrable domains of hosts by a table of suffix rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.operators.joins import skew_join


def bare_host(netloc: Column) -> Column:
    """A network location without user, port and final dot, in lower case."""
    host = F.regexp_replace(F.regexp_replace(netloc, "^.*@", ""), ":[0-9]*$", "")
    return F.lower(F.regexp_replace(host, r"\.$", ""))


def parsed_rules(suffixes: DataFrame, rule: str = "rule") -> DataFrame:
    """(name, extra, exception) of suffix rules: a plain ``co.uk``; ``*.ck``, which takes one
    label more than its name; ``!www.ck``, an exception from such a rule, one label less."""
    text = F.lower(F.trim(F.col(rule)))
    exception, wild = text.startswith("!"), text.startswith("*.")
    return suffixes.where(text != "").select(
        F.when(exception, F.substring(text, F.lit(2), F.length(text)))
        .when(wild, F.substring(text, F.lit(3), F.length(text))).otherwise(text).alias("name"),
        F.when(exception, -1).when(wild, 1).otherwise(0).alias("extra"),
        exception.alias("exception")).distinct()


def registrable(hosts: DataFrame, host: str, suffixes: DataFrame, rule: str = "rule") -> DataFrame:
    """(host, suffix, domain) per distinct non-NULL host.

    The host's label tails meet the rules in a hash join. An exception wins, then the rule that
    takes most labels; a host that no rule fits has its last label as suffix. The domain is the
    suffix and one label before it, or the host itself where there is none.
    """
    names = hosts.select(F.col(host).alias("host")).where("host IS NOT NULL").distinct()
    labels = F.split(bare_host(F.col("host")), r"\.")
    tails = names.select("host", labels.alias("labels")).select(
        "host", "labels", F.posexplode("labels").alias("at", "_label")).select(
        "host", "labels", (F.size("labels") - F.col("at")).alias("length"),
        F.array_join(F.slice("labels", F.col("at") + 1, F.size("labels")), ".").alias("name"))
    found = tails.join(parsed_rules(suffixes, rule), "name").where(
        F.col("length") + F.col("extra") <= F.size("labels"))
    best = found.groupBy("host").agg(F.max_by(
        F.col("length") + F.col("extra"),
        F.struct("exception", F.col("length") + F.col("extra"))).alias("_n"))
    placed = names.join(best, "host", "left").select(
        "host", labels.alias("labels"), F.coalesce("_n", F.lit(1)).alias("_n"))

    def last(n: Column) -> Column:
        return F.array_join(F.slice("labels", -F.least(n, F.size("labels")), F.size("labels")), ".")

    return placed.select("host", last(F.col("_n")).alias("suffix"),
                         last(F.col("_n") + 1).alias("domain"))


def with_domain(rows: DataFrame, host: str, suffixes: DataFrame, spread: list[str],
                rule: str = "rule", out: str = "domain") -> DataFrame:
    """Add each row's registrable domain; NULL for a NULL host. Rules are applied once per
    distinct host, and a host with very many rows is split by the ``spread`` columns."""
    found = registrable(rows, host, suffixes, rule).select(F.col("host").alias(host),
                                                           F.col("domain").alias(out))
    return skew_join(rows, found, host, spread, "left")
