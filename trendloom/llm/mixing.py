"""Mixing sources to target weights by the cube method of balanced sampling.

A source whose target is r times its size takes every text floor(r) times for certain and once
more with probability frac(r). The cube method makes these extra draws: it moves the vector of
probabilities along directions that change neither the words nor the texts taken (the null
space of the two constraints) until components reach 0 or 1. Blocks of one source fly
independently; what stays undecided in a block, two texts at most, flies again in a block of
the next level, until one block per source is left. Its last two texts land on the choice that
misses the word total least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.storage import stored

WEIGHTS = (5, 2, 1)  # of the sources in code point order, repeating
SHARE = 1.5  # of all words
MOST = 2.0  # times a source's or a text's own size
SEED = 7
BLOCK = 4096  # texts that fly together
UNDECIDED = 2  # at most, per block: the number of constraints
TOLERANCE = 1e-9


def words(text: str) -> Column:
    """Number of words; none for NULL."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")),
                      F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target) out of one row (source, source_size) per source. Targets
    are shared by weight and stop at ``most`` times the size; the excess is shared again
    until none is above. One row per source is all that is ever ranked or summed."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = stored(sizes.select(
        "source", "source_size", F.get(cycle, rank % len(weights)).alias("weight"),
        (F.col("source_size") * most).alias("limit")), "mix-sources")
    level, full = 0.0, 0
    while True:  # the words per unit of weight rise until no further source is full
        above = F.col("weight") * level >= F.col("limit") if level else F.lit(False)
        state = rows.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(above, 1).otherwise(0)).alias("full"),
            F.sum(F.when(above, F.col("limit")).otherwise(0.0)).alias("given"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if not state["all"] or not state["weight"] or (level and state["full"] == full):
            break
        full = state["full"]
        level = (share * state["all"] - state["given"]) / state["weight"]
    return rows.select("source", "source_size",
                       F.least(F.col("weight") * level, F.col("limit")).alias("target"))


def fly(sizes: np.ndarray, chances: np.ndarray, rng: np.random.Generator,
        land: bool) -> np.ndarray:
    """Move ``chances`` until at most two lie strictly between 0 and 1, keeping their sum and
    their sum weighted by ``sizes``; with ``land`` the last ones are rounded."""
    out = chances.astype(float).copy()
    out[out < TOLERANCE], out[out > 1 - TOLERANCE] = 0.0, 1.0
    waiting = np.flatnonzero((out > 0) & (out < 1)).tolist()
    draws = iter(rng.random(len(waiting) + 1).tolist())
    active: list[int] = []
    size, p = sizes.astype(float).tolist(), out.tolist()
    for unit in waiting:
        active.append(unit)
        if len(active) <= UNDECIDED:
            continue
        a, b, c = (size[i] for i in active)
        direction = (c - b, a - c, b - a)  # keeps count and words
        if not any(direction):
            direction = (1.0, -1.0, 0.0)
        up, down = np.inf, np.inf
        for i, u in zip(active, direction):
            if u > 0:
                up, down = min(up, (1 - p[i]) / u), min(down, p[i] / u)
            elif u < 0:
                up, down = min(up, p[i] / -u), min(down, (1 - p[i]) / -u)
        step = up if next(draws) < down / (up + down) else -down
        for i, u in zip(active, direction):
            p[i] = min(1.0, max(0.0, p[i] + step * u))
            if p[i] < TOLERANCE or p[i] > 1 - TOLERANCE:
                p[i] = round(p[i])
        active = [i for i in active if 0 < p[i] < 1]
    if land and active:
        options = [[(bits >> k) & 1 for k in range(len(active))]
                   for bits in range(1 << len(active))]
        count, total = sum(p[i] for i in active), sum(p[i] * size[i] for i in active)
        best = min(options, key=lambda o: (
            abs(sum(x * size[i] for x, i in zip(o, active)) - total), abs(sum(o) - count), o))
        for x, i in zip(best, active):
            p[i] = x
    return np.asarray(p, float)


def _flight(units: DataFrame, seed: int, level: int, land: bool) -> DataFrame:
    """One flight of every (source, block)."""
    columns = ["source", "unit", "words", "chance"]

    def flown(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["order", "unit"], kind="stable")
        first = group["unit"].iloc[0] if len(group) else 0
        rng = np.random.default_rng([seed, level, len(group), abs(int(first))])
        chances = fly(group["words"].to_numpy(), group["chance"].to_numpy(), rng, land)
        return group.assign(chance=chances)[columns]

    ordered = units.withColumn("order", F.xxhash64(F.lit(seed + level), "unit"))
    return ordered.groupBy("source", "block").applyInPandas(
        flown, "source string, unit long, words long, chance double")


def balanced_sample(units: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(source, unit, taken) from (source, unit, words, chance): 1 or 0 per unit, balanced
    within each source on the number of units and on their words. ``unit`` is unique within
    its source. The units of a block are fixed by hashes, so reruns agree."""
    decided, level = [], 0
    while True:
        counts = units.groupBy("source").agg(F.count("*").alias("n")).withColumn(
            "blocks", F.ceil(F.col("n") / block))
        largest = counts.agg(F.max("blocks")).first()[0] or 0
        counts = counts.withColumnRenamed("source", "_source")
        dealt = units.join(counts, units["source"].eqNullSafe(counts["_source"])).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(-seed - level), "unit"), "blocks"))
        flown = stored(_flight(dealt.select(*units.columns, "block"), seed, level, largest <= 1),
                       "flight")
        ready = F.col("chance").isin(0.0, 1.0)
        decided.append(flown.where(ready).select(
            "source", "unit", F.col("chance").cast("int").alias("taken")))
        if largest <= 1:
            break
        units, level = flown.where(~ready), level + 1
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
        seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, row_key, size, source_size, target, times) per row of ``docs``.

    ``size`` is the number of words and ``times`` how often the mix takes the row.
    ``row_key`` is a hash of key, source and text, to find the row again; rows that agree in
    it are decided together. A NULL source is a source, the last one. Texts without words
    are taken as often as their source's ratio says, which costs no words. Sources without
    words are taken no times. Other columns are not read.
    """
    body = F.col(text).cast("string")
    rows = stored(docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.xxhash64(F.col(key).cast("long"), F.col(source).cast("string"), body).alias("row_key"),
        words(text).alias("size")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    certain = F.floor(ratio + TOLERANCE)
    shares = targets.select(F.col("source").alias("_source"), "source_size", "target",
                            certain.cast("int").alias("certain"),
                            (ratio - certain).alias("chance"))
    rows = rows.join(shares, rows["source"].eqNullSafe(shares["_source"])).drop("_source")
    units = rows.where(F.col("chance") > TOLERANCE).groupBy("source", "row_key").agg(
        F.sum("size").alias("words"), F.first("chance").alias("chance")).select(
        "source", F.col("row_key").alias("unit"), "words", "chance")
    drawn = balanced_sample(stored(units, "mix-units"), seed, block).select(
        F.col("unit").alias("row_key"), "taken")
    return rows.join(drawn, "row_key", "left").select(
        "doc_id", "source", "row_key", "size", "source_size", "target",
        (F.col("certain") + F.coalesce("taken", F.lit(0))).alias("times"))


def repeated(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", text: str = "text",
             source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as ``mixed`` takes them, with all their columns."""
    times = mixed.where("times > 0").select(
        F.col("row_key").alias("_row_key"), F.col("times").alias("_times")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    value = F.col("_row")
    return rows.withColumn("_row_key", F.xxhash64(
        value[key].cast("long"), value[source].cast("string"), value[text].cast("string"))).join(
        times, "_row_key").select("_row", F.explode(F.sequence(F.lit(1), "_times"))).select(
        "_row.*")
