"""How far the sources of a language diverge in their use of terms.

Each group (language, source) and each language has counts over the language's kept terms,
which are numbered in the order of their bytes. The counts are kept as segment trees over the
term numbers, cut into blocks of 2^WIDTH_BITS terms. Trees are hash-consed: subtrees with the same
counts are one node, wherever they stand and whichever group they belong to. Two trees are
walked at the same time from the roots down; node pairs that come up again in a walk are
collapsed into one with a multiplicity, so equal pairs, all pairs of empty subtrees among
them, are priced once.

A tile is a block of terms for two chunks of a language's sources, so a task holds at most
2 * CHUNK trees or so, however many sources or terms there are.

A term is a maximal run of bytes other than 0x00-0x40, 0x5B-0x60 and 0x7B-0x7F, A-Z in lower
case.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.hashing import BYTES, LOWERED
from trendloom.llm.storage import bounded_batches, stored
from trendloom.operators.numbering import numbered

LEAST_DOCS = 30  # documents of the language that a kept term occurs in
SMOOTHING = 5  # added to every count
WHOLE = 1_000_000_000  # shares are in billionths
TERMS = 50  # terms reported per group
WIDTH_BITS = 12  # of the number of terms in a block
CHUNK = 64  # sources of a chunk, on average
PENDING = 200_000  # distinct terms that a task holds before it hands its counts on

TERM_BYTES = ((LOWERED >= 0x61) & (LOWERED <= 0x7A)) | (BYTES >= 0x80)
CLEANED = bytes(np.where(TERM_BYTES, LOWERED, 0x20).astype(np.uint8))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and documents that hold it, of
    rows (lang, source, text) without NULLs."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        pending = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, in_docs) in groups.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                     pa.array([t.decode() for t in n], pa.string()),
                     pa.array(list(n.values()), pa.int64()),
                     pa.array([in_docs[t] for t in n], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            groups.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3))):
                terms = text.as_buffer().to_pybytes().translate(CLEANED).split()
                if not terms:
                    continue
                n, in_docs = groups.setdefault((lang.as_py(), source.as_py()),
                                               (Counter(), Counter()))
                before = len(n)
                n.update(terms)
                in_docs.update(set(terms))
                pending += len(n) - before
                if pending > PENDING:
                    yield from handed_on()
                    pending = 0
        yield from handed_on()

    bounded_batches(docs.sparkSession)
    return docs.select("lang", "source", "text").mapInArrow(
        counted, "lang string, source string, term string, n long, docs long").groupBy(
        "lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def hash_consed(counts: np.ndarray) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
    """(leaf values, levels, roots, leaves) of the segment trees over the rows of ``counts``,
    whose width is a power of two. Level by level from the leaves up, equal (left, right) pairs
    get one node; a level is the arrays of its nodes' children. ``leaves`` are the leaf nodes
    of every tree."""
    values, nodes = np.unique(counts, return_inverse=True)
    leaves = nodes = nodes.reshape(counts.shape)
    levels, n = [], len(values)
    while nodes.shape[1] > 1:
        pairs, above = np.unique(nodes[:, ::2] * n + nodes[:, 1::2], return_inverse=True)
        levels.append((pairs // n, pairs % n))
        nodes, n = above.reshape(nodes.shape[0], -1), len(pairs)
    return values, levels, nodes[:, 0], leaves


def leaf_pairs(levels: list, n_leaves: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """(walk, leaf a, leaf b, times): the simultaneous walks of the trees with the roots ``a``
    and ``b``. In each walk a node pair is opened once and remembers how often it came up."""
    walk, times = np.arange(len(a)), np.ones(len(a), np.int64)
    sizes = [n_leaves, *(len(left) for left, _ in levels)]
    for (left, right), n in zip(reversed(levels), reversed(sizes[:-1])):
        walk, times = np.tile(walk, 2), np.tile(times, 2)
        a, b = np.concatenate((left[a], right[a])), np.concatenate((left[b], right[b]))
        keys, at = np.unique((walk * n + a) * n + b, return_inverse=True)
        times = np.bincount(at.reshape(-1), times, len(keys)).astype(np.int64)
        walk, a, b = keys // (n * n), keys // n % n, keys % n
    return walk, a, b, times


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(WHOLE * (count + SMOOTHING) / total) in whole numbers: a long division of three
    steps, exact for totals up to 9 * 10^15."""
    rest, out = counts + SMOOTHING, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // totals
        rest = rest % totals
    return out + 1


def _priced(tile: pd.DataFrame, bits: int) -> pd.DataFrame:
    """All pairs of sources and the best terms of each source, in one tile of 2^bits terms."""
    first = tile.iloc[0]
    lang, block, width = first["lang"], int(first["block"]), int(first["width"])
    tile = tile.sort_values(["whole", "source"]).reset_index(drop=True)
    counts = np.zeros((len(tile), 1 << bits), np.int64)
    for row, (places, n) in enumerate(zip(tile["places"], tile["counts"])):
        if places is not None and len(places):
            counts[row, places] = n
    counts[:, width:] = -1  # beyond the last term: priced nothing
    totals = tile["total"].to_numpy(np.int64)
    chunk, whole = tile["chunk"].to_numpy(), tile["whole"].to_numpy(bool)
    values, levels, roots, leaves = hash_consed(counts)
    sources = tile["source"].to_numpy()
    out = []

    def prices(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
        """(walk, leaf x, leaf y, times, share x, share y) of the walks of trees x and y."""
        walk, a, b, times = leaf_pairs(levels, len(values), roots[x], roots[y])
        real = values[a] >= 0
        walk, a, b, times = walk[real], a[real], b[real], times[real]
        return (walk, a, b, times, shares(values[a], totals[x][walk]),
                shares(values[b], totals[y][walk]))

    for i in np.flatnonzero(~whole):
        # Within a chunk the later source, across chunks those of the other one.
        other = (chunk != chunk[i]) & (chunk[i] == first["ca"]) if first["ca"] != first["cb"] \
            else np.arange(len(tile)) > i
        others = np.flatnonzero(other & ~whole)
        if len(others):
            walk, _, _, times, p, q = prices(np.full(len(others), i), others)
            sums = np.zeros(len(others), np.int64)
            np.add.at(sums, walk, np.abs(p - q) * times)
            out.append(pd.DataFrame({
                "part": "pair", "source": sources[i], "other": sources[others], "term": -1,
                "value": sums}))
    for w in np.flatnonzero(whole):
        own = np.flatnonzero(~whole)
        walk, a, b, _, p, q = prices(own, np.full(len(own), w))
        order = np.argsort(keys := (walk * len(values) + a) * len(values) + b)
        for k, i in enumerate(own):
            at = np.flatnonzero(counts[i] > 0)
            found = order[np.searchsorted(keys[order], (
                k * len(values) + leaves[i, at]) * len(values) + leaves[w, at])]
            more = p[found] > q[found]
            at, gap = at[more], (p - q)[found][more]
            best = np.lexsort((at, -gap))[:TERMS]
            out.append(pd.DataFrame({
                "part": "term", "source": sources[i], "other": None, "term": (block << bits) + at[best],
                "value": gap[best]}))
    columns = ["lang", "part", "source", "other", "term", "value"]
    if not out:
        return pd.DataFrame(columns=columns)
    return pd.concat(out, ignore_index=True).assign(lang=lang)[columns]


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          least_docs: int = LEAST_DOCS, bits: int = WIDTH_BITS, chunk: int = CHUNK) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of ``docs``.

    Part ``pair`` has a row for each other source of the language: how far apart the two are,
    summed over all kept terms, in billionths. Part ``term`` has the TERMS terms that the group
    holds most above its language. Ranks count from 1 by falling value, ties by the item's
    bytes. NULLs in the three columns are empty texts, and '' is a language or source like any
    other; groups without terms take part with zero counts; a language without kept terms has
    pairs of value 0. Every row is a document, repeated ones too. Texts of any length are
    counted where they lie. An empty table gives no rows. Other columns are not read. Blocks of
    2^bits terms and chunks of about ``chunk`` sources bound what a task holds, not the result.
    """
    width = 1 << bits
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
              for c, name in ((lang, "lang"), (source, "source"), (text, "text"))]
    docs = docs.select(*values)
    counts = stored(term_counts(docs), "divergence-counts")
    kept = numbered(counts.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("_docs")).where(
        F.col("_docs") >= least_docs).drop("_docs"), ["term"], "id", ["lang"], start=0)
    kept = stored(kept, "divergence-terms")
    own = stored(counts.join(kept.select("lang", "term", "id"), ["lang", "term"]).select(
        "lang", "source", "id", "n"), "divergence-own")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(
        own.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    chunks = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / chunk).cast("int").alias("chunks")).join(
        langs.withColumnRenamed("n", "lang_n"), "lang", "left").na.fill(0, ["v", "lang_n"])
    chunks = chunks.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / width)))

    # A tree per group and one per language, each in blocks; empty blocks are there as well.
    no_source = F.lit(None).cast("string").alias("source")
    trees = groups.select("lang", "source", F.lit(False).alias("whole"), "n").join(
        chunks.drop("lang_n"), "lang").unionByName(
        chunks.select("lang", no_source, F.lit(True).alias("whole"), F.col("lang_n").alias("n"),
                      "chunks", "v", "blocks"))
    trees = trees.select(
        "lang", "source", "whole", "chunks",
        (F.coalesce("n", F.lit(0)) + SMOOTHING * F.col("v")).alias("total"), "v",
        F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    vectors = own.select("lang", "source", F.lit(False).alias("whole"), "id", "n").unionByName(
        kept.select("lang", no_source, F.lit(True).alias("whole"), "id", "n"))
    vectors = vectors.groupBy("lang", "source", "whole", F.shiftright(
        "id", bits).alias("block")).agg(F.collect_list(F.struct(
            F.col("id").bitwiseAND(width - 1).cast("int").alias("place"), "n")).alias("_v"))
    vectors = vectors.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                             F.col("whole").alias("_whole"), F.col("block").alias("_block"),
                             F.col("_v.place").alias("places"), F.col("_v.n").alias("counts"))
    rows = trees.join(vectors, (F.col("lang") == F.col("_lang")) & F.col("source").eqNullSafe(
        F.col("_source")) & (F.col("whole") == F.col("_whole"))
        & (F.col("block") == F.col("_block")), "left")
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    tiles = F.when(F.col("whole"), F.transform(every, lambda j: F.struct(
        j.alias("ca"), j.alias("cb")))).otherwise(F.transform(every, lambda j: F.struct(
            F.least("chunk", j).alias("ca"), F.greatest("chunk", j).alias("cb"))))
    filled = F.least(F.lit(width).cast("bigint"), F.col("v") - F.col("block") * width)
    rows = rows.select("lang", "source", "whole", "total", "chunk", "block", filled.alias("width"),
                       "places", "counts", F.explode(tiles).alias("_t"))
    rows = rows.select("*", "_t.*").drop("_t")
    found = stored(rows.groupBy("lang", "block", "ca", "cb").applyInPandas(
        lambda tile: _priced(tile, bits), "lang string, part string, source string, other string, term long, value long"),
        "divergence-tiles")

    sums = found.where("part = 'pair'").groupBy("lang", "source", "other").agg(
        F.sum("value").alias("value"))
    pairs = sums.unionByName(sums.select("lang", F.col("other").alias("source"),
                                         F.col("source").alias("other"), "value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"),
                         "value", F.row_number().over(by_value).alias("rank"))
    by_gap = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    best = found.where("part = 'term'").select(
        "lang", "source", "term", "value", F.row_number().over(by_gap).alias("rank")).where(
        F.col("rank") <= TERMS)
    names = kept.select(F.col("lang"), F.col("id").alias("term"), F.col("term").alias("item"))
    terms = best.join(names, ["lang", "term"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
