"""Term statistics: counts per document and corpus, TF-IDF, top terms per window.

A document's terms are counted inside its own row, a batch of documents at a time, so no
shuffle is needed to get from tokens to ``(document, term, n)``. What is shuffled
afterwards are per-term sums, combined on the map side first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendloom.operators.joins import ROWS_PER_TASK, hot_keys, skew_join
from trendloom.operators.packed import best_pairs, frequent_terms, packed, parts_of, runs
from trendloom.schemas import PAIR_REPORT, TREND_REPORT
from trendloom.session import work_dir

DIGITS = 9
POOL = 25
TOP = 5


def _runs(tokens: pa.Array) -> pa.Array:
    """(term, n) of the distinct tokens of each list; none of a NULL one."""
    dictionary, rows, codes, n = runs(tokens)
    words = pa.StructArray.from_arrays(
        [dictionary.take(pa.array(codes)), pa.array(n, pa.int64())], ["term", "n"])
    offsets = np.searchsorted(rows, np.arange(len(tokens) + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words)


def doc_terms(docs: DataFrame, ids: list[str], tokens: str, with_docs: bool = False) -> DataFrame:
    """One row (ids, doc_len, term, n) per document and distinct token. ``with_docs`` adds one
    with a NULL term per document, so that documents are counted in the same pass."""
    runs = F.arrow_udf(_runs, "array<struct<term string, n bigint>>")(tokens)
    if with_docs:
        none = F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"))
        runs = F.concat(runs, F.array(none))
    # The outer form: the plain one would test the array's size in an extra filter below,
    # and with it clean every text twice.
    length = F.greatest(F.size(tokens), F.lit(1)) if with_docs else F.size(tokens)
    rows = docs.select(*ids, length.alias("doc_len"), F.explode_outer(runs).alias("_t"))
    term = F.col("_t.term")
    kept = term.isNull() | (term != "") if with_docs else term.isNotNull() & (term != "")
    return rows.where(kept).select(*ids, "doc_len", "_t.term", "_t.n")


def term_counts(docs: DataFrame, tokens: str) -> DataFrame:
    """Occurrences of each token in the corpus."""
    return (
        docs.select(F.explode_outer(tokens).alias("term")).where(F.col("term") != "")
        .groupBy("term").agg(F.count("*").alias("n"))
    )


def top_terms_by_count(counts: DataFrame, k: int = POOL) -> DataFrame:
    return counts.orderBy(F.desc("n"), "term").limit(k)


def idf(n_docs: Column, df: Column) -> Column:
    return F.log10(n_docs / df)


def tfidf(docs: DataFrame, doc_id: str, tokens: str) -> DataFrame:
    """(doc_id, term, n, tf, df, idf, tfidf) over one corpus; a term that occurs in every
    document scores 0."""
    terms = doc_terms(docs, [doc_id], tokens)
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    n_docs = docs.agg(F.count("*")).scalar()
    scored = skew_join(terms, df, "term", [doc_id], counts=df).withColumn(
        "tf", F.col("n") / F.col("doc_len")
    ).withColumn("idf", idf(n_docs, F.col("df")))
    return scored.select(
        doc_id, "term", "n", "tf", "df", "idf",
        (F.col("idf") * F.col("tf")).alias("tfidf"),
    )


def rounded(score: Column | str, digits: int = DIGITS) -> Column:
    """Scores are ranked and reported to nine digits, so that equal scores tie."""
    return F.round(score, digits)


def top_pairs(scores: DataFrame, doc_id: str, k: int = TOP) -> DataFrame:
    """The k best (document, term) pairs; a term may come up more than once."""
    return (
        scores.select(doc_id, "term", rounded("tfidf").alias("tfidf"))
        .orderBy(F.desc("tfidf"), "term", doc_id).limit(k)
    )


def term_stats(terms: DataFrame, *group: str) -> DataFrame:
    """Occurrences, document frequency and highest TF per (group, term).

    All three can be merged, and the highest TF-IDF of a term is its IDF times its
    highest TF, so scores never have to go back to single documents.
    """
    return terms.groupBy(*group, "term").agg(
        F.sum("n").alias("n"), F.count("*").alias("df"),
        F.max(F.col("n") / F.col("doc_len")).alias("max_tf"),
    )


def merge_stats(stats: DataFrame, *group: str) -> DataFrame:
    return stats.groupBy(*group, "term").agg(
        F.sum("n").alias("n"), F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"))


def top_terms(docs: DataFrame, tokens: str, pool: int = POOL, k: int = TOP) -> DataFrame:
    """Of the ``pool`` most frequent terms the k with the highest TF-IDF."""
    stats = term_stats(doc_terms(docs, [], tokens))
    n_docs = docs.agg(F.count("*")).scalar()
    return (
        stats.orderBy(F.desc("n"), "term").limit(pool)
        .select("term", rounded(idf(n_docs, F.col("df")) * F.col("max_tf")).alias("score"))
        .orderBy(F.desc("score"), "term").limit(k)
    )


def top_terms_by_group(stats: DataFrame, n_docs: DataFrame, group: list[str],
                       pool: int = POOL, k: int = TOP) -> DataFrame:
    """:func:`top_terms` for every group. ``stats`` has one row per (group, term),
    ``n_docs`` one row per group."""
    return _ranked(_pooled(stats, group, pool).join(n_docs, group), group, k)


def _pooled(stats: DataFrame, group: list[str], pool: int) -> DataFrame:
    frequent = W.partitionBy(*group).orderBy(F.desc("n"), "term")
    return stats.withColumn("_r", F.row_number().over(frequent)).where(F.col("_r") <= pool)


def _ranked(pooled: DataFrame, group: list[str], k: int) -> DataFrame:
    best = W.partitionBy(*group).orderBy(F.desc("score"), "term")
    return (
        pooled.withColumn("score", rounded(idf(F.col("n_docs"), F.col("df")) * F.col("max_tf")))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select(*group, "rank", "term", "score")
    )


def slide_start(ts: Column, slide: int) -> Column:
    """Start of the slide a time falls into, in seconds since the epoch."""
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return seconds - F.pmod(seconds, F.lit(slide))


def window_starts(slide_col: Column, window: int, slide: int) -> Column:
    """Starts of all windows that cover a slide; windows are aligned to the slide and
    hold a whole number of slides."""
    if window % slide:
        raise ValueError("the window must be a multiple of the slide")
    return F.sequence(slide_col - (window - slide), slide_col, F.lit(slide).cast("bigint"))


def windowed_top_terms(docs: DataFrame, topic: str, ts: str, tokens: str, window: int,
                       slide: int, pool: int = POOL, k: int = TOP) -> DataFrame:
    """Top terms per (window, topic) over sliding windows.

    The term counts of documents move once, as packed blocks, to the one place that makes all
    windows of a stretch of time.
    """
    parts = parts_of(docs)
    blocks = packed(docs, topic, slide_start(F.col(ts), slide), tokens, window, slide, parts=parts)
    pooled = kept(frequent_terms(blocks, window, slide, parts, pool))
    return _top_terms_of_pools(pooled, pool, k, window).withColumnRenamed("topic", topic)


def _top_terms_of_pools(pooled: DataFrame, pool: int, k: int, window: int) -> DataFrame:
    group = ["window_start", "topic"]
    return with_window_bounds(_ranked(_pooled(pooled, group, pool), group, k), window)


def top_terms_of_blocks(blocks: DataFrame, parts: int, window: int, slide: int, pool: int = POOL,
                        k: int = TOP) -> DataFrame:
    """Blocks of term counts -> ranked terms per (window, topic)."""
    return _top_terms_of_pools(frequent_terms(blocks, window, slide, parts, pool), pool, k, window)


def terms_and_docs(stats: DataFrame, *group: str) -> tuple[DataFrame, DataFrame]:
    """Statistics over :func:`doc_terms` ``with_docs`` as those of terms and (group, n_docs)."""
    n_docs = stats.where("term IS NULL").select(*group, F.col("df").alias("n_docs"))
    return stats.where("term IS NOT NULL"), n_docs


CHUNK_WINDOWS = 64  # window starts of a chunk
PLACE = ["_chunk", "_part"]  # with the topic: what one task holds of the slides


def kept(stats: DataFrame) -> DataFrame:
    """Statistics that are read more than once, written to the shared work folder."""
    path = work_dir(stats.sparkSession, "slides")
    stats.write.parquet(path)
    return stats.sparkSession.read.schema(stats.schema).parquet(path)


def in_chunks(stats: DataFrame, topic: str, window: int, slide: int,
              rows: int = ROWS_PER_TASK) -> DataFrame:
    """Per-slide rows dealt out by chunks of CHUNK_WINDOWS window starts.

    A slide is in the chunks of all windows that cover it, which is one for most slides and two
    for those near a chunk's start. Everything a window needs is then in one place, and time
    does not make a place grow. A (topic, chunk) of more than about ``rows`` rows is dealt out
    further by term. The windows are made of the rows without a shuffle. The rows are read more
    than once, for the weights, the bounds and the windows, so they should be :func:`kept`.
    """
    span = CHUNK_WINDOWS * slide
    first = F.floor((F.col("slide") - (window - slide)) / span).cast("bigint")
    last = F.floor(F.col("slide") / span).cast("bigint")
    laid = stats.withColumn("_chunk", F.explode(F.sequence(first, last)))
    keyed = laid.withColumn("_key", F.struct(topic, "_chunk"))
    hot = hot_keys(keyed.groupBy("_key").agg(F.count("*").alias("_rows")), "_key", "_rows",
                   "_parts", rows)
    parted = keyed.join(F.broadcast(hot), keyed["_key"] == hot["_hot_key"], "left")
    part = F.pmod(F.xxhash64("term"), F.coalesce("_parts", F.lit(1))).cast("int")
    return parted.withColumn("_part", part).select(*stats.columns, *PLACE).repartition(
        topic, *PLACE)


def window_bounds(laid: DataFrame, topic: str, window: int, slide: int,
                  pool: int = POOL) -> DataFrame:
    """(topic, place, window_start, bound): a count that ``pool`` terms of the window reach.

    It is the highest ``pool``-th count of the window's slides. Bounds come from how many terms
    have which count, so no slide's terms are sorted. Windows without a bound are left out."""
    place = [topic, *PLACE]
    by_count = laid.groupBy(*place, "slide", "n").agg(F.count("*").alias("_terms"))
    above = W.partitionBy(*place, "slide").orderBy(F.desc("n"))
    bounds = by_count.withColumn("_above", F.sum("_terms").over(above)).where(
        F.col("_above") >= pool).groupBy(*place, "slide").agg(F.max("n").alias("bound"))
    start = F.explode(window_starts(F.col("slide"), window, slide)).alias("window_start")
    return bounds.select(*place, start, "bound").groupBy(*place, "window_start").agg(
        F.max("bound").alias("bound"))


def within_reach(laid: DataFrame, bounds: DataFrame, topic: str, window: int,
                 slide: int) -> DataFrame:
    """The rows of :func:`in_chunks` that can matter to the pool of some window.

    A term that occurs less often than the least of the :func:`window_bounds` of a slide's
    windows, in all slides of the chunk that share a window with this one, is in no pool here.
    That is exact: a term that is in a window's pool keeps all its rows of that window.
    """
    place = [topic, *PLACE]
    # A slide whose windows do not all have a bound keeps all its rows.
    covered = F.explode(F.sequence("window_start", F.col("window_start") + window - slide,
                                   F.lit(slide).cast("bigint"))).alias("slide")
    least = bounds.select(*place, covered, "bound").groupBy(*place, "slide").agg(
        F.min("bound").alias("_least"), F.count("*").alias("_windows"))
    around = W.partitionBy(*place, "term").orderBy("slide").rangeBetween(
        slide - window, window - slide)
    reach = laid.withColumn("_most", F.sum("n").over(around))
    kept = reach.join(least.hint("shuffle_hash"), [*place, "slide"], "left").where(
        F.col("_windows").isNull() | (F.col("_windows") < window // slide)
        | (F.col("_most") >= F.col("_least")))
    return kept.select(*laid.columns)


def _nodes(window: int, slide: int) -> Column:
    """The dyadic nodes a slide belongs to, as (level, node); a node of level l covers 2^l
    slides, and none is longer than a window."""
    at = F.expr(f"slide div {slide}")
    return F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright(at, level).alias("node"))
                     for level in range((window // slide).bit_length())])


def _readers(window: int, slide: int) -> Column:
    """Starts of the windows that read a node: those that cover it but not its parent. A window
    reads at most two nodes of a level, and each of its slides through exactly one."""
    spans, top = window // slide, (window // slide).bit_length() - 1
    size = F.expr("shiftleft(1L, level)")
    begin = F.col("node") * size
    end = begin + size
    even = F.col("node") % 2 == 0
    low = F.when((F.col("level") == top) | even, end - spans).otherwise(
        F.greatest(end - spans, begin - size + 1))
    high = F.when((F.col("level") == top) | ~even, begin).otherwise(
        F.least(begin, end + size - spans - 1))
    return F.transform(F.when(low <= high, F.sequence(low, high, F.lit(1).cast("bigint"))),
                       lambda start: start * slide)


def by_windows(laid: DataFrame, topic: str, window: int, slide: int,
               merge: Callable[..., DataFrame]) -> DataFrame:
    """Rows of :func:`in_chunks` merged per (window_start, topic, term), without a shuffle.

    A slide goes into one node per level, about log2(window / slide) of them, and what a term
    has in a node is merged there once; a window then reads at most two nodes a level.
    """
    group = [topic, *PLACE]
    nodes = merge(laid.select(*laid.columns, F.inline(_nodes(window, slide))).drop("slide"),
                  *group, "level", "node")
    starts = nodes.select(*nodes.columns, F.explode(_readers(window, slide)).alias("window_start"))
    own = F.floor(F.col("window_start") / (CHUNK_WINDOWS * slide)) == F.col("_chunk")
    return merge(starts.where(own).drop("level", "node"), *group, "window_start")


def top_terms_of_slides(stats: DataFrame, counts: DataFrame, topic: str, window: int,
                        slide: int, pool: int = POOL, k: int = TOP) -> DataFrame:
    """Per-slide statistics and document counts -> ranked terms per (window, topic)."""
    return _top_terms(in_chunks(kept(stats), topic, window, slide), counts, topic, window, slide,
                      pool, k)


def _top_terms(laid: DataFrame, counts: DataFrame, topic: str, window: int, slide: int,
               pool: int, k: int) -> DataFrame:
    bounds = window_bounds(laid, topic, window, slide, pool)
    near = within_reach(laid, bounds, topic, window, slide)
    merged = by_windows(near, topic, window, slide, merge_stats).join(
        bounds.hint("shuffle_hash"), [topic, *PLACE, "window_start"], "left").where(
        F.col("bound").isNull() | (F.col("n") >= F.col("bound")))
    n_docs = window_docs(counts, topic, window, slide)
    return with_window_bounds(top_terms_by_group(
        merged.drop(*PLACE, "bound"), n_docs, ["window_start", topic], pool, k), window)


def window_docs(counts: DataFrame, topic: str, window: int, slide: int) -> DataFrame:
    """Documents per (window, topic) out of those per slide."""
    start = F.explode(window_starts(F.col("slide"), window, slide))
    return counts.withColumn("window_start", start).groupBy("window_start", topic).agg(
        F.sum("n_docs").alias("n_docs"))


def _best(entries: Column, k: int) -> Column:
    return F.slice(F.sort_array(entries, asc=True), 1, k)


def pair_stats(docs: DataFrame, topic: str, slide: str, tokens: str, k: int = TOP,
               with_docs: bool = False) -> DataFrame:
    """(topic, slide, term, df, best) out of documents with an ``id``: a term's document
    frequency and its ``k`` entries with the highest TF, as (-tf, id) in that order. Both
    merge, and in any window a term's best pairs are among the best of its slides. The terms
    of a document move once."""
    terms = doc_terms(docs, [topic, slide, "id"], tokens, with_docs).select(
        topic, slide, "term", (-F.col("n") / F.col("doc_len")).alias("less_tf"),
        F.col("id").cast("string").alias("id"))
    keys = [topic, slide, "term"]
    ranked = W.partitionBy(*keys).orderBy("less_tf", "id")
    whole = ranked.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = terms.select("*", F.row_number().over(ranked).alias("_r"),
                        F.count("*").over(whole).alias("df")).where(F.col("_r") <= k)
    return rows.groupBy(*keys).agg(F.first("df").alias("df"), F.sort_array(
        F.collect_list(F.struct("less_tf", "id"))).alias("best"))


def merge_pairs(stats: DataFrame, *group: str, k: int = TOP) -> DataFrame:
    """Merge rows of one (group, term): as many as slides or batches hold it, ``k`` entries
    each."""
    return stats.groupBy(*group, "term").agg(
        F.sum("df").alias("df"), _best(F.flatten(F.collect_list("best")), k).alias("best"))


def _top_of_pairs(pairs: DataFrame, k: int, window: int) -> DataFrame:
    group = ["window_start", "topic"]
    scores = pairs.select(*group, "term", "id", rounded(
        idf(F.col("n_docs"), F.col("df")) * -F.col("less_tf")).alias("score"))
    best = W.partitionBy(*group).orderBy(F.desc("score"), "term", "id")
    return with_window_bounds(
        scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
            *group, "rank", "term", "id", "score"), window)


def top_pairs_of_blocks(blocks: DataFrame, parts: int, window: int, slide: int,
                        k: int = TOP) -> DataFrame:
    """The ``k`` best (document, term) pairs per (window, topic), out of blocks of term counts of
    documents with ids; a term may come up more than once."""
    return _top_of_pairs(best_pairs(blocks, window, slide, parts, k), k, window)


def windowed_top_pairs(docs: DataFrame, topic: str, ts: str, tokens: str, window: int,
                       slide: int, k: int = TOP) -> DataFrame:
    """:func:`top_pairs_of_blocks` of documents with an ``id``."""
    parts = parts_of(docs)
    blocks = packed(docs, topic, slide_start(F.col(ts), slide), tokens, window, slide, "id", parts)
    pairs = kept(best_pairs(blocks, window, slide, parts, k))
    return _top_of_pairs(pairs, k, window).withColumnRenamed("topic", topic)


@dataclass(frozen=True)
class Ranking:
    """How the windows of a trend table are ranked: ``rank`` takes blocks of term counts, of
    documents with their ids if ``doc_id`` names them."""

    report: StructType
    doc_id: str | None
    rank: Callable[..., DataFrame]


TOP_TERMS = Ranking(TREND_REPORT, None, top_terms_of_blocks)
TOP_PAIRS = Ranking(PAIR_REPORT, "id", top_pairs_of_blocks)


def with_window_bounds(df: DataFrame, window: int) -> DataFrame:
    """Window start in seconds -> start and end as timestamps, first in the row."""
    rest = [c for c in df.columns if c != "window_start"]
    start = F.col("window_start")
    return df.select(
        F.timestamp_seconds(start).cast("timestamp_ntz").alias("window_start"),
        F.timestamp_seconds(start + window).cast("timestamp_ntz").alias("window_end"), *rest)
