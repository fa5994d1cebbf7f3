"""Importance resampling of a corpus towards a target distribution.

Features are hashed runs of words. A text is cut at its newlines, which are never part of a
word: each distinct line's feature counts are computed once and multiplied by how often the
line occurs, and the runs that reach over a newline are added from the texts. A bucket's gain
compares the target's share with the corpus's; texts are drawn by the highest gain plus Gumbel
noise, which samples without replacement in proportion to the importance weights.

A word is a maximal run of bytes other than 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F, A-Z in lower
case first.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.hashing import BYTES, LOWERED, slabs, text_bytes
from trendloom.llm.storage import bounded_batches, stored
from trendloom.operators.numbering import numbered

RUN = 2  # words of the longest feature
BUCKETS = 10_000
PERCENT = 25  # texts drawn of a hundred
LEAST_WORDS = 20  # shorter texts are not drawn
SEED = 7
LONG_WORD = 64  # bytes of a word above which its checksum is taken alone

LETTER = ((LOWERED >= 0x30) & (LOWERED <= 0x39)) | ((LOWERED >= 0x61) & (LOWERED <= 0x7A)) | (
    BYTES >= 0x80)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


CRC_TABLE = _crc_table()
BLANK = np.uint32(0x20)


def _step(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return CRC_TABLE[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def extended(state: np.ndarray, data: np.ndarray, starts: np.ndarray,
             lengths: np.ndarray) -> np.ndarray:
    """Checksum states after the bytes of one word each; words go byte by byte, all at once."""
    order = np.argsort(-lengths, kind="stable")
    out, at, left = state[order], starts[order], lengths[order]
    first = int(np.searchsorted(-left, -LONG_WORD))
    for i in range(first):
        word = data[at[i]:at[i] + left[i]].tobytes()
        out[i] = zlib.crc32(word, int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    ends = np.searchsorted(-left[first:], -np.arange(LONG_WORD + 1), side="left") + first
    for j in range(int(left[first]) if first < len(left) else 0):
        part = slice(first, int(ends[j]))
        out[part] = _step(out[part], data[at[part] + j].astype(np.uint32))
    states = np.empty_like(out)
    states[order] = out
    return states


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, bounds): where the words of each text lie."""
    inside = LETTER[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[edges]
    ends[edges[1:] - 1] = inside[edges[1:] - 1]
    if len(data):
        ends[-1] = inside[-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1 - starts, np.searchsorted(starts, offsets)


def runs_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owner: np.ndarray,
            run: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first word, bucket) of all runs of 1, 2, ... ``run`` words of the same owner."""
    n = len(starts)
    state = np.full(n, 0xFFFFFFFF, np.uint32)
    for size in range(1, run + 1):
        first = np.arange(max(n - size + 1, 0))
        first = first[owner[first] == owner[first + size - 1]]
        last = first + size - 1
        before = state[first] if size == 1 else _step(state[first], BLANK)
        state = np.zeros(n, np.uint32)
        state[first] = extended(before, data, starts[last], lengths[last])
        yield size, first, (state[first] ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray,
                                               np.ndarray, slice]]:
    """(bytes, starts, lengths, owner, words per text, rows) of the texts of a batch."""
    for first, last, part, inner in slabs(*text_bytes(column)):
        data = LOWERED[part]
        starts, lengths, bounds = words_of(data, inner)
        counts = np.diff(bounds)
        yield data, starts, lengths, np.repeat(np.arange(len(counts)), counts), counts, slice(
            first, last)


def _summed(df: DataFrame, found, buckets: int) -> DataFrame:
    """(bucket, n): the sums of the (buckets, weights) that ``found`` gives for each batch,
    added up in each task and then over all tasks."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for bucket, weight in found(batch):
                np.add.at(totals, bucket, weight)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])],
                                         names=["bucket", "n"])

    return df.mapInArrow(counted, "bucket long, n long")


def feature_counts(docs: DataFrame, text: str = "text", run: int = RUN,
                   buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often the features of all texts fall into each bucket, by segment
    deduplication; buckets without any have no row.

    Lines are brought together by their text and counted on the map side first, so a line that
    a third of all texts hold is no hot key. NULL texts and texts without words have no
    features; an empty table gives no rows. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text")).where("text IS NOT NULL")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(
        F.count("*").alias("times"))

    def inside(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        times = batch.column(1).to_numpy()
        for data, starts, lengths, owner, _, rows in _texts(batch.column(0)):
            for _, first, bucket in runs_of(data, starts, lengths, owner, run, buckets):
                yield bucket, times[rows][owner[first]]

    def across(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        for data, starts, lengths, owner, _, _ in _texts(batch.column(0)):
            line = np.cumsum(data == 10)[starts]
            breaks = np.flatnonzero((line[1:] != line[:-1]) & (owner[1:] == owner[:-1])) + 1
            # Words less than a run away from a newline, on both sides.
            near = np.zeros(len(starts), bool)
            for j in range(1 - run, run - 1):
                near[np.clip(breaks + j, 0, max(len(starts) - 1, 0))] = True
            kept = np.flatnonzero(near)
            stretch = np.cumsum((np.diff(kept, prepend=-2) > 1) | (np.diff(
                owner[kept], prepend=-1) != 0))
            for size, first, bucket in runs_of(data, starts[kept], lengths[kept], stretch, run,
                                               buckets):
                over = line[kept[first]] != line[kept[first + size - 1]]
                yield bucket[over], 1

    return _summed(lines, inside, buckets).unionByName(_summed(texts, across, buckets)).groupBy(
        "bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, in thousandths, out of two :func:`feature_counts`: the log of
    the target's smoothed share over the corpus's. A table of ``buckets`` numbers."""
    counts = np.zeros((2, buckets), np.int64)
    for i, table in enumerate((corpus, target)):
        for row in table.collect():
            counts[i, row["bucket"]] = row["n"]
    total, wanted = (int(x) + buckets for x in counts.sum(axis=1))
    return np.array([math.floor(1000 * math.log((float(t) + 1) * total / ((float(s) + 1) * wanted)))
                     for s, t in counts.T.tolist()], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text",
            run: int = RUN) -> DataFrame:
    """(doc_id, row_key, n_words, n_features, weight) per row: the mean gain of its features,
    floored; 0 without features."""
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    bounded_batches(docs.sparkSession)
    doc_id, value = F.col(f"`{key}`").cast("long"), F.col(f"`{text}`").cast("string")
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, value).alias("row_key"),
                       value.alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, sums = (np.zeros(n, np.int64) for _ in range(3))
            for data, starts, lengths, owner, counts, part in _texts(batch.column(2)):
                words[part] = counts
                for _, first, bucket in runs_of(data, starts, lengths, owner, run, buckets):
                    features[part] += np.bincount(owner[first], minlength=len(counts))
                    np.add.at(sums[part], owner[first], shared.value[bucket])
            weight = np.where(features, sums // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, (words, features, weight))],
                names=["doc_id", "row_key", "n_words", "n_features", "weight"])

    return rows.mapInArrow(scored, "doc_id long, row_key long, n_words long, n_features long, "
                                   "weight long")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
             target_text: str = "text", run: int = RUN, buckets: int = BUCKETS,
             percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """(doc_id, row_key, n_words, n_features, weight, score, rank) per row of ``docs``.

    Of the N texts with at least ``least_words`` words the ``percent * N // 100`` with the
    highest scores are drawn and ranked from 1; the rank of all others is NULL. Ties go to the
    smaller key, NULL keys last; rows that are equal in both key and score are ranked in the
    order of their other columns, repeated rows one after the other. NULL and empty texts have
    no features and weight 0. A NULL key is the empty text in the seeded hash. ``row_key`` is
    xxhash64 of key and text, to find the row again. An empty ``target`` is a target without
    features; empty ``docs`` give no rows. Other columns are not read.
    """
    gain = gains(feature_counts(docs, text, run, buckets),
                 feature_counts(target, target_text, run, buckets), buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"),
                                                           F.lit(""))), 256)
    unit = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000.0 * F.log(-F.log(unit)))
    rows = stored(weighed(docs, gain, key, text, run).withColumn(
        "score", F.col("weight") + noise), "resampling-scores")
    able = rows.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    ranked = numbered(able, [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight",
                             "row_key"], "rank")
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(
        rest)


def drawn_documents(docs: DataFrame, ranks: DataFrame, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that :func:`resample` drew. Of repeated rows as
    many stay as were drawn."""
    kept = ranks.where("rank IS NOT NULL").groupBy("row_key").agg(F.count("*").alias("_drawn"))
    all_copies = ranks.groupBy("row_key").agg(F.count("*").alias("_copies"))
    kept = kept.join(all_copies, "row_key").withColumnRenamed("row_key", "_row_key")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    value = F.col("_row")
    found = rows.withColumn("_row_key", F.xxhash64(
        value[key].cast("long"), value[text].cast("string"))).join(kept, "_row_key")
    some = found.where("_drawn < _copies").withColumn("_n", F.row_number().over(
        Window.partitionBy("_row_key").orderBy(F.lit(1)))).where("_n <= _drawn")
    return found.where("_drawn = _copies").select("_row").unionByName(
        some.select("_row")).select("_row.*")
