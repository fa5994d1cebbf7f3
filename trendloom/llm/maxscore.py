"""Exact top-k search by MaxScore over sharded postings.

Terms are the components of integer vectors; a shard holds one posting list per term. A
query's terms are ordered by how much they can change a score in the shard. The weakest ones,
whose bounds together cannot lift a row over the k-th best score so far, are non-essential:
the essential postings are traversed, and the others are probed only for rows that are still
competitive. Scores may be negative; bounds are taken from the lowest contribution up.

Queries go to the shards in blocks, and the shards' results are merged. A task holds one shard
and one block of fixed sizes, whatever the number of rows and queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.storage import stored

SCALE = 256
BANDS = (2.0 ** 13, 2.0 ** 22)  # a shard's rows are searched apart by their greatest component
SHARD_ROWS = 16_384
BLOCK_QUERIES = 2_048
WIDE = 280  # bytes of any score: two doubles, both scales and the sum over the terms
CHUNK = 2_048  # rows scored before a threshold is known, and rows traversed at a time


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(SCALE x) / SCALE, which a double holds exactly; large ones are integers as they are."""
    large = np.abs(values) >= 2.0 ** 53
    return np.where(large, values, np.floor(np.where(large, 0.0, values) * SCALE) / SCALE) + 0.0


def exact(terms: np.ndarray, bound: float) -> np.ndarray:
    """SCALE times the terms, in numbers that hold all sums up to ``bound`` exactly."""
    if bound < 2.0 ** 53:
        return terms * SCALE
    if bound < 2.0 ** 62:
        return (terms * SCALE).astype(np.int64)
    whole = np.frompyfunc(lambda t: int(t) * SCALE if abs(t) >= 2.0 ** 53 else int(t * SCALE), 1, 1)
    return whole(terms).astype(object)


def _integers(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, terms): rows with a key and a vector of finite components only. The terms are
    :func:`quantised`."""
    wide = df.select(F.col(key).cast("long").alias("vec_id"),
                     F.col(vector).cast("array<double>").alias("terms"))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, rows = [], []
            for vec in batch.column(1):
                values = None if not vec.is_valid else vec.values
                fine = values is not None and values.null_count == 0
                if fine:
                    values = values.to_numpy(zero_copy_only=False)
                    fine = bool(np.isfinite(values).all())
                keep.append(fine)
                rows.append(quantised(values) if fine else None)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["vec_id", "terms"])
            yield out.filter(pa.array(keep, pa.bool_()))

    return wide.where(F.col("vec_id").isNotNull()).mapInArrow(scaled, "vec_id long, terms array<double>")


def _matrix(terms: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Vectors as rows of the longest one's width, or of the first ``width`` terms; a missing
    component is a term the vector does not have."""
    flat = terms.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks) if flat.num_chunks else pa.array([], terms.type)
    if width is not None:
        flat = pc.list_slice(flat, 0, width) if width else pa.array([[]] * len(flat), terms.type)
    lengths = np.diff(flat.offsets.to_numpy())
    width = int(lengths.max(initial=0)) if width is None else width
    out = np.zeros((len(flat), width), np.float64)
    if len(flat):
        out[np.arange(width) < lengths[:, None]] = flat.flatten().to_numpy()
    return out


def top_k(postings: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int,
          low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """(score, id) of the k best rows of a shard for one query, ids other than ``own``.

    ``ids`` are sorted. ``postings`` has a row per term; ``low`` and ``high`` are its least and greatest weights."""
    floor = np.minimum(query * low, query * high)  # least contribution of each term
    gain = np.maximum(query * low, query * high) - floor
    order = np.argsort(gain, kind="stable")  # weakest first
    reach = np.cumsum(gain[order])
    base = floor.sum()
    others = np.ones(len(ids), bool)
    others[np.searchsorted(ids, own, "left"):np.searchsorted(ids, own, "right")] = False
    best: list[tuple[int, int]] = []
    threshold = -np.inf
    for start in range(0, postings.shape[1], CHUNK):
        block = postings[:, start:start + CHUNK]
        optional = (int(np.searchsorted(reach, threshold - base, side="left"))
                    if len(best) == k else 0)
        essential, probes = order[optional:], order[:optional][::-1]
        # What is in ``score`` after a term: its contributions, with the floor of the rest.
        score = query[essential] @ block[essential] + floor[probes].sum()
        at = np.arange(block.shape[1])
        rest = reach[optional - 1] if optional else 0
        live = (score + rest >= threshold) & others[start:start + CHUNK]
        at, score = at[live], score[live]
        for step in range(0, len(probes), 8):
            if not len(at):
                break
            part = probes[step:step + 8]
            score = score + query[part] @ block[np.ix_(part, at)] - floor[part].sum()
            left = len(probes) - step - len(part)
            rest = reach[left - 1] if left else 0
            live = score + rest >= threshold
            at, score = at[live], score[live]
        if len(at) > 4 * k:  # ties of the k-th stay
            cut = np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[score >= cut], score[score >= cut]
        found = [(int(s), int(i)) for s, i in zip(score, ids[start + at])]
        best = sorted(best + found, key=lambda x: (-x[0], x[1]))[:k]
        threshold = best[-1][0] if len(best) == k else -np.inf
    return best


def search(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding",
           k: int = 5, shard_rows: int = SHARD_ROWS,
           block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products with all rows
    but those of its own key; all rows, if there are fewer. Ties go to the smaller key.

    Components x count as floor(256 x), x as double, and all scores are exact. A score that
    64 bits cannot hold is given as NULL, at its right rank. Vectors that are NULL or hold a NULL or
    non-finite component take no part, nor do rows without a key. A shorter vector has no
    weight in the further terms. Repeated rows are results of their own; repeated query rows
    count once, of different vectors under one key the largest. A shard is as wide as its own
    longest vector. Empty tables give no rows. Other columns are not read.
    """
    rows = stored(_integers(rows, key, vector), "vectors")
    asked = stored(_integers(queries, key, vector).groupBy(F.col("vec_id").alias("query_id")).agg(
        F.max("terms").alias("terms")), "queries")
    n, m = rows.count(), asked.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_queries))
    # Places in files deal rows out evenly, repeated ones too; a retried task deals alike.
    dealt = rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards))
                            .cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        rows = _matrix(left.column("terms"))[order]
        # Terms that no row of the shard has change no score of it.
        asking = _matrix(right.column("terms"), rows.shape[1])
        band = np.searchsorted(BANDS, np.abs(rows).max(axis=1, initial=0), side="right")
        out: list[tuple[int, int, int]] = []
        for one in np.unique(band):
            near = band == one
            # Few distinct bounds and so few forms: every query takes the least that is exact.
            terms = np.ascontiguousarray(rows[near].T)
            forms: dict[type, tuple[np.ndarray, ...]] = {}
            with np.errstate(over="ignore"):
                most = np.abs(terms).max(axis=1)
                # Bounds and scores add up at most four times this.
                bounds = 4.0 * SCALE * SCALE * (np.abs(asking) @ most)
            for query_id, query, bound in zip(right.column("query_id").to_pylist(), asking,
                                              np.nan_to_num(bounds, nan=np.inf).tolist()):
                query = exact(query, bound)
                if query.dtype.type not in forms:
                    postings = exact(terms, bound)
                    forms[query.dtype.type] = (postings, postings.min(axis=1),
                                               postings.max(axis=1))
                postings, low, high = forms[query.dtype.type]
                out += [(query_id, i, s)
                        for s, i in top_k(postings, ids[near], query, query_id, k, low, high)]
        columns = list(zip(*out)) or [[], [], []]
        scores = list(columns[2])
        fits = [-1 << 63 <= s < 1 << 63 for s in scores]
        # Beyond 64 bits a score is ordered by its sign, then as an unsigned number of WIDE bytes.
        return pa.table({
            "query_id": pa.array(list(columns[0]), pa.int64()),
            "vec_id": pa.array(list(columns[1]), pa.int64()),
            "score": pa.array([s if fit else None for s, fit in zip(scores, fits)], pa.int64()),
            "beyond": pa.array([0 if fit else 1 if s > 0 else -1 for s, fit in zip(scores, fits)],
                               pa.int32()),
            "wide": pa.array([None if fit else (s + (1 << 8 * WIDE - 1)).to_bytes(WIDE, "big")
                              for s, fit in zip(scores, fits)], pa.binary())})

    found = dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        searched, "query_id long, vec_id long, score long, beyond int, wide binary")
    order = Window.partitionBy("query_id").orderBy(
        F.col("beyond").desc(), F.col("score").desc(), F.col("wide").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
