"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows are shuffled by a seeded hash and ranked within their source; a source of n rows puts its
r-th row at (r - 1/2) / n. In the order of these fractions every stretch has each source in
proportion, so equal cuts give shards that all match the mixture.

Neither a source nor the whole order is ever sorted in one task. Ranks come from buckets of
the sort key: the rows in lower buckets (sums over a count table) plus the rank inside the
bucket. Hashes and fractions are uniform, so all buckets are of one size, about the root of
the number of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.storage import stored

SEED = 20240
ROWS = "rows"


def _ranked(rows: DataFrame, group: list[str], bucket: str, order: list[str],
            name: str) -> DataFrame:
    """Add ``name``: the rank from 0 within ``group`` by (bucket, order)."""
    key = [*group, bucket]
    counts = rows.groupBy(*key).agg(F.count("*").alias("_count"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_of_{c}") for c in key],
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in key]
    joined = rows.join(offsets, same).drop(*[f"_of_{c}" for c in key])
    inside = F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1
    return joined.withColumn(name, F.col("_before") + inside).drop("_before")


def interleaved(rows: DataFrame, source: str, identity: list[str], seed: int = SEED) -> DataFrame:
    """Add ``position`` (from 0, without gaps): the place of each row in the proportional
    interleaving of the sources. ``identity`` names the columns that tell rows apart; rows
    equal in all of them take places next to each other in any order. A NULL source is a
    source. The result depends on the rows and the seed alone."""
    total = rows.count()
    buckets = max(1, math.isqrt(total))
    # 31 bits choose the bucket; the whole hash is the order inside it.
    rows = rows.withColumn("_hash", F.xxhash64(F.lit(seed), *identity)).withColumn(
        "_bucket", F.floor(F.shiftrightunsigned("_hash", 33) * buckets / (1 << 31)).cast("int"))
    order = ["_hash", *identity]
    sizes = rows.groupBy(source).agg(F.count("*").alias("_size"))
    sizes = sizes.withColumnRenamed(source, "_source")
    ranked = _ranked(rows, [source], "_bucket", order, "_rank")
    ranked = ranked.join(sizes, ranked[source].eqNullSafe(sizes["_source"])).drop("_source")
    place = (2 * F.col("_rank") + 1) / (2.0 * F.col("_size"))
    ranked = stored(ranked.withColumn("_place", place).withColumn(
        "_bucket", F.least(F.floor(F.col("_place") * buckets), F.lit(buckets - 1)).cast("int")),
        "interleaving")
    return _ranked(ranked.withColumn("_all", F.lit(0)), ["_all"], "_bucket",
                   ["_place", source, *order], "position").drop(
        "_all", "_bucket", "_hash", "_place", "_rank", "_size")


def cut(position: Column, total: int, shards: int) -> tuple[Column, Column]:
    """(shard, slot) of a place among ``total``: shards of sizes at most one apart, the
    larger ones first."""
    small, larger = divmod(total, shards)
    edge = larger * (small + 1)
    shard = F.when(position < edge, F.floor(position / (small + 1))).otherwise(
        larger + F.floor((position - edge) / max(1, small)))
    start = shard * small + F.least(shard, F.lit(larger))
    return shard.cast("int"), (position - start).cast("long")


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text",
                    source: str = "source", seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, text_crc32, law, shard, slot, grown_shard) per row.

    The law is ``rows``: shard sizes in rows differ by one at most, and ``grown_shard`` is
    NULL. ``size`` is the UTF-8 length of the text plus 16; a NULL text counts no bytes and has
    no checksum. NULL and repeated keys, NULL sources and fewer rows than shards (the first
    shards get one each) are allowed; an empty table gives an empty one. Other columns are
    not read.
    """
    body = F.col(text).cast("string")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("_text"))
    rows = stored(rows, "shard-rows")
    placed = interleaved(rows, "source", ["doc_id", "_text"], seed)
    shard, slot = cut(F.col("position"), rows.count(), shards)
    return placed.select(
        "doc_id", "source", "size", "text_crc32", F.lit(ROWS).alias("law"),
        shard.alias("shard"), slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
