"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.session import work_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back. This cuts the lineage,
    and lost executors cost nothing that was finished."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20  # of rows that Python workers take at once; one longer row is a batch


def bounded_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """From now on this session's Arrow batches are cut by bytes as well as by rows, so that a
    batch of very long texts does not fill a worker's memory. A lower limit of the session's
    own stays."""
    set_before = spark.conf.get(BATCH_CONF).lower()
    if not set_before.rstrip("b").isdigit() or int(set_before.rstrip("b")) > limit:
        spark.conf.set(BATCH_CONF, limit)


FILTER_BITS = 23  # 1 MB, whatever the number of keys


def key_bits(keys: DataFrame, key: str) -> Broadcast:
    """A bitmap of fixed size of the keys, for :func:`has_bits`."""
    bit = F.pmod(F.col(key), F.lit(1 << FILTER_BITS))
    parts = keys.groupBy(F.shiftright(bit, 15).alias("part")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(32767)).alias("bits"))
    bitmap = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    # 1 MB at most, in one job: an iterator would start one for each partition.
    for row in parts.collect():
        bitmap[row["part"] << 12:(row["part"] + 1) << 12] = np.frombuffer(row["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def has_bits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the bitmap; all that are in it may."""
    bits = keys & ((1 << FILTER_BITS) - 1)
    return (bitmap[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)


def rows_by_bits(df: DataFrame, shared: Broadcast, inside: bool) -> DataFrame:
    """The rows of ``df`` whose first column may be in the bitmap, or those that cannot."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = has_bits(shared.value, batch.column(0).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(found == inside))

    return df.mapInArrow(kept, df.schema)


def rows_with_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Most of the rows of ``df`` whose first column is not among the keys taken out before a
    join moves them; the join stays exact without this. A bitmap of fixed size tells."""
    return rows_by_bits(df, key_bits(keys, key), True)
