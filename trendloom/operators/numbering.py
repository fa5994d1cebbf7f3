"""Gapless row numbers in a global order, without a task that sees all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trendloom.session import work_dir

TASK_BITS = 33  # monotonically_increasing_id keeps the place within the task in the lower bits


def numbered(df: DataFrame, order: list[Column | str], name: str = "id",
             within: list[str] | None = None, start: int = 1) -> DataFrame:
    """Add ``name``: the row's number from ``start`` on in the given order, per group of the
    ``within`` columns if given.

    Rows are dealt out by ranges of the order and sorted there; a number is the place within
    the range plus the rows of the ranges before. Those are one count per task and group, so
    nothing but such counts is ever brought together. The placed rows are written once, which
    makes the numbers repeatable for whatever reads them. Ties are in the order of a hash of
    the row; rows that are equal in all columns are told apart by where they were read, so that
    a great many of them do not meet in one task. An empty table stays empty.
    """
    within = within or []
    plain = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
    keyed = df.select("*", F.xxhash64(*plain).alias("_hash"),
                      F.monotonically_increasing_id().alias("_read"))
    by = [*within, *order, "_hash", "_read"]
    placed = keyed.repartitionByRange(*by).sortWithinPartitions(*by).drop("_hash", "_read")
    placed = placed.withColumn("_at", F.monotonically_increasing_id())
    path = work_dir(df.sparkSession, "numbered")
    placed.write.parquet(path)
    placed = df.sparkSession.read.schema(placed.schema).parquet(path).withColumn(
        "_task", F.shiftright("_at", TASK_BITS))
    counts = placed.groupBy(*within, "_task").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first"))
    if within:
        before = F.sum("_n").over(W.partitionBy(*within).orderBy("_task").rowsBetween(
            W.unboundedPreceding, -1))
        shifts = counts.select(*[F.col(c).alias(f"_of_{c}") for c in within],
                               F.col("_task").alias("_of_task"),
                               (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
        same = [placed[c].eqNullSafe(shifts[f"_of_{c}"]) for c in within]
        rows = placed.join(shifts, [placed["_task"] == shifts["_of_task"], *same])
    else:
        # One row per task of the range shuffle.
        tasks = counts.orderBy("_task").collect()
        ends = accumulate((t["_n"] for t in tasks), initial=0)
        shifts = df.sparkSession.createDataFrame(
            [(t["_task"], before - t["_first"]) for t, before in zip(tasks, ends)],
            "_task long, _shift long")
        rows = placed.join(F.broadcast(shifts), "_task")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns],
                       (F.col("_at") + F.col("_shift") + start).alias(name))
