"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator of one row.

    The optimizer copies a projected expression into every filter above it, and a filter
    on a decoded or cleaned text would then decode or clean the text again per condition.
    It does not look through a generator, so these columns are evaluated once; the plan
    stays a pipeline without a shuffle, for batches and streams alike.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
