"""Dates out of the two feeds' text formats; anything unreadable becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
          "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def iso_date(published_at: Column) -> Column:
    """``2019-02-03T10:00:00Z`` -> date."""
    return F.split_part(published_at, F.lit("T"), F.lit(1)).try_cast("date")


def tweet_date_string(created_at: Column) -> Column:
    """``Wed Aug 27 13:08:45 +0000 2008`` -> ``2008-08-27``."""
    parts = F.split(created_at, " ")
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.get(parts, 1))
    month = F.when(number > 0, F.lpad(number.cast("string"), 2, "0"))
    date = F.concat(F.get(parts, 5), F.lit("-"), month, F.lit("-"), F.get(parts, 2))
    return date


def tweet_date(created_at: Column) -> Column:
    return tweet_date_string(created_at).try_cast("date")
