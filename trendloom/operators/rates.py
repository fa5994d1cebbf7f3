"""Daily and overall counts, shares and rankings of the two feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trendloom.dictionaries import CHART_TOPICS
from trendloom.operators.joins import small_or_not


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def with_share(counts: DataFrame, count: str, share: str) -> DataFrame:
    """Each count over the sum of all counts. The sum is taken from the counts, as a
    scalar subquery, so that the raw rows are aggregated once and no task sees all rows."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.col(count) / total)


def share_by(df: DataFrame, key: str, count: str = "count",
             share: str = "relative_rank") -> DataFrame:
    """Rows per key and their share of all rows."""
    return with_share(count_by(df, key, name=count), count, share)


def top_shares(df: DataFrame, key: str, k: int = 15) -> DataFrame:
    """The k most frequent values with their shares."""
    return share_by(df, key).orderBy(F.desc("count"), key).limit(k)


def top_per_day(df: DataFrame, day: str, key: str, k: int = 3) -> DataFrame:
    """The k most frequent values of each day. Each task keeps its own first k rows of a
    day before the shuffle, so a day with very many values is no problem."""
    ranked = W.partitionBy(day).orderBy(F.desc("count"), key)
    return (
        count_by(df, day, key)
        .withColumn("row_number", F.row_number().over(ranked))
        .where(F.col("row_number") <= k)
    )


def ranked_per_day(df: DataFrame, day: str, key: str) -> DataFrame:
    """All values of each day with their place in the day's order: most frequent first, then
    by name. A day has one row per value, so no day holds its raw rows in one task."""
    place = F.row_number().over(W.partitionBy(day).orderBy(F.desc("count"), key))
    return count_by(df, day, key).withColumn("position", place)


def rate_by_day(df: DataFrame, day: str, keywords: str) -> DataFrame:
    """Rows per (day, keyword combination) over all rows of that day.

    The daily totals are sums of the counts already made; a day has at most one count per
    combination of topics. Rows without a day get no total, as in an equi-join.
    """
    counts = count_by(df, day, keywords, name="count_matched")
    total = F.sum("count_matched").over(W.partitionBy(day))
    return counts.withColumn(
        "total", F.when(F.col(day).isNotNull(), total)
    ).withColumn("relative_count", F.col("count_matched") / F.col("total"))


def topic_rate_by_day(df: DataFrame, day: str, topics: str) -> DataFrame:
    """Rows per (day, single topic) over all rows of that day; a row with two topics
    counts for both."""
    totals = count_by(df, day, name="total")
    counts = count_by(df.select(day, F.explode_outer(topics).alias("topic"))
                      .where(F.col("topic").isNotNull()), day, "topic", name="count_matched")
    # Both sides have one row per day and topic at most.
    return counts.join(totals, day, "left").withColumn(
        "relative_count", F.col("count_matched") / F.col("total"))


def keyword_pivot(rates: DataFrame, day: str, keywords: str,
                  topics: Sequence[str] = CHART_TOPICS) -> DataFrame:
    """One row per day, one rate column per topic; single-topic rows only."""
    names = {topic: topic.lower().replace(" ", "_") for topic in topics}
    return rates.where(F.col(keywords).isin(*topics)).groupBy(day).agg(*[
        F.max(F.when(F.col(keywords) == topic, F.col("relative_count"))).alias(name)
        for topic, name in names.items()
    ])


def date_range(df: DataFrame, day: str) -> tuple[Column, Column]:
    """First and last day of a feed as scalar subqueries."""
    return df.agg(F.min(day)).scalar(), df.agg(F.max(day)).scalar()


def within_days_of(df: DataFrame, day: str, other: DataFrame, other_day: str) -> DataFrame:
    """Rows whose day lies in the date range of another feed."""
    first, last = date_range(other, other_day)
    return df.where(F.col(day).between(first, last))


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def influencers(tweets: DataFrame) -> DataFrame:
    """Posts per account and follower count."""
    return count_by(tweets, "screen_name", "user_followers_count", name="count_posting")


INFLUENCER_ORDERS: Mapping[str, Sequence[str]] = {
    "followers": ("user_followers_count", "count_posting"),
    "posts": ("count_posting", "user_followers_count"),
}


def influencer_keys(order: str) -> list[Column]:
    first, second = INFLUENCER_ORDERS[order]
    return [F.desc(first), F.desc(second), F.col("screen_name")]


def sorted_influencers(tweets: DataFrame, order: str = "posts") -> DataFrame:
    """All accounts in order: a range-partitioned sort, no task has all rows."""
    return influencers(tweets).orderBy(*influencer_keys(order))


def top_influencers(tweets: DataFrame, order: str = "posts", k: int = 20) -> DataFrame:
    """The first k accounts with their rank, bubble size and chart position."""
    keys = influencer_keys(order)
    top = sorted_influencers(tweets, order).limit(k)
    # Numbers at most k rows, hence one task.
    return top.withColumn("rank", F.row_number().over(W.orderBy(*keys))).select(
        F.lit(order).alias("ordering"), "rank", "screen_name", "user_followers_count",
        "count_posting", (F.col("user_followers_count") / 1000).alias("bubble_size"),
        (2 * F.col("rank") - 1).alias("x"),
    )


def first_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the first in the given order. Each task drops all but its own
    first row of a key before the shuffle."""
    ranked = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(ranked)).where("_n = 1").drop("_n")


def first_rows(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """:func:`first_per_key` of wide rows: the first ones are found by key and order alone, and
    only rows that have these move whole."""
    first = small_or_not(first_per_key(df.select(key, *dict.fromkeys(order)), key,
                                       *[F.col(c) for c in order]))
    names = list(dict.fromkeys([key, *order]))
    first = first.select(*[F.col(c).alias(f"_first_{c}") for c in names])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_first_{c}")) for c in names])
    return first_per_key(df.join(first, same, "left_semi"), key, *[F.col(c) for c in order])


def shared_news(tweets: DataFrame, news: DataFrame, tweet_order: Sequence[str],
                news_order: Sequence[str]) -> DataFrame:
    """One (tweet, article) row per URL both feeds have: the first tweet with the first
    article. Both sides are cut to one row per URL before they meet."""
    left = first_rows(tweets.where(F.col("url").isNotNull()), "url", tweet_order)
    right = first_rows(news.where(F.col("url").isNotNull()), "url", news_order)
    return left.join(right, "url")
