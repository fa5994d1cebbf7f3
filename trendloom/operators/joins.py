"""Joins that survive a key holding a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000  # rows of one key that one task may take
# Keys above that weight number total / ROWS_PER_TASK at most; the weight rises with the total
# where this would be more keys than these. That bounds what is broadcast.
MOST_HOT = 100_000


def hot_keys(counts: DataFrame, key: str, weight: str, salts: str,
             rows: int = ROWS_PER_TASK) -> DataFrame:
    """(key, salts) of the keys too heavy for one task, out of one row per key: into how many
    parts each is to be split."""
    total = counts.agg(F.sum(weight)).scalar()
    share = F.greatest(F.lit(rows), F.ceil(total / MOST_HOT))
    return counts.where((F.col(weight) > share) & F.col(key).isNotNull()).select(
        F.col(key).alias("_hot_key"), F.ceil(F.col(weight) / share).cast("int").alias(salts))


SMALL_ROWS = 1_000_000  # narrow rows that every task may hold


def small_or_not(rows: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """Narrow rows to be joined: broadcast if a count shows that they are few, and left to
    Spark otherwise."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def skew_join(left: DataFrame, right: DataFrame, key: str, spread: list[str],
              how: str = "inner", counts: DataFrame | None = None,
              right_spread: list[str] | None = None, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Equi-join on ``key`` in which no task takes more than about ``rows`` rows of a key from
    either side.

    Rows of a heavy key get a part number from a hash of the ``spread`` columns (repeatable,
    so a retried task gives the same rows), as many parts as the key's weight asks for; the
    other side's rows of that key are repeated once per part. All other rows move once.
    ``counts`` is (key, weight) of the left side with one row per key; without it that column
    is counted first. The right side is split only if ``right_spread`` is given, which needs
    an inner join; leave it out where the right side has few rows per key.
    """
    if right_spread and how != "inner":
        raise ValueError("only an inner join can split its right side")

    def weights(side: DataFrame) -> DataFrame:
        return side.groupBy(key).agg(F.count("*").alias("_weight"))

    counts = weights(left) if counts is None else counts
    weight = next(c for c in counts.columns if c != key)
    left_hot = F.broadcast(hot_keys(counts, key, weight, "_left_parts", rows))
    right_hot = F.broadcast(hot_keys(weights(right), key, "_weight", "_right_parts", rows)) \
        if right_spread else None

    def marked(side: DataFrame) -> DataFrame:
        for hot in filter(None, (left_hot, right_hot)):
            side = side.join(hot, side[key] == hot["_hot_key"], "left").drop("_hot_key")
        parts = ["_left_parts"] + ["_right_parts"] * (right_hot is not None)
        return side.withColumns({c: F.coalesce(c, F.lit(1)) for c in parts})

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    # A NULL key matches nothing, so its rows may go anywhere.
    part = F.pmod(F.xxhash64(*spread), F.when(F.col(key).isNull(), 64)
                  .otherwise(F.col("_left_parts"))).cast("int")
    salted = marked(left).withColumn("_left_part", part)
    repeated = marked(right).withColumn("_left_part", every("_left_parts"))
    on = [key, "_left_part"]
    if right_hot is not None:
        salted = salted.withColumn("_right_part", every("_right_parts"))
        repeated = repeated.withColumn("_right_part", F.pmod(
            F.xxhash64(*right_spread), F.col("_right_parts")).cast("int"))
        on.append("_right_part")
    helpers = ["_left_parts", "_right_parts"]
    return salted.drop(*helpers).join(repeated.drop(*helpers), on, how).drop(
        "_left_part", "_right_part")


def tweet_links(tweets: DataFrame, url: str = "url") -> DataFrame:
    """One row per link of a comma-joined link column."""
    return tweets.withColumn(url, F.explode(F.split(url, ",")))


def url_join(tweets: DataFrame, news: DataFrame, tweet_id: str = "id",
             explode_urls: bool = False, news_id: str = "doc_id") -> DataFrame:
    """Every (tweet, article) pair with the same URL; the URL appears once.

    A tweet with several links has them comma-joined and matches no article, unless
    ``explode_urls`` splits them.
    """
    left = tweet_links(tweets) if explode_urls else tweets
    return skew_join(left, news, "url", [tweet_id], right_spread=[news_id])


URL_BUCKETS = 200


def save_for_join(sides: dict[str, DataFrame], key: str, buckets: int = URL_BUCKETS,
                  rows: int = ROWS_PER_TASK) -> None:
    """Save two tables for joins on ``key`` that move nothing.

    Both are bucketed and sorted by the key. A key that is heavy on either side would make its
    bucket heavy as well; its rows go into a table of their own, ``<name>_hot``.
    """
    keys = [hot_keys(df.groupBy(key).agg(F.count("*").alias("_weight")), key, "_weight", "_parts",
                     rows).select("_hot_key") for df in sides.values()]
    hot = F.broadcast(keys[0].unionByName(keys[1]).distinct())
    for name, df in sides.items():
        heavy = df[key] == hot["_hot_key"]
        df.join(hot, heavy, "left_anti").repartition(buckets, key).write.mode(
            "overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
        df.join(hot, heavy, "left_semi").write.mode("overwrite").saveAsTable(f"{name}_hot")


def url_join_tables(spark: SparkSession, tweets: str, news: str, url: str = "url",
                    tweet_id: str = "id", news_id: str = "doc_id") -> DataFrame:
    """:func:`url_join` of two tables of :func:`save_for_join`: bucket by bucket, without a
    shuffle, for all but the heavy keys, which are split."""
    even = spark.table(tweets).join(spark.table(news).hint("merge"), url)
    heavy = skew_join(spark.table(f"{tweets}_hot"), spark.table(f"{news}_hot"), url, [tweet_id],
                      right_spread=[news_id])
    return even.unionByName(heavy)


def url_join_counts(tweets: DataFrame, news: DataFrame) -> DataFrame:
    """Number of joined rows and of distinct URLs in :func:`url_join`, without building
    the pairs: both sides are counted per URL first."""
    shared = tweets.groupBy("url").agg(F.count("*").alias("n_tweets")).join(
        news.groupBy("url").agg(F.count("*").alias("n_news")), "url"
    )
    return shared.agg(
        F.count("*").alias("n_urls"),
        F.coalesce(F.sum(F.col("n_tweets") * F.col("n_news")), F.lit(0)).alias("n_rows"),
    )


def all_content(*columns: str):
    """The texts joined by blanks, skipping NULLs."""
    return F.concat_ws(" ", *columns)


def content_length(*columns: str) -> Column:
    """Characters of :func:`all_content`; NULL if all texts are NULL."""
    some = F.coalesce(*[F.col(c) for c in columns]).isNotNull()
    return F.when(some, F.length(all_content(*columns))).cast("bigint")


def joined_length(*lengths: str) -> Column:
    """Characters of the texts of some :func:`content_length` joined by blanks."""
    known = F.array_compact(F.array(*lengths))
    return F.aggregate(known, F.greatest(F.size(known) - 1, F.lit(0)).cast("bigint"),
                       lambda total, n: total + n)


def replacements(rows: DataFrame, row_id: str, values: str, table: DataFrame, old: str,
                 new: str) -> DataFrame:
    """Replace the elements of an array column that ``table(old, new)``, one row per ``old``,
    knows. Only elements that are replaced move: each row's distinct elements meet the table
    in an inner join, and the row gets back a small map. A row whose id is shared by several
    rows gets their common map, which is the same for each element.
    """
    pairs = table.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    # The outer form: the plain one would test the array's size in an extra filter below.
    known = rows.select(row_id, F.explode_outer(F.array_distinct(values)).alias("_old")).join(
        pairs, "_old").select(row_id, "_old", "_new").distinct()
    maps = known.groupBy(row_id).agg(F.map_from_entries(
        F.collect_list(F.struct("_old", "_new"))).alias("_map"))
    found = rows.join(maps, row_id, "left")
    return found.withColumn(values, F.when(F.col("_map").isNull(), F.col(values)).otherwise(
        F.transform(values, lambda v: F.coalesce(F.element_at("_map", v), v)))).drop("_map")


def resolve_redirects(tweets: DataFrame, redirects: DataFrame, tweet_id: str = "id",
                      urls: str = "urls") -> DataFrame:
    """Replace each link of an array column by its target in ``redirects(url, location)``.

    One hop, no network. NULL and empty arrays and NULL links stay what they were.
    """
    return replacements(tweets, tweet_id, urls, redirects, "url", "location")
