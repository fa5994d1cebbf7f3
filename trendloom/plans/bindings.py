"""Views of the test tables as the two feeds: news articles and a message stream.

The tables hold no tweets, so links, hashtags, keywords and defects are added to whole
document texts by rules on the ids. ``oracle.py`` has the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import schemas
from trendloom.functions.keywords import keyword_string, matched_topics
from trendloom.functions.urls import netloc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_rows(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def every(column: str, n: int, text: str) -> Column:
    return F.when(F.col(column) % n == 0, text).otherwise("")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Links are found for the ids alone, so that texts move once.
    links = docs.select("doc_id").distinct().withColumn(
        "page_id", F.col("doc_id") % n_rows(pages)).join(
        pages.select("page_id", "url"), "page_id", "left").select("doc_id", "url")
    docs = docs.repartition(parts, "doc_id")
    day = F.lpad((1 + F.floor(F.col("doc_id") / 7) % 30).cast("string"), 2, "0")
    return docs.join(links, "doc_id", "left").select(
        "doc_id",
        F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("author"), F.col("doc_id") % 97))
        .alias("author"),
        F.when(F.col("doc_id") % 3 != 0,
               F.concat("lang", F.lit(" [+"), "n_chars", F.lit(" chars]"))).alias("content"),
        F.concat(
            "text", every("doc_id", 6, " machine learning"), every("doc_id", 10, " big data"),
            every("doc_id", 14, " deep learning"), every("doc_id", 15, " artificial intelligence"),
        ).alias("description"),
        F.concat(F.lit("2024-01-"), day, F.lit("T08:00:00Z")).alias("publishedAt"),
        F.col("source").alias("source_name"),
        F.concat(F.lit("Article "), "doc_id").alias("title"),
        "url",
    )


MAX_FILES_CONF = "trendloom.stream.maxFilesPerTrigger"


def events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The events, as a stream of their files if wanted. The session's MAX_FILES_CONF limits
    the files of one micro-batch."""
    batch = table(spark, sf_dir, "events")
    if not stream:
        return batch
    reader = spark.readStream.schema(batch.schema)
    if files := spark.conf.get(MAX_FILES_CONF, None):
        reader = reader.option("maxFilesPerTrigger", files)
    # A pattern stands for the single file as well as for the folder of part files, which a
    # stream would not take and would take by different options.
    return reader.parquet(f"{sf_dir}/events.parque[t]")


def tweets(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    # The events are few bytes a row. They get their links first and are dealt out before texts
    # are joined to them: rows with texts do not move again, and however few files the events
    # come from, the work on the texts is spread.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        events(spark, sf_dir, stream).select("event_id", "ts", "user_id")
        .withColumn("doc_id", F.col("event_id") % n_rows(docs))
        .withColumn("page_id", F.col("event_id") % n_rows(pages))
        .join(pages.select("page_id", "url"), "page_id", "left").repartition(parts, "doc_id")
        .join(docs.select("doc_id", "text", "lang", "source"), "doc_id", "left")
    )
    text = F.concat(
        every("event_id", 5, "RT @user7: "), "text", every("event_id", 3, " #bigdata"),
        every("event_id", 4, " #machinelearning"), every("event_id", 7, " #ai"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" @user"), "user_id")).otherwise(""),
        every("event_id", 6, " machine learning"), every("event_id", 10, " big data"),
        every("event_id", 14, " deep learning"), every("event_id", 15, " artificial intelligence"),
    )
    created = F.concat(F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "),
                       F.date_format("ts", "yyyy"))
    return rows.select(
        F.col("event_id").alias("id"), "ts", "user_id", "lang", "source", "url",
        F.concat(F.lit("user"), "user_id").alias("screen_name"),
        (F.col("user_id") * 7919 % 100000).cast("int").alias("user_followers_count"),
        created.alias("created_at"), F.col("ts").cast("date").alias("created_at_dt"),
        text.alias("text"),
    )


def stored_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets with the matched topics and the host of their link."""
    rows = tweets(spark, sf_dir)
    return rows.withColumn("tweet_matched_words", keyword_string(matched_topics(F.col("text")))) \
        .withColumn("domain", netloc(F.col("url")))


def links(row_id: str = "id") -> Column:
    """The links of a message; some have none, several, or only allow-listed ones."""
    n = F.col(row_id)
    link = F.col("url")
    return (
        F.when(n % 13 == 0, F.array().cast("array<string>"))
        .when(n % 17 == 0, F.array(F.lit(None).cast("string")))
        .when(n % 19 == 0, F.array(F.concat(F.lit("https://twitter.com/user7/status/"), n)))
        .when(n % 7 == 0, F.array(link, F.concat(F.lit("https://en.wikipedia.org/wiki/"), "source")))
        .otherwise(F.array(link))
    )


def messages(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The message stream (key, value, timestamp) with nested JSON values. Some messages
    have no entities, links or text, and some values are cut off."""
    n = F.col("id")
    user = F.struct(
        F.concat(F.lit("User "), "user_id").alias("name"), "screen_name",
        F.col("user_followers_count").alias("followers_count"),
        F.when(F.col("user_id") % 3 != 0, "UTC").alias("time_zone"),
        F.concat(F.lit("City "), F.col("user_id") % 50).alias("location"),
        (F.col("user_id") % 40).alias("listed_count"),
    )
    payload = F.to_json(F.struct(
        "id",
        F.when(n % 23 != 0, F.col("text")).alias("text"),
        "created_at",
        F.when(n % 5 == 0, F.struct(F.lit(7).alias("id"))).alias("retweeted_status"),
        F.when(n % 11 != 0, F.struct(F.transform(
            links(), lambda link: F.struct(link.alias("expanded_url"))).alias("urls"))
        ).alias("entities"),
        user.alias("user"),
        F.when(n % 9 == 0, F.struct(F.lit("Point").alias("type"))).alias("geo"),
        F.when(n % 4 == 0, F.struct(F.lit("US").alias("country"))).alias("place"),
        (n % 100).alias("favorite_count"), (n % 37).alias("retweet_count"),
        (n % 2 == 0).alias("favorited"), (n % 5 == 0).alias("retweeted"),
    ))
    cut_off = F.concat(F.lit('{"id": '), "id", F.lit(', "text": "'), "screen_name")
    return tweets(spark, sf_dir, stream).select(
        F.col("id").cast("string").alias("key"),
        F.when(n % 29 == 0, cut_off).otherwise(payload).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ).select(*schemas.MESSAGE.names)


def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose address carries a query or fragment redirect to the bare address."""
    bare = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, sf_dir, "pages").select("url", bare.alias("location")).where(
        F.col("url") != F.col("location")).distinct()


def lemmas(counts: DataFrame) -> DataFrame:
    """Forms of a vocabulary that are another of its words plus an s."""
    words = counts.select("term")
    plural = words.select(F.col("term").alias("lemma"), F.concat("term", F.lit("s")).alias("term"))
    return words.join(plural, "term").select(F.col("term").alias("form"), "lemma")
