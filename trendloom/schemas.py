"""Schemas of the raw and stored tables (all columns nullable)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()  # noqa: E741
D, TS, NTZ = T.DoubleType(), T.TimestampType(), T.TimestampNTZType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


NEWS = struct(author=S, content=S, description=S, publishedAt=S, source_name=S, title=S, url=S)

TWEETS = struct(
    domain=S, tweet_match_count=I, user_followers_count=I, text=S, mention=S, user_loc=S,
    tweet_geo=S, screen_name=S, url=S, created_at=S, user_time_zone=S, twitter_RT=S,
    tweet_favorite_count=I, retweet_status=I, tweet_place=S, tweet_coordinates=S,
    tweet_matched_words=S, user_name=S, tweet_retweet_count=I,
)

# Stream payload. Ids are read as text so that no id is too long for the schema;
# geo, coordinates, place and retweeted_status stay JSON text.
CORRUPT = "_corrupt"
TWEET_JSON = struct(
    id=S, text=S, created_at=S, retweeted_status=S,
    entities=struct(urls=T.ArrayType(struct(expanded_url=S))),
    user=struct(name=S, screen_name=S, followers_count=I, time_zone=S, location=S, listed_count=I),
    geo=S, coordinates=S, place=S, favorite_count=I, retweet_count=I, favorited=B, retweeted=B,
    **{CORRUPT: S},
)

MESSAGE = struct(key=S, value=S, timestamp=TS)

FLAT_TWEET_COLUMNS = [
    "id", "retweet_status", "created_at", "text", "tweet_match_count",
    "tweet_matched_words", "user_name", "screen_name", "user_followers_count", "url",
    "user_time_zone", "user_loc", "mention", "domain", "twitter_RT",
    "user_listed_count", "tweet_geo", "tweet_coordinates", "tweet_place",
    "tweet_favorite_count", "tweet_retweet_count", "tweet_favorited", "tweet_retweeted",
]

# Tables the streaming jobs keep, one folder per batch.
# Blocks of term counts: their topic, stretch of time, whether windows of the stretch before
# reach them, part of the terms, the slides that have documents, and the day they are of.
PACKED = struct(topic=S, stretch=L, head=B, part=I, parts=I, slides=T.ArrayType(L),
                block=T.BinaryType(), day=I)
TREND_REPORT = struct(window_start=NTZ, window_end=NTZ, topic=S, rank=I, term=S, score=D,
                      emitted_at=TS)
PAIR_REPORT = struct(window_start=NTZ, window_end=NTZ, topic=S, rank=I, term=S, id=S, score=D,
                     emitted_at=TS)
OUTCOME_COUNTS = struct(slide=L, inbound=L, matched=L, cleaned=L, not_matched=L, errored=L)
VALUE_COUNTS = struct(slide=L, kind=S, value=S, n=L)
HASHTAG_COUNTS = struct(slide=L, metric=S, hashtag=S, n=L)
MARK = struct(limit=L, latest=L)
