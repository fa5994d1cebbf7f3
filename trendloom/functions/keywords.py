"""Keyword, hashtag and ingest predicates as native columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.dictionaries import HASHTAGS, TOPICS, TRACK, TRACK_LANGUAGES


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when any of the words is a substring of the text (case-sensitive)."""
    return reduce(lambda a, b: a | b, [text.contains(word) for word in words])


def matched_topics(text: Column, topics: Mapping[str, Sequence[str]] = TOPICS) -> Column:
    """Sorted array of the topics one of whose synonyms occurs; empty for NULL text."""
    return F.array_compact(F.array(*[
        F.when(contains_any(text, topics[name]), F.lit(name)) for name in sorted(topics)
    ]))


def keyword_string(topics: Column) -> Column:
    """The matched topics as one group key, e.g. ``AI,Big data``."""
    return F.array_join(topics, ",")


def hit_topics(text: Column, hashtags: Mapping[str, str] = HASHTAGS) -> Column:
    """Array of the trend topics whose hashtag occurs in the lower-cased text."""
    lowered = F.lower(text)
    return F.array_compact(F.array(*[
        F.when(lowered.contains(tag), F.lit(topic)) for tag, topic in hashtags.items()
    ]))


def is_tracked(text: Column, lang: Column, track: Sequence[str] = TRACK,
               languages: Sequence[str] = TRACK_LANGUAGES) -> Column:
    """Ingest filter: one of the languages and any of the phrases, ignoring case."""
    phrases = list(dict.fromkeys(phrase.lower() for phrase in track))
    return lang.isin(*languages) & contains_any(F.lower(text), phrases)
