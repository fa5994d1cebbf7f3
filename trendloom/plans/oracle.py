"""SQL building blocks: the bindings and the text functions in DuckDB's dialect.

They are written from the definitions, not from the Spark plans: windows are expanded per
document, scores are joined per document, topics are tested one by one.
"""

from __future__ import annotations

from trendloom import dictionaries as d
from trendloom.functions import stem
from trendloom.functions.text import UNICODE_SPACE
from trendloom.functions.urls import NETLOC, PRIMARY_DOMAIN


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(lit(word) for word in words) + ")"


def every(column: str, n: int, text: str) -> str:
    return f"CASE WHEN {column} % {n} = 0 THEN {lit(text)} ELSE '' END"


def topics(text: str, dictionary=d.TOPICS) -> str:
    cases = []
    for name in sorted(dictionary):
        tests = " OR ".join(f"contains({text}, {lit(word)})" for word in dictionary[name])
        cases.append(f"CASE WHEN {tests} THEN {lit(name)} END")
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


def hits(text: str) -> str:
    cases = [f"CASE WHEN contains(lower({text}), {lit(tag)}) THEN {lit(topic)} END"
             for tag, topic in d.HASHTAGS.items()]
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


def netloc(url: str) -> str:
    return f"regexp_extract({url}, {lit(NETLOC)}, 1)"


def primary(host: str) -> str:
    return f"coalesce(nullif(regexp_extract({host}, {lit(PRIMARY_DOMAIN)}, 1), ''), {host})"


def normalize(text: str) -> str:
    single = {char: plain for char, plain in d.PUNCTUATION.items() if len(plain) == 1}
    out = f"translate({text}, {lit(''.join(single))}, {lit(''.join(single.values()))})"
    for char, plain in d.PUNCTUATION.items():
        if char not in single:
            out = f"replace({out}, {lit(char)}, {lit(plain)})"
    for char, plain in d.PUNCTUATION.items():
        out = f"replace({out}, {lit(d.literal_escape(char))}, {lit(plain)})"
    return out


def tokens_a(text: str) -> str:
    out = f"regexp_replace(replace({text}, chr(10), ' '), '(?s)https+.*', '')"
    out = f"regexp_replace({normalize(out)}, '@\\w+', '', 'g')"
    out = f"string_split(lower(regexp_replace({out}, '[^a-zA-Z]+', ' ', 'g')), ' ')"
    return (f"list_filter({out}, lambda x: x <> 'rt' AND length(x) > 3 "
            f"AND x NOT IN {in_list(d.STOP_WORDS)})")


def raw_tokens_b(text: str) -> str:
    out = f"lower(replace({normalize(f"replace({text}, '\\n', ' ')")}, 'b''', ''))"
    for phrase, word in d.PHRASES.items():
        out = f"replace({out}, {lit(phrase)}, {lit(word)})"
    out = f"string_split_regex({out}, '[ \\t\\n\\x0B\\f\\r]+')"
    out = (f"list_filter({out}, lambda x: NOT contains(x, 'http') AND NOT starts_with(x, '@') "
           f"AND x <> 'rt')")
    out = f"list_transform({out}, lambda x: regexp_replace(x, '[^a-z]', '', 'g'))"
    return f"list_filter({out}, lambda x: x <> '' AND x NOT IN {in_list(d.STOP_WORDS_STREAM)})"


def tokens_c(text: str, drop: str = "\\u", extra: str = "") -> str:
    out = f"string_split_regex(lower({text}), {lit(UNICODE_SPACE)})"
    out = f"list_transform({out}, lambda x: rtrim(x, ','))"
    out = (f"list_filter({out}, lambda x: NOT contains(x, {lit(drop)}) {extra}"
           f"AND x NOT IN {in_list(d.STOP_WORDS_NEWS)})")
    out = f"list_transform({out}, lambda x: regexp_replace(x, '[^a-zA-Z]', '', 'g'))"
    return f"list_filter({out}, lambda x: length(x) > 3 OR x IN {in_list(d.SHORT_TERMS)})"


def tokens_d(text: str) -> str:
    out = f"replace(replace({text}, '\\n', ' '), 'b''', '')"
    return tokens_c(out, extra="AND NOT contains(x, 'http') AND x <> 'rt' ")


def _suffix_cte(name: str, source: str, rules: dict[str, str], condition: str) -> str:
    pattern = lit("^(.*?)(" + "|".join(rules) + ")$")
    cases = " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in rules.items())
    return f"""
{name}_x AS (SELECT term, w, regexp_extract(w, {pattern}, 1) AS s,
    regexp_extract(w, {pattern}, 2) AS x FROM {source}),
{name} AS (SELECT term, CASE WHEN x <> '' AND {condition}
    THEN s || CASE x {cases} END ELSE w END AS w FROM {name}_x)"""


def stem_ctes(source: str) -> str:
    """CTEs ending in ``stems(term, stem)`` for the distinct words of ``source(term)``."""
    def has(pattern: str, column: str = "s") -> str:
        return f"regexp_matches({column}, {lit(pattern)})"

    step4 = lit("^(.*?)(" + "|".join(stem.STEP_4) + ")$")
    return f"""
p0 AS (SELECT term, regexp_replace(term, '^y', 'Y') AS w FROM (SELECT DISTINCT term FROM {source})),
{_suffix_cte('p1a', 'p0', stem.STEP_1A, 'true').strip()},
p1b_x AS (SELECT term, w, regexp_extract(w, '^(.*?)(eed|ed|ing)$', 1) AS s,
    regexp_extract(w, '^(.*?)(eed|ed|ing)$', 2) AS x FROM p1a),
p1b AS (SELECT term, CASE
    WHEN x = 'eed' THEN CASE WHEN {has(stem.M_ABOVE_0)} THEN s || 'ee' ELSE w END
    WHEN x <> '' AND {has(stem.HAS_VOWEL)} THEN CASE
        WHEN {has('(?:at|bl|iz)$')} THEN s || 'e'
        WHEN {has(stem.DOUBLED)} THEN left(s, length(s) - 1)
        WHEN {has(stem.SHORT)} THEN s || 'e'
        ELSE s END
    ELSE w END AS w FROM p1b_x),
p1c AS (SELECT term, CASE WHEN w LIKE '%y' AND {has(stem.HAS_VOWEL, "left(w, length(w) - 1)")}
    THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM p1b),
{_suffix_cte('p2', 'p1c', stem.STEP_2, has(stem.M_ABOVE_0)).strip()},
{_suffix_cte('p3', 'p2', stem.STEP_3, has(stem.M_ABOVE_0)).strip()},
p4_x AS (SELECT term, w, CASE WHEN regexp_matches(w, '[st]ion$') THEN left(w, length(w) - 3)
    WHEN regexp_matches(w, {step4}) THEN regexp_extract(w, {step4}, 1) END AS s FROM p3),
p4 AS (SELECT term, CASE WHEN s IS NOT NULL AND {has(stem.M_ABOVE_1)} THEN s ELSE w END AS w
    FROM p4_x),
p5a_x AS (SELECT term, w, left(w, length(w) - 1) AS s FROM p4),
p5a AS (SELECT term, CASE WHEN w LIKE '%e' AND ({has(stem.M_ABOVE_1)} OR
    ({has(stem.M_EQUALS_1)} AND NOT {has(stem.SHORT)})) THEN s ELSE w END AS w FROM p5a_x),
p5b AS (SELECT term, CASE WHEN w LIKE '%ll' AND {has(stem.M_ABOVE_1, 'w')}
    THEN left(w, length(w) - 1) ELSE w END AS w FROM p5a),
stems AS (SELECT term, CASE WHEN length(term) <= 2 THEN term
    ELSE regexp_replace(w, '^Y', 'y') END AS stem FROM p5b)"""


NEWS = f"""
news AS MATERIALIZED (
  SELECT d.doc_id,
    CASE WHEN d.doc_id % 4 <> 0 THEN 'author' || (d.doc_id % 97) END AS author,
    CASE WHEN d.doc_id % 3 <> 0 THEN d.lang || ' [+' || d.n_chars || ' chars]' END AS content,
    d.text || {every('d.doc_id', 6, ' machine learning')} || {every('d.doc_id', 10, ' big data')}
      || {every('d.doc_id', 14, ' deep learning')}
      || {every('d.doc_id', 15, ' artificial intelligence')} AS description,
    '2024-01-' || lpad(CAST(1 + (d.doc_id // 7) % 30 AS VARCHAR), 2, '0') || 'T08:00:00Z'
      AS "publishedAt",
    d.source AS source_name, 'Article ' || d.doc_id AS title, p.url
  FROM documents d
  LEFT JOIN pages p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages)
)"""

TWEETS = f"""
tweets AS MATERIALIZED (
  SELECT e.event_id AS id, e.ts, e.user_id, d.lang, d.source, p.url,
    'user' || e.user_id AS screen_name,
    CAST(e.user_id * 7919 % 100000 AS INTEGER) AS user_followers_count,
    strftime(e.ts, '%a %b %d %H:%M:%S') || ' +0000 ' || strftime(e.ts, '%Y') AS created_at,
    CAST(e.ts AS DATE) AS created_at_dt,
    {every('e.event_id', 5, 'RT @user7: ')} || d.text || {every('e.event_id', 3, ' #bigdata')}
      || {every('e.event_id', 4, ' #machinelearning')} || {every('e.event_id', 7, ' #ai')}
      || CASE WHEN e.event_id % 2 = 0 THEN ' @user' || e.user_id ELSE '' END
      || {every('e.event_id', 6, ' machine learning')} || {every('e.event_id', 10, ' big data')}
      || {every('e.event_id', 14, ' deep learning')}
      || {every('e.event_id', 15, ' artificial intelligence')} AS text
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
  LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
)"""

STORED = f"""
stored AS (
  SELECT *, array_to_string({topics('text')}, ',') AS tweet_matched_words,
    {netloc('url')} AS domain
  FROM tweets
)"""

CLEANED_NEWS = f"""
cleaned_news AS (
  SELECT *, TRY_CAST(split_part("publishedAt", 'T', 1) AS DATE) AS "PublishedDate",
    array_to_string({topics('description')}, ',') AS matched_keywords
  FROM news
)"""

IN_RANGE = """
in_range AS (
  SELECT * FROM cleaned_news WHERE "PublishedDate" BETWEEN
    (SELECT min(created_at_dt) FROM tweets) AND (SELECT max(created_at_dt) FROM tweets)
)"""

# The links alone, without the texts.
LINK_ROWS = """
link_rows AS (
  SELECT id, CASE WHEN id % 13 = 0 THEN CAST([] AS VARCHAR[])
      WHEN id % 17 = 0 THEN [CAST(NULL AS VARCHAR)]
      WHEN id % 19 = 0 THEN ['https://twitter.com/user7/status/' || id]
      WHEN id % 7 = 0 THEN [url, 'https://en.wikipedia.org/wiki/' || source]
      ELSE [url] END AS links
  FROM (SELECT e.event_id AS id, p.url, d.source FROM events e
    LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
    LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages))
)"""

# The defects of bindings.messages, and the links behind them.
PROCESSED = f"""
linked AS (
  SELECT *, CASE
      WHEN id % 13 = 0 THEN CAST([] AS VARCHAR[])
      WHEN id % 17 = 0 THEN [CAST(NULL AS VARCHAR)]
      WHEN id % 19 = 0 THEN ['https://twitter.com/user7/status/' || id]
      WHEN id % 7 = 0 THEN [url, 'https://en.wikipedia.org/wiki/' || source]
      ELSE [url] END AS links
  FROM tweets
),
processed AS (
  SELECT *, {topics('text')} AS words,
    list_transform(links, lambda x: {primary(netloc('x'))}) AS primary_domains,
    CASE WHEN id % 29 = 0 THEN -102
      WHEN id % 11 = 0 THEN -2
      WHEN len(links) = 0 THEN -3
      WHEN list_contains(list_transform(links, lambda x: x IS NULL), true) THEN -104
      WHEN len(list_filter(list_transform(links, lambda x: {primary(netloc('x'))}),
        lambda x: x NOT IN {in_list(d.ALLOWED_DOMAINS)})) = 0 THEN -8
      WHEN id % 23 = 0 THEN -101
      ELSE CAST(len({topics('text')}) AS INTEGER) END AS code
  FROM linked
),
routed AS (
  SELECT *, CASE WHEN code >= 1 THEN 'matched' WHEN code <= -100 THEN 'error'
    ELSE 'not_matched' END AS route
  FROM processed
)"""

# The same with links resolved before anything is done with them.
RESOLVED = PROCESSED.replace("linked AS (", "unresolved AS (", 1).replace("processed AS (", """
resolved AS (
  SELECT id, list(coalesce(location, link) ORDER BY pos) AS targets
  FROM (SELECT id, unnest(links) AS link, unnest(range(len(links))) AS pos FROM unresolved)
  LEFT JOIN redirects ON redirects.url = link GROUP BY id
),
linked AS (
  SELECT u.* REPLACE (coalesce(targets, links) AS links) FROM unresolved u
  LEFT JOIN resolved USING (id)
),
processed AS (""", 1)

FLAT = f"""
flat AS (
  SELECT CAST(id AS VARCHAR) AS id, CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END AS retweet_status,
    created_at, {normalize('text')} AS text, code AS tweet_match_count,
    array_to_string(words, ',') AS tweet_matched_words, 'User ' || user_id AS user_name,
    screen_name, user_followers_count, array_to_string(links, ',') AS url,
    CASE WHEN user_id % 3 <> 0 THEN 'UTC' END AS user_time_zone,
    'City ' || (user_id % 50) AS user_loc,
    array_to_string(regexp_extract_all(text, '@(\\w+)', 1), ',') AS mention,
    array_to_string(primary_domains, ',') AS domain,
    CASE WHEN id % 5 = 0 THEN nullif(regexp_extract(text, 'RT\\s@(\\w+):', 1), '') END
      AS "twitter_RT",
    CAST(user_id % 40 AS INTEGER) AS user_listed_count,
    CASE WHEN id % 9 = 0 THEN '{{"type":"Point"}}' END AS tweet_geo,
    CAST(NULL AS VARCHAR) AS tweet_coordinates,
    CASE WHEN id % 4 = 0 THEN '{{"country":"US"}}' END AS tweet_place,
    CAST(id % 100 AS INTEGER) AS tweet_favorite_count,
    CAST(id % 37 AS INTEGER) AS tweet_retweet_count,
    id % 2 = 0 AS tweet_favorited, id % 5 = 0 AS tweet_retweeted
  FROM routed WHERE route = 'matched'
)"""


def with_views(sql: str, *views: str) -> str:
    return "WITH " + ",\n".join(view.strip() for view in views) + "\n" + sql.strip()


def seconds(ts: str) -> str:
    return f"CAST(floor(epoch({ts})) AS BIGINT)"


def starts(ts: str, window: int, slide: int) -> str:
    """Starts of all windows over a time, to be unnested."""
    first = f"({seconds(ts)} // {slide}) * {slide}"
    return f"range({first} - {window - slide}, {first} + {slide}, {slide})"


def bounds(window: int) -> str:
    return (f"CAST(make_timestamp(CAST(window_start * 1000000 AS BIGINT)) AS TIMESTAMP) AS window_start, "
            f"CAST(make_timestamp(CAST((window_start + {window}) * 1000000 AS BIGINT)) AS TIMESTAMP) AS window_end")
