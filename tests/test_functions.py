"""Hand-written cases of the column functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from trendloom import dictionaries as d
from trendloom.functions import dates, keywords, stem as stem_module, text, urls
from trendloom.functions.stem import stem_tokens, stem_word


@pytest.mark.parametrize("value, expected", [
    ("I love MachineLearning", "Machine Learning"),
    ("Big data and Artificial Intelligence", "AI,Big data"),
    ("HTML", "Machine Learning"),
    ("AI", ""), ("AI now", "AI"),
    ("Natual Language Processing", "NLP"), ("Natural Language Processing", "NLP"),
    ("", ""), (None, ""),
])
def test_keywords(one, value, expected):
    assert one(lambda c: keywords.keyword_string(keywords.matched_topics(c)), value) == expected


def test_hashtag_is_a_substring(one):
    assert one(keywords.hit_topics, "Fly #Airflow") == ["AI"]
    assert one(keywords.hit_topics, "#BigData #MachineLearning") == ["Big data", "Machine Learning"]


@pytest.mark.parametrize("value, host, primary", [
    ("http://www.bbc.co.uk/x", "www.bbc.co.uk", "co.uk"),
    ("https://my-site.com", "my-site.com", "site.com"),
    ("http://host:8080/a", "host:8080", "host:8080"),
    ("http://user@Www.X.com:80/a?b", "user@Www.X.com:80", "user@Www.X.com:80"),
    ("http://a.org?q=1#f", "a.org", "a.org"),
    ("notaurl", "", ""), ("", "", ""),
])
def test_domains(one, value, host, primary):
    assert one(urls.netloc, value) == host
    assert one(lambda c: urls.primary_domain(urls.netloc(c)), value) == primary


def test_allow_list(one):
    kind = "array<string>"
    assert one(urls.all_allowed, ["twitter.com"], kind) is True
    assert one(urls.all_allowed, ["twitter.com", "bbc.com"], kind) is False


@pytest.mark.parametrize("value, expected", [
    ("Wed Aug 27 13:08:45 +0000 2008", datetime.date(2008, 8, 27)),
    ("Wed Abc 27 13:08:45 +0000 2008", None), ("garbage", None), (None, None),
])
def test_tweet_date(one, value, expected):
    assert one(dates.tweet_date, value) == expected


def test_iso_date(one):
    assert one(dates.iso_date, "2019-02-03T10:00:00Z") == datetime.date(2019, 2, 3)
    assert one(dates.iso_date, "soon") is None


@pytest.mark.parametrize("value, expected", [
    ("it’s – so…", "it's - so..."), ("café", "cafe"),
    (r"it\xe2\x80\x99s \xe2\x80\x93 so\xe2\x80\xa6", "it's - so..."),
    (r"caf\xc3\xa9", "cafe"), ("plain", "plain"), (None, None),
])
def test_normalize(one, value, expected):
    assert one(text.normalize_punct, value) == expected


def test_every_mapping_has_both_forms(one):
    for char, plain in d.PUNCTUATION.items():
        assert one(text.normalize_punct, f"a{char}b") == f"a{plain}b"
        assert one(text.normalize_punct, f"a{d.literal_escape(char)}b") == f"a{plain}b"


def test_mentions(one):
    assert one(text.mentions, "hi @bob_1 and @al") == ["bob_1", "al"]
    assert one(text.retweeted_account, "RT @bob: x") == "bob"
    assert one(text.retweeted_account, "x") is None


def test_cleaner_a(one):
    assert one(text.clean_tokens_a, "RT @bob Learning\nfast https://x.y lost words") == [
        "learning", "fast"]
    assert one(text.clean_tokens_a, "see http://site https://y z") == ["http", "site"]
    assert one(text.clean_tokens_a, "héros café’s foo@bar-baz1quux") == ["heros", "cafe", "quux"]
    assert one(text.clean_tokens_a, "") == []
    assert one(text.clean_tokens_a, None) is None


def test_cleaner_b(one):
    assert one(text.clean_tokens_b, "RT @bob Machine learning, deep learning! http://t.co/x") == [
        "machinelearn", "deeplearn"]
    assert one(text.clean_tokens_b, "ML and #AI please") == [
        "machinelearning", "artificialintelligence", "pleas"]
    protected = lambda c: text.clean_tokens_b(c, list(d.PHRASES.values()))
    assert one(protected, "machine learning") == ["machinelearning"]
    assert one(text.raw_tokens_b, "bob's caf\\xc3\\xa9 a\\nbird") == ["bos", "cafe", "bird"]
    assert one(text.clean_tokens_b, None) is None


def test_cleaner_c(one):
    assert one(text.clean_tokens_c, "here: we learn") == ["here", "learn"]
    assert one(text.clean_tokens_c, "AI NLP cat learning,") == ["ai", "nlp", "learning"]
    assert one(text.clean_tokens_c, "caf\\u00e9 human") == ["human"]
    assert one(lambda c: text.clean_tokens_c(c, drop="u"), "caf\\u00e9 human learn") == ["learn"]
    assert one(text.clean_tokens_c, "wide　space don't") == ["wide", "space"]
    assert one(text.clean_tokens_c, None) is None


def test_cleaner_d(one):
    assert one(text.clean_tokens_d, "rt, b'Learning http://x\\nfaster") == ["learning", "faster"]


def test_stems(one):
    # Examples printed with the published rules.
    pairs = """caresses caress ponies poni cats cat feed feed agreed agre plastered plaster
    motoring motor conflated conflat troubled troubl sized size hopping hop falling fall
    hissing hiss failing fail filing file happy happi sky sky relational relat conditional
    condit rational ration digitizer digit vietnamization vietnam operator oper feudalism
    feudal hopefulness hope formaliti formal triplicate triplic electrical electr goodness
    good revival reviv adjustable adjust replacement replac adoption adopt homologou homolog
    effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control
    roll roll please pleas as as""".split()
    words, stems = pairs[::2], pairs[1::2]
    assert one(stem_tokens, words, "array<string>") == stems
    assert one(stem_word, "generalizations") == "gener"


def test_stems_keep_nulls_and_order(spark):
    from pyspark.sql import functions as F
    rows = [(1, ["ponies", "cats"]), (2, None), (3, []), (4, ["cats", None])]
    out = spark.createDataFrame(rows, "id int, t array<string>").coalesce(1).select(
        "id", stem_tokens(F.col("t")).alias("t")).orderBy("id").collect()
    assert [row["t"] for row in out] == [["poni", "cat"], None, [], ["cat", None]]


ODD_TEXTS = [
    None, "", " ", "RT @bob caf\\xc3\\xa9\\nÉté don’t b'quoted' HTTP://x https", "MACHİNE LEARNİNG ﬁne İstanbul",
    "Kelvin\tBig\x0bData flies and　dies\x1cTHE,the,, u\\u00e9 nlp ai ML dl",
    "yellowing yes generalizations agreed hopping falling filing controlling flies dying", "x" * 50_000,
    "computer vision … natural\nlanguage processing rt http @at @", "ﬀﬁ 日本語 ß ẞ Σας ΣΑΣ",
]


def test_cleaners_equal_their_steps(spark):
    """The cleaners take distinct words of a batch once; that changes no text's tokens."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS * 2)], "id int, t string")
    words = list(d.PHRASES.values())
    t = F.col("t")
    for whole, steps in (
            (text.clean_tokens_b(t), text.finish_tokens_b(stem_tokens(text.raw_tokens_b(t)))),
            (text.clean_tokens_b(t, words), text.finish_tokens_b(
                stem_tokens(text.raw_tokens_b(t), words))),
            (text.clean_tokens_c(t), text.finish_tokens_c(text.raw_tokens_c(t))),
            (text.clean_tokens_c(t, "u"), text.finish_tokens_c(text.raw_tokens_c(t, "u"))),
            (text.clean_tokens_d(t), text.finish_tokens_c(text.raw_tokens_d(t)))):
        found = rows.select("id", whole.alias("a"), steps.alias("b")).collect()
        assert [r["a"] for r in found] == [r["b"] for r in found]
        plan = rows.select(whole)._jdf.queryExecution().executedPlan().toString()
        assert "lambdafunction" not in plan  # no step per token of every text


def test_stem_of_a_word_equals_the_columns(spark):
    endings = [*stem_module.STEP_1A, *stem_module.STEP_2, *stem_module.STEP_3, *stem_module.STEP_4,
               "ion", "sion", "tion", "ing", "ed", "eed", "e", "y", "ll"]
    words = [a + b + c for a in ("", "y", "hop", "oper", "tr", "controll", "gener", "vis")
             for b in endings for c in ("", "s", "ing", "ed", "ness")]
    rows = spark.createDataFrame([(w, stem_module.stem(w)) for w in words], "w string, s string")
    assert rows.where(stem_word(F.col("w")) != F.col("s")).count() == 0
