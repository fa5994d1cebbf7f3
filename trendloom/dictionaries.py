"""Topic synonyms, domains, word lists, punctuation, outcome codes.

Everything in this module is data that decides results, so it is stated plainly.
Operators take these as default arguments; pass your own to replace them.
"""

# Topic -> synonyms, matched as case-sensitive substrings. The
# trailing blanks are part of the synonyms; the misspelt NLP entry is kept beside
# the right spelling so that texts with either are tagged.
TOPICS = {
    "Machine Learning": ["ML", "Machine Learning", "MachineLearning", "machine learning"],
    "Deep Learning": ["DL ", "Deep Learning", "DeepLearning", "deep learning"],
    "Big data": ["Big data", "bigdata", "big data"],
    "NLP": ["NLP", "Natual Language Processing", "Natural Language Processing",
            "natural language processing"],
    "Computer Vision": ["ComputerVision", "computer vision", "Computer Vision"],
    "AI": ["AI ", "Artificial Intelligence", "ArtificialIntelligence",
           "artificial intelligence"],
}

# Phrases that decide whether a message enters the stream at all.
TRACK = [
    "ML", "Machine Learning", "MachineLearning", "machine learning",
    "DL", "Deep Learning", "DeepLearning", "deep learning",
    "Big data", "bigdata", "NLP", "Natural Language Processing",
    "computer vision", "ComputerVision", "Artificial Intelligence", "AI ",
]
TRACK_LANGUAGES = ["en"]

# Primary domains whose links alone do not make a message relevant.
ALLOWED_DOMAINS = ["wikipedia.org", "twitter.com"]

# Hashtag -> topic of the trend streams.
HASHTAGS = {"#bigdata": "Big data", "#machinelearning": "Machine Learning", "#ai": "AI"}

# Topics drawn as daily lines.
CHART_TOPICS = ["Machine Learning", "Big data", "AI", "Deep Learning"]

# Stop words of cleaner A (153 words).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what
which who whom this that these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for
with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now d ll m o re ve y ain aren couldn didn doesn
hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
""".split()

# Cleaner B adds one word to the list.
STOP_WORDS_STREAM = STOP_WORDS + ["would"]

# Cleaners C and D use the public English list, which also holds the
# contracted forms.
CONTRACTIONS = """
you're you've you'll you'd she's it's that'll don't should've aren't couldn't didn't
doesn't hadn't hasn't haven't isn't mightn't mustn't needn't shan't shouldn't wasn't
weren't won't wouldn't
""".split()
STOP_WORDS_NEWS = STOP_WORDS + CONTRACTIONS

# Words cleaner B drops after stemming.
NOISE_WORDS = ["gtgt", "gtgtgt", "thank", "thanks", "please", "gt", "iot", "yes", "hey",
               "move", "data", "big", "amp"]

# Phrases written as one word, and the acronyms that stand for them.
PHRASES = {
    "machine learning": "machinelearning",
    "deep learning": "deeplearning",
    "natural language processing": "naturallanguageprocessing",
    "artificial intelligence": "artificialintelligence",
    "big data": "bigdata",
    "computer vision": "computervision",
}
ACRONYMS = {
    "ml": "machinelearning",
    "dl": "deeplearning",
    "nlp": "naturallanguageprocessing",
    "ai": "artificialintelligence",
}

# Acronyms cleaners C and D keep although they are short.
SHORT_TERMS = ["ai", "nlp", "ml", "dl"]

# Typographic character -> plain text.
PUNCTUATION = {
    "’": "'", "é": "e",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-",
    "‘": "'", "‛": "'",
    "“": '"', "”": '"', "„": '"', "‟": '"',
    "…": "...",
    "′": "'", "″": "'", "‴": "'", "‵": "'", "‶": "'", "‷": "'",
    "⁺": "+", "⁻": "-", "⁼": "=", "⁽": "(", "⁾": ")",
}


def literal_escape(char: str) -> str:
    """The character as escaped UTF-8 text, e.g. backslash-x-e2 ... for a quote."""
    return "".join(f"\\x{byte:02x}" for byte in char.encode("utf-8"))


# Outcome codes and reasons of the message checks.
NO_ENTITIES = (-2, "no entities element")
NO_URLS = (-3, "no entities.urls element")
ALL_ALLOWED = (-8, "All domains whitelisted")
NO_TEXT = (-101, "no text")
BAD_JSON = (-102, "not a JSON object")
NO_EXPANDED_URL = (-104, "no expanded_url")
NO_HASHTAG = (-2, "no searched hashtag")

# Output topic per route.
ROUTE_TOPICS = {"matched": "twitter_matched", "cleaned": "twitter_cleaned",
                "not_matched": "twitter_notmatched", "error": "twitter_err"}
HASHTAG_MATCHED_TOPIC = "twitter_matched_tdidf"
HASHTAG_NOT_MATCHED_TOPIC = "twitter_processed_notmatched"

# Fixed values: (window, slide) in seconds of the three stream applications.
ETL_WINDOW = (1800, 600)
TREND_WINDOW = (1500, 300)
CHART_WINDOW = (600, 60)
