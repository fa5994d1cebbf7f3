"""Text normalising and the four cleaners.

Each cleaner turns a whole text into an array of tokens; NULL text gives NULL. The
cleaners differ in the order of their steps, and that order decides results: C and D
test stop words before they strip non-letters, A and B after.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.dictionaries import (
    ACRONYMS, NOISE_WORDS, PHRASES, PUNCTUATION, SHORT_TERMS, STOP_WORDS,
    STOP_WORDS_NEWS, STOP_WORDS_STREAM, literal_escape,
)
from trendloom.functions.stem import stem

ASCII_SPACE = " \t\n\x0b\f\r"
UNICODE_SPACE = (r"[ \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")
ESCAPE = "\\u"
MIN_LENGTH = 4


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _unescape(text: Column, mapping: Mapping[str, str]) -> Column:
    """Literal escapes as plain text; few texts have any, so the rest is only searched for
    the marker."""
    out = text
    for char, plain in mapping.items():
        out = _replace(out, literal_escape(char), plain)
    return F.when(text.contains("\\x"), out).otherwise(text)


def normalize_punct(text: Column, mapping: Mapping[str, str] = PUNCTUATION) -> Column:
    """Typographic characters, and their literal escapes, as plain text."""
    single = {char: plain for char, plain in mapping.items() if len(plain) == 1}
    out = F.translate(text, "".join(single), "".join(single.values()))
    for char, plain in mapping.items():
        if char not in single:
            out = _replace(out, char, plain)
    # A text of one byte per character has nothing to translate.
    return _unescape(F.when(F.octet_length(text) > F.char_length(text), out).otherwise(text),
                     mapping)


def _normalize_for(text: Column, needed: str) -> Column:
    """:func:`normalize_punct` where all that counts afterwards are letters and the
    characters in ``needed``: replacements by anything else may be left undone."""
    out = text
    for char, plain in PUNCTUATION.items():
        if plain.isalpha() or plain in needed:
            out = _replace(out, char, plain)
    return _unescape(out, PUNCTUATION)


def mentions(text: Column) -> Column:
    """Account names after an at sign."""
    return F.regexp_extract_all(text, F.lit(r"@(\w+)"), F.lit(1))


def retweeted_account(text: Column) -> Column:
    """Account of an ``RT @name:`` prefix, NULL when there is none."""
    name = F.regexp_extract(text, r"RT\s@(\w+):", 1)
    return F.when(name != "", name)


def _keep(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Tokens of four letters or more that are no stop words."""
    stops = [word for word in stop_words if len(word) >= MIN_LENGTH]
    return F.filter(
        tokens, lambda t: (F.length(t) >= MIN_LENGTH) & (~t.isin(*stops) if stops else F.lit(True))
    )


def clean_tokens_a(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Console trend cleaner: everything from the first ``https`` on goes, then mentions,
    then everything that is no letter."""
    out = _normalize_for(F.substring_index(text, "https", 1), "")
    # Two plain patterns: one alternation of both takes several times as long.
    out = F.regexp_replace(out, r"@\w+", "")
    letters = F.lower(F.regexp_replace(out, r"[^a-zA-Z]+", " "))
    # "rt" needs no test of its own: it is shorter than the shortest kept token.
    return _keep(F.split(letters, " "), stop_words)


def _strip(tokens: Column) -> Column:
    """Letters only, token by token. (Over the joined tokens the pattern would have to spare
    the blank, and such a class is several times slower.)"""
    return F.transform(tokens, lambda t: F.regexp_replace(t, "[^a-zA-Z]+", ""))


def raw_tokens_b(text: Column, phrases: Mapping[str, str] = PHRASES,
                 stop_words: Sequence[str] = STOP_WORDS_STREAM) -> Column:
    """Chart trend cleaner up to the stemming step."""
    out = _normalize_for(_replace(text, "\\n", " "), "'")
    out = F.lower(_replace(out, "b'", ""))
    for phrase, word in phrases.items():
        out = _replace(out, phrase, word)
    for space in ASCII_SPACE[1:]:
        out = _replace(out, space, " ")
    tokens = F.filter(
        F.split(out, " "), lambda t: ~t.contains("http") & ~t.startswith("@") & (t != "rt"))
    return F.filter(_strip(tokens), lambda t: (t != "") & ~t.isin(*stop_words))


def finish_tokens_b(stems: Column, acronyms: Mapping[str, str] = ACRONYMS,
                    noise_words: Sequence[str] = NOISE_WORDS) -> Column:
    """Chart trend cleaner after the stemming step."""

    def spell_out(token: Column) -> Column:
        out = token
        for short, word in acronyms.items():
            out = F.when(token == short, word).otherwise(out)
        return out

    return _keep(F.transform(stems, spell_out), noise_words)


MOST_KNOWN = 1 << 18  # words that a worker remembers


def _by_word(text: Column, prepare: Callable[[pa.Array], pa.Array],
             change: Callable[[pa.Array], pa.Array]) -> Column:
    """The words between blanks of the prepared texts, changed, without those that become NULL.
    A batch of texts changes each distinct word once."""

    def cleaned(column: pa.Array) -> pa.Array:
        lists = pc.split_pattern(prepare(column), " ")
        coded = lists.flatten().dictionary_encode()
        words = change(coded.dictionary).take(coded.indices)
        kept = np.concatenate(([0], np.cumsum(words.is_valid().to_numpy(zero_copy_only=False))))
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return pa.ListArray.from_arrays(pa.array(kept[ends], pa.int32()), words.drop_null(),
                                        mask=lists.is_null() if lists.null_count else None)

    return F.arrow_udf(cleaned, "array<string>")(text)


def _lowered(texts: pa.Array) -> pa.Array:
    # The one letter whose lower-case form is two characters.
    return pc.utf8_lower(pc.replace_substring(texts, "\u0130", "i\u0307"))


def _letters(words: pa.Array, kept: pa.Array) -> pa.Array:
    """Letters only of the words that are kept, NULL for others."""
    return pc.replace_substring_regex(pc.if_else(kept, words, None), "[^a-zA-Z]+", "")


def _in(words: pa.Array, values: Sequence[str]) -> pa.Array:
    return pc.is_in(words, pa.array(list(values), pa.string()))


def clean_tokens_b(text: Column, protect: Sequence[str] = ()) -> Column:
    """Chart trend cleaner: :func:`raw_tokens_b`, stems, :func:`finish_tokens_b`, with each
    distinct word of a batch taken through them once. Words in ``protect`` are not stemmed;
    pass the values of ``PHRASES`` to keep joined phrases equal to their spelt-out acronyms."""
    signs = {char: plain for char, plain in PUNCTUATION.items() if plain.isalpha() or plain in "'"}
    escapes = {literal_escape(char): plain for char, plain in PUNCTUATION.items()}
    known: dict[str, str | None] = {}

    def prepare(texts: pa.Array) -> pa.Array:
        escaped = pc.any(pc.match_substring(texts, "\\x")).as_py()
        for old, new in ({"\\n": " "} | signs | (escapes if escaped else {}) | {"b'": ""}).items():
            texts = pc.replace_substring(texts, old, new)
        texts = _lowered(texts)
        for old, new in (dict(PHRASES) | dict.fromkeys(ASCII_SPACE[1:], " ")).items():
            texts = pc.replace_substring(texts, old, new)
        return texts

    def finished(word: str | None) -> str | None:
        if not word:
            return None
        word = word if word in protect else stem(word)
        word = ACRONYMS.get(word, word)
        return word if len(word) >= MIN_LENGTH and word not in NOISE_WORDS else None

    def change(words: pa.Array) -> pa.Array:
        dropped = pc.or_(pc.or_(pc.match_substring(words, "http"), pc.starts_with(words, "@")),
                         pc.equal(words, "rt"))
        letters = _letters(words, pc.invert(dropped))
        coded = pc.if_else(pc.invert(_in(letters, STOP_WORDS_STREAM)), letters,
                           None).dictionary_encode()
        if len(known) > MOST_KNOWN:
            known.clear()
        distinct = coded.dictionary.to_pylist()
        known.update((word, finished(word)) for word in distinct if word not in known)
        return pa.array([known[word] for word in distinct], pa.string()).take(coded.indices)

    return _by_word(text, prepare, change)


def raw_tokens_c(text: Column, drop: str = ESCAPE) -> Column:
    """News cleaner up to the lemma step. Tokens that contain ``drop`` are left out; the
    default is a literal unicode escape, ``"u"`` drops every token with that letter."""
    tokens = F.transform(F.split(F.lower(text), UNICODE_SPACE), lambda t: F.rtrim(t, F.lit(",")))
    return F.filter(tokens, lambda t: (t != "") & ~t.contains(drop))


def raw_tokens_d(text: Column, drop: str = ESCAPE) -> Column:
    """Merged-text cleaner up to the lemma step."""
    out = _replace(_replace(text, "\\n", " "), "b'", "")
    return F.filter(raw_tokens_c(out, drop), lambda t: ~t.contains("http") & (t != "rt"))


def finish_tokens_c(tokens: Column, stop_words: Sequence[str] = STOP_WORDS_NEWS,
                    short_terms: Sequence[str] = SHORT_TERMS) -> Column:
    """News and merged-text cleaner after the lemma step."""
    kept = F.filter(tokens, lambda t: ~t.isin(*stop_words))
    return F.filter(
        _strip(kept),
        lambda t: (F.length(t) >= MIN_LENGTH) | t.isin(*short_terms),
    )


def _clean_tokens_c(text: Column, drop: str, merged: bool) -> Column:
    """:func:`finish_tokens_c` of :func:`raw_tokens_c` or, for ``merged`` texts,
    :func:`raw_tokens_d`, with each distinct word of a batch taken through them once."""

    def prepare(texts: pa.Array) -> pa.Array:
        for old, new in {"\\n": " ", "b'": ""}.items() if merged else ():
            texts = pc.replace_substring(texts, old, new)
        return pc.replace_substring_regex(_lowered(texts), UNICODE_SPACE, " ")

    def change(words: pa.Array) -> pa.Array:
        words = pc.utf8_rtrim(words, ",")
        dropped = pc.or_(pc.match_substring(words, drop), _in(words, STOP_WORDS_NEWS))
        if merged:
            dropped = pc.or_(pc.or_(dropped, pc.match_substring(words, "http")),
                             pc.equal(words, "rt"))
        letters = _letters(words, pc.invert(dropped))
        kept = pc.or_(pc.greater_equal(pc.utf8_length(letters), MIN_LENGTH),
                      _in(letters, SHORT_TERMS))
        return pc.if_else(kept, letters, None)

    return _by_word(text, prepare, change)


def clean_tokens_c(text: Column, drop: str = ESCAPE) -> Column:
    """News cleaner without lemmas; ``operators.vocabulary`` has the form with lemmas."""
    return _clean_tokens_c(text, drop, False)


def clean_tokens_d(text: Column, drop: str = ESCAPE) -> Column:
    """Merged-text cleaner without lemmas."""
    return _clean_tokens_c(text, drop, True)
