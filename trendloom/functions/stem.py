"""Porter's suffix stripping (1980), as columns and for one word.

A word's measure is a pattern over its consonants and vowels, and the steps are conditional
expressions over all tokens of a text, one after the other; nothing leaves the JVM. Each step
looks at the last two letters first, so that patterns run on the few words they may change.
:func:`stem` has the same rules for one word, for batches that stem each distinct word once.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"

# A word is [C](VC){m}[V]; "y" is a vowel after a consonant. An initial "y" is written
# "Y" while the rules run, so that it only reads as a consonant.
CONSONANTS = "[^aeiou][^aeiouy]*"
VOWELS = "[aeiouy][aeiou]*"
HAS_VOWEL = f"^({CONSONANTS})?[aeiouy]"
M_ABOVE_0 = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}"
M_EQUALS_1 = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}({VOWELS})?$"
M_ABOVE_1 = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}{VOWELS}{CONSONANTS}"
SHORT = f"^{CONSONANTS}[aeiouy][^aeiouwxy]$"
DOUBLED = "(?:" + "|".join(c * 2 for c in "bcdfghjkmnpqrtvwx") + ")$"

# The published suffix rules of steps 1a, 2, 3 and 4.
STEP_1A = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
          "ful": "", "ness": ""}
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
          "ent", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


# While the rules run, a word that stays as it is stands in capitals, and a stem that step 1b
# has left to be repaired ends in this sign.
REPAIR = "\uE000"


def _shorter(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _marked(word: Column, protect: Sequence[str]) -> Column:
    still = F.length(word) <= 2
    if protect:
        still = still | word.isin(*protect)
    return F.when(still, F.translate(word, LETTERS, LETTERS.upper())).when(
        word.startswith("y"), F.concat(F.lit("Y"), F.substring(word, F.lit(2), F.length(word)))
    ).otherwise(word)


def _rewritten(word: Column, rules: Mapping[str, str], condition: str | None) -> Column:
    """The word by the longest suffix it has; the rule only holds if the stem fits."""
    out = word
    for suffix in sorted(rules, key=len):
        stem = _shorter(word, len(suffix))
        new = F.concat(stem, F.lit(rules[suffix]))
        if condition is not None:
            new = F.when(stem.rlike(condition), new).otherwise(word)
        out = F.when(word.endswith(suffix), new).otherwise(out)
    endings = {suffix[-2:] for suffix in rules}
    if min(map(len, endings)) < 2:
        return out
    return F.when(F.substring(word, -2, 2).isin(*sorted(endings)), out).otherwise(word)


def _past_and_gerund(word: Column) -> Column:
    """Step 1b: -eed, -ed and -ing; the stem that the latter two leave is to be repaired."""
    def stripped(n: int) -> Column:
        stem = _shorter(word, n)
        return F.when(stem.rlike(HAS_VOWEL), F.concat(stem, F.lit(REPAIR))).otherwise(word)

    eed = F.when(_shorter(word, 3).rlike(M_ABOVE_0), _shorter(word, 1)).otherwise(word)
    return F.when(word.endswith("ing"), stripped(3)).when(word.endswith("eed"), eed).when(
        word.endswith("ed"), stripped(2)).otherwise(word)


def _repaired(word: Column) -> Column:
    stem = _shorter(word, 1)
    add_e = stem.rlike("(?:at|bl|iz)$") | stem.rlike(SHORT)
    return F.when(word.endswith(REPAIR), F.when(stem.rlike(DOUBLED), _shorter(word, 2)).when(
        add_e, F.concat(stem, F.lit("e"))).otherwise(stem)).otherwise(word)


def _final_y(word: Column) -> Column:
    """Step 1c."""
    stem = _shorter(word, 1)
    return F.when(word.endswith("y") & stem.rlike(HAS_VOWEL), F.concat(stem, F.lit("i"))).otherwise(
        word)


def _long_suffixes(word: Column) -> Column:
    """Step 4; -ion only goes after s or t."""
    rules = {suffix: "" for suffix in STEP_4}
    ion = word.endswith("sion") | word.endswith("tion")
    stem = _shorter(word, 3)
    return F.when(ion, F.when(stem.rlike(M_ABOVE_1), stem).otherwise(word)).otherwise(
        _rewritten(word, rules, M_ABOVE_1))


def _final_e(word: Column) -> Column:
    stem = _shorter(word, 1)
    one = stem.rlike(M_EQUALS_1) & ~stem.rlike(SHORT)
    return F.when(word.endswith("e") & (stem.rlike(M_ABOVE_1) | one), stem).otherwise(word)


def _double_l(word: Column) -> Column:
    return F.when(word.endswith("ll") & word.rlike(M_ABOVE_1), _shorter(word, 1)).otherwise(word)


STEPS = [
    lambda w: _rewritten(w, STEP_1A, None), _past_and_gerund, _repaired, _final_y,
    lambda w: _rewritten(w, STEP_2, M_ABOVE_0), lambda w: _rewritten(w, STEP_3, M_ABOVE_0),
    _long_suffixes, _final_e, _double_l,
]


def stem_tokens(tokens: Column, protect: Sequence[str] = ()) -> Column:
    """Stems of an array of lower-case words; words of one or two letters and those in
    ``protect`` stay as they are, NULL stays NULL."""
    out = F.transform(tokens, lambda w: _marked(w, protect))
    for step in STEPS:
        out = F.transform(out, step)
    return F.transform(out, lambda w: F.translate(w, LETTERS.upper(), LETTERS))


def stem_word(word: Column, protect: Sequence[str] = ()) -> Column:
    """Stem of one word per row."""
    return F.get(stem_tokens(F.array(word), protect), 0)


def _by_ending(rules: Mapping[str, str]) -> dict[str, list[tuple[str, str]]]:
    """Rules by the last two letters of their suffix, longest suffix first."""
    out: dict[str, list[tuple[str, str]]] = {}
    for suffix in sorted(rules, key=len, reverse=True):
        out.setdefault(suffix[-2:], []).append((suffix, rules[suffix]))
    return out


BY_ENDING = [(_by_ending(rules), re.compile(condition).match) for rules, condition in (
    (STEP_2, M_ABOVE_0), (STEP_3, M_ABOVE_0),
    (dict.fromkeys(STEP_4, "") | {"sion": "s", "tion": "t"}, M_ABOVE_1))]
WORD_HAS_VOWEL, WORD_ABOVE_0, WORD_ABOVE_1, WORD_EQUALS_1, WORD_SHORT = (
    re.compile(x).match for x in (HAS_VOWEL, M_ABOVE_0, M_ABOVE_1, M_EQUALS_1, SHORT))


def _plural(word: str) -> str:
    suffix = next((x for x in sorted(STEP_1A, key=len, reverse=True) if word.endswith(x)), None)
    return word if suffix is None else word[:-len(suffix)] + STEP_1A[suffix]


def _repair(stem: str) -> str:
    if re.search(DOUBLED, stem):
        return stem[:-1]
    return stem + "e" if stem.endswith(("at", "bl", "iz")) or WORD_SHORT(stem) else stem


def stem(word: str) -> str:
    """Stem of one lower-case word; equals :func:`stem_word`."""
    if len(word) <= 2:
        return word
    word = "Y" + word[1:] if word[0] == "y" else word
    word = _plural(word) if word[-1] == "s" else word
    if word.endswith("eed"):
        word = word[:-1] if WORD_ABOVE_0(word[:-3]) else word
    elif cut := 3 * word.endswith("ing") or 2 * word.endswith("ed"):
        word = _repair(word[:-cut]) if WORD_HAS_VOWEL(word[:-cut]) else word
    if word.endswith("y") and WORD_HAS_VOWEL(word[:-1]):
        word = word[:-1] + "i"
    for rules, fits in BY_ENDING:
        for suffix, new in rules.get(word[-2:], ()):
            if word.endswith(suffix):
                # Of -sion and -tion the s or t stays, and is part of the stem.
                kept = word[:-len(suffix)] + (new if suffix in ("sion", "tion") else "")
                if fits(kept):
                    word = word[:-len(suffix)] + new
                break
    if word.endswith("e") and (WORD_ABOVE_1(word[:-1]) or WORD_EQUALS_1(
            word[:-1]) and not WORD_SHORT(word[:-1])):
        word = word[:-1]
    if word.endswith("ll") and WORD_ABOVE_1(word):
        word = word[:-1]
    return word.lower()
