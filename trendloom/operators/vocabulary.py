"""Stems and lemmas as jobs over the vocabulary."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.stem import stem_word
from trendloom.functions.text import finish_tokens_c, raw_tokens_c
from trendloom.operators.columns import compute_once
from trendloom.operators.joins import replacements


def stem_vocabulary(counts: DataFrame) -> DataFrame:
    """(term, n) -> (term, stem, n). Every distinct word is stemmed once."""
    return counts.select("term", stem_word(F.col("term")).alias("stem"), "n")


def lemma_counts(counts: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(term, n) -> (lemma, n, n_forms) with ``lemmas(form, lemma)``, one row per form.
    Both sides have one row per word, so no key is hot."""
    return (
        counts.join(lemmas, counts["term"] == lemmas["form"], "left")
        .groupBy(F.coalesce("lemma", "term").alias("lemma"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("n_forms"))
    )


# Endings of nouns and what they are detached to, in the order of trial.
NOUN_RULES = {"s": "", "ses": "s", "ves": "f", "xes": "x", "zes": "z", "ches": "ch", "shes": "sh",
              "men": "man", "ies": "y"}


def rule_lemmas(words: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None,
                word: str = "term", entry: str = "term",
                rules: Mapping[str, str] = NOUN_RULES) -> DataFrame:
    """(form, lemma) of the words that have another base form: a table for
    :func:`lemmatize_tokens`.

    Every rule whose ending a word has makes a candidate; candidates that the lexicon holds are
    accepted, in a semi-join, and the shortest one is the lemma, the first rule's of equals. A
    word that the lexicon holds itself competes with them and is longer. ``exceptions`` are
    (form, lemma) rows that come before the rules. Words are taken once, however often they
    come; NULLs have no lemma. Both tables may be of any size.
    """
    forms = words.select(F.col(word).alias("form")).where("form IS NOT NULL").distinct()
    made = F.array_compact(F.array(*[
        F.when(F.col("form").endswith(ending) & (F.length("form") > len(ending)), F.struct(
            F.lit(i).alias("rule"), F.concat(F.substring(
                "form", F.lit(1), F.length("form") - len(ending)), F.lit(new)).alias("lemma")))
        for i, (ending, new) in enumerate(rules.items())]))
    known = lexicon.select(F.col(entry).alias("lemma")).distinct()
    lemmas = forms.select("form", F.inline(made)).join(known, "lemma", "left_semi").groupBy(
        "form").agg(F.min_by("lemma", F.struct(F.length("lemma"), "rule")).alias("lemma"))
    if exceptions is None:
        return lemmas
    given = exceptions.select("form", F.col("lemma").alias("_given")).dropDuplicates(["form"])
    return forms.join(given, "form", "left").join(lemmas, "form", "left").select(
        "form", F.coalesce("_given", "lemma").alias("lemma")).where(
        F.col("lemma") != F.col("form"))


def lemmatize_tokens(docs: DataFrame, doc_id: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """Replace the tokens of every document by their lemmas, keeping order.

    ``lemmas`` may be of any size: it is shuffled unless it is known to be small. Only words
    that have a lemma leave their document.
    """
    return replacements(docs, doc_id, tokens, lemmas, "form", "lemma")


def clean_with_lemmas(docs: DataFrame, doc_id: str, text: str, lemmas: DataFrame, out: str,
                      raw_tokens: Callable[[Column], Column] = raw_tokens_c) -> DataFrame:
    """News cleaner C (or D with ``raw_tokens_d``) with lemmas between its two halves."""
    words = compute_once(docs.select(doc_id, F.col(text).alias("_text")),
                         **{out: raw_tokens(F.col("_text"))}).drop("_text")
    cleaned = lemmatize_tokens(words, doc_id, out, lemmas)
    return cleaned.withColumn(out, finish_tokens_c(F.col(out)))
