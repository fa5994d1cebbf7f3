"""Shared inputs of the tests."""

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, size=5):
    own = words(text)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i:i + size]) for i in range(len(own) - size + 1)}


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows):
    """(doc_id, text[, lang[, source]]) rows as a documents table."""
    full = [(r + (None,) * 4)[:4] + (len(r[1] or ""),) for r in map(tuple, rows)]
    return spark.createDataFrame(full, DOCS)


def odd_documents():
    """NULLs, empty, blank, very long and repeated rows."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    return [(1, "Some plain text. It has a few words.", "en", "a"), (2, None, "en", "a"),
            (3, "", None, "b"), (4, " \n\t ", "en", None), (None, "no key at all here", "en", "b"),
            (5, long, "de", "b"), (6, long, "de", None), (7, "same", "en", "a"),
            (7, "same", "en", "a"), (7, "same", "en", "a"), (None, None, None, None),
            (8, "ünï códe — 漢字 🎉", "fr", "c")]
