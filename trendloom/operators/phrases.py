"""Which phrases of a dictionary table occur in which texts, for dictionaries of any size.

A test of every phrase on every text does not scale with the dictionary. Here each phrase is
kept under one n-gram of its own, the one that the fewest texts hold; a text's distinct
n-grams meet that index in a join, and only the phrases they fetch are searched in the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from trendloom.operators.joins import ROWS_PER_TASK, skew_join
from trendloom.session import work_dir

GRAM = 4  # characters of an n-gram; shorter phrases are n-grams themselves
INDEX_ROWS = 1_000_000  # of n-grams or phrases that are held by every task; more are shuffled


def grams(text: Column, size: int) -> Column:
    """The distinct n-grams of one size; none for NULL and shorter texts. The text is cut into
    its characters once; a substring by position would be looked for from the start each time."""
    last = F.char_length(text) - size
    made = F.transform(F.array(F.split(text, "")), lambda chars: F.transform(
        F.sequence(F.lit(0), last), lambda at: F.concat(
            *[F.get(chars, at + i) for i in range(size)])))
    return F.when(last >= 0, F.array_distinct(F.get(made, 0)))


def _sized_grams(text: Column, sizes: list[int]) -> Column:
    """Distinct n-grams of several sizes in one array."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(grams(text, size), none) for size in sizes])


def _hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` neighbouring characters, good in its high bits."""
    out = np.zeros(len(codes) - size + 1, np.uint64)
    for i in range(size):
        out = (out ^ codes[i:len(codes) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
    return out


def known_grams(texts: DataFrame, text: str, wanted: DataFrame, sizes: list[int],
                *keep: str) -> DataFrame:
    """(keep..., _grams): the distinct n-grams of each text that ``wanted(gram)``, INDEX_ROWS at
    most, holds. Tasks hold ``wanted`` as sets behind tables of hashes, so no n-gram outside of
    it becomes a row or even a string."""
    rows = texts.select(*keep, F.col(text).cast("binary").alias("_bytes"))
    schema = StructType([*rows.schema.fields[:-1], StructField("_grams", ArrayType(StringType()))])
    grams_by_size: dict[int, set[str]] = {n: set() for n in sizes}
    for row in wanted.select("gram").distinct().collect():
        grams_by_size.setdefault(len(row[0]), set()).add(row[0])
    held = texts.sparkSession.sparkContext.broadcast(grams_by_size)

    def found(body: bytes | None, tables: dict[int, tuple[set[str], int, np.ndarray]]) -> list[str]:
        chars = (body or b"").decode("utf-8", "surrogateescape")
        codes = np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        out: set[str] = set()
        for n, (own, shift, table) in tables.items():
            if len(codes) >= n:
                maybe = np.flatnonzero(table[_hashes(codes, n) >> np.uint64(shift)])
                out |= own.intersection([chars[at:at + n] for at in maybe.tolist()])
        return list(out)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {}
        for n, own in held.value.items():
            shift = 64 - max(16, len(own).bit_length() + 4)
            table = np.zeros(1 << (64 - shift), bool)
            for gram in own:
                codes = np.frombuffer(gram.encode("utf-32-le"), "<u4").astype(np.uint64)
                table[_hashes(codes, n) >> np.uint64(shift)] = True
            tables[n] = own, shift, table
        for batch in batches:
            grams_of = [found(body.as_py(), tables) for body in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(grams_of, pa.list_(pa.string()))],
                names=schema.names)

    return rows.mapInArrow(made, schema)


def phrase_index(texts: DataFrame, text: str, phrases: DataFrame, phrase: str = "phrase",
                 gram: int = GRAM) -> DataFrame:
    """(gram, phrase): every distinct phrase under its rarest n-gram in ``texts``.

    Phrases shorter than ``gram`` characters are kept under themselves. How many texts hold an
    n-gram is counted for the dictionary's n-grams only, added up on the map side. Ties go to
    the first n-gram by its characters. Empty and NULL phrases are left out.
    """
    known = phrases.select(F.col(phrase).alias("phrase")).where("phrase <> ''").distinct()
    size = F.least(F.char_length("phrase"), F.lit(gram))
    own = F.transform(F.sequence(F.lit(1), F.char_length("phrase") - size + 1),
                      lambda at: F.substring(F.col("phrase"), at, size))
    pairs = known.select("phrase", F.explode(F.array_distinct(own)).alias("gram"))
    sizes = _sizes(known, gram)
    if not sizes:
        return pairs.select("gram", "phrase")
    wanted = pairs.select("gram").distinct()
    if wanted.limit(INDEX_ROWS + 1).count() <= INDEX_ROWS:
        found = known_grams(texts, text, wanted, sizes).select(F.explode("_grams").alias("gram"))
    else:
        found = texts.select(F.explode_outer(_sized_grams(F.col(text), sizes)).alias("gram")).join(
            wanted, "gram", "left_semi")
    counts = found.groupBy("gram").agg(F.count("*").alias("_texts"))
    ranked = pairs.join(counts, "gram", "left")
    rarest = F.min_by("gram", F.struct(F.coalesce("_texts", F.lit(0)), "gram"))
    return ranked.groupBy("phrase").agg(rarest.alias("gram")).select("gram", "phrase")


def _sizes(known: DataFrame, gram: int) -> list[int]:
    """The lengths up to ``gram`` that phrases are kept under: ``gram`` numbers at most."""
    size = F.least(F.char_length("phrase"), F.lit(gram)).alias("size")
    return sorted(row["size"] for row in known.select(size).distinct().collect())


def phrase_matches(texts: DataFrame, key: str, text: str, phrases: DataFrame,
                   phrase: str = "phrase", gram: int = GRAM,
                   rows: int = ROWS_PER_TASK) -> DataFrame:
    """(key, columns of ``phrases``): the dictionary rows whose phrase is a substring of the
    text, letter case included; the same as testing all of them with ``contains``.

    An index that every task can hold is looked up where the texts lie: the n-grams of a text
    that are in no phrase's place go before anything moves. A larger one meets the n-grams in
    a shuffle in which heavy n-grams are split; candidates come back to their text by ``key``,
    which has to be unique, and texts move once. NULL texts hold nothing, NULL and empty
    phrases are in no text, and a phrase that stands in several dictionary rows matches with
    all of them.
    """
    path = work_dir(texts.sparkSession, "phrases")
    phrase_index(texts, text, phrases, phrase, gram).write.parquet(path)
    index = texts.sparkSession.read.schema("gram string, phrase string").parquet(path)
    sizes = _sizes(index, gram)
    own = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    if not sizes:
        found = own.select("_key", F.lit(None).cast("string").alias("_phrase")).where("false")
    elif index.limit(INDEX_ROWS + 1).count() <= INDEX_ROWS:
        candidates = known_grams(own, "_text", index, sizes, "_key", "_text").select(
            "_key", "_text", F.explode("_grams").alias("gram")).join(F.broadcast(index), "gram")
        found = candidates.where(F.col("_text").contains(F.col("phrase"))).select(
            "_key", F.col("phrase").alias("_phrase"))
    else:
        fetched = skew_join(
            own.select("_key", F.explode_outer(_sized_grams(F.col("_text"), sizes)).alias("gram")),
            index, "gram", ["_key"], rows=rows).select("_key", "phrase")
        candidates = fetched.groupBy("_key").agg(F.collect_set("phrase").alias("_phrases"))
        held = F.filter("_phrases", lambda p: F.contains(F.col("_text"), p))
        found = own.join(candidates, "_key").select("_key", F.explode_outer(held).alias("_phrase"))
        found = found.where("_phrase IS NOT NULL")
    return found.join(phrases, found["_phrase"] == phrases[phrase]).select(
        F.col("_key").alias(key), *phrases.columns)


def tagged_topics(texts: DataFrame, key: str, text: str, phrases: DataFrame,
                  topic: str = "topic", phrase: str = "phrase") -> DataFrame:
    """(key, topics): the sorted topics one of whose phrases occurs, an empty array without."""
    hits = phrase_matches(texts, key, text, phrases, phrase).groupBy(key).agg(
        F.sort_array(F.collect_set(topic)).alias("topics"))
    return texts.select(key).join(hits, key, "left").withColumn(
        "topics", F.coalesce("topics", F.array().cast("array<string>")))
