"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Every word of a text becomes a template word: numbers, names and units turn into typed
placeholders, everything else into its lower-case form without edge punctuation. Windows of
template words are hash-joined with the windows of the benchmark items, so a question whose
numbers or names were changed still meets its original. A meeting counts only where each slot
value of the item stands for one value of the document.

Template and text have the same words at the same places, so all windows of a copied passage
lie on one diagonal (place in the text minus place in the item); a word put in or left out
moves the rest of the passage to another one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.storage import stored
from trendloom.operators.columns import compute_once

WINDOW = 5  # template words
LEAST_PLAIN = 3  # words of a window that are not placeholders, at least
COVER = 0.5  # share of an item's words that its windows in the text must cover
BLOCK_WINDOWS = 65_536  # windows of the benchmark that a task holds at once
BUCKETS = 16_384

NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve twenty "
                "thirty forty fifty sixty seventy eighty ninety hundred thousand million").split()
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr day days week weeks month "
         "months year years hour hours minute minutes second seconds meter meters metre metres "
         "mile miles foot feet inch inches gram grams kilogram kilograms pound pounds liter "
         "liters litre litres dollar dollars euro euros cent cents percent").split()
NUMBER, NAME, UNIT, OTHER = "\x01", "\x02", "\x03", "\x04"
BLANKS = r"[\x20\x09-\x0D]+"
SOLID = r"\p{L}\p{M}\p{N}"  # what edge punctuation is not
EDGE = rf"[^{SOLID}\x01-\x03 ]*"


def lined_up(text: Column) -> Column:
    """The words of the whole text between single blanks, one blank before and after."""
    clean = F.translate(F.coalesce(text, F.lit("")), NUMBER + NAME + UNIT, OTHER * 3)
    return F.concat(F.lit(" "), F.regexp_replace(clean, BLANKS, " "), F.lit(" "))


def words(line: Column) -> Column:
    return F.filter(F.split(line, " +"), lambda w: w != "")


def template(line: Column) -> Column:
    """The line of template words, one for each word, by passes over the whole line.

    A name is a capital and lower-case letters after a word that does not end a sentence. A
    number is of digits or spelled out; a unit counts right after a number. A word of
    punctuation alone stays as it is.
    """
    line = F.regexp_replace(
        line, rf"(?<=[^ .!?:;] ){EDGE}\p{{Lu}}\p{{Ll}}+(?:'s)?{EDGE}(?= )", NAME)
    line = F.regexp_replace(
        F.lower(line),
        rf"(?<= ){EDGE}(?:[0-9][0-9.,:/\-]*|{'|'.join(NUMBER_WORDS)}){EDGE}(?= )", NUMBER)
    line = F.regexp_replace(
        line, rf"(?<=\x01 ){EDGE}(?:{'|'.join(UNITS)}){EDGE}(?= )", UNIT)
    line = F.regexp_replace(line, rf"(?<= )[^{SOLID}\x01-\x03 ]+(?=[{SOLID}])", "")
    return F.regexp_replace(line, rf"(?<=[{SOLID}])[^{SOLID}\x01-\x03 ]+(?= )", "")


def _windowed(rows: DataFrame, text: Column) -> DataFrame:
    """Add the arrays ``_raw``, ``_words`` (template) and ``_hashes`` (one per window)."""
    rows = compute_once(rows, _line=lined_up(text.cast("string")))
    rows = compute_once(rows, _words=words(template(F.col("_line"))))
    rows = compute_once(rows, _codes=F.transform("_words", lambda w: F.xxhash64(w)))
    last = F.size("_words") - WINDOW
    codes = F.col("_codes")
    hashes = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(codes, i + j) for j in range(WINDOW)])))
    return compute_once(rows, _hashes=hashes).drop("_codes")


def _cut(array: str, at: str) -> Column:
    return F.slice(array, F.col(at) + 1, WINDOW)


def is_slot(word: Column) -> Column:
    return word.isin(NUMBER, NAME, UNIT)


def item_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(hash, item_id, item_words, at, item_raw, item_template) per window of every item.
    Windows with too few plain words are too common to count."""
    rows = _windowed(benchmark.select(F.col(item).cast("long").alias("item_id"),
                                      F.col(text).alias("_body")), F.col("_body"))
    rows = rows.withColumn("_raw", words(F.col("_line")))
    rows = rows.select("item_id", F.size("_words").alias("item_words"), "_raw", "_words",
                       F.posexplode("_hashes").alias("at", "hash"))
    rows = rows.select("hash", "item_id", "item_words", "at", _cut("_raw", "at").alias("item_raw"),
                       _cut("_words", "at").alias("item_template"))
    plain = F.size(F.filter("item_template", lambda w: ~is_slot(w)))
    return rows.where(plain >= LEAST_PLAIN).distinct()


def _hash_table(hashes: DataFrame) -> Column:
    """The hashes, BLOCK_WINDOWS numbers or so, as a constant: an array of buckets."""
    buckets: list[list[int]] = [[] for _ in range(BUCKETS)]
    for row in hashes.toLocalIterator():
        buckets[row["hash"] & (BUCKETS - 1)].append(row["hash"])
    return F.from_json(F.lit(json.dumps(buckets)), "array<array<bigint>>")


def _value(word: Column) -> Column:
    """A slot's value as it is compared: lower case, no edge punctuation."""
    bare = F.regexp_replace(F.lower(word), rf"^[^{SOLID}]+|[^{SOLID}]+$", "")
    return F.regexp_replace(bare, "'s$", "")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text",
                  cover: float = COVER) -> DataFrame:
    """(doc_id, row_key, item_id, item_words, covered_words, slots_changed): the benchmark
    items that stand in a text, re-parameterised or not.

    An item stands in a text if windows of consistent diagonals cover at least ``cover`` of
    its words. ``slots_changed`` tells whether a slot value differs. NULL and empty texts hold
    nothing, and items of fewer than WINDOW words are found nowhere. Repeated rows give one
    result; ``row_key`` is xxhash64 of key and text. NULL keys are results like others. Other
    columns are not read. Any number of items works: the texts are read once per
    BLOCK_WINDOWS benchmark windows.
    """
    items = stored(item_windows(benchmark, item, item_text), "benchmark-windows")
    hashes = items.select("hash").distinct()
    blocks = -(-hashes.count() // BLOCK_WINDOWS)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(key).cast("long"), F.col(text).cast("string"))
                       .alias("row_key"), F.col(text).cast("string").alias("_body"))
    rows = _windowed(rows, F.col("_body"))
    found = None
    for block in range(max(1, blocks)):
        part = hashes.where(F.pmod(F.shiftright("hash", 20), F.lit(max(1, blocks))) == block)
        held = _hash_table(part)
        hits = F.filter(
            F.transform("_hashes", lambda h, i: F.when(
                F.array_contains(F.get(held, h.bitwiseAND(BUCKETS - 1).cast("int")), h),
                F.struct(i.alias("place"), h.alias("hash")))),
            lambda hit: hit.isNotNull())
        some = compute_once(rows, _hits=hits).where(F.size("_hits") > 0).withColumn(
            "_raw", words(F.col("_line"))).select(
            "doc_id", "row_key", "_raw", F.explode("_hits").alias("_hit"))
        some = some.withColumn("place", F.col("_hit.place")).select(
            "doc_id", "row_key", "place", F.col("_hit.hash").alias("hash"),
            _cut("_raw", "place").alias("raw"))
        found = some if found is None else found.unionByName(some)

    met = found.join(items, "hash").withColumn("_slots", F.filter(
        F.zip_with(
            F.arrays_zip("item_template", "item_raw"), "raw",
            lambda of, word: F.when(is_slot(of["item_template"]), F.struct(
                F.struct(of["item_template"].alias("kind"), _value(of["item_raw"]).alias("value"))
                .alias("slot"), _value(word).alias("value")))),
        lambda slot: slot.isNotNull()))
    item_key = ["doc_id", "row_key", "item_id", "item_words"]
    diagonals = met.groupBy(*item_key, (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("places"),
        F.array_distinct(F.flatten(F.collect_set("_slots"))).alias("slots"))
    values = F.array_distinct(F.transform("slots", lambda s: s["slot"]))
    changed = F.exists("slots", lambda s: s["slot"]["value"] != s["value"])
    diagonals = diagonals.where(F.size(values) == F.size("slots")).withColumn("changed", changed)
    whole = diagonals.groupBy(*item_key).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("places")))).alias("places"),
        F.max("changed").alias("slots_changed"))
    places = F.col("places")
    covered = F.aggregate(
        F.transform(places, lambda p, i: F.when(i > 0, F.least(
            p - F.get(places, i - 1), F.lit(WINDOW))).otherwise(WINDOW)),
        F.lit(0), lambda total, x: total + x)
    return whole.withColumn("covered_words", covered).where(
        F.col("covered_words") >= cover * F.col("item_words")).select(
        "doc_id", "row_key", "item_id", "item_words", "covered_words", "slots_changed")


def decontaminated(docs: DataFrame, found: DataFrame, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`contamination` did not find, with all columns."""
    keys = stored(found.select(F.col("row_key").alias("_row_key")).distinct(), "contaminated")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.withColumn("_row_key", F.xxhash64(
        F.col("_row")[key].cast("long"), F.col("_row")[text].cast("string"))).join(
        keys, "_row_key", "left_anti").select("_row.*")
