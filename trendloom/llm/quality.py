"""Quality classifier: hashed word n-gram logistic regression trained by follow the
regularised leader (FTRL-proximal), scored as sparse dot products."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.hashing import (
    BYTES, EXACT_CODE, HASH_BYTES, SHINGLE_BASE, SPACE, U, mix, slabs, text_bytes, word_hashes,
)
from trendloom.llm.storage import bounded_batches

BITS = 18  # 2^BITS weights
SAMPLE = 8192  # training texts at most, half of them per class
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1.0
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

# Classes of bytes whose runs make up a word's shape: lower and non-ASCII letters, upper
# letters, digits; every other byte is its own class.
SHAPE = BYTES.astype(np.uint8)
SHAPE[(BYTES >= 97) & (BYTES <= 122) | (BYTES >= 128)] = ord("a")
SHAPE[(BYTES >= 65) & (BYTES <= 90)] = ord("A")
SHAPE[(BYTES >= 48) & (BYTES <= 57)] = ord("0")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; NULL keys are in no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def _shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with each run of one byte class inside a word cut to one byte."""
    kinds = SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | SPACE[data[1:]]
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    return kinds[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices, offsets) of every text's n-grams: words, word pairs, word shapes, pairs of
    shapes, and whether a word stands for the first time in its text. A text of n words has
    5n indices, in blocks of one kind."""
    words, bounds = word_hashes(data, offsets)
    shapes, _ = word_hashes(*_shapes(data, offsets), EXACT_CODE)
    n = len(words)
    lasts = bounds[1:][np.diff(bounds) > 0] - 1

    def pairs(x: np.ndarray) -> np.ndarray:
        following = np.concatenate((x[1:], np.zeros(min(n, 1), U)))
        following[lasts] = U(0)
        return mix(x * SHINGLE_BASE + following)

    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(U)
    new = np.zeros(n, U)
    new[np.unique(mix(text) ^ words, return_index=True)[1]] = U(1)
    kinds = [words, pairs(words), shapes, pairs(shapes), new]
    marked = np.stack([mix(x + U(k + 1)) for k, x in enumerate(kinds)], axis=1)
    return (marked & U((1 << bits) - 1)).astype(np.int64).ravel(), bounds * len(kinds)


def margins(indices: np.ndarray, bounds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Dot product of each text's counts, divided by the root of their number, with the
    weights; the last weight is the bias, alone for an empty text."""
    lengths = np.diff(bounds)
    sums = np.concatenate(([0.0], np.cumsum(weights[indices])))[bounds]
    return np.diff(sums) / np.sqrt(np.maximum(lengths, 1)) + weights[-1]


def train_ftrl(examples: Iterable[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS,
               alpha: float = ALPHA, beta: float = BETA, l1: float = L1,
               l2: float = L2) -> np.ndarray:
    """Weights (bias last) after ``epochs`` passes of FTRL-proximal over (distinct indices, their
    counts, label).
    Texts of one class only give its smoothed share as bias; no texts give zeros."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    # All texts lie in two buffers: small arrays would leave the driver's memory in pieces.
    packed, values, ends, targets = bytearray(), bytearray(), [0], []
    for at, counts, label in examples:
        packed += np.append(at, 1 << bits).astype(np.int32).tobytes()
        values += np.append(counts / np.sqrt(max(1, counts.sum())), 1.0).astype(np.float32).tobytes()
        ends.append(len(packed) // 4)
        targets.append(label)
    indices, xs = np.frombuffer(packed, np.int32), np.frombuffer(values, np.float32)

    def weight(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for lo, hi, label in zip(ends, ends[1:], targets):
            at, x = indices[lo:hi], xs[lo:hi]
            w = weight(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weight(np.arange((1 << bits) + 1))


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
           folds: int, held_out: int, size: int) -> DataFrame:
    """(text, label) of at most ``size`` labelled texts outside the held-out fold, at most
    half of them per class, chosen by a hash of the key."""
    known = labels.where(F.col(label).isin(0, 1) & (fold(key, folds) != held_out)).select(
        F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).distinct()
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_key"), "_key")
    chosen = known.withColumn("_n", F.row_number().over(order)).where(
        F.col("_n") <= size // 2).select("_key", "_label")
    # At most ``size`` rows of two numbers: a proven bound.
    return docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).join(
        F.broadcast(chosen), "_key").select("_key", "_text", "_label")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
        size: int = SAMPLE, bits: int = BITS) -> np.ndarray:
    """Learn weights from a bounded sample of the labelled texts. Rows without a key, with
    a label other than 0 or 1, or in the held-out fold teach nothing. A key whose labels
    differ counts once with each; texts of a repeated key all count, to ``size`` in all. Whole
    texts are learnt from: each is at most 2^bits indices with their counts, however long."""
    bounded_batches(docs.sparkSession)

    def indices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            rows, counts = [], []
            for _, _, part, inner in slabs(data, offsets, HASH_BYTES):
                found, bounds = features(part, inner, bits)
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    at, n = np.unique(found[lo:hi], return_counts=True)
                    rows.append(at.astype(np.int32).tobytes())
                    counts.append(n.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(rows, pa.binary()),
                 pa.array(counts, pa.binary())], names=["key", "label", "indices", "counts"])

    rows = sample(docs, labels, key, text, label, folds, held_out, size).mapInArrow(
        indices, "key long, label int, indices binary, counts binary")
    rows = rows.orderBy(F.xxhash64("key", F.lit(1)), "key", "label", "indices", "counts").limit(size)
    # Bytes, not lists of numbers: the driver holds 8 bytes for each distinct feature of a text.
    return train_ftrl(((np.frombuffer(r["indices"], np.int32), np.frombuffer(r["counts"], np.int32),
                        r["label"]) for r in rows.toLocalIterator()), bits)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = THRESHOLD,
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep..., score, predicted) per row, from the whole text. ``score`` is the chance of
    label 1. A NULL text scores as an empty one, by the bias alone. Columns not named in
    ``keep`` are not read; a column named score or predicted is not kept."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    bits = int(np.log2(len(weights) - 1))
    kept = docs.select(*keep, F.col(text).cast("string").alias("_text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            parts = [margins(*features(part, inner, bits), shared.value)
                     for _, _, part, inner in slabs(data, offsets, HASH_BYTES)]
            margin = np.concatenate(parts) if parts else np.zeros(0)
            chance = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(chance),
                 pa.array((chance >= threshold).astype(np.int32))],
                names=[*keep, "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return kept.mapInArrow(scored, ", ".join([*fields, "score double", "predicted int"]))
