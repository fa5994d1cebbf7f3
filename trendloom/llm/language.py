"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time. It labels every byte of a
text; a text's probabilities are the mean over its bytes. Texts are read whole, in segments of
one length that run side by side, so memory does not follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.hashing import slabs, text_bytes
from trendloom.llm.storage import stored

HIDDEN = 8  # units per direction
SEGMENT = 64  # bytes that one run of the network sees
SAMPLE = 600  # training texts per language, at most
SAMPLE_CHARS = 2_000  # characters kept of each training text, from a seeded place
STEPS, BATCH, RATE = 200, 256, 0.02
LANES = 4_096  # segments that run side by side
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
SEED = 11

Weights = dict[str, np.ndarray]


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; NULL keys are in no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1.0
    x *= 0.5
    return x


def _direction(inputs: np.ndarray, table: np.ndarray, inner: np.ndarray,
               keep: list | None = None) -> np.ndarray:
    """Hidden states (steps, units, lanes) of one direction. ``inputs`` (steps, lanes) holds
    bytes, ``table`` (3 units, 256) the input's part of update, reset and candidate, ``inner``
    (3 units, units) the state's. The gates are those of a GRU whose reset acts on the state's
    part of the candidate."""
    units = inner.shape[1]
    steps, lanes = inputs.shape
    out = np.empty((steps, units, lanes), np.float32)
    state = np.zeros((units, lanes), np.float32)
    for t in range(steps):
        fed = np.take(table, inputs[t], axis=1)
        own = inner @ state
        gates = _sigmoid(fed[:2 * units] + own[:2 * units])
        update, reset = gates[:units], gates[units:]
        candidate = np.tanh(fed[2 * units:] + reset * own[2 * units:])
        if keep is not None:
            keep.append((state, update, reset, candidate, own[2 * units:]))
        state = candidate + update * (state - candidate)
        out[t] = state
    return out


def _backward(grads: np.ndarray, inputs: np.ndarray, inner: np.ndarray,
              kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``table`` and ``inner`` from those of the states."""
    units = inner.shape[1]
    d_table, d_inner = np.zeros((256, 3 * units), np.float32), np.zeros_like(inner)
    carried = np.zeros_like(grads[0])
    for t in range(len(inputs) - 1, -1, -1):
        state, update, reset, candidate, own = kept[t]
        d_state = grads[t] + carried
        d_candidate = d_state * (1 - update) * (1 - candidate * candidate)
        d_update = d_state * (state - candidate) * update * (1 - update)
        d_reset = d_candidate * own * reset * (1 - reset)
        d_fed = np.concatenate((d_update, d_reset, d_candidate))
        d_own = np.concatenate((d_update, d_reset, d_candidate * reset))
        np.add.at(d_table, inputs[t], d_fed.T)
        d_inner += d_own @ state.T
        carried = d_state * update + inner.T @ d_own
    return d_table.T, d_inner


def _label(states: np.ndarray, weights: Weights) -> np.ndarray:
    """Probabilities (classes, ...) from states (2 units, ...)."""
    scores = np.tensordot(weights["out"], states, 1)
    scores += weights["bias"].reshape(-1, *[1] * (scores.ndim - 1))
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0)
    return scores


def train(segments: np.ndarray, lengths: np.ndarray, labels: np.ndarray, classes: int,
          hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, rate: float = RATE,
          seed: int = SEED) -> Weights:
    """Fit the network to (segments, steps) of bytes with Adam, every byte up to a segment's
    length being a labelled example."""
    rng = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[-1])).astype(np.float32)

    weights: Weights = {
        "table_f": start(3 * hidden, 256) * 4, "inner_f": start(3 * hidden, hidden),
        "table_b": start(3 * hidden, 256) * 4, "inner_b": start(3 * hidden, hidden),
        "out": start(classes, 2 * hidden), "bias": np.zeros(classes, np.float32)}
    first = {k: np.zeros_like(w) for k, w in weights.items()}
    second = {k: np.zeros_like(w) for k, w in weights.items()}
    for step in range(1, steps + 1):
        picked = rng.integers(0, len(segments), batch)
        inputs = segments[picked].T
        backwards = inputs[::-1]
        used = (np.arange(inputs.shape[0])[:, None] < lengths[picked]).astype(np.float32)
        kept_f: list = []
        kept_b: list = []
        ahead = _direction(inputs, weights["table_f"], weights["inner_f"], kept_f)
        behind = _direction(backwards, weights["table_b"], weights["inner_b"], kept_b)[::-1]
        states = np.concatenate((ahead, behind), axis=1).transpose(1, 0, 2)
        errors = _label(states, weights)
        errors[labels[picked], :, np.arange(batch)] -= 1
        errors *= used / used.sum()
        grads = {"out": np.tensordot(errors, states, ([1, 2], [1, 2])),
                 "bias": errors.sum(axis=(1, 2))}
        back = np.tensordot(weights["out"].T, errors, 1).transpose(1, 0, 2)
        grads["table_f"], grads["inner_f"] = _backward(
            back[:, :hidden], inputs, weights["inner_f"], kept_f)
        grads["table_b"], grads["inner_b"] = _backward(
            back[::-1, hidden:], backwards, weights["inner_b"], kept_b)
        pace = rate * (1 - step / (steps + 1))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            weights[k] -= (pace * (first[k] / (1 - 0.9 ** step))
                           / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return weights


def segmented(data: np.ndarray, offsets: np.ndarray,
              size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segments, lengths, text of each): whole texts cut into pieces of ``size`` bytes, the
    last one filled with zeros."""
    counts = -(-np.diff(offsets) // size)
    text = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = offsets[:-1][text] + nth * size
    lengths = np.minimum(size, offsets[1:][text] - begins)
    at = begins[:, None] + np.arange(size)
    inside = np.arange(size) < lengths[:, None]
    out = np.zeros(at.shape, np.uint8)
    out[inside] = data[at[inside]]
    return out, lengths, text


def text_chances(data: np.ndarray, offsets: np.ndarray, weights: Weights) -> np.ndarray:
    """(texts, classes): the mean probabilities over every byte; zeros for empty texts."""
    texts, classes = len(offsets) - 1, len(weights["bias"])
    totals = np.zeros((texts, classes))
    segments, lengths, text = segmented(data, offsets)
    for lo in range(0, len(segments), LANES):
        inputs = np.ascontiguousarray(segments[lo:lo + LANES].T)
        ahead = _direction(inputs, weights["table_f"], weights["inner_f"])
        behind = _direction(inputs[::-1], weights["table_b"], weights["inner_b"])[::-1]
        own = np.zeros((classes, inputs.shape[1]), np.float32)
        for t in range(len(inputs)):
            labelled = _label(np.concatenate((ahead[t], behind[t])), weights)
            own += np.where(t < lengths[lo:lo + LANES], labelled, 0)
        for c in range(classes):
            totals[:, c] += np.bincount(text[lo:lo + LANES], own[c], texts)
    return totals / np.maximum(1, np.diff(offsets))[:, None]


def sample(docs: DataFrame, key: str, text: str, lang: str, folds: int, held_out: int,
           size: int, chars: int) -> DataFrame:
    """(lang, piece, n): of each language at most ``size`` rows outside the held-out fold, those
    with the least hashes of their keys, and of each text ``chars`` characters from a seeded
    place. Keys and languages alone decide; the texts of the others do not move."""
    body = F.col(text).cast("string")
    room = F.greatest(F.length(body) - chars, F.lit(0)) + 1
    piece = F.substr(body, F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), room).cast("int") + 1,
                     F.lit(chars))
    known = docs.where(F.col(lang).isNotNull() & (fold(key, folds) != held_out)).select(
        F.xxhash64(F.col(key)).alias("order"), F.col(lang).cast("string").alias("lang"),
        body.alias("body"), piece.alias("piece"))
    first = Window.partitionBy("lang").orderBy("order")
    bounds = stored(known.select("lang", "order").withColumn("n", F.row_number().over(first)).where(
        F.col("n") <= size).groupBy("lang").agg(F.max("order").alias("most")), "language-sample")
    chosen = known.join(bounds, "lang").where("order <= most AND body IS NOT NULL")
    order = Window.partitionBy("lang").orderBy("order", "piece")
    return chosen.withColumn("n", F.row_number().over(order)).where(F.col("n") <= size).select(
        "lang", "piece", "n")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        folds: int = FOLDS, held_out: int = HELD_OUT, size: int = SAMPLE,
        chars: int = SAMPLE_CHARS) -> tuple[list[str], Weights]:
    """(languages, weights) learned from a bounded sample per language. Rows without a key,
    text or language and rows of the held-out fold teach nothing. Languages are drawn equally
    often. Without any example there is no language."""
    rows = sample(docs, key, text, lang, folds, held_out, size, chars).orderBy("lang", "n")
    langs: list[str] = []
    segments, lengths, labels = [], [], []
    for row in rows.toLocalIterator():
        if not langs or langs[-1] != row["lang"]:
            langs.append(row["lang"])
        data = np.frombuffer(row["piece"].encode("utf-8", "replace"), np.uint8)
        own, sizes, _ = segmented(data, np.array([0, len(data)]))
        segments.append(own)
        lengths.append(sizes)
        labels.append(np.full(len(own), len(langs) - 1))
    if not sum(map(len, labels)):
        return [], {}
    segments, lengths = np.concatenate(segments), np.concatenate(lengths)
    labels = np.concatenate(labels)
    rng = np.random.default_rng(SEED)
    groups = [np.flatnonzero(labels == c) for c in range(len(langs))]
    most = max(map(len, groups))
    even = np.concatenate([rng.choice(g, most) if len(g) else g for g in groups])
    return langs, train(segments[even], lengths[even], labels[even], len(langs))


def predict(docs: DataFrame, langs: list[str], weights: Weights, key: str = "doc_id",
            text: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row, from the whole text alone.

    ``score`` is the mean probability of the predicted language over all bytes. A NULL text
    or one without a letter is ``und`` with score 0, as is everything if no language was
    learned. Ties go to the alphabetically first language. A NULL key is not held out.
    Repeated rows stay; other columns are not read.
    """
    body = F.col(text).cast("string")
    lettered = F.coalesce(body.rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.coalesce(fold(key, folds) == held_out, F.lit(False)).alias("held_out"),
                       F.when(lettered, body).alias("text"))
    if not langs:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"),
                           F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = np.array([*langs, UNKNOWN], object)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            parts = [text_chances(part, inner, shared.value)
                     for _, _, part, inner in slabs(data, offsets)]
            chances = np.concatenate(parts) if parts else np.zeros((0, len(langs)))
            some = np.diff(offsets) > 0
            best = np.where(some, chances.argmax(axis=1), len(langs))
            score = np.where(some, chances.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names[best], pa.string()),
                 pa.array(np.clip(score, 0, 1), pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(predicted, "doc_id long, held_out boolean, lang_pred string, score double")
