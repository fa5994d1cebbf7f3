"""Term counts of documents as packed blocks, and windows made of them.

A row per (document, term) costs tens of bytes wherever it lies or moves. Here a task keeps the
counts of its documents as numbers, sorts them by topic, stretch of time and term, and lets one
compressed block leave per topic and stretch: each term of a block stands there once, and an
entry is a place in its list of documents and a count, two to five bytes in all. Blocks of the
same place are put together, so they can be stored, and read again by the days they are of.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.schemas import PACKED

DAY = 86_400
SPANS = 100  # a stretch of time is so many times as long as a window
HELD = 1 << 22  # entries, or half as many documents or tokens, that a task keeps before blocks leave
KINDS = [np.dtype(kind) for kind in ("u1", "u2", "u4", "u8")]


def stretch(window: int, slide: int) -> int:
    """Seconds of a stretch of time."""
    if window % slide:
        raise ValueError("the window must be a multiple of the slide")
    return SPANS * window


def runs(tokens: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct terms, rows, codes, n) of the tokens of each list, NULL ones left out."""
    coded = tokens.flatten().dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(tokens)), lengths)
    known = coded.is_valid().to_numpy(zero_copy_only=False)
    codes = pc.fill_null(coded.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(coded.dictionary))
    found, n = np.unique(rows[known] * size + codes[known], return_counts=True)
    return coded.dictionary, found // size, found % size, n


def _numbers(values: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as the largest needs."""
    most = int(values.max()) if len(values) else 0
    kind = next(i for i, k in enumerate(KINDS) if most <= np.iinfo(k).max)
    return struct.pack("<BQ", kind, len(values)) + values.astype(KINDS[kind]).tobytes()


def _taken(data: memoryview, at: int) -> tuple[np.ndarray, int]:
    kind, n = struct.unpack_from("<BQ", data, at)
    values = np.frombuffer(data, KINDS[kind], n, at + 9)
    return values, at + 9 + values.nbytes


def _strings(values: pa.Array) -> bytes:
    """Strings; a NULL one has the length 0, others one more than theirs."""
    lengths = pc.fill_null(pc.add(pc.binary_length(values), 1), 0).to_numpy(zero_copy_only=False)
    # Copied, so that the strings lie one after the other, NULL ones without bytes.
    values = pc.fill_null(values, "").take(pa.array(np.arange(len(values))))
    _, offsets, data = values.buffers()
    size = int(np.frombuffer(offsets, np.int32)[len(values)]) if len(values) else 0
    return _numbers(lengths) + struct.pack("<Q", size) + (
        memoryview(data)[:size].tobytes() if size else b"")


def _strings_taken(data: memoryview, at: int) -> tuple[pa.Array, int]:
    lengths, at = _taken(data, at)
    size, = struct.unpack_from("<Q", data, at)
    lengths = lengths.astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(np.maximum(lengths - 1, 0)))).astype(np.int32)
    none = pc.invert(pa.array(lengths == 0)) if (lengths == 0).any() else None
    valid = none.buffers()[1] if none is not None else None
    values = pa.StringArray.from_buffers(
        len(lengths), pa.py_buffer(offsets), pa.py_buffer(data[at + 8:at + 8 + size]), valid)
    return values, at + 8 + size


def block(slides: np.ndarray, lengths: np.ndarray, ids: pa.Array | None, terms: pa.Array,
          counts: np.ndarray, docs: np.ndarray, n: np.ndarray) -> bytes:
    """Documents (slide within the stretch, length, id), terms, documents of each term, and the
    entries (document, occurrences) term by term."""
    body = b"".join((_numbers(slides), _numbers(lengths), _strings(ids) if ids is not None else b"",
                     _strings(terms), _numbers(counts), _numbers(docs), _numbers(n)))
    return struct.pack("<Q?", len(body), ids is not None) + pa.compress(body, "zstd", asbytes=True)


def opened(data: bytes) -> tuple:
    """What :func:`block` was made of."""
    size, with_ids = struct.unpack_from("<Q?", data)
    body = memoryview(pa.decompress(data[9:], size, "zstd", asbytes=True))
    slides, at = _taken(body, 0)
    lengths, at = _taken(body, at)
    ids, at = _strings_taken(body, at) if with_ids else (None, at)
    terms, at = _strings_taken(body, at)
    counts, at = _taken(body, at)
    docs, at = _taken(body, at)
    n, _ = _taken(body, at)
    return slides, lengths, ids, terms, counts, docs, n


class _Held:
    """The documents that a task keeps."""

    def __init__(self, window: int, slide: int, parts: int):
        self.window, self.slide, self.parts, self.span = window, slide, parts, stretch(window, slide)
        self._empty()

    def _empty(self) -> None:
        self.docs: list[tuple] = []  # topics, slides, lengths, ids
        self.entries: list[tuple] = []  # distinct terms, documents, codes, occurrences
        self.n_docs = self.n_entries = 0

    def add(self, batch: pa.RecordBatch) -> None:
        terms, rows, codes, n = runs(batch.column(2))
        empty = pc.index(terms, "").as_py()
        if empty >= 0:
            some = codes != empty
            rows, codes, n = rows[some], codes[some], n[some]
        lengths = pc.fill_null(pc.list_value_length(batch.column(2)), 0)
        self.docs.append((batch.column(0), batch.column(1).to_numpy(zero_copy_only=False),
                          lengths.to_numpy(zero_copy_only=False).astype(np.int64),
                          batch.column(3) if batch.num_columns > 3 else None))
        self.entries.append((terms, rows.astype(np.int64) + self.n_docs, codes, n))
        self.n_docs += batch.num_rows
        self.n_entries += len(rows)

    def full(self) -> bool:
        return max(self.n_entries, 2 * self.n_docs) >= HELD

    def _places(self, topics: pa.Array, slides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each document, a document of each place): topic, stretch, whether the slide
        is also in windows that start in the stretch before, and day."""
        stretches = slides // self.span
        head = slides - stretches * self.span < self.window - self.slide
        place = topics.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for values in (stretches, head, slides // DAY):
            _, codes = np.unique(values, return_inverse=True)
            _, place = np.unique(place * (int(codes.max()) + 1) + codes, return_inverse=True)
        return place, np.unique(place, return_index=True)[1]

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """All that is kept, as rows of blocks."""
        if not self.n_docs:
            return
        topics = pa.chunked_array([d[0] for d in self.docs]).combine_chunks().dictionary_encode()
        slides, lengths = (np.concatenate([d[i] for d in self.docs]) for i in (1, 2))
        ids = None if self.docs[0][3] is None else pa.concat_arrays([d[3] for d in self.docs])
        place, one = self._places(topics, slides)
        by_place = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[by_place], np.arange(len(one) + 1))
        within = np.empty(len(place), np.int64)  # a document's number in its place
        within[by_place] = np.arange(len(place)) - bounds[place[by_place]]
        within_span = (slides - slides // self.span * self.span) // self.slide

        terms = pa.concat_arrays([e[0] for e in self.entries]).dictionary_encode()
        recode = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.cumsum([0, *[len(e[0]) for e in self.entries]])
        codes = np.concatenate([recode[e[2] + begin] for e, begin in zip(self.entries, begins)])
        docs, n = (np.concatenate([e[i] for e in self.entries]) for i in (1, 3))
        self._empty()
        terms = terms.dictionary
        order = pc.sort_indices(terms)
        rank = np.empty(len(terms), np.int64)
        rank[order.to_numpy()] = np.arange(len(terms))
        terms, codes = terms.take(order), rank[codes]
        part = np.zeros(len(terms), np.int64)
        if self.parts > 1:
            part = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % self.parts
                             for t in terms.to_pylist()], np.int64)
        size = max(1, len(terms))
        key = (place[docs] * self.parts + part[codes]) * size + codes
        order = np.argsort(key, kind="stable")
        key, docs, n = key[order], within[docs[order]], n[order]
        starts = np.searchsorted(key, np.arange(len(one) * self.parts + 1) * size)
        topic_of = topics.dictionary.take(pa.array(topics.indices.take(pa.array(one))))
        rows: list[tuple] = []
        for i, doc in enumerate(one.tolist()):
            own = by_place[bounds[i]:bounds[i + 1]]
            own_ids = None if ids is None else ids.take(pa.array(own))
            slide = int(slides[doc])
            stretch_of = slide // self.span
            known = np.unique(slides[own]).tolist()
            for p in range(self.parts):
                lo, hi = starts[i * self.parts + p], starts[i * self.parts + p + 1]
                at = key[lo:hi] % size
                new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else at
                data = block(within_span[own], lengths[own], own_ids, terms.take(pa.array(at[new])),
                             np.diff(np.append(new, len(at))), docs[lo:hi], n[lo:hi])
                rows.append((topic_of[i].as_py(), stretch_of,
                             slide - stretch_of * self.span < self.window - self.slide, p, self.parts,
                             known if p == 0 else [], data, slide // DAY))
                if len(rows) >= 64:
                    yield _rows(rows)
                    rows = []
        if rows:
            yield _rows(rows)


SCHEMA = pa.schema([("topic", pa.string()), ("stretch", pa.int64()), ("head", pa.bool_()),
                    ("part", pa.int32()), ("parts", pa.int32()), ("slides", pa.list_(pa.int64())),
                    ("block", pa.binary()), ("day", pa.int32())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows), SCHEMA)], schema=SCHEMA)


def parts_of(docs: DataFrame) -> int:
    """Into how many parts the terms of a place are dealt out: a power of two that grows with the
    session's shuffle partitions, which grow with the data."""
    wanted = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16
    return 1 << max(0, wanted.bit_length() - 1)


def packed(docs: DataFrame, topic: str, slide_start: Column, tokens: str, window: int, slide: int,
           doc_id: str | None = None, parts: int | None = None) -> DataFrame:
    """Blocks (PACKED) of documents. A document without topic or time is in no window."""
    stretch(window, slide)
    parts = parts_of(docs) if parts is None else parts
    rows = docs.select(F.col(topic).cast("string").alias("topic"), slide_start.alias("slide"),
                       F.col(tokens).alias("tokens"),
                       *([F.col(doc_id).cast("string").alias("id")] if doc_id else []))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(window, slide, parts)
        for batch in batches:
            batch = batch.filter(pc.and_(pc.is_valid(batch.column(0)), pc.is_valid(batch.column(1))))
            if batch.num_rows:
                held.add(batch)
            if held.full():
                yield from held.blocks()
        yield from held.blocks()

    return rows.mapInArrow(made, PACKED)


class _Place:
    """The documents and entries of a place, by slides; terms are numbered in their order."""

    def __init__(self, blocks: list[tuple[int, bytes]], place: int, spans: int, with_ids: bool):
        n_slides = SPANS * spans
        slides, lengths, ids, terms, codes, docs, n = [], [], [], [], [], [], []
        n_docs = n_terms = 0
        for stretch_of, data in blocks:
            own, length, doc_ids, words, counts, at, times = opened(data)
            slides.append(own.astype(np.int64) + (stretch_of - place) * n_slides)
            lengths.append(length)
            ids.append(doc_ids)
            terms.append(words)
            codes.append(np.repeat(np.arange(n_terms, n_terms + len(words), dtype=np.int32),
                                   counts.astype(np.int64)))
            docs.append(at.astype(np.int32) + np.int32(n_docs))
            n.append(times.astype(np.int32))
            n_docs += len(own)
            n_terms += len(words)
        coded = pa.concat_arrays(terms).dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        rank = np.empty(len(coded.dictionary), np.int32)
        rank[order.to_numpy()] = np.arange(len(coded.dictionary), dtype=np.int32)
        self.terms = coded.dictionary.take(order)
        codes = rank[coded.indices.to_numpy(zero_copy_only=False)][np.concatenate(codes)]
        slide = np.concatenate(slides)
        self.ids = pa.concat_arrays(ids) if with_ids else None
        docs, n = np.concatenate(docs), np.concatenate(n)
        order = np.argsort(slide[docs].astype(np.uint16 if 2 * n_slides < 1 << 16 else np.int64),
                           kind="stable")
        self.codes, self.docs, self.n = codes[order], docs[order], n[order]
        self.lengths = np.concatenate(lengths).astype(np.int64)
        bounds = np.arange(n_slides + spans)
        self.at = np.searchsorted(slide[self.docs], bounds)
        self.n_docs = np.searchsorted(np.sort(slide), bounds)
        self.table = np.zeros(len(self.terms), np.float64)  # scratch, a value per term

    def looked_up(self, codes: np.ndarray, values: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """The value of the term of each entry; 0 where the term has none."""
        self.table[codes] = values
        found = self.table[self.codes[lo:hi]]
        self.table[codes] = 0
        return found

    def counted(self, lo: int, hi: int, weights: np.ndarray | None = None) -> tuple:
        """(codes of the terms of some entries, in order; number or sum of weights of each)."""
        codes = self.codes[lo:hi]
        if 4 * (hi - lo) < len(self.terms):
            found, place = np.unique(codes, return_inverse=True)
            return found, np.bincount(place, weights)
        counts = np.bincount(codes, weights)
        found = np.flatnonzero(counts)
        return found, counts[found]


def by_places(blocks: DataFrame, window: int, slide: int, parts: int, with_ids: bool, schema: str,
              one_window: Callable[[_Place, int, int, int], dict | None]) -> DataFrame:
    """Rows (topic, window_start, n_docs and what ``one_window`` gives as columns) of blocks of
    which all windows of a place and part of the terms are made by one task."""
    places = F.explode(F.when(F.col("head"), F.array(F.col("stretch"), F.col("stretch") - 1))
                       .otherwise(F.array("stretch"))).alias("place")
    spread = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = blocks.select("topic", places, F.pmod("part", F.lit(parts)).alias("part"), "stretch",
                         "block").repartition(spread, "topic", "place", "part")
    rows = rows.sortWithinPartitions("topic", "place", "part")
    spans, names = window // slide, [f.split()[0] for f in schema.split(", ")]

    def windows(topic: str, place: int, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        own = _Place(held, place, spans, with_ids)
        for start in range(SPANS * spans):
            lo, hi = int(own.at[start]), int(own.at[start + spans])
            if lo == hi:
                continue
            found = one_window(own, lo, hi, int(own.n_docs[start + spans] - own.n_docs[start]))
            size = len(found[names[-1]])
            found |= {"topic": pa.repeat(topic, size),
                      "window_start": pa.repeat((place * SPANS * spans + start) * slide, size),
                      "n_docs": pa.repeat(int(own.n_docs[start + spans] - own.n_docs[start]), size)}
            yield pa.RecordBatch.from_arrays([pa.array(found[name]) for name in names], names=names)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for i, new in enumerate(zip(*columns)):
                if new != key and held:
                    yield from windows(*key[:2], held)
                    held = []
                key = new
                held.append((batch.column(3)[i].as_py(), batch.column(4)[i].as_py()))
        if held:
            yield from windows(*key[:2], held)

    return rows.mapInArrow(made, schema)


def frequent_terms(blocks: DataFrame, window: int, slide: int, parts: int, pool: int) -> DataFrame:
    """(topic, window_start, n_docs, term, n, df, max_tf): the ``pool`` most frequent terms of each
    window, of each part of the terms."""
    def one_window(own: _Place, lo: int, hi: int, n_docs: int) -> dict:
        codes, n = own.counted(lo, hi, own.n[lo:hi])
        if len(codes) > pool:
            reach = np.partition(n, len(n) - pool)[len(n) - pool]
            some = np.flatnonzero(n >= reach)
            some = np.sort(some[np.argsort(-n[some], kind="stable")[:pool]])
            codes, n = codes[some], n[some]
        place = own.looked_up(codes, np.arange(1, len(codes) + 1), lo, hi)
        here = np.flatnonzero(place)
        place = place[here].astype(np.int64) - 1
        tf = own.n[lo:hi][here] / own.lengths[own.docs[lo:hi][here]]
        max_tf = np.zeros(len(codes))
        np.maximum.at(max_tf, place, tf)
        return {"term": own.terms.take(pa.array(codes)), "n": n.astype(np.int64),
                "df": np.bincount(place, minlength=len(codes)).astype(np.int64),
                "max_tf": max_tf}

    return by_places(blocks, window, slide, parts, False,
                     "topic string, window_start long, n_docs long, term string, n long, df long, "
                     "max_tf double", one_window)


NEAR = 1e-8  # scores nearer than this may be equal after rounding


def best_pairs(blocks: DataFrame, window: int, slide: int, parts: int, k: int) -> DataFrame:
    """(topic, window_start, n_docs, term, df, id, less_tf): pairs of each window that hold the
    ``k`` best by score, term and id, of each part of the terms. Of pairs with one score only the
    first ``k`` are given."""
    def one_window(own: _Place, lo: int, hi: int, n_docs: int) -> dict:
        codes, df = own.counted(lo, hi)
        df = own.looked_up(codes, df, lo, hi)
        tf = own.n[lo:hi] / own.lengths[own.docs[lo:hi]]
        score = np.log10(n_docs / df) * tf
        if len(score) > k:
            score_k = np.partition(score, len(score) - k)[len(score) - k]
            some = np.flatnonzero(score >= score_k - NEAR)
        else:
            some = np.arange(len(score))
        if len(some) > k:
            ids = own.ids.take(pa.array(own.docs[lo:hi][some]))
            id_rank = pc.rank(ids, "ascending", null_placement="at_start", tiebreaker="dense")
            order = np.lexsort((id_rank.to_numpy(), own.codes[lo:hi][some], -score[some]))
            some = some[order]
            new = np.concatenate(([True], score[some[1:]] != score[some[:-1]]))
            begins = np.flatnonzero(new)
            nth = np.arange(len(some)) - np.repeat(begins, np.diff(np.append(begins, len(some))))
            some = some[nth < k]
        return {"term": own.terms.take(pa.array(own.codes[lo:hi][some])),
                "df": df[some].astype(np.int64),
                "id": own.ids.take(pa.array(own.docs[lo:hi][some])), "less_tf": -tf[some]}

    return by_places(blocks, window, slide, parts, True,
                     "topic string, window_start long, n_docs long, term string, df long, id string, "
                     "less_tf double", one_window)
