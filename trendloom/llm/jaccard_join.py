"""N-gram Jaccard join by grouped prefixes.

Word shingles are put in one global order, rare ones first. Sets that overlap enough share a
shingle in their prefixes. Documents with the same prefix and size form one group; only
groups are indexed and filtered as pairs, then expanded to their members and verified on the
texts.

The answer wanted is the connected classes, so links inside a class already known need no
proof. A first round verifies a star in every prefix shingle and size band and joins the
classes it finds. A few members of each shingle's largest class are then compared with all
others there, and for every two classes the closest pair by signature is verified. The last
round verifies every pair of members that share a prefix
shingle, pass the filters by size, position and parity signature (all without false
rejections) and are still in different classes. Dense groups
of copies thus cost one verification a member, and no link between classes is lost. Shingles
of two members alone, by far the most, are settled by the first round and left out later.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.components import components
from trendloom.llm.hashing import (
    HASH_BYTES, U, batch_shingles, mix, shingle_hashes, slabs, text_bytes, word_hashes,
)
from trendloom.llm.storage import (
    bounded_batches, key_bits, rows_by_bits, rows_with_keys, stored,
)

SIZE = 5  # words of a shingle
PERCENT = 80  # least Jaccard similarity
BRIDGES = 8  # members of a shingle's largest class that all others there are tried with
ORDER_BITS = 25  # frequencies are counted for 2^ORDER_BITS classes of shingles
STEPS = 8  # levels of frequency to a doubling
MOST_SEEN = 1 << 20  # groups that a task remembers to have sent
CHUNK_BITS = 19  # counts that travel in one row
SPARSE = 64  # a chunk where one count in so many, or fewer, is not zero travels as places and counts
SIGNATURE = 8  # 64-bit words of a set's parity signature; larger sets have a finer one as well


def _order(docs: DataFrame, size: int) -> np.ndarray:
    """Level of each class of shingles (by their top bits): how often it occurs in all texts,
    as a logarithm in a byte. Any order gives the same result; this one keeps frequent shingles
    out of the prefixes. A table of fixed size."""
    classes, chunk = 1 << ORDER_BITS, 1 << CHUNK_BITS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes, np.uint8)  # of one task; a class is frequent at 255 already
        for batch in batches:
            for _, _, part, inner in slabs(*text_bytes(batch.column(0)), HASH_BYTES):
                hashes, _ = shingle_hashes(*word_hashes(part, inner), size)
                at, n = np.unique((hashes >> U(64 - ORDER_BITS)).astype(np.int64),
                                  return_counts=True)
                total[at] = np.minimum(total[at] + n, 255)
        rows = []
        for i in range(classes // chunk):
            part = total[i * chunk:(i + 1) * chunk]
            at = np.flatnonzero(part)
            if len(at) * SPARSE <= chunk:
                packed = at.astype(np.int32).tobytes(), part[at].tobytes()
            else:
                packed = None, zlib.compress(part.tobytes(), 1)
            if len(at):
                rows.append((i, *packed))
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(
                (pa.int32(), pa.binary(), pa.binary()))], names=["chunk", "places", "counts"])

    def levelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, places, part in zip(batch.column(0).to_pylist(), batch.column(1),
                                       batch.column(2)):
                if i not in totals:
                    totals[i] = np.zeros(chunk, np.int64)
                if places.is_valid:
                    totals[i][np.frombuffer(places.as_buffer(), np.int32)] += np.frombuffer(
                        part.as_buffer(), np.uint8)
                else:
                    totals[i] += np.frombuffer(zlib.decompress(part.as_buffer()), np.uint8)
        levels = [np.minimum(STEPS * np.log2(n + 1.0), 255).astype(np.uint8)
                  for n in totals.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()),
             pa.array([zlib.compress(x.tobytes(), 1) for x in levels], pa.binary())],
            names=["chunk", "levels"])

    levels = np.zeros(classes, np.uint8)
    # At most 32 MB, compressed, in one job: an iterator would start one for each partition.
    for row in docs.mapInArrow(counted, "chunk int, places binary, counts binary").repartition(
            "chunk").mapInArrow(levelled, "chunk int, levels binary").collect():
        at = row["chunk"] * chunk
        levels[at:at + chunk] = np.frombuffer(zlib.decompress(row["levels"]), np.uint8)
    return levels


def ordered_set(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The distinct shingles in the global order: by level, then by their own value."""
    tokens = np.unique(hashes)
    level = levels[(tokens >> U(64 - ORDER_BITS)).astype(np.int64)]
    return tokens[np.argsort(level, kind="stable")]


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-n * percent // 100) + 1


def _fingerprint(tokens: np.ndarray) -> bytes:
    """128 bits of a set."""
    a, b = int(mix(tokens).sum(dtype=U)), int(mix(tokens ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=U))
    return a.to_bytes(8, "big") + b.to_bytes(8, "big")


def _signature(tokens: np.ndarray, bits: int = 64 * SIGNATURE) -> np.ndarray:
    """For each of ``bits`` classes of shingles, whether the set has an odd number.
    Two signatures differ in no more bits than the sets have shingles apart."""
    odd = np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _fine_bits(n: int) -> int:
    """Bits of the finer signature of a set of ``n`` shingles: a power of two from n on. Half of
    any bits differ by chance, so fewer tell nothing. Sets of few shingles need none."""
    bits = 1 << max(n - 1, 0).bit_length()
    return bits if bits > 64 * SIGNATURE else 0


def _apart(left: str, right: str) -> Column:
    """Bits in which the signatures differ."""
    left, right = F.col(left)["words"], F.col(right)["words"]
    return sum((F.bit_count(left[i].bitwiseXOR(right[i])) for i in range(SIGNATURE)), F.lit(0))


def _apart_finely(left: str, right: str) -> Column:
    """The same of the finer signatures, where both sets have one and of like length, else NULL.
    Halves of a signature make the next shorter one."""
    left, right = F.col(left)["fine"], F.col(right)["fine"]
    size = F.least(F.size(left), F.size(right))

    def folded(words: Column) -> Column:
        return F.when(F.size(words) > size, F.zip_with(
            F.slice(words, 1, size), F.slice(words, size + 1, size),
            lambda x, y: x.bitwiseXOR(y))).otherwise(words)

    bits = F.zip_with(folded(left), folded(right), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.when((size > 0) & (F.greatest(F.size(left), F.size(right)) <= 2 * size),
                  F.aggregate(bits, F.lit(0), lambda total, x: total + x))


def _alike(n: str, left: str, m: str, right: str, percent: int) -> Column:
    """The signatures allow the similarity: the sets are at most
    (n + m) * (100 - percent) / (100 + percent) shingles apart."""
    def few(apart: Column) -> Column:
        return apart * (100 + percent) <= (F.col(n) + F.col(m)) * (100 - percent)

    return few(_apart(left, right)) & F.coalesce(few(_apart_finely(left, right)), F.lit(True))


def _sets(docs: DataFrame, levels: np.ndarray, size: int, percent: int) -> DataFrame:
    """(doc_id, row_key, n, node, gid, signature, prefix) per row of (doc_id, row_key, text).
    The prefix is NULL where the task remembers to have sent this group's."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            counts, nodes, groups, signatures, finer, prefixes = [], [], [], [], [], []
            for _, hashes in batch_shingles(batch.column(2), size):
                tokens = ordered_set(hashes, shared.value)
                n = len(tokens)
                prefix = tokens[:prefix_length(n, percent)] if n else tokens
                group = int(mix(np.append(prefix, U(n)) + np.arange(len(prefix) + 1, dtype=U))
                            .sum(dtype=U).view(np.int64))
                counts.append(n)
                nodes.append(_fingerprint(tokens) if n else None)
                groups.append(group)
                signatures.append(_signature(tokens))
                finer.append(_signature(tokens, _fine_bits(n)) if _fine_bits(n) else [])
                prefixes.append(None if not n or group in seen else prefix.view(np.int64))
                if len(seen) >= MOST_SEEN:
                    seen.clear()
                seen.add(group)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(nodes, pa.binary()), pa.array(groups, pa.int64()),
                 pa.StructArray.from_arrays(
                     [pa.array(signatures, pa.list_(pa.int64())),
                      pa.array(finer, pa.list_(pa.int64()))], names=["words", "fine"]),
                 pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "row_key", "n", "node", "gid", "signature", "prefix"])

    return docs.mapInArrow(made, "doc_id long, row_key long, n long, node binary, gid long, "
                                 "signature struct<words: array<long>, fine: array<long>>, "
                                 "prefix array<long>")


def _fits(n: str, m: str, percent: int) -> Column:
    """The sizes allow the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _reaches(n: str, i: str, m: str, j: str, percent: int) -> Column:
    """Sets of ``n`` and ``m`` with a common shingle at ``i`` and ``j`` (from 0) can overlap
    enough: 100 * overlap >= percent * (n + m - overlap)."""
    n, i, m, j = (F.col(c) for c in (n, i, m, j))
    most = F.least(i, j) + 1 + F.least(n - i, m - j) - 1
    return most * (100 + percent) >= (n + m) * percent


def _index(sets: DataFrame, percent: int) -> DataFrame:
    """(token, gid, n, pos, reps, more): the prefix shingles that several groups share. ``reps``
    are the first group of the shingle's size band and the first of the shingle, by size.
    ``more`` is whether more than two groups share it. The index moves once."""
    # Size and place travel as one number, which sorts by size.
    rows = sets.where(F.col("prefix").isNotNull()).select(
        "gid", "n", F.posexplode("prefix").alias("pos", "token")).select(
        "token", "gid", (F.shiftleft("n", 32) + F.col("pos")).alias("at"))
    by_token = Window.partitionBy("token").orderBy("at", "gid")
    whole = by_token.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size = F.shiftright("at", 32)
    rows = rows.select(
        "*", F.lag("gid").over(by_token).alias("_before"),
        (F.min("gid").over(whole) != F.max("gid").over(whole)).alias("_several"),
        F.first(F.struct("gid", "at")).over(by_token).alias("_first"))
    # A group that another task has sent as well stands next to itself.
    rows = rows.where("_several AND NOT (_before <=> gid)").withColumn(
        "band", F.floor(F.log(size.cast("double")) / math.log(100 / percent)))
    by_band = Window.partitionBy("token", "band").orderBy("at", "gid")
    rows = rows.withColumn("_rep", F.first(F.struct("gid", "at")).over(by_band))

    def place(at: str) -> Column:
        return F.col(at).bitwiseAND((1 << 32) - 1).cast("int")

    return rows.select(
        "token", "gid", size.cast("int").alias("n"), place("at").alias("pos"),
        F.array_distinct(F.array("_rep", "_first")).alias("reps"),
        (F.count("*").over(whole) > 2).alias("more"))


def _unsettled(index: DataFrame, large: DataFrame) -> DataFrame:
    """The rows of ``index`` whose shingle has more than two members. Two groups of one member
    each have been tried with each other, which is all there is. ``large`` has the ``gid`` of
    the groups of several members."""
    two = index.where(~F.col("more")).select("gid", "token")
    tokens = stored(rows_with_keys(two, large, "gid").join(large, "gid").select("token").distinct(),
                    "jaccard-large")
    rows = index.select("token", "gid", "pos", "more")
    again = rows_with_keys(rows.where(~F.col("more")), tokens, "token").join(tokens, "token")
    return rows.where("more").unionByName(again).drop("more")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough, by exact comparison."""
    named = texts.select("node", "text")
    rows = pairs.join(named.withColumnsRenamed({"node": "a", "text": "text_a"}), "a").join(
        named.withColumnsRenamed({"node": "b", "text": "text_b"}), "b").select(
        "a", "b", "text_a", "text_b")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for (_, x), (_, y) in zip(batch_shingles(batch.column(2), size),
                                      batch_shingles(batch.column(3), size)):
                x, y = np.unique(x), np.unique(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(similar, "a binary, b binary")


def _texts(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``pairs``: the text of one document each."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))).distinct()
    picked = stored(sets.where(F.col("n") > 0).groupBy("node").agg(
        F.min("row_key").alias("row_key")).join(wanted, "node", "left_semi"), "jaccard-picked")
    found = rows_with_keys(docs.select("row_key", "text"), picked, "row_key")
    return stored(found.join(picked, "row_key").groupBy("row_key", "node").agg(
        F.first("text").alias("text")).select("node", "text"), "jaccard-texts")


def _bridges(rows: DataFrame) -> DataFrame:
    """BRIDGES rows of every token, chosen by hashes: another few for each token."""
    own = [c for c in rows.columns if c != "token"]
    chosen = rows.groupBy("token").agg(*[
        F.min_by(F.struct(*own), F.xxhash64(F.lit(i), "token", "node")).alias(f"_{i}")
        for i in range(BRIDGES)])
    return chosen.select("token", F.explode(F.array_distinct(F.array(*[
        f"_{i}" for i in range(BRIDGES)]))).alias("_row")).select("token", "_row.*")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): ``classes`` after further links. Only the links between classes are
    followed. Nodes without a class yet are classes of their own."""
    ends = links
    for end in "ab":
        ends = ends.join(classes.withColumnRenamed("node", end), end, "left").withColumn(
            end, F.coalesce("component", end)).drop("component")
    found = components(ends).select(F.col("node").alias("component"),
                                    F.col("component").alias("_name"))
    known = classes.join(found, "component", "left").select(
        "node", F.coalesce("_name", "component").alias("component"))
    fresh = found.select(F.col("component").alias("node"), F.col("_name").alias("component"))
    return stored(known.unionByName(fresh.join(classes, "node", "left_anti")), "jaccard-classes")


def jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, row_key, n_shingles, component_id, component) per row of ``docs``.

    ``component_id`` is the smallest key among the documents that links reach, the document
    itself included. ``row_key`` is xxhash64 of the text, to find the row again. Documents
    with equal sets are linked. A text without words, or NULL, has no shingles and is linked
    with nothing: its component is its own key. NULL keys take part but never name a class
    that has another key. Repeated rows are rows of their own. Texts of any length are compared
    whole. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(key).cast("long"), F.col(text).cast("string")).alias("row_key"),
                       F.col(text).cast("string").alias("text"))
    sets = stored(_sets(docs, _order(docs.select("text"), size), size, percent), "jaccard-sets")
    members = stored(sets.where(F.col("n") > 0).groupBy("node").agg(
        F.first("gid").alias("gid"), F.first("n").cast("int").alias("n"),
        F.first("signature").alias("signature")), "jaccard-members")
    index = stored(_index(sets, percent), "jaccard-index")
    leads = members.groupBy("gid").agg(F.min_by(F.struct("node", "n", "signature"), "node")
                                       .alias("lead")).select(
        F.col("gid").alias("rep"), F.col("lead.node").alias("a"), F.col("lead.n").alias("an"),
        F.col("lead.signature").alias("as"))
    bs = members.select("gid", F.col("node").alias("b"), F.col("n").alias("bn"),
                        F.col("signature").alias("bs"))

    near = index.select("gid", "n", "pos", F.explode("reps").alias("_rep")).select(
        "gid", "n", "pos", F.col("_rep.gid").alias("rep"),
        F.shiftright("_rep.at", 32).cast("int").alias("rep_n"),
        F.col("_rep.at").bitwiseAND((1 << 32) - 1).cast("int").alias("rep_pos"))
    near = near.where((F.col("rep") != F.col("gid")) & _fits("rep_n", "n", percent)
                      & _reaches("rep_n", "rep_pos", "n", "pos", percent))
    stars = near.select("rep", "gid").distinct().join(leads, "rep").join(bs, "gid")
    inside = bs.join(leads, bs["gid"] == leads["rep"]).where(F.col("a") != F.col("b"))
    pairs = stored(stars.where(_alike("an", "as", "bn", "bs", percent)).select("a", "b").unionByName(
        inside.where(_alike("an", "as", "bn", "bs", percent)).select("a", "b")).distinct(),
        "jaccard-pairs")
    links = stored(_verified(pairs, _texts(docs, sets, pairs), size, percent), "jaccard-links")
    classes = components(links)

    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    signatures = members.select("node", "signature")
    several = stored(members.groupBy("gid").agg(F.count("*").alias("_size")).where("_size > 1"),
                     "jaccard-several")
    expanded = _unsettled(index, several.select("gid")).join(
        members.drop("signature"), "gid").select("token", "node", "n", "pos")
    # The members of a group share their whole prefix; for them the group is one shingle more.
    alike = members.join(several.where("_size > 2"), "gid", "left_semi").select(
        F.col("gid").alias("token"), "node", "n", F.lit(0).alias("pos"))
    tokens = stored(expanded.unionByName(alike), "jaccard-tokens")
    for bridge in (True, False):
        # Shingles whose members are still in different classes. One end of a pair between
        # classes is outside the shingle's largest class. Of two members alone, the first
        # has been tried with the second.
        rows = tokens.join(classes, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        per_class = rows.groupBy("token", "component").agg(F.count("*").alias("size"))
        mixed = per_class.groupBy("token").agg(
            F.max_by("component", F.struct("size", "component")).alias("main"),
            F.count("*").alias("classes"), F.sum("size").alias("members")).where(
            "classes > 1 AND members > 2").select("token", "main")
        rows = rows.join(mixed, "token").join(signatures, "node")
        rows = stored(rows, "jaccard-mixed")
        outside = rows.where(F.col("component") != F.col("main")).select(
            "token", F.col("node").alias("a"), F.col("n").alias("an"), F.col("pos").alias("ap"),
            F.col("component").alias("ac"), F.col("signature").alias("as"))
        if bridge:
            rows = _bridges(rows.where(F.col("component") == F.col("main")))
        rest = outside.join(rows, "token").where(
            (F.col("ac") != F.col("component"))
            & ((F.col("component") == F.col("main")) | (F.col("a") < F.col("node")))
            & _fits("an", "n", percent) & _reaches("an", "ap", "n", "pos", percent)
            & _alike("an", "as", "n", "signature", percent))
        if bridge:
            # Of two classes the closest pair that has not been tried.
            distance = F.coalesce(_apart_finely("as", "signature"), _apart("as", "signature"))
            rest = rest.select(
                F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"),
                (distance / (F.col("an") + F.col("n"))).alias("_apart"),
                F.least("ac", "component").alias("_one"),
                F.greatest("ac", "component").alias("_other"))
            rest = rest.join(tried, ["a", "b"], "left_anti").groupBy("_one", "_other").agg(
                F.min(F.struct("_apart", "a", "b")).alias("_pair")).select("_pair.a", "_pair.b")
        else:
            rest = rest.select(F.least("a", "node").alias("a"),
                               F.greatest("a", "node").alias("b"))
            rest = rest.distinct().join(tried, ["a", "b"], "left_anti")
        rest = stored(rest, "jaccard-rest")
        if rest.isEmpty():
            continue
        more = stored(_verified(rest, _texts(docs, sets, rest), size, percent), "jaccard-more")
        tried = tried.unionByName(rest)
        if not more.isEmpty():
            classes = _joined(classes, more)

    full = sets.where(F.col("n") > 0).select("doc_id", "row_key", "n", "node").join(
        classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = full.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    full = full.join(names, "component")
    empty = sets.where(F.col("n") == 0).withColumns(
        {"component_id": F.col("doc_id"), "component": F.lit(None).cast("binary")})
    columns = ["doc_id", "row_key", F.col("n").alias("n_shingles"), "component_id", "component"]
    return full.select(*columns).unionByName(empty.select(*columns))


def keep_one(docs: DataFrame, classes: DataFrame, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row of every class of :func:`jaccard_classes`, with all columns of ``docs``: of the
    rows with the class's smallest key, the one with the smallest row key; a class whose keys
    are all NULL likewise. All rows without words stay, repeated ones too. An empty table
    gives no rows. Columns of ``docs`` may have any names. Only rows that may be left out or
    repeated are moved; a bitmap of fixed size of their row keys tells."""
    bounded_batches(docs.sparkSession)
    firsts = classes.where(F.col("component").isNotNull()
                           & F.col("doc_id").eqNullSafe(F.col("component_id")))
    firsts = firsts.groupBy("component", "row_key").agg(F.count("*").alias("_copies")).groupBy(
        "component").agg(F.min(F.struct("row_key", "_copies")).alias("_first")).select(
        F.col("_first.row_key").alias("_row_key"), "_first._copies")
    firsts = stored(firsts, "jaccard-firsts")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    value = F.col("_row")
    words = F.coalesce(value[text].cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    others = classes.where(F.col("component").isNotNull()).select(
        F.col("row_key").alias("_row_key")).distinct().join(
        firsts.where("_copies = 1"), "_row_key", "left_anti")
    shared = key_bits(others, "_row_key")
    keyed = rows.where(words).select(F.xxhash64(
        value[key].cast("long"), value[text].cast("string")).alias("_row_key"), "_row")
    full = rows_by_bits(keyed, shared, True).join(firsts, "_row_key")
    repeated = full.where("_copies > 1").withColumn("_n", F.row_number().over(
        Window.partitionBy("_row_key").orderBy(F.lit(1)))).where("_n = 1")
    return rows_by_bits(keyed, shared, False).select("_row").unionByName(
        full.where("_copies = 1").select("_row")).unionByName(
        repeated.select("_row")).unionByName(rows.where(~words)).select("_row.*")
