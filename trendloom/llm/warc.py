"""WARC archives: writing records, and reading archives back by boundary-chain verification.

Records are written as text whose line separator is the blank pair of lines that ends every
record. Reading cuts the files at every record magic, wherever it stands: each piece is a
candidate record with the offset of its successor, out of its length header. Payloads may
contain the magic, so not every candidate is a record. Those that are form a chain from the
start of the file, and pointer jumping from there finds them.

Candidates of a split that follow each other without a gap are contracted to runs first, so the
pointers that jump are one per split and per false magic. No file is read by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendloom.llm.storage import stored

CRLF = "\r\n"
STRETCH = 1 << 20  # bytes of a file within which pieces look for their record
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FIELDS = {"type": "WARC-Type", "page": "X-Page-Id", "refers": "X-Refers-To-Page",
          "digest": "WARC-Payload-Digest", "payload": "X-Payload-Length", "length": "Content-Length"}


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hexadecimal digits make four letters."""
    digits = F.sha1(data)
    letters = F.concat(*[
        F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(letters, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            revisit_least: int = 0) -> DataFrame:
    """One WARC record (string ``value``, without its end) per row of ``pages``.

    Of the records with equal payloads of at least ``revisit_least`` bytes, the one with the
    largest key is the response; the others revisit it and carry no payload. NULL payloads are
    empty. Rows without a key revisit, or are responses if no equal row has a key. Rows that
    share the largest key are all responses.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
                        body.alias("body")).withColumns({
        "size": F.octet_length("body").cast("long"),
        "digest": base32_sha1(F.col("body").cast("binary"))})
    # Only payloads that occur more than once need a look-up.
    shared = rows.where(F.col("size") >= revisit_least).groupBy("digest").agg(
        F.max("page").alias("first"), F.count("*").alias("n")).where("n > 1").select(
        "digest", "first")
    rows = rows.join(stored(shared, "warc-shared"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))

    page = F.coalesce(F.col("page").cast("string"), F.lit(""))
    one_line = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    return rows.select(F.concat(
        F.lit(MAGIC),
        field(FIELDS["type"], F.when(again, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", one_line),
        field(FIELDS["digest"], F.concat(F.lit("sha1:"), "digest")),
        field(FIELDS["payload"], F.col("size")),
        field(FIELDS["page"], page),
        F.when(again, field(FIELDS["refers"], F.col("first"))).otherwise(""),
        field("Content-Type", F.lit("text/html")),
        field(FIELDS["length"], F.when(again, F.lit(0)).otherwise(F.col("size"))),
        F.lit(CRLF),
        F.when(again, "").otherwise(F.col("body"))).alias("value"))


def write_archives(found: DataFrame, path: str) -> None:
    """Write records as WARC files below ``path``, one per task."""
    found.write.option("lineSep", END).text(path)


def _field(head: Column, name: str) -> Column:
    """A field of a record's head; NULL if it is missing or empty."""
    value = F.regexp_extract(head, rf"(?i)(?:^|\r\n){FIELDS[name]}: ?([^\r\n]*)", 1)
    return F.when(value != "", value)


def _number(head: Column, name: str) -> Column:
    """A field that is a number; NULL if it is none."""
    return _field(head, name).try_cast("long")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, id, value): the archives cut at every magic. The pieces of a split have
    rising ids, one apart, that depend on which task reads the split."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), "value")


def first_ids(cut: DataFrame) -> DataFrame:
    """(_file, _split, _least): one row per split."""
    return cut.groupBy(F.col("file").alias("_file"), F.col("split").alias("_split")).agg(
        F.min("id").alias("_least"))


def numbered(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """Replace ``id`` by ``order``, which counts a split's pieces from 0, whoever reads it."""
    same = (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split"))
    return rows.join(firsts, same).withColumn("order", F.col("id") - F.col("_least")).drop(
        "_file", "_split", "_least", "id")


def candidates(cut: DataFrame) -> DataFrame:
    """A row per piece: its size and, read as a record's, the fields of its head. ``whole``
    tells whether the block ends inside the piece, as it does unless the block holds the
    magic; ``block_digest`` is then its digest."""
    rows = cut.withColumn("head", F.substring_index("value", END, 1))
    rows = rows.withColumns({
        "size": F.octet_length("value").cast("long") + len(MAGIC),
        "head_size": (F.octet_length("head") + len(END)).cast("long"),
        "length": _number(F.col("head"), "length")})
    whole = F.coalesce(F.col("size") - len(MAGIC) >= F.col("head_size") + F.col("length"),
                       F.lit(False))
    return rows.select(
        "file", "split", "id", "size", "head_size", "length", whole.alias("whole"),
        _field(F.col("head"), "type").alias("record_type"),
        _number(F.col("head"), "page").alias("page_id"),
        _number(F.col("head"), "refers").alias("refers_to"),
        F.substring_index(_field(F.col("head"), "digest"), ":", -1).alias("named_digest"),
        _number(F.col("head"), "payload").alias("named_bytes"),
        F.when(whole, base32_sha1(_block(F.col("value").cast("binary")))).alias("block_digest"))


def _block(data: Column) -> Column:
    return F.substring(data, F.col("head_size").cast("int") + 1, F.col("length").cast("int"))


def placed(rows: DataFrame) -> DataFrame:
    """Add ``offset`` (of the magic) and ``next`` (of the successor's magic)."""
    totals = rows.groupBy("file", "split").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("file").alias("_file"), F.col("split").alias("_split"),
                           F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("file", "split").orderBy("order").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(starts, (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")))
    # The first piece of a file stands before the first magic and counts one magic too much.
    offset = F.col("start") + F.col("ahead") - len(MAGIC)
    return rows.withColumn("offset", offset).withColumn(
        "next", F.col("offset") + len(MAGIC) + F.col("head_size") + F.col("length") + len(END)
    ).drop("_file", "_split", "start", "ahead")


def reachable(rows: DataFrame) -> DataFrame:
    """The rows of (file, split, offset, next, ...) on the chain of successors that starts at
    offset 0 of their file."""
    in_split = Window.partitionBy("file", "split").orderBy("offset")
    joined = F.lag("next").over(in_split).eqNullSafe(F.col("offset"))
    rows = rows.withColumn("_first", F.when(~joined, F.col("offset")))
    rows = rows.withColumn("run", F.last("_first", ignorenulls=True).over(in_split)).drop("_first")
    rows = stored(rows, "warc-runs")
    # A run is left where its last piece points to; it may be entered at any of its pieces.
    ends = rows.groupBy("file", "run").agg(F.max_by("next", "offset").alias("to"))
    entries = rows.select(F.col("file").alias("_file"), F.col("offset").alias("to"),
                          F.col("run").alias("next_run"))
    jumps = stored(ends.join(entries, (F.col("file") == F.col("_file"))
                             & (ends["to"] == entries["to"])).select(
        "file", "run", "next_run", entries["to"].alias("entry")), "warc-jumps")
    # (run, entry): the runs reached, and where.
    reached = rows.where("offset = 0").select("file", F.col("run"), F.lit(0).cast("long")
                                              .alias("entry"))
    steps = jumps
    count = -1
    while True:
        hop = steps.select(F.col("file").alias("_file"), F.col("run").alias("_run"), "next_run",
                           F.col("entry").alias("_entry"))
        on = (F.col("file") == F.col("_file")) & (F.col("run") == F.col("_run"))
        further = reached.join(hop, on).select("file", F.col("next_run").alias("run"),
                                               F.col("_entry").alias("entry"))
        reached = stored(reached.unionByName(further).distinct(), "warc-reached")
        now = reached.count()
        if now == count:
            break
        count = now
        # Twice the stride: all runs reached so far are at most one stride from the start.
        ahead = steps.select(F.col("file").alias("_file"), F.col("run").alias("_run"),
                             F.col("next_run").alias("_next"), F.col("entry").alias("_entry"))
        steps = stored(steps.join(ahead, (F.col("file") == F.col("_file"))
                                  & (F.col("next_run") == F.col("_run"))).select(
            "file", "run", F.col("_next").alias("next_run"), F.col("_entry").alias("entry")),
            "warc-steps")
    entered = reached.select(F.col("file").alias("_file"), F.col("run").alias("_run"), "entry")
    return rows.join(entered, (F.col("file") == F.col("_file")) & (F.col("run") == F.col("_run"))) \
        .where(F.col("offset") >= F.col("entry")).drop("_file", "_run", "entry", "run")


def _put_together(cut: DataFrame, at: DataFrame, broken: DataFrame) -> DataFrame:
    """(file, offset, block_digest) of records whose block spans several pieces. A record and
    the pieces inside it meet by stretches of the file."""
    spans = broken.select(
        F.col("file"), "offset", "head_size", "length", "next",
        F.explode(F.sequence(F.floor(F.col("offset") / STRETCH), F.floor(F.col("next") / STRETCH)))
        .alias("stretch"))
    parts = at.select("file", "split", "order", F.col("offset").alias("part"),
                      F.floor(F.col("offset") / STRETCH).alias("stretch")).join(
        spans, ["file", "stretch"]).where("part >= offset AND part < next").drop("stretch")
    # Only the files with such records are read again, and only their pieces move.
    files = stored(broken.select("file").distinct(), "warc-broken")
    again = cut.join(files, "file", "left_semi")
    again = numbered(again, stored(first_ids(again.drop("value")), "warc-firsts"))
    text = parts.join(again, ["file", "split", "order"]).groupBy(
        "file", "offset", "head_size", "length").agg(
        F.array_sort(F.collect_list(F.struct("part", "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    return text.select("file", "offset", base32_sha1(_block(joined.cast("binary")))
                       .alias("joined_digest"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, record_type, page_id, refers_to, payload_bytes, payload_digest) of every
    record in the WARC files below ``path``. Length and digest are those of the block that was
    read; a revisit has the ones its head names. Magic inside a payload is no record, even if
    a whole record stands there. What follows a broken record, where no chain leads, is left
    out. No files give no rows; a record without page number has NULL there.
    """
    cut = pieces(spark, path)
    found = stored(candidates(cut), "warc-pieces")
    at = stored(placed(numbered(found, first_ids(found))), "warc-placed")
    real = stored(reachable(at.where("offset >= 0 AND length IS NOT NULL")), "warc-records")
    revisit = F.col("record_type") == "revisit"
    records = real.where("whole").withColumn("joined_digest", F.lit(None).cast("string"))
    broken = real.where("NOT whole")
    if not broken.isEmpty():
        together = _put_together(cut, at.where("offset >= 0"), broken).select(
            F.col("file").alias("_file"), F.col("offset").alias("_offset"), "joined_digest")
        records = records.unionByName(broken.join(together, (F.col("file") == F.col("_file")) & (
            F.col("offset") == F.col("_offset"))).drop("_file", "_offset"))
    return records.select(
        "file", "offset", "record_type", "page_id", "refers_to",
        F.when(revisit, F.col("named_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("named_digest")).otherwise(
            F.coalesce("joined_digest", "block_digest")).alias("payload_digest"))
