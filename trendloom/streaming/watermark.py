"""Event-time windows that close, and the rows that come too late for them.

The counts are Spark's own: a watermark on the event time, windows in the state store, append
mode, so that a window's row is emitted once, when no row that may still count can change it.
Spark drops rows that come after all their windows have closed without a trace. Here the same
streaming query also carries its input rows, so each batch can be compared with the limit that
the batch before worked under, and late rows are kept and counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from trendloom.operators.terms import slide_start
from trendloom.schemas import MARK, NTZ, L, struct
from trendloom.streaming.jobs import start


def closing_counts(stream: DataFrame, ts: str, window: int, slide: int, delay: int,
                   by: Sequence[str] = ()) -> DataFrame:
    """(window_start, window_end, by..., n) of every sliding window, in append mode once: when
    the latest time seen is ``delay`` seconds past its end."""
    spans = F.window(ts, f"{window} seconds", f"{slide} seconds")
    return stream.withWatermark(ts, f"{delay} seconds").groupBy(spans.alias("_w"), *by).agg(
        F.count("*").alias("n")).select(
        F.col("_w.start").cast(NTZ).alias("window_start"),
        F.col("_w.end").cast(NTZ).alias("window_end"), *by, "n")


class ClosedWindows:
    """The tables of one watermarked stream: ``windows``, each emitted once, and ``late`` rows.

    ``schema`` is that of the stream; rows without a time are in no window and count as late.
    A batch writes folders named after it, so a replayed batch overwrites itself, and a query
    that is started again goes on from its checkpoint and the marks of its last batch.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, ts: str, window: int,
                 slide: int, delay: int, by: Sequence[str] = ()):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.ts, self.window, self.slide, self.delay, self.by = ts, window, slide, delay, list(by)
        self.window_schema = struct(window_start=NTZ, window_end=NTZ, **{
            name: schema[name].dataType for name in self.by}, n=L)

    def _stream(self, stream: DataFrame) -> DataFrame:
        """Closed windows and input rows in one stream, as two struct columns."""
        rows = stream.select(*self.schema.names)
        counts = closing_counts(rows, self.ts, self.window, self.slide, self.delay, self.by)
        return counts.select(F.struct(*self.window_schema.names).alias("closed")).unionByName(
            rows.select(F.struct(*self.schema.names).alias("row")), allowMissingColumns=True)

    def _mark(self, batch_id: int) -> tuple[int | None, int | None]:
        """(limit, latest): the watermark that a batch worked under and the latest time seen up
        to its end, in seconds."""
        if batch_id < 0:
            return None, None
        mark = self.spark.read.schema(MARK).parquet(f"{self.path}/marks/batch_id={batch_id}")
        return tuple(mark.first())

    def _write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            self._write(batch.where("closed IS NOT NULL").select("closed.*"), "windows", batch_id)
            rows = batch.where("row IS NOT NULL").select("row.*")
            closed, before = self._mark(batch_id - 1)
            ends = slide_start(F.col(self.ts), self.slide) + self.window
            late = F.col(self.ts).isNull()
            if closed is not None:
                late = late | (ends <= closed)
            self._write(rows.where(late), "late", batch_id)
            seen = rows.agg(F.max(F.unix_seconds(F.col(self.ts).cast("timestamp")))).first()[0]
            latest = max((t for t in (before, seen) if t is not None), default=None)
            limit = None if before is None else before - self.delay
            mark = self.spark.createDataFrame([(limit, latest)], MARK).coalesce(1)
            self._write(mark, "marks", batch_id)
        finally:
            batch.unpersist()

    def start(self, stream: DataFrame, checkpoint: str,
              interval: int | None = None) -> StreamingQuery:
        return start(self._stream(stream), self.write_batch, checkpoint, interval)

    def _read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(struct(**{f.name: f.dataType for f in schema}, batch_id=L)
                                      ).parquet(f"{self.path}/{name}")

    def windows(self) -> DataFrame:
        """All windows emitted so far, with the batch that closed them."""
        return self._read("windows", self.window_schema)

    def late(self) -> DataFrame:
        """The rows that were in no window any more when they came, with their batch."""
        return self._read("late", self.schema)

    def late_counts(self) -> DataFrame:
        """(slide, by..., n): late rows per slide, the metric beside the windows' counts."""
        return self.late().groupBy(slide_start(F.col(self.ts), self.slide).alias("slide"),
                                   *self.by).agg(F.count("*").alias("n"))
