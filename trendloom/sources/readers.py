"""Sources: stored collections, tables, message streams, catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trendloom import schemas
from trendloom.functions.keywords import is_tracked
from trendloom.operators.columns import compute_once


def scan_news(spark: SparkSession, path: str) -> DataFrame:
    """Stored news documents as JSON lines; the schema is given, so nothing is inferred
    and every executor reads its own part."""
    return spark.read.schema(schemas.NEWS).json(path)


def scan_tweets(spark: SparkSession, path: str) -> DataFrame:
    """Stored flat tweets as JSON lines."""
    return spark.read.schema(schemas.TWEETS).json(path)


def checked_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Stored JSON lines with what is wrong with them: the columns of ``schema``, ``_broken``,
    and for a broken line ``_line`` and ``_file``. A line is broken if it is no JSON object or
    if a field does not fit the schema; its columns are NULL then. Blank lines are skipped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    full = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType())])
    lines = spark.read.text(path).where("trim(value) <> ''").select(
        "value", F.col("_metadata.file_path").alias("_file"))
    rows = compute_once(lines, _row=F.from_json("value", full, options))
    row = F.col("_row")
    broken = row.isNull() | row[schemas.CORRUPT].isNotNull()
    return rows.select(
        *[F.when(~broken, row[name]).alias(name) for name in schema.names],
        broken.alias("_broken"), F.when(broken, F.col("value")).alias("_line"),
        F.when(broken, F.col("_file")).alias("_file"))


def quarantine(spark: SparkSession, path: str, schema: StructType,
               out: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines) of stored JSON lines, both kept below ``out``. Every line is
    decoded once; the two tables are partitions of one, so reading one does not scan the other."""
    checked = checked_documents(spark, path, schema)
    checked.write.mode("overwrite").partitionBy("_broken").parquet(out)
    kept = spark.read.schema(checked.schema).parquet(out)
    return (kept.where("NOT _broken").select(*schema.names),
            kept.where("_broken").select("_line", "_file"))


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns, partitioning, location and provider of a table."""
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   starting_offsets: str = "latest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Message stream out of Kafka, one task per topic partition. Needs the Kafka
    connector on the classpath (``--packages org.apache.spark:spark-sql-kafka-0-10``)."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same message stream out of a folder of JSON lines (key, value, timestamp)."""
    reader = spark.readStream.schema(schemas.MESSAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def track(messages: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Ingest filter of the collector: language and tracked phrases."""
    return messages.where(is_tracked(F.col(text), F.col(lang)))
