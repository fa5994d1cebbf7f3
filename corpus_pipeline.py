"""From raw documents to shards: classify, deduplicate, decontaminate, mix, shard.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns the
next stage's documents. Each stage is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import decontaminate, jaccard_join, mixing, quality, sharding
from trendloom.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # SQL expresses neither the training nor the balanced draws


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    weights = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.select(*COLUMNS), weights, keep=tuple(COLUMNS)).where(
        "predicted = 1").select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    docs = docs.select(*COLUMNS)
    return jaccard_join.keep_one(docs, jaccard_join.jaccard_classes(docs))


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    docs = docs.select(*COLUMNS)
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.decontaminated(docs, found)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    docs = docs.select(*COLUMNS)
    return mixing.repeated(docs, mixing.mix(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard_documents(docs.select(*COLUMNS)).select(
        "doc_id", "source", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate_documents),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs.select(*[F.col(c) for c in docs.columns]), f"stage-{i}")
    return docs
