"""Bag of words and LDA topics over cleaned news."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trendloom.operators.columns import compute_once
from trendloom.operators.terms import doc_terms, term_stats
from trendloom.session import work_dir

VOCAB_SIZE = 3000
MIN_DF = 5
N_TOPICS = 10
MAX_ITER = 100
TERMS_PER_TOPIC = 5
SEED = 17
FOLD_INS = 20  # rounds of a document's fold-in
CONCENTRATION = 0.1  # of the topics of a document, before it is read


def fit_vocabulary(docs: DataFrame, tokens: str, vocab_size: int = VOCAB_SIZE,
                   min_df: int = MIN_DF) -> DataFrame:
    """(term_index, term): the ``vocab_size`` most frequent terms among those in at least
    ``min_df`` documents, equal counts by name."""
    stats = term_stats(doc_terms(docs, [], tokens)).where(F.col("df") >= min_df)
    top = stats.orderBy(F.desc("n"), "term").limit(vocab_size)
    # Numbers at most vocab_size rows, hence one task.
    index = F.row_number().over(W.orderBy(F.desc("n"), "term")) - 1
    return top.select(index.alias("term_index"), "term")


def bag_of_words(docs: DataFrame, doc_id: str, tokens: str, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, term_index, term, n): the non-zero entries of the count vectors. Spark
    decides by the vocabulary's size how to join it."""
    return doc_terms(docs, [doc_id], tokens).join(vocabulary, "term").select(
        doc_id, "term_index", "term", "n")


def vectorizer(vocabulary: DataFrame, tokens: str, out: str = "raw_features"):
    """The same vocabulary as a CountVectorizerModel, for pipelines that need vectors."""
    words = [row["term"] for row in vocabulary.orderBy("term_index").collect()]
    if not words:
        raise ValueError("no term occurs in enough documents")
    return CountVectorizerModel.from_vocabulary(words, tokens, out)


def idf_weights(docs: DataFrame, doc_id: str, tokens: str, vocabulary: DataFrame) -> DataFrame:
    """(term_index, term, df, idf) of the vocabulary, with idf = ln((m + 1) / (df + 1)) over m
    documents: the weights that the LDA's features carry."""
    df = bag_of_words(docs, doc_id, tokens, vocabulary).groupBy("term_index", "term").agg(
        F.count("*").alias("df"))
    m = docs.where(F.col(tokens).isNotNull()).agg(F.count("*")).scalar()
    return df.withColumn("idf", F.ln((m + 1) / (F.col("df") + 1)))


def fit_topics(docs: DataFrame, tokens: str, k: int = N_TOPICS, max_iter: int = MAX_ITER,
               vocab_size: int = VOCAB_SIZE, min_df: int = MIN_DF,
               seed: int = SEED) -> tuple[LDAModel, list[str]]:
    """(model, vocabulary) of an LDA over IDF-weighted counts.

    The count vectors are written to the shared work folder: the fit passes over them
    once per iteration, and a lost executor re-reads them instead of cleaning again. What the
    executors have room for is kept weighted while it is fitted.
    """
    spark = docs.sparkSession
    vocabulary = fit_vocabulary(docs, tokens, vocab_size, min_df)
    model = vectorizer(vocabulary, tokens)
    path = work_dir(spark, "lda-features")
    model.transform(docs.select(tokens).where(F.col(tokens).isNotNull())).select(
        "raw_features").write.parquet(path)
    counts = spark.read.parquet(path)
    features = IDF(inputCol="raw_features", outputCol="features").fit(counts).transform(counts)
    features = features.select("features").persist()
    lda = LDA(k=k, maxIter=max_iter, seed=seed, optimizer="online", featuresCol="features")
    fitted = lda.fit(features)
    features.unpersist()
    return fitted, model.vocabulary


def lda_topics(docs: DataFrame, tokens: str, k: int = N_TOPICS, max_iter: int = MAX_ITER,
               vocab_size: int = VOCAB_SIZE, min_df: int = MIN_DF,
               n_terms: int = TERMS_PER_TOPIC, seed: int = SEED) -> DataFrame:
    """(topic, rank, term, weight) of :func:`fit_topics`."""
    model, vocabulary = fit_topics(docs, tokens, k, max_iter, vocab_size, min_df, seed)
    words = docs.sparkSession.createDataFrame(list(enumerate(vocabulary)),
                                              "term_index int, term string")
    return (
        model.describeTopics(maxTermsPerTopic=n_terms)
        .select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights"))
                .alias("pos", "entry"))
        .select("topic", (F.col("pos") + 1).alias("rank"),
                F.col("entry.termIndices").alias("term_index"),
                F.round("entry.termWeights", 4).alias("weight"))
        .join(words, "term_index").select("topic", "rank", "term", "weight")
    )


def topic_matrix(model: LDAModel, vocabulary: list[str], spark: SparkSession) -> DataFrame:
    """(term, weights): for each term of the vocabulary its probability in every topic."""
    matrix = model.topicsMatrix().toArray()
    matrix = matrix / matrix.sum(axis=0)
    return spark.createDataFrame(list(zip(vocabulary, matrix.tolist())),
                                 "term string, weights array<double>")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def exp_digamma(x: Column) -> Column:
    """exp of the digamma function for x > 0, by its asymptotic series at x + 6."""
    steps = sum((1.0 / (x + i) for i in range(1, 6)), 1.0 / x)
    z = x + 6.0
    series = F.ln(z) - 1.0 / (2.0 * z) - 1.0 / (12.0 * z * z) + 1.0 / (120.0 * z * z * z * z)
    return F.exp(series - steps)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def fold_in(bag: DataFrame, doc_id: str, topics: DataFrame, rounds: int = FOLD_INS,
            concentration: float = CONCENTRATION) -> DataFrame:
    """(doc_id, shares): the topic mixture of every document under a fixed model, by variational
    inference.

    ``bag`` is (doc_id, term, n), ``topics`` is (term, weights), one row per term of the model's
    vocabulary; other terms are left out, and a document without known terms is not in the
    result. Terms get their weights in one join; a document's terms, as many as the vocabulary
    has at most, are then in its row, and the rounds run there: each term is dealt to the topics
    by its weight times exp(digamma(strength)), and a topic's strength is the concentration plus
    what it was dealt.
    """
    known = bag.join(topics, "term").groupBy(doc_id).agg(F.collect_list(
        F.struct(F.col("n").cast("double").alias("n"), "weights")).alias("_words"))
    words = F.col("_words")
    k = F.size(F.get(words, 0)["weights"])
    total = _sum(F.transform(words, lambda w: w["n"]))
    first = F.transform(F.sequence(F.lit(1), k), lambda _: concentration + total / k)

    def dealt(strengths: Column) -> Column:
        by_topic = F.transform(strengths, exp_digamma)
        return _bound(by_topic, lambda e: F.transform(F.zip_with(e, F.aggregate(
            words, F.transform(e, lambda _: F.lit(0.0)), lambda sums, w: _bound(
                w["n"] / _dot(w["weights"], e),
                lambda rate: F.zip_with(sums, w["weights"], lambda s, x: s + rate * x))),
            lambda e_k, s: e_k * s), lambda d: d + concentration))

    strengths = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, lambda s, _: dealt(s))
    shares = F.transform("_s", lambda s: s / _sum(F.col("_s")))
    return compute_once(known, _s=strengths).select(doc_id, shares.alias("shares"))


def term_likelihood(bag: DataFrame, doc_id: str, topics: DataFrame, mixtures: DataFrame) -> DataFrame:
    """(n_terms, log_likelihood) of documents under a model and their mixtures: the mean log
    probability of a term. Of terms that were not folded in, it measures the model."""
    rows = bag.join(topics, "term").join(mixtures, doc_id)
    return rows.agg(
        F.sum("n").alias("n_terms"),
        (F.sum(F.col("n") * F.ln(_dot(F.col("weights"), F.col("shares")))) / F.sum("n")).alias(
            "log_likelihood"))
