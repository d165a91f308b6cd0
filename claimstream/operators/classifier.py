"""The text classifier: TF-IDF with logistic regression, and what it has learned."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TEXT = "entity_redacted_claim"
FEATURES = 10000

# How a coefficient is described, and the word list of a feature
# that no word maps to.
RAISES = "Increases hallucination likelihood"
LOWERS = "Decreases hallucination likelihood"
NO_WORD = "Unknown (hash collision)"


def classifier(features: int = FEATURES) -> Pipeline:
    """Untrained stages: words, hashed counts, inverse document frequency, regression."""
    return Pipeline(
        stages=[
            Tokenizer(inputCol=TEXT, outputCol="words"),
            HashingTF(numFeatures=features, inputCol="words", outputCol="word_counts"),
            IDF(inputCol="word_counts", outputCol="features"),
            LogisticRegression(),
        ]
    )


def fit(train: DataFrame, features: int = FEATURES) -> PipelineModel:
    """The trained stages.  The texts are cut and hashed once: the counts are kept while they are learned from."""
    tokenizer, hashing, idf, regression = classifier(features).getStages()
    counts = hashing.transform(tokenizer.transform(train)).select("label", "word_counts").persist()
    try:
        weights = idf.fit(counts)
        learned = regression.fit(weights.transform(counts))
    finally:
        counts.unpersist()
    return PipelineModel(stages=[tokenizer, hashing, weights, learned])


def accuracy(model: PipelineModel, held_out: DataFrame) -> float:
    """Share of held-out claims the model gets right."""
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(
        model.transform(held_out)
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, claims: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Claims with the model's decision, batch or streaming."""
    return model.transform(claims).select(
        *keep, "claim", TEXT, "label", F.col("prediction").alias("predicted_label")
    )


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per feature.  The table has the size of the model, not of the data."""
    weights = model.stages[-1].coefficients.toArray()
    rows = [(i, float(w)) for i, w in enumerate(weights)]
    return spark.createDataFrame(rows, "feature_index int, importance double")


def top_features(weights: DataFrame, k: int = 30) -> DataFrame:
    """The k features of largest absolute weight, and the direction of each."""
    size = F.abs("importance")
    return (
        weights.orderBy(size.desc(), "feature_index")
        .limit(k)
        .withColumn("influence", F.when(F.col("importance") > 0, RAISES).otherwise(LOWERS))
    )


def words(df: DataFrame, text: str = TEXT) -> DataFrame:
    """The words of each text as the classifier sees them, one row each.

    The outer explode keeps the optimizer from splitting every text a second time for an
    inferred non-empty filter.
    """
    split = Tokenizer(inputCol=text, outputCol="words").transform(df)
    exploded = split.withColumn("word", F.explode_outer("words")).drop("words")
    return exploded.where(F.col("word").isNotNull())


def vocabulary(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Distinct words with their number of uses."""
    return words(df.select(text), text).groupBy("word").agg(F.count("*").alias("uses"))


def term_weights(df: DataFrame, text: str) -> DataFrame:
    """Document frequency and inverse document frequency of every word.

    Repeats of a word go inside its text, before any shuffle.
    """
    texts = df.agg(F.count("*")).scalar()
    split = Tokenizer(inputCol=text, outputCol="words").transform(df.select(text))
    per_text = split.select(F.explode_outer(F.array_distinct("words")).alias("word"))
    frequency = (
        per_text.where(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.count("*").alias("doc_freq"))
    )
    return frequency.withColumn("idf", F.log((texts + 1) / (F.col("doc_freq") + 1)))


def word_features(vocab: DataFrame, features: int = FEATURES) -> DataFrame:
    """The feature each word is hashed to, by the classifier's own hashing."""
    hashing = HashingTF(inputCol="_one", outputCol="_vector", numFeatures=features)
    hashed = hashing.transform(vocab.withColumn("_one", F.array("word")))
    index = F.unwrap_udt("_vector")["indices"][0]
    return hashed.withColumn("feature_index", index).drop("_one", "_vector")


def feature_words(
    top: DataFrame, vocab: DataFrame, k: int = 20, features: int = FEATURES
) -> DataFrame:
    """Top features with their k most used words, as an array and joined; ties go alphabetically.

    ``top`` has a fixed number of rows and is the broadcast side; the vocabulary is not.
    """
    order = Window.partitionBy("feature_index").orderBy(F.col("uses").desc(), "word")
    ranked = (
        word_features(vocab, features)
        .join(F.broadcast(top.select("feature_index")), "feature_index")
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= k)
    )
    listed = ranked.groupBy("feature_index").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_rank", "word"))), lambda e: e["word"]
        ).alias("_words")
    )
    return top.join(listed, "feature_index", "left").select(
        "feature_index",
        F.col("importance").alias("coefficient"),
        "influence",
        F.coalesce("_words", F.array(F.lit(NO_WORD))).alias("words"),
        F.coalesce(F.array_join("_words", "|"), F.lit(NO_WORD)).alias("possible_words"),
    )


def importance_report(word_rows: DataFrame, per_sign: int = 15, shown: int = 5) -> DataFrame:
    """The strongest features of each direction, ranked, with a few words each."""
    strongest = Window.partitionBy("influence").orderBy(F.abs("coefficient").desc(), "feature_index")
    return (
        word_rows.withColumn("rank", F.row_number().over(strongest))
        .where(F.col("rank") <= per_sign)
        .withColumn("possible_words", F.array_join(F.slice("words", 1, shown), "|"))
        .drop("words")
    )
