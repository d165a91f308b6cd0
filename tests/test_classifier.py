import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from claimstream.operators import classifier
from claimstream.session import fresh_path

FALSE_WORDS = ["flat", "hoax", "myth"]
TRUE_WORDS = ["round", "proof", "fact"]


@pytest.fixture(scope="module")
def claims(spark):
    rows = []
    for i in range(120):
        words = (FALSE_WORDS if i % 2 else TRUE_WORDS)[i % 3 :][:2]
        rows.append((i, f"claim {i}", f"the <ENTITY> is {' '.join(words)} {i % 7}", i % 2))
    return spark.createDataFrame(
        rows, "id int, claim string, entity_redacted_claim string, label int"
    )


@pytest.fixture(scope="module")
def model(claims):
    return classifier.fit(claims, features=500)


def test_accuracy_and_reload(spark, claims, model):
    assert classifier.accuracy(model, claims) == 1.0
    path = fresh_path(spark, "model")
    classifier.save(model, path)
    classifier.save(model, path)
    scored = classifier.score(classifier.load(path), claims, ("id",))
    assert scored.columns == ["id", "claim", "entity_redacted_claim", "label", "predicted_label"]
    assert scored.where("label != predicted_label").count() == 0


def test_word_features_match_the_model(spark, claims):
    vocab = classifier.vocabulary(claims)
    hashing = HashingTF(inputCol="w", outputCol="v", numFeatures=500)
    for r in classifier.word_features(vocab, 500).collect():
        assert r.feature_index == hashing.indexOf(r.word)
    uses = {r.word: r.uses for r in vocab.collect()}
    assert uses["the"] == 120 and uses["<entity>"] == 120


def test_importance_words_and_report(spark, claims, model):
    weights = classifier.coefficients(spark, model)
    assert weights.count() == 500
    top = classifier.top_features(weights, 10)
    sizes = [abs(r.importance) for r in top.collect()]
    assert sizes == sorted(sizes, reverse=True)
    words = classifier.feature_words(top, classifier.vocabulary(claims), features=500)
    by_word = {w: r for r in words.collect() for w in r.possible_words.split("|")}
    assert by_word["hoax"].influence == classifier.RAISES
    assert by_word["proof"].influence == classifier.LOWERS
    report = classifier.importance_report(words, per_sign=2, shown=1).collect()
    assert sorted((r.influence, r["rank"]) for r in report) == [
        (classifier.LOWERS, 1),
        (classifier.LOWERS, 2),
        (classifier.RAISES, 1),
        (classifier.RAISES, 2),
    ]
    assert all("|" not in r.possible_words for r in report)


def test_feature_without_words(spark, claims):
    top = spark.createDataFrame(
        [(499, 1.0, classifier.RAISES)], "feature_index int, importance double, influence string"
    )
    none = classifier.vocabulary(claims).where(F.lit(False))
    got = classifier.feature_words(top, none, features=500).first()
    assert got.possible_words == classifier.NO_WORD


def test_term_weights(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "a")], "id int, text string")
    got = {r.word: (r.doc_freq, round(r.idf, 6)) for r in classifier.term_weights(df, "text").collect()}
    assert got == {"a": (2, 0.0), "b": (1, 0.405465)}


def test_texts_are_hashed_once_for_training(spark, claims):
    """Tokens of a text are taken once, however many passes the stages make over the counts."""
    taken = spark.sparkContext.accumulator(0)

    def seen(text):
        taken.add(1)
        return text

    counted = F.udf(seen, "string").asNondeterministic()
    watched = claims.withColumn(classifier.TEXT, counted(classifier.TEXT))
    classifier.fit(watched, features=500)
    assert taken.value == claims.count()
