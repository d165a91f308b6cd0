"""The registered queries: every operator run over the given tables.

Each function takes a session and the folder of the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimstream.functions import scored as S
from claimstream.functions.text import choose_text, find_entities, redact, redact_by_rule
from claimstream.operators import classifier, dgim, lsh, patterns, positions, prepare, sampling, similarity
from claimstream.operators import scored as ops
from claimstream.plans import views
from claimstream.session import cut, fresh_path
from claimstream.sources import readers, sinks
from claimstream.streaming import jobs, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Streaming queries replay the month of events in slices of this many days.
SLICE_DAYS = 8


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    messages = views.scored_messages(spark, folder)
    return ops.parse_scored(messages, ["id", "ts", "batch_id", "key"])


def _text() -> Column:
    return F.col("claim")


# --- claims: reading, cleaning, publishing ---------------------------------------


@query
def read_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims written as JSON lines and read back with the fixed schema."""
    path = fresh_path(spark, "claims")
    claims = views.claims(spark, folder).select("claim", "entity_redacted_claim", "label")
    sinks.write_table(claims, path, "json")
    return readers.read_claims(spark, path)


def _corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Raw corpus lines, some of them broken."""
    path = fresh_path(spark, "corpus")
    sinks.write_table(views.raw_corpus(spark, folder), path, "json")
    views.broken_lines(spark, folder).write.mode("append").text(path)
    return readers.read_raw(spark, path)


@query
def claims_prepare(spark: SparkSession, folder: str) -> DataFrame:
    """Raw corpus lines to clean redacted claims."""
    return prepare.prepare_claims(_corpus(spark, folder))


@query
def corpus_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the corpus that are no JSON."""
    return prepare.unreadable(_corpus(spark, folder))


@query
def claims_redact(spark: SparkSession, folder: str) -> DataFrame:
    """Number of distinct entities and the redacted text of every document."""
    found = find_entities(_text())
    return views.documents(spark, folder).select(
        "id", F.size(found).alias("n_entities"), redact_by_rule(_text()).alias("redacted")
    )


@query
def dictionary_redact(spark: SparkSession, folder: str) -> DataFrame:
    """Redaction with a dictionary: the words of the benchmark items that start in capitals."""
    docs = views.documents(spark, folder).select("id", "claim")
    benchmark = views.table(spark, folder, "benchmark").select("text")
    names = benchmark.select(F.explode(find_entities(F.col("text"))).alias("entity"))
    found = prepare.dictionary_entities(docs, names, "id", "claim")
    none = F.array().cast("array<string>")
    return docs.join(found, "id", "left").select(
        "id", redact(_text(), F.coalesce("entities", none)).alias("redacted")
    )


@query
def claim_text(spark: SparkSession, folder: str) -> DataFrame:
    """Redacted text where there is one, else the claim."""
    docs = ops.parse_scored(views.document_messages(spark, folder), ["id"])
    text = choose_text(F.col("entity_redacted_claim"), F.col("claim"))
    return docs.select("id", text.alias("text"))


@query
def shingle_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words and word 3-grams per document."""
    return prepare.text_sizes(views.documents(spark, folder), "id", "claim")


@query
def publish_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """All claims, labelled or not, published with a constant key, read back and parsed."""
    path = fresh_path(spark, "topic")
    claims = views.claims(spark, folder, labelled_only=False).select("claim", "label")
    sinks.publish(claims, "parquet", {"path": path}, key="fever")
    sent = spark.read.schema("key string, value string").parquet(path)
    value = F.from_json("value", "claim string, label int").alias("v")
    return sent.select("key", value).select("key", "v.claim", "v.label")


# --- the scored stream ------------------------------------------------------------


@query
def payload_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Messages flattened back to columns."""
    return _scored(spark, folder).drop("ts")


@query
def positive_bits(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select(
        "id", S.positive_bit(F.col("predicted_label")).alias("is_positive")
    )


@query
def prediction_category(spark: SparkSession, folder: str) -> DataFrame:
    return ops.with_category(_scored(spark, folder)).select(
        "id", "predicted_positive", "actual_positive", "prediction_category"
    )


@query
def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.batch_counts(_scored(spark, folder), ["batch_id"])


@query
def confusion_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    return ops.confusion(ops.with_category(_scored(spark, folder)), ["batch_id"])


@query
def quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return ops.quality(confusion_by_batch(spark, folder))


@query
def head_sample(spark: SparkSession, folder: str) -> DataFrame:
    """First five messages of every batch."""
    first = ops.head_sample(_scored(spark, folder), ["batch_id"], ["ts", "id"])
    return first.select("batch_id", "arrival", "id", "predicted_label")


@query
def state_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots of the counts per key and batch, written, and the newest of each key."""
    path = fresh_path(spark, "snapshots")
    counts = ops.batch_counts(_scored(spark, folder), ["key", "batch_id"])
    counts.write.partitionBy("batch_id").parquet(path)
    snapshots = spark.read.schema(counts.schema).parquet(path)
    newest = readers.latest_state(snapshots, ["key"])
    return newest.select("key", "batch_id", "row_count", "positive_count")


# --- words and patterns -----------------------------------------------------------


@query
def ngram_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 most frequent word 3-grams."""
    return patterns.top_patterns(views.documents(spark, folder), _text(), 50)


@query
def pattern_record(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 most frequent 3-grams of each source as one record, in JSON."""
    record = patterns.pattern_record(views.documents(spark, folder), _text(), ["source"])
    return record.select("source", F.to_json("patterns").alias("patterns"))


@query
def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.vocabulary(views.documents(spark, folder), "claim")


@query
def tfidf_terms(spark: SparkSession, folder: str) -> DataFrame:
    terms = classifier.term_weights(views.documents(spark, folder), "claim")
    return terms.withColumn("idf", F.round("idf", 6))


# --- samples ----------------------------------------------------------------------


@query
def reservoir_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A uniform sample of 100 messages."""
    rows = ops.with_category(_scored(spark, folder))
    return sampling.reservoir(rows, "id").select("id", "priority", "prediction_category")


@query
def reservoir_distribution(spark: SparkSession, folder: str) -> DataFrame:
    rows = ops.with_category(_scored(spark, folder))
    return sampling.sample_distribution(sampling.reservoir(rows, "id"))


@query
def split(spark: SparkSession, folder: str) -> DataFrame:
    """Train or test mark of every document."""
    docs = views.documents(spark, folder).select("id")
    return sampling.split(docs, "id")


# --- near-duplicates --------------------------------------------------------------


@query
def minhash_signatures(spark: SparkSession, folder: str) -> DataFrame:
    signed = lsh.signatures(views.documents(spark, folder), "id", _text())
    return signed.select("id", F.array_join("signature", ",").alias("signature"))


def _links(spark: SparkSession, folder: str, scope: tuple[str, ...] = ()) -> DataFrame:
    return lsh.bucket_links(views.documents(spark, folder), "id", _text(), scope)


@query
def lsh_links(spark: SparkSession, folder: str) -> DataFrame:
    """Per band, every document in a shared bucket with the first document of the bucket."""
    return _links(spark, folder)


@query
def lsh_verified_links(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with an earlier one at a true Jaccard similarity of 0.7 or more, and the first such."""
    return similarity.earlier_similar(views.documents(spark, folder), "id", _text())


@query
def similar_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the first document of each bucket they share, texts included."""
    docs = views.documents(spark, folder)
    return lsh.similar_claims(_links(spark, folder), docs, "id", "claim")


@query
def similarity_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return lsh.clusters(_links(spark, folder), "id")


@query
def lsh_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, positives and positives with an earlier similar one, source by source."""
    docs = ops.parse_scored(views.document_messages(spark, folder), ["id", "source"])
    text = choose_text(F.col("entity_redacted_claim"), F.col("claim"))
    positives = docs.where(F.col("predicted_label") >= S.THRESHOLD)
    links = lsh.bucket_links(positives, "id", text, ["source"])
    bit = S.positive_bit(F.col("predicted_label"))
    return lsh.summary(docs, links, "id", ["source"], bit)


# --- sliding-window counts --------------------------------------------------------


def _bits(spark: SparkSession, folder: str) -> DataFrame:
    bit = S.positive_bit(F.col("predicted_label")).alias("is_positive")
    return _scored(spark, folder).select("key", "ts", "id", "batch_id", bit)


def _one_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _bits(spark, folder).withColumn("key", F.lit("all"))


@query
def stream_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Position of every message in its stream."""
    placed = positions.with_positions(_bits(spark, folder), ["key"], ["ts", "id"])
    return placed.select("key", "id", "pos")


@query
def window_exact(spark: SparkSession, folder: str) -> DataFrame:
    """True number of positives among the last 1000 messages of each stream."""
    placed = positions.with_positions(_bits(spark, folder), ["key"], ["ts", "id"])
    return positions.window_counts(placed, ["key"], "is_positive").select(
        "key", "id", "pos", "exact"
    )


@query
def dgim_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """Estimate at every message, one stream per event type."""
    counted = dgim.dgim(_bits(spark, folder), ["key"], ["ts", "id"], "is_positive")
    return counted.select("key", "id", "pos", "exact", "estimate")


@query
def dgim_small_window(spark: SparkSession, folder: str) -> DataFrame:
    """Estimate at every message over the last 16, as one stream in many small chunks."""
    stream = _one_stream(spark, folder)
    counted = dgim.dgim(
        stream, ["key"], ["ts", "id"], "is_positive", window=16, chunk_rows=64, fan=3
    )
    return counted.select("pos", "exact", "estimate")


@query
def dgim_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Estimate over all messages as one stream, held against its bounds."""
    counted = dgim.dgim(_one_stream(spark, folder), ["key"], ["ts", "id"], "is_positive")
    exact, estimate = F.col("exact"), F.col("estimate")
    within = (exact <= estimate) & (estimate < F.greatest(2 * exact, F.lit(1)))
    return counted.select("pos", "exact", within.alias("within"))


@query
def dgim_batch_stats(spark: SparkSession, folder: str) -> DataFrame:
    """The daily record of one stream of all messages, worked on in small chunks."""
    stream = _one_stream(spark, folder)
    counted = dgim.dgim(stream, ["key"], ["ts", "id"], "is_positive", chunk_rows=1000, fan=3)
    return dgim.batch_statistics(counted, ["key"], "batch_id", "is_positive")


@query
def dgim_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The histogram each stream ends with, one row per bucket."""
    counted = cut(dgim.dgim(_bits(spark, folder), ["key"], ["ts", "id"], "is_positive"))
    state = dgim.dgim_state(counted, ["key"], "is_positive")
    return dgim.dgim_buckets(state, ["key"]).select(
        "key", "window_size", "stream_position", "total_ones", F.inline("buckets")
    )


# --- the classifier ---------------------------------------------------------------


def _prepared(spark: SparkSession, folder: str, labelled_only: bool = False) -> DataFrame:
    """The redacted claims as a written table: training reads them more than once."""
    path = fresh_path(spark, "prepared")
    sinks.write_table(views.claims(spark, folder, labelled_only), path, "parquet")
    return sampling.split(spark.read.parquet(path), "id")


def _labelled(claims: DataFrame) -> DataFrame:
    return claims.where(F.col("label").isNotNull())


def _fit(claims: DataFrame) -> PipelineModel:
    return classifier.fit(_labelled(claims).where("is_train"))


def _top(spark: SparkSession, claims: DataFrame) -> DataFrame:
    return classifier.top_features(classifier.coefficients(spark, _fit(claims)))


@query
def train_eval(spark: SparkSession, folder: str) -> DataFrame:
    """Rows trained on, rows held out, and whether the model does as well as the commoner class alone.

    The accuracy itself is learned, which SQL cannot express; ``model_accuracy`` has it.
    """
    claims = _labelled(_prepared(spark, folder, labelled_only=True))
    held_out = claims.where(~F.col("is_train"))
    right = classifier.accuracy(_fit(claims), held_out)
    guess = F.avg(F.when(~F.col("is_train"), F.col("label").cast("double")))
    return claims.agg(
        F.count_if("is_train").alias("train_rows"),
        F.count_if(~F.col("is_train")).alias("test_rows"),
        (F.lit(right) >= F.greatest(guess, 1 - guess)).alias("at_least_guessing"),
    )


@query
def score_claims(spark: SparkSession, folder: str) -> DataFrame:
    """All claims scored by a model that was saved and loaded again."""
    claims, path = _prepared(spark, folder), fresh_path(spark, "model")
    classifier.save(_fit(claims), path)
    scored = classifier.score(classifier.load(path), claims, ("id",))
    decided = F.col("predicted_label").isin(0.0, 1.0)
    return scored.select("id", "label", decided.alias("decided"))


@query
def model_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out accuracy of the classifier beside that of always choosing the commoner class."""
    claims = _labelled(_prepared(spark, folder, labelled_only=True))
    held_out = claims.where(~F.col("is_train"))
    right = classifier.accuracy(_fit(claims), held_out)
    guess = F.avg(F.col("label").cast("double"))
    return held_out.agg(
        F.count("*").alias("test_rows"),
        F.lit(right).alias("accuracy"),
        F.greatest(guess, 1 - guess).alias("commoner_class"),
    )


@query
def claim_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """What the classifier decides for every claim, labelled or not."""
    claims = _prepared(spark, folder)
    scored = classifier.score(_fit(claims), claims, ("id",))
    return scored.select("id", "label", "predicted_label")


@query
def feature_weights(spark: SparkSession, folder: str) -> DataFrame:
    """The 30 features of largest weight, their weights and directions."""
    return _top(spark, _prepared(spark, folder, labelled_only=True))


@query
def feature_word_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The words of those features."""
    return _feature_words(spark, folder).drop("words")


@query
def influence_report(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest features of each direction with a few words each."""
    return classifier.importance_report(_feature_words(spark, folder))


@query
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    """The 30 features of largest weight, by rank; the weights are learned, their order is not."""
    return _ranked(_top(spark, _prepared(spark, folder, labelled_only=True)), "importance")


def _ranked(rows: DataFrame, weight: str, *by: str) -> DataFrame:
    """Rank of each row by weight, and whether weight, direction and feature agree with it."""
    order = Window.partitionBy(*by).orderBy(F.abs(weight).desc(), "feature_index")
    before = F.lag(F.abs(weight)).over(order)
    name = F.when(F.col(weight) > 0, classifier.RAISES).otherwise(classifier.LOWERS)
    agrees = (
        F.coalesce(before >= F.abs(weight), F.lit(True))
        & (F.col("influence") == name)
        & F.col("feature_index").between(0, classifier.FEATURES - 1)
    )
    return rows.select(*by, F.row_number().over(order).alias("rank"), agrees.alias("agrees"))


@query
def feature_words(spark: SparkSession, folder: str) -> DataFrame:
    """Rank of the features, and whether all words listed for them belong to them."""
    listed = _feature_words(spark, folder)
    each = listed.select("feature_index", F.explode("words").alias("word"))
    own = classifier.word_features(each.withColumnRenamed("feature_index", "listed_for"))
    wrong = own.where(
        (F.col("word") != classifier.NO_WORD) & (F.col("listed_for") != F.col("feature_index"))
    ).select(F.col("listed_for").alias("feature_index")).distinct()
    order = Window.orderBy(F.abs("coefficient").desc(), "feature_index")
    return listed.join(wrong.withColumn("_wrong", F.lit(True)), "feature_index", "left").select(
        F.row_number().over(order).alias("rank"),
        (F.size("words").between(1, 20) & F.col("_wrong").isNull()).alias("words_belong"),
    )


def _feature_words(spark: SparkSession, folder: str) -> DataFrame:
    claims = _labelled(_prepared(spark, folder, labelled_only=True))
    return classifier.feature_words(_top(spark, claims), classifier.vocabulary(claims))


@query
def importance_report(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of the report table, written as csv and read back, and whether its rows agree."""
    path = fresh_path(spark, "report")
    report = classifier.importance_report(_feature_words(spark, folder))
    sinks.write_table(report, path, "csv")
    back = spark.read.schema(report.schema).option("header", "true").csv(path)
    checked = _ranked(back, "coefficient", "influence").where(F.col("rank") <= 15)
    return checked.agg(
        F.count_if("agrees").alias("agreeing"), F.count_if(~F.col("agrees")).alias("wrong")
    ).select((F.col("agreeing") > 0).alias("has_rows"), "wrong")


# --- streams ----------------------------------------------------------------------


def _replay(
    spark: SparkSession,
    folder: str,
    start: Callable[[DataFrame], StreamingQuery],
    times: int = 1,
    days: int = SLICE_DAYS,
) -> None:
    """Send the events slice by slice, each ``times`` times, and run the job after each.

    A run takes all that is new as one batch and goes on from the checkpoint of the run before,
    so the batches are the slices, whatever files they are written in.
    """
    path = fresh_path(spark, "scored-topic")
    messages = views.scored_messages(spark, folder)
    low, high = messages.agg(F.min("batch_id"), F.max("batch_id")).first()
    for day in range(low, high + 1, days):
        part = views.scored_messages(spark, folder, since=day, until=day + days)
        for _ in range(times):
            part.write.mode("append").parquet(path)
            start(readers.stream_files(spark, path, messages.schema, "parquet")).awaitTermination()


def _slices(spark: SparkSession, messages: DataFrame, place: str, slices: Column) -> readers.Slices:
    """Messages as a rate-limited stream, one slice a batch.

    ``slices`` numbers them by ``_distance``, how far ``place`` is from its least, and ``_reach``, above all distances.
    """
    path = fresh_path(spark, "slices")
    low, high = messages.agg(F.min(place), F.max(place)).first()
    placed = messages.withColumns({"_distance": F.col(place) - low, "_reach": F.lit(high - low + 1)})
    sinks.write_slices(placed.withColumn("slice", slices).drop("_distance", "_reach"), path, "slice")
    return readers.stream_slices(spark, path, messages.schema)


def _sliced_days(spark: SparkSession, folder: str) -> readers.Slices:
    """The month of events, some days a slice."""
    days = F.floor(F.col("_distance") / SLICE_DAYS).cast("bigint")
    return _slices(spark, views.scored_messages(spark, folder), "batch_id", days)


def _sampled(spark: SparkSession, folder: str) -> str:
    out = fresh_path(spark, "metrics")
    stream = _sliced_days(spark, folder)
    jobs.metrics_and_sample(
        stream, "id", out, f"{out}/_run", trigger=jobs.ALL_THEN_STOP
    ).awaitTermination()
    return out


@query
def stream_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome counts of the whole replayed stream, from its per-batch records."""
    stats = spark.read.parquet(f"{_sampled(spark, folder)}/stats")
    sums = ["batch_size", *[f"{c}s" for c in S.CATEGORIES]]
    return stats.agg(
        F.max("total_processed").alias("total_processed"), *[F.sum(c).alias(c) for c in sums]
    )


@query
def stream_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The record of every batch of a stream limited to a slice a trigger."""
    stats = spark.read.parquet(f"{_sampled(spark, folder)}/stats")
    return stats.select("batch_id", "batch_size", *[f"{c}s" for c in S.CATEGORIES], "total_processed")


@query
def stream_reservoir(spark: SparkSession, folder: str) -> DataFrame:
    """The sample after the last batch of the replayed stream."""
    sample = spark.read.parquet(f"{_sampled(spark, folder)}/sample")
    newest = sample.agg(F.max("batch_id")).scalar()
    return sample.where(F.col("batch_id") == newest).select(
        "id", "priority", "prediction_category"
    )


@query
def stream_dgim(spark: SparkSession, folder: str) -> DataFrame:
    """Estimate at the end of each stream, after the last micro-batch."""
    out, keys, order = fresh_path(spark, "window"), ["key"], ["ts", "id"]
    stream = _sliced_days(spark, folder)
    jobs.positives_in_window(
        stream, keys, order, out, f"{out}/_run", trigger=jobs.ALL_THEN_STOP
    ).awaitTermination()
    schema = jobs.window_state(stream.schema, keys, order)
    newest = readers.keyed_state(spark, f"{out}/state", keys, schema)
    total = dgim.dgim_total(F.col("recent"), F.col("overhang"))
    return newest.select("key", "pos", total.alias("estimate"))


def _counted_in_state(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The replayed stream counted by the stateful operator: its output and its checkpoint."""
    out = fresh_path(spark, "window-state")
    _replay(
        spark,
        folder,
        lambda stream: stateful.write_window_counts(
            stateful.window_counts(stream, ["key"], ["ts", "id"]), out, f"{out}-run", jobs.ALL_THEN_STOP
        ),
    )
    return out, f"{out}-run"


@query
def stream_dgim_state(spark: SparkSession, folder: str) -> DataFrame:
    """Estimate at the end of each stream, from state in the checkpoint of a query restarted per slice."""
    out, _ = _counted_in_state(spark, folder)
    ends = readers.latest_state(spark.read.parquet(out), ["key"])
    return ends.select("key", "pos", "exact", "estimate")


@query
def window_state_read(spark: SparkSession, folder: str) -> DataFrame:
    """Position and estimate of each stream as its operator holds them in the checkpoint."""
    _, checkpoint = _counted_in_state(spark, folder)
    return readers.operator_state(spark, checkpoint).select("key", "pos", "estimate")


@query
def stream_lsh(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters among the positive documents of two micro-batches, each for itself."""
    path, out = fresh_path(spark, "document-topic"), fresh_path(spark, "similar")
    messages = views.document_messages(spark, folder).drop("source")
    for half in (0, 1):
        part = messages.where(F.crc32(F.col("id").cast("string").cast("binary")) % 2 == half)
        part.write.mode("append").parquet(path)
        stream = readers.stream_files(spark, path, messages.schema, "parquet")
        jobs.similar_and_frequent(
            stream, "id", out, f"{out}/_run", trigger=jobs.ALL_THEN_STOP
        ).awaitTermination()
    return spark.read.parquet(f"{out}/clusters").select("cluster_id", "id")


@query
def stream_lsh_index(spark: SparkSession, folder: str) -> DataFrame:
    """Links of documents that come in three batches by id, each against all that came before."""
    out = fresh_path(spark, "index")
    thirds = F.floor(F.col("_distance") * 3 / F.col("_reach")).cast("bigint")
    stream = _slices(spark, views.document_messages(spark, folder).drop("source"), "id", thirds)
    jobs.similar_to_earlier(
        stream, "id", out, f"{out}/_run", _text(), trigger=jobs.ALL_THEN_STOP
    ).awaitTermination()
    return spark.read.parquet(f"{out}/links").select("band", "first_id", "id")


@query
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """Claims published as messages, some of them broken, and scored by the streaming job."""
    topic, out = fresh_path(spark, "claim-topic"), fresh_path(spark, "predictions")
    claims = _prepared(spark, folder)
    model = _fit(claims)
    sinks.publish(claims.drop("id", "is_train"), "parquet", {"path": topic})
    views.broken_lines(spark, folder).write.mode("append").parquet(topic)
    stream = readers.stream_files(spark, topic, "value string", "parquet")
    jobs.score_topic(
        stream,
        model,
        "parquet",
        {"path": out},
        f"{out}-run",
        jobs.ALL_THEN_STOP,
        rejects=f"{out}-rejects",
    ).awaitTermination()
    scored = ops.parse_scored(spark.read.parquet(out))
    decided = F.col("predicted_label").isin(0.0, 1.0)
    return (
        scored.groupBy("label", decided.alias("decided"))
        .agg(F.count("*").alias("n"))
        .unionByName(
            spark.read.parquet(f"{out}-rejects").agg(
                F.lit("rejected").alias("label"),
                F.lit(False).alias("decided"),
                F.count("*").alias("n"),
            )
        )
    )


@query
def stream_table(spark: SparkSession, folder: str) -> DataFrame:
    """The replayed stream appended to a table."""
    out = fresh_path(spark, "table")
    _replay(
        spark,
        folder,
        lambda stream: jobs.to_table(
            stream.withColumnRenamed("batch_id", "day"),
            out,
            f"{out}-run",
            ["id", "day"],
            partitions=4,
            trigger=jobs.ALL_THEN_STOP,
        ),
    )
    return spark.read.parquet(out).select("id", "day", "claim", "label", "predicted_label")


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """A stream whose producer sends everything twice, each message kept once."""
    out, delay = fresh_path(spark, "deduplicated"), f"{SLICE_DAYS + 1} days"
    _replay(
        spark,
        folder,
        lambda stream: jobs.without_repeats(
            stream, "id", "ts", delay, out, f"{out}-run", jobs.ALL_THEN_STOP
        ),
        times=2,
    )
    return spark.read.parquet(out).select("id", "key", "batch_id")
