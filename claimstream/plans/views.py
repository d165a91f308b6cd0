"""The given tables seen as claims, scored claims and topic messages."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstream.functions.text import redact_by_rule
from claimstream.sources.readers import read_table

# The language of a document decides its corpus label; the last label
# is unknown to the label mapping and gets dropped.
LANGUAGE_LABEL = {"en": "SUPPORTS", "fr": "REFUTES", "de": "NOT ENOUGH INFO", "es": "OTHER"}


# A session whose tables are single files, as in tests and benchmarks, may name the number of
# partitions its tables are dealt into; unset, they are read as they are.
PARTITIONS = "spark.claimstream.partitions"

# Fixed value: every so many documents carry a redacted text of their own.
REDACTED_EVERY = 3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    partitions = spark.conf.get(PARTITIONS, None)
    return read_table(spark, f"{folder}/{name}.parquet", int(partitions) if partitions else None)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a claim without redaction."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("claim"), "lang", "source"
    )


def raw_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as labelled corpus lines."""
    label = F.lit(None).cast("string")
    for lang, name in LANGUAGE_LABEL.items():
        label = F.when(F.col("lang") == lang, F.lit(name)).otherwise(label)
    return documents(spark, folder).select("claim", label.alias("label"))


def broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are no JSON, one for every hundredth document."""
    docs = table(spark, folder, "documents").where(F.col("doc_id") % 100 == 0)
    return docs.select(F.concat(F.lit("{broken "), F.col("doc_id").cast("string")).alias("value"))


def claims(spark: SparkSession, folder: str, labelled_only: bool = True) -> DataFrame:
    """Documents with their quality label, redacted; low quality is class 1.

    Training needs the label; whoever publishes or scores takes every document.
    """
    labelled = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), (1 - F.col("quality")).alias("label")
    )
    return (
        documents(spark, folder)
        .join(labelled, "id", "inner" if labelled_only else "left")
        .select("id", "claim", redact_by_rule(F.col("claim")).alias("entity_redacted_claim"), "label")
    )


def scored_messages(
    spark: SparkSession, folder: str, since: int | None = None, until: int | None = None
) -> DataFrame:
    """Events as messages: value over 100 is the score, errors are the positive class.

    ``since`` and ``until`` are epoch days; the bounds are put on the stored column, so
    they reach the scan.
    """
    events = table(spark, folder, "events")
    midnight = datetime(1970, 1, 1)
    if since is not None:
        events = events.where(F.col("ts") >= F.lit(midnight + timedelta(since)).cast("timestamp_ntz"))
    if until is not None:
        events = events.where(F.col("ts") < F.lit(midnight + timedelta(until)).cast("timestamp_ntz"))
    day = F.unix_date(F.to_date("ts")).cast("bigint")
    payload = F.struct(
        F.concat_ws(" ", "event_type", "props").alias("claim"),
        F.col("event_type").alias("entity_redacted_claim"),
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("predicted_label"),
    )
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        day.alias("batch_id"),
        F.col("event_type").alias("key"),
        F.to_json(payload).alias("value"),
    )


def document_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as scored messages: labelled good is negative, all others positive."""
    labelled = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    payload = F.struct(
        F.col("text").alias("claim"),
        F.when(F.col("doc_id") % REDACTED_EVERY == 0, redact_by_rule(F.col("text")))
        .otherwise("")
        .alias("entity_redacted_claim"),
        F.coalesce("toxic", F.lit(0)).alias("label"),
        F.when(F.col("quality") == 1, 0.0).otherwise(1.0).alias("predicted_label"),
    )
    return (
        table(spark, folder, "documents")
        .join(labelled, "doc_id", "left")
        .select(F.col("doc_id").alias("id"), "source", F.to_json(payload).alias("value"))
    )
