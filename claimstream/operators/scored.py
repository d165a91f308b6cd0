"""Operators over the scored stream: parsing, outcomes, metrics, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimstream.functions import scored as S
from claimstream.schemas import SCORED


def parse_scored(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten the JSON value of each message; text that is no number gives a null score.

    The parsed value passes through a one-element inline: filters on its fields then stay
    above it instead of parsing the message once more each.
    """
    data = F.from_json(F.col("value").cast("string"), SCORED)
    return messages.select(*keep, F.inline_outer(F.array(data))).withColumn(
        "predicted_label", F.col("predicted_label").try_cast("double")
    )


def stamp(df: DataFrame, batch_id: Column | int | None = None) -> DataFrame:
    """Add the ingestion time and, inside a micro-batch, the batch id."""
    out = df.withColumn("processed_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
    if batch_id is None:
        return out
    value = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return out.withColumn("batch_id", value.cast("bigint"))


def usable() -> Column:
    """Rows that have both a score and a label."""
    return F.col("predicted_label").isNotNull() & F.col("label").isNotNull()


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows the metrics cannot use: malformed messages, bad scores, missing labels."""
    return parsed.where(~usable())


def with_category(parsed: DataFrame) -> DataFrame:
    """Predicted and actual class and the outcome of every usable row."""
    return (
        parsed.where(usable())
        .withColumn("predicted_positive", F.col("predicted_label") >= S.THRESHOLD)
        .withColumn("actual_positive", S.label_is_true(F.col("label")))
        .withColumn(
            "prediction_category",
            S.category(F.col("predicted_positive"), F.col("actual_positive")),
        )
    )


def confusion(categorised: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and the four outcome counts per group."""
    outcome = F.col("prediction_category")
    return categorised.groupBy(*by).agg(
        F.count("*").alias("batch_size"),
        *[F.count_if(outcome == name).alias(f"{name}s") for name in S.CATEGORIES],
    )


def quality(confused: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where a denominator is 0."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    precision, recall = F.col("precision"), F.col("recall")
    return (
        confused.withColumn("accuracy", S.share(tp + tn, F.col("batch_size")))
        .withColumn("precision", S.share(tp, tp + fp))
        .withColumn("recall", S.share(tp, tp + fn))
        .withColumn("f1_score", S.share(2 * (precision * recall), precision + recall))
    )


def batch_counts(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and positive rows per group."""
    return parsed.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.sum(S.positive_bit(F.col("predicted_label"))).alias("positive_count"),
    )


def head_sample(df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows of each group by arrival order.

    Spark prunes every task to ``rows`` rows per group before the shuffle
    (WindowGroupLimit), so a group that fills the table costs no more than another.  Without
    groups the first rows are taken beforehand, which needs no sort of all rows.
    """
    if not by:
        df = df.orderBy(*order).limit(rows)
    arrival = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("arrival", arrival).where(F.col("arrival") <= rows)
