"""Expressions over scored claims."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The decision threshold, the spellings of a positive label,
# and the names of the four outcomes.
THRESHOLD = 0.5
TRUE_LABELS = ("1", "true")
CATEGORIES = ("true_positive", "false_positive", "true_negative", "false_negative")


def positive_bit(predicted: Column) -> Column:
    """1 when the score reaches the threshold, else 0; a missing score is 0."""
    return F.coalesce((predicted >= THRESHOLD).cast("int"), F.lit(0))


def label_is_true(label: Column) -> Column:
    """Labels arrive as text: 1 or true in any case is positive, null stays null."""
    return F.lower(label).isin(*TRUE_LABELS)


def category(predicted_positive: Column, actual_positive: Column) -> Column:
    """Which of the four outcomes a row is; null when either side is unknown."""
    true_pos, false_pos, true_neg, false_neg = CATEGORIES
    return (
        F.when(predicted_positive & actual_positive, true_pos)
        .when(predicted_positive & ~actual_positive, false_pos)
        .when(~predicted_positive & ~actual_positive, true_neg)
        .when(~predicted_positive & actual_positive, false_neg)
    )


def share(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
