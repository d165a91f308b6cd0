"""Helpers of the trained models: bounded samples and sums over ragged rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def training_sample(docs: DataFrame, labels: DataFrame, id: str, label: str, most: int) -> DataFrame:
    """``docs`` with the label of at most ``most`` ids, drawn by a hash of the id.

    The draw is made on the labels alone; ids with contradicting labels are left out.  Only
    the drawn ids, ``most`` at most, are broadcast to the documents.
    """
    agreed = (
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
        .groupBy(id)
        .agg(F.min(label).alias("_label"), F.max(label).alias("_other"))
        .where("_label = _other")
    )
    drawn = agreed.orderBy(F.xxhash64(id), id).limit(most).select(id, "_label")
    return docs.join(F.broadcast(drawn), id)


def row_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values[start:end]`` for every row; an empty row sums to 0."""
    out = np.zeros((len(starts), *values.shape[1:]), dtype=values.dtype)
    full = ends > starts
    if full.any():
        out[full] = np.add.reduceat(values, starts[full], axis=0)
    return out


def letters(text: Column) -> Column:
    """Whether a text has a letter."""
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))
