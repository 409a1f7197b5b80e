"""Importance of the features of a fitted model, by permutation.

The values of one feature are exchanged between the rows, and the accuracy that is lost tells
how much the model relies on it. Rows are put in hash order once, and each takes the value of
the next one; so all features need one join, and all their predictions one job.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.functions import keys
from penprint.operators.ordering import row_numbers
from penprint.session import staged


def exchanged_rows(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """``label, own, other``: the values of each row and of the next one in hash order; the last takes the first's."""
    hashed = rows.select(
        key, "label", vector_to_array("features").alias("own"), keys.hash_key(F.lit(seed), F.col(key)).alias("_h")
    )
    placed = staged(row_numbers(hashed, "_h", "_place", start=0), "places")
    count = F.lit(placed.count())
    # n % 0 of an empty table is never worked out
    before = F.when(F.col("_place") == 0, count - 1).otherwise(F.col("_place") - 1)
    return placed.join(placed.select(before.alias("_place"), F.col("own").alias("other")), "_place").select(
        "label", "own", "other"
    )


def permutation_importance(model, rows: DataFrame, key: str, features: list[int], seed: int = 42) -> DataFrame:
    """``feature, accuracy, permuted, importance``: accuracy on ``rows``, with the feature exchanged, and the loss.

    ``model`` is any fitted model that reads ``features`` and writes ``prediction``; ``rows``: ``key, label, features``,
    rows that it was not fitted on. Without rows the result is empty.
    """
    pairs = exchanged_rows(rows, key, seed)
    # -1 stands for the rows as they are
    asked = pairs.select("label", "own", "other", F.explode(F.array(*[F.lit(i) for i in (-1, *features)])).alias("feature"))
    values = F.transform(
        "own", lambda x, i: F.when(i == F.col("feature"), F.get("other", F.col("feature"))).otherwise(x)
    )
    predicted = model.transform(asked.select("label", "feature", array_to_vector(values).alias("features")))
    right = F.avg((F.col("label") == F.col("prediction")).cast("int"))
    # a row per feature
    scores = staged(predicted.groupBy("feature").agg(right.alias("permuted")), "importance")
    whole = scores.where("feature = -1").select(F.col("permuted").alias("accuracy")).scalar()
    return scores.where("feature >= 0").select(
        "feature", whole.alias("accuracy"), "permuted", (whole - F.col("permuted")).alias("importance")
    )
