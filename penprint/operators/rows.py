"""Arrays to rows, and columns that must not be worked out twice.

A plain ``explode`` makes the optimizer add a filter on the size of its array
and push it below the projections, which repeats all the work behind the
array. The outer form adds no filter; the empty row is dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: Column, keep: list, value: str, position: str | None = None) -> DataFrame:
    """One row per element: ``keep``, the position (from 0) if named, and ``value``."""
    names = (position or "_pos", value)
    rows = df.select(*keep, F.posexplode_outer(array).alias(*names)).where(
        F.col(names[0]).isNotNull()
    )
    return rows if position else rows.drop("_pos")


def unnest_structs(df: DataFrame, array: Column, keep: list, probe: str) -> DataFrame:
    """One row per struct of the array: ``keep`` and its fields; ``probe`` is a field that is never null."""
    return df.select(*keep, F.inline_outer(array)).where(F.col(probe).isNotNull())


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns in such a way that a later filter on them does not compute them again."""
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline_outer(packed))


def with_labels(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """The rows of both tables joined on ``key``; a key that is repeated in either of them is an error.

    Repeats are counted where the join has brought equal keys together anyway. Rows without a
    partner, and null keys, drop out.
    """
    same = Window.partitionBy(key)

    def single(df: DataFrame) -> DataFrame:
        counted = df.where(F.col(key).isNotNull()).withColumn("_repeats", F.count("*").over(same))
        message = F.concat(F.lit(f"repeated {key}: "), F.col(key).cast("string"))
        once = F.when(F.col("_repeats") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
        return counted.where(once).drop("_repeats")

    return single(features).join(single(labels), key)
