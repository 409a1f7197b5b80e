"""Exact running totals and row numbers over ordered sets of any size.

A window without partitions, or with one very large partition, would sort all
its rows in one task. Here Spark's range partitioning cuts the order first: each
range is summed on its own, and the totals of earlier ranges are added afterwards.
Ranges go by group and key together, so a large group is cut as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.session import staged

RANGE_ROWS = 1_000_000


def running_totals(
    df: DataFrame,
    key: str,
    sums: dict[str, str | Column],
    group: tuple[str, ...] = (),
    descending: bool = False,
    range_rows: int = RANGE_ROWS,
    written: bool = False,
) -> DataFrame:
    """Add to each row the total of ``sums`` over all rows up to and including it.

    Rows are ordered by ``key`` inside ``group``. Key values should be unique
    in a group, or the order among equal ones is open; add up ties beforehand.
    The rows are written first (unless ``written`` says that they are a written
    table); their number gives the number of ranges.
    """
    df = df if written else staged(df, "ordered")
    ranges = -(-df.count() // range_rows)
    order = F.desc(key) if descending else F.asc(key)
    sums = {name: F.col(c) if isinstance(c, str) else c for name, c in sums.items()}
    out = [c for c in df.columns if c not in sums]

    def up_to(*part):
        return (
            Window.partitionBy(*part)
            .orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    if ranges <= 1:
        return df.select(*out, *[F.sum(c).over(up_to(*group)).alias(n) for n, c in sums.items()])

    # written again, so that both readers below see the same ranges
    cut = df.repartitionByRange(ranges, *group, order)
    ranged = staged(cut.withColumn("_range", F.spark_partition_id()), "ranges")
    part = [*group, "_range"]
    inside = ranged.select(
        *out, "_range", *[F.sum(c).over(up_to(*part)).alias(n) for n, c in sums.items()]
    )
    per_range = ranged.groupBy(*part).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = per_range.select(
        *[F.col(c).alias(f"_of_{c}") for c in part],
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in sums],
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in part]
    return inside.join(before, same).select(
        *out, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums]
    )


def row_numbers(
    df: DataFrame,
    key: str,
    name: str,
    group: tuple[str, ...] = (),
    start: int = 1,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Number the rows of each group in the order of ``key``."""
    numbered = running_totals(df, key, {name: F.lit(1)}, group, range_rows=range_rows)
    return numbered.withColumn(name, (F.col(name) + (start - 1)).cast("long"))
