"""Exact deduplication against a persistent index of digests.

The index is a Parquet table in a folder, bucketed and sorted by the SHA-256 of the
text. A batch of new documents is reduced to one row per digest, anti-joined with the
index by sort-merge (the index side is read bucket by bucket and is not shuffled),
and what is new is appended in the same layout. The folder outlives the session: open
it again with the same number of buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.session import new_path, staged


def digest(text: Column) -> Column:
    """SHA-256 of the unchanged text in UTF-8, lower-case hexadecimal; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class DigestIndex:
    """Digests seen so far, each with the id of the document that stays for it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest STRING, keep_id BIGINT, keep_row BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> None:
        """Append the digests of a batch that are not in the index yet.

        ``rows``: digest, doc_id and row (a number that tells rows with one id apart). Of
        the rows of a digest the largest (doc_id, row) stays; a null id comes last.
        """
        best = F.max(F.struct("doc_id", "row")).alias("best")
        batch = rows.groupBy("digest").agg(best).select(
            "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")
        )
        fresh = batch.hint("merge").join(self.table(), "digest", "left_anti")
        fresh.repartition(self.buckets, "digest").write.mode("append").insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def forget(self) -> None:
        """Drop the session's name for the index; the files stay."""
        self.spark.sql(f"DROP TABLE {self.name}")


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, digest and a row number of every document, written once."""
    return staged(
        docs.select("doc_id", digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")),
        "digests",
    )


def deduplicate(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Texts are equal
    when identical, null being empty. The newer half of the ids is indexed before the
    older half, so the document with the largest id stays; exactly one row of a group
    is kept, also when ids repeat or are null. With an index that holds earlier data,
    a text it knows keeps no document of this batch, and keep_id names the earlier one.
    """
    spark = docs.sparkSession
    index = index or DigestIndex(spark, new_path(spark, "digest-index"))
    rows = digest_rows(docs)
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is not None:
        middle = low + (high - low) // 2
        index.add(rows.where(F.col("doc_id") > middle))
        index.add(rows.where(F.col("doc_id") <= middle))
    index.add(rows.where(F.col("doc_id").isNull()))
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = staged(sizes.join(index.table(), "digest"), "digest-groups")
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, one row for each text, with all their columns."""
    own = next(n for n in (f"_digest{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    kept = staged(
        deduplicate(docs, index).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")),
        "kept",
    )
    marked = docs.withColumn(own, digest(F.col("text")))
    same = marked["doc_id"].eqNullSafe(kept["_id"]) & (marked[own] == kept["_sha"])
    # rows that repeat id and text are told apart by neither
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)
