"""Sinks. Each table is written by its tasks; nothing passes through the driver."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_chapters(chapters: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Chapter table, one folder per author and book; a book's rows are put together first."""
    chapters.repartition("author", "book").write.mode(mode).partitionBy("author", "book").parquet(path)


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has ended: its marker file is there. A folder without it is half written."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Any table, as Parquet. ``mode="ignore"`` skips the work when a finished output exists.

    What a broken run has left there is no output and is written again.
    """
    if mode == "ignore":
        if committed(df.sparkSession, path):
            return
        mode = "overwrite"
    df.write.mode(mode).parquet(path)


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """Vocabulary as text, one term per line in the order of ``idx``."""
    vocabulary.orderBy("idx").select("term").write.mode("overwrite").text(path)


def write_word_list(words: DataFrame, path: str) -> None:
    """Words as text, one per line, repeats kept."""
    words.select("word").write.mode("overwrite").text(path)


def append_metrics(metrics: DataFrame, path: str, fresh: bool = False) -> None:
    """Add rows to the metrics table; ``fresh`` starts it anew."""
    metrics.write.mode("overwrite" if fresh else "append").option("header", True).csv(path)


def write_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Put the rows of a run into the metrics table, one folder per run.

    A run that is written again replaces its own rows and leaves those of other runs alone.
    """
    rows = metrics.withColumn("run_id", F.lit(run_id))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").option("header", True).csv(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Predictions as CSV with a header."""
    predictions.write.mode("overwrite").option("header", True).csv(path)


def write_section_texts(sections: DataFrame, path: str, book: str) -> None:
    """Readable section texts, one folder per book; a book's rows are put together first."""
    sections.select(F.col(book), "value").repartition(book).write.mode("overwrite").partitionBy(book).text(path)


def write_corpus(chapters: DataFrame, path: str) -> None:
    """The running corpus: one line of prepared text per chapter, all books."""
    chapters.select(F.regexp_replace("text", r"\s+", " ").alias("value")).write.mode(
        "overwrite"
    ).text(path)


def write_catalog(catalog: DataFrame, path: str) -> None:
    """The filtered catalogue as CSV."""
    catalog.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _local_root(spark: SparkSession, path: str) -> str | None:
    """``path`` on the mounted file system that it is on; None where Spark reaches it in another way."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    return whole.getPath() if whole.getScheme() == "file" else None


def _one_file_each(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task that is run again writes the same files again
        folder = os.path.join(root, f"part-{TaskContext.get().partitionId():05d}")
        os.makedirs(folder, exist_ok=True)
        half = os.path.join(folder, f"_half-{uuid.uuid4().hex}")
        open_name, file, n = None, None, 0

        def close() -> None:
            file.close()
            os.replace(half, os.path.join(folder, open_name))

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if file is None or name != open_name:
                    if file is not None:
                        close()
                    open_name, file, n = name, open(half, "wb"), n + 1
                file.write((value or b"") + b"\n")
        if file is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["files"])

    return run


def write_texts(texts: DataFrame, path: str) -> None:
    """A file ``<name>.txt`` for each ``name`` with the lines ``value`` of its rows; a null is an empty line.

    Names are letters, digits and, not at the start, underscores; rows without one share a file. On a mounted file system the tasks
    write the files themselves, a folder per task: Spark's writer makes a folder, a checksum and calls of
    the system's ``chmod`` for each. Elsewhere it does the work, and the name is that of the folder ``name=<name>``.
    """
    spark = texts.sparkSession
    root = _local_root(spark, path)
    rows = texts.select(F.col("name").cast("string").alias("name"), "value").repartition("name")
    if root is None:
        rows.write.partitionBy("name").option("lineSep", "\n").text(path)
        return
    if os.path.exists(root):
        raise FileExistsError(root)
    file = F.concat(F.coalesce(F.nullif("name", F.lit("")), F.lit("-")), F.lit(".txt")).alias("file")
    sorted_rows = rows.select(file, "value").sortWithinPartitions("file")
    sorted_rows.mapInArrow(_one_file_each(root), "files long").agg(F.sum("files")).collect()
    os.makedirs(root, exist_ok=True)
    open(os.path.join(root, "_SUCCESS"), "w").close()
