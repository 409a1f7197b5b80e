"""Readers. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penprint.functions import keys
from penprint.functions.text import strip_ends

SOURCES = "author string, title string, url string"
CHAPTERS = "section_num int, chapter_num int, name string, text string, wc int"
CATALOG = (
    "id string, title string, author string, authoryearofbirth double, authoryearofdeath double, "
    "language string, downloads long, subjects string, type string"
)


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """A CSV table with a header; quoted fields may hold commas and quotes.

    With ``multi_line`` they may hold line ends too, and a file is read by one task;
    without it, large files are split.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """The list of books: ``author, title, url``."""
    return read_csv(spark, path, SOURCES)


def read_catalog(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The large catalogue, one row per work. Files are split unless titles hold line ends (``multi_line``)."""
    return read_csv(spark, path, CATALOG, multi_line)


def read_texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """One row per file below ``folder``: ``file_path, text``."""
    return (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))
    )


def read_raw_books(spark: SparkSession, folder: str) -> DataFrame:
    """Raw book files ``<author>/raw_<title>.txt``: ``author, book, raw``."""
    files = read_texts(spark, folder, "raw*.txt")
    name = keys.path_part(F.col("file_path"), 1)
    return files.select(
        keys.path_part(F.col("file_path"), 2).alias("author"),
        F.regexp_extract(name, r"^raw_(.*)\.txt$", 1).alias("book"),
        F.col("text").alias("raw"),
    )


def read_chapter_files(spark: SparkSession, folder: str) -> DataFrame:
    """Chapter tables ``<author>/<book>/data.csv``, author and book taken from the path.

    Rows without text (section headings) are left out.
    """
    rows = read_csv(spark, f"{folder}/*/*/*.csv", CHAPTERS).select(
        "*",
        keys.path_part(F.col("_metadata.file_path"), 3).alias("author"),
        keys.path_part(F.col("_metadata.file_path"), 2).alias("book"),
    )
    return rows.na.drop()


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token files ``PG<code>_tokens.txt``, one token per line: ``pg_code, tokens``.

    The name may be that of the file or of its folder; other files are left out.
    """
    files = read_texts(spark, folder).where(F.regexp_like("file_path", F.lit(r"PG\d+_tokens[./]")))
    lines = F.split("text", r"\R")
    tokens = F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1))
    return files.select(
        F.regexp_extract("file_path", r"PG(\d+)_tokens", 1).alias("code"),
        F.coalesce(tokens, lines).alias("tokens"),
    ).select(F.col("code").cast("int").alias("pg_code"), "tokens")


def read_word_vectors(spark: SparkSession, path: str, dims: int) -> DataFrame:
    """Word vectors in text form, ``word f1 f2 ...``: ``word, vec``.

    Lines with a wrong number of values or with one that is no number are
    skipped; of several lines for a word the last one counts.
    """
    lines = spark.read.text(path).select(
        F.split(strip_ends(F.col("value")), " ").alias("parts"),
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ).alias("line"),
    )
    rows = lines.select(
        F.get("parts", F.lit(0)).alias("word"),
        F.transform(
            F.slice("parts", F.lit(2), F.size("parts")), lambda x: x.try_cast("float")
        ).alias("vec"),
        "line",
    ).where((F.size("vec") == dims) & F.forall("vec", lambda x: x.isNotNull()))
    return rows.groupBy("word").agg(F.max_by("vec", "line").alias("vec"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-case words, one per line."""
    return (
        spark.read.text(path)
        .select(F.lower(strip_ends(F.col("value"))).alias("word"))
        .where(F.col("word") != "")
        .distinct()
    )


def read_vectors(spark: SparkSession, path: str, key: str, key_type: T.DataType) -> DataFrame:
    """Saved text vectors: ``key, vector``."""
    schema = T.StructType(
        [T.StructField(key, key_type), T.StructField("vector", T.ArrayType(T.DoubleType()))]
    )
    return spark.read.schema(schema).parquet(path)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The chunk dataset: ``author_id, book_id, chunk, text``."""
    return spark.read.schema(
        "author_id long, book_id long, chunk int, text string"
    ).parquet(path)
