"""Book catalogue: filters, ids, missing books, and the chunk dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.functions import keys
from penprint.operators.chunks import chunk_by_length
from penprint.operators.ordering import row_numbers

# Author entries that name nobody.
PLACEHOLDER_AUTHORS = ("Various", "Anonymous", "Unknown")
ENGLISH = "['en']"
TEXT_TYPE = "Text"
CHUNK_LENGTH = 500


def drop_empty(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with a null or an empty string in one of the columns."""
    for name in subset:
        df = df.where(F.col(name).isNotNull() & (F.col(name) != ""))
    return df


def filter_catalog(
    df: DataFrame,
    language: str = ENGLISH,
    kind: str | None = TEXT_TYPE,
    placeholders: tuple[str, ...] = PLACEHOLDER_AUTHORS,
) -> DataFrame:
    """Text works of one language with a real author and a title; adds ``pg_code``."""
    kept = df.where(F.col("language") == language)
    if kind is not None:
        kept = kept.where(F.col("type") == kind)
    kept = kept.na.drop(subset=["author", "title"]).where(~F.col("author").isin(*placeholders))
    return kept.withColumn("pg_code", keys.code_from_id(F.col("id")))


def assign_ids(df: DataFrame) -> DataFrame:
    """Add ``author_id`` (rank of the author's name) and ``book_id`` (rank of the code per author).

    Both start at 0. Only the distinct authors are ranked and then joined
    back. Authors with very many books are ranked in several tasks.
    """
    authors = row_numbers(df.select("author").distinct(), "author", "author_id", start=0)
    books = row_numbers(df, "pg_code", "book_id", group=("author",), start=0)
    return books.join(authors, "author")


def multi_book_authors(df: DataFrame) -> DataFrame:
    """Keep the rows of authors with more than one book."""
    several = df.groupBy("author").count().where(F.col("count") > 1).select("author")
    return df.join(several, "author", "left_semi")


def build_catalog(df: DataFrame, **filters) -> DataFrame:
    """Filtered catalogue with ids: ``title, author, pg_code, author_id, book_id``.

    Ids are given before single-book authors leave, so author ids have gaps.
    """
    with_ids = assign_ids(filter_catalog(df, **filters))
    return multi_book_authors(with_ids).select(
        "title", "author", "pg_code", "author_id", "book_id"
    )


def missing_books(catalog: DataFrame, books: DataFrame) -> DataFrame:
    """Catalogue rows without a token file; ``books`` has ``pg_code``."""
    return catalog.join(books.select("pg_code"), "pg_code", "left_anti")


def present_books(catalog: DataFrame, books: DataFrame) -> DataFrame:
    """Catalogue rows with a token file."""
    return catalog.join(books.select("pg_code"), "pg_code", "left_semi")


def build_dataset(
    catalog: DataFrame, books: DataFrame, length: int = CHUNK_LENGTH
) -> DataFrame:
    """Chunks of the catalogue's books: ``author_id, book_id, chunk, text``.

    ``books`` holds ``pg_code`` and ``tokens``. The catalogue is the lookup
    side, so texts stay where they were read unless it is too large to copy.
    """
    ids = catalog.select("pg_code", "author_id", "book_id")
    matched = books.select("pg_code", "tokens").join(ids, "pg_code")
    return chunk_by_length(matched, "tokens", ["author_id", "book_id"], length, drop_tail=False)
