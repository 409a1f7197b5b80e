"""Corpus reports: word counts by author, book pivot, style figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from penprint.functions import keys
from penprint.functions import lexicon as lex
from penprint.functions import text as tx


def word_counts(chapters: DataFrame, author: str, book: str, wc: str = "wc") -> DataFrame:
    """Words per author and book."""
    return chapters.groupBy(author, book).agg(F.sum(wc).alias("wc"))


def author_book_pivot(
    counts: DataFrame, author: str, book: str, books: int = 4, names: dict[str, str] | None = None
) -> DataFrame:
    """One row per author with the words of its first ``books`` books, and their total over all.

    ``counts`` has one row per book. With ``names`` authors get their display
    name, and ``place`` their place in its order.
    """
    order = Window.partitionBy(author).orderBy(book)
    # of each author only the first few books reach the window
    first = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= books)
    columns = [
        F.sum(F.when(F.col("rank") == i, F.col("wc"))).alias(f"book_{i}")
        for i in range(1, books + 1)
    ]
    totals = counts.groupBy(author).agg(F.sum("wc").alias("total_wc"))
    wide = first.groupBy(F.col(author).alias("_author")).agg(*columns)
    wide = wide.join(totals, F.col("_author").eqNullSafe(F.col(author))).select(
        author, *[f"book_{i}" for i in range(1, books + 1)], "total_wc"
    )
    if names:
        order = F.array_position(F.array(*[F.lit(a) for a in names]), F.col(author))
        wide = wide.withColumn("place", F.nullif(order, F.lit(0)).cast("int")).withColumn(
            author, keys.display_name(F.col(author), names)
        )
    return wide


def style_figures(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Sentence length, word length and punctuation use of each text.

    A sentence ends at ``.``, ``!`` or ``?``; pieces without a word do not count.
    """
    word = r"[\p{L}\p{N}_]+(?:[-'][\p{L}\p{N}_]+)*"
    pieces = F.split(F.col(text), r"[.!?]+")
    parts = df.select(
        *keep,
        F.size(F.filter(pieces, lambda s: F.regexp_like(s, F.lit(r"[\p{L}\p{N}_]")))).alias("sentences"),
        F.regexp_extract_all(F.col(text), F.lit(word), F.lit(0)).alias("_words"),
        F.size(
            F.filter(
                F.regexp_extract_all(F.col(text), F.lit(lex.TOKEN), F.lit(0)),
                lambda t: F.instr(F.lit(lex.PUNCTUATION), t) > 0,
            )
        ).alias("marks"),
    )
    letters = F.length(F.array_join("_words", ""))
    words = F.size("_words")
    return parts.select(
        *keep,
        F.col("sentences").cast("long").alias("sentences"),
        words.cast("long").alias("words"),
        F.coalesce(F.try_divide(words, F.col("sentences")), F.lit(0.0)).alias("sentence_length"),
        F.coalesce(F.try_divide(letters, words), F.lit(0.0)).alias("word_length"),
        F.coalesce(F.try_divide(F.col("marks"), words), F.lit(0.0)).alias("marks_per_word"),
    )


def style_by_author(df: DataFrame, text: str, author: str) -> DataFrame:
    """Mean style figures of each author's texts."""
    figures = style_figures(df, text, [author])
    return figures.groupBy(author).agg(
        F.count("*").alias("texts"),
        *[F.avg(c).alias(c) for c in ("sentence_length", "word_length", "marks_per_word")],
    )


def class_counts(df: DataFrame, author: str) -> DataFrame:
    """Texts per author."""
    return df.groupBy(author).agg(F.count("*").alias("n"))
