"""One run from raw book files to metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint import settings as st
from penprint.operators import chunks as ck
from penprint.operators import structure
from penprint.plans import grid
from penprint.session import staged
from penprint.settings import Settings


@dataclass
class Run:
    """Results of one workflow run."""

    metrics: DataFrame
    cells: list
    features: grid.Features
    rejected: DataFrame


CHAPTER_KEY = ["author", "book", "section_num", "chapter_num", "name"]


def book_chapters(books: DataFrame, patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chapters of raw books and the rejected books.

    ``books``: ``author, book, raw``; ``patterns``: ``book, pattern``.
    """
    found = structure.find_headers(structure.read_structure(books), patterns, "book")
    chapters = structure.split_chapters(found, ["author", "book"])
    rejected = structure.rejected_books(found, ["author", "book"])
    return chapters.where(F.col("chapter_num") > 0), rejected


def _with_id(pieces: DataFrame) -> DataFrame:
    chunk_id = F.concat_ws("/", "author", "book", "section_num", "chapter_num", "chunk")
    return pieces.where(F.col("text") != "").withColumn("chunk_id", chunk_id)


def run_workflow(
    books: DataFrame,
    patterns: DataFrame,
    vectors: DataFrame,
    vector_dims: int,
    settings: Settings,
    classes: dict[str, int] = st.AUTHOR_CLASSES,
    target: str = st.TARGET_AUTHOR,
    model_names: tuple[str, ...] = tuple(grid.models.MODELS),
    max_features: int = grid.vocabulary.MAX_FEATURES,
) -> Run:
    """Raw books to chunks, features, fitted models and metrics."""
    chapters, rejected = book_chapters(books, patterns)
    chunks = staged(_with_id(ck.prepare_chunks(chapters, settings, "text", CHAPTER_KEY)), "chunks")
    rows = grid.labelled(chunks, settings, "author", classes, target)
    features = grid.make_features(
        rows, vectors, vector_dims, settings, max_features=max_features
    )
    count = len(classes) if settings.multiclass else 2
    cells = grid.fit_grid(features, count, model_names)
    return Run(grid.metrics_table(cells, settings), cells, features, rejected)


def run_sweep(
    books: DataFrame,
    patterns: DataFrame,
    vectors: DataFrame,
    vector_dims: int,
    runs: dict[str, Settings] | None = None,
    classes: dict[str, int] = st.AUTHOR_CLASSES,
    target: str = st.TARGET_AUTHOR,
    model_names: tuple[str, ...] = tuple(grid.models.MODELS),
    max_features: int = grid.vocabulary.MAX_FEATURES,
) -> tuple[DataFrame, DataFrame]:
    """Metrics of all runs of a settings sweep, with their ``settings_id``, and the rejected books.

    The books are read and cut once for all runs.
    """
    runs = runs or st.sweep()
    chapters, rejected = book_chapters(books, patterns)
    pieces = ck.sweep_chunks(chapters, runs, "text", CHAPTER_KEY)
    all_chunks = staged(_with_id(pieces), "sweep", partition_by=("settings_id",))
    table = None
    for name, settings in runs.items():
        chunks = all_chunks.where(F.col("settings_id") == name)
        rows = grid.labelled(chunks, settings, "author", classes, target)
        features = grid.make_features(
            rows, vectors, vector_dims, settings, max_features=max_features
        )
        count = len(classes) if settings.multiclass else 2
        metrics = grid.metrics_table(grid.fit_grid(features, count, model_names), settings)
        metrics = metrics.withColumn("settings_id", F.lit(name))
        table = metrics if table is None else table.unionByName(metrics)
    return table, rejected
