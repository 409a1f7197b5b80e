"""Term counts, vocabularies and TF-IDF."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    SQLTransformer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penprint.functions import lexicon as lex
from penprint.functions import text as tx
from penprint.operators import grams
from penprint.operators.ordering import row_numbers
from penprint.operators.rows import unnest_structs
from penprint.session import staged

MAX_FEATURES = 10_000
# a model holds its vocabulary; beyond this, ``joined_tfidf`` does without one
MOST_FEATURES = 500_000


def with_terms(df: DataFrame, text: str, low: int = 1, high: int = 2) -> DataFrame:
    """Add ``terms``, the n-grams of a text."""
    if (low, high) == (1, 1):
        return df.withColumn("terms", tx.terms(F.col(text)))
    words = df.withColumn("_words", tx.terms(F.col(text)))
    return words.withColumn("terms", tx.ngrams(F.col("_words"), low, high)).drop("_words")


def corpus_counts(
    df: DataFrame, terms: str = "terms", with_total: bool = False, low: int = 1, high: int = 1
) -> DataFrame:
    """``term, cf, df``: occurrences and texts per term, or per n-gram of ``low`` to ``high`` terms.

    Tasks count the terms of many texts at once, so a row per term of such a part is moved, in
    one shuffle. N-grams should be made here, of terms without blanks: ``terms`` that hold them
    already cost more. ``with_total`` adds a row for the empty term, whose ``df`` is the number
    of texts.
    """
    counted = df.select(terms).mapInArrow(
        grams.counts_task(max(low, 1), high, with_total), "term string, cf long, df long"
    )
    # added up after the move: most n-grams of a task are rare, and a table of them would not fit
    moved = counted.repartition("term").groupBy("term")
    return moved.agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def top_terms(counts: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The ``max_features`` most frequent terms; ties in the order of the term."""
    return counts.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)


def index_terms(terms: DataFrame) -> DataFrame:
    """Add ``idx``, the place of a term in sorted order, from 0."""
    return row_numbers(terms, "term", "idx", start=0)


def vocabulary(
    df: DataFrame, terms: str = "terms", max_features: int | None = MAX_FEATURES
) -> DataFrame:
    """``term, cf, df, idx``; all terms when ``max_features`` is None."""
    counts = corpus_counts(df, terms)
    if max_features is None:
        return index_terms(counts)
    # a bounded list: one window holds it
    place = F.row_number().over(Window.orderBy("term")) - 1
    return top_terms(counts, max_features).withColumn("idx", place.cast("long"))


def idf(documents: Column, df: Column) -> Column:
    """Smoothed inverse document frequency, plus one."""
    return F.log((1 + documents) / (1 + df)) + 1


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _term_stages(text: str, low: int, high: int) -> list[SQLTransformer]:
    """Stages that add ``terms``, in SQL so that they are saved with the model."""
    words = f"regexp_extract_all(lower({text}), {_quoted(lex.TERM)}, 0)"
    grams, sizes = "_words", ["_words"] if low <= 1 else []
    for n in range(2, high + 1):
        count = f"greatest(size(_words) - {n - 1}, 0)"
        grams = (
            f"zip_with(slice({grams}, 1, {count}), slice(_words, {n}, {count}), "
            "(head, word) -> concat(head, ' ', word))"
        )
        if n >= low:
            sizes.append(grams)
    return [
        SQLTransformer(statement=f"SELECT *, {words} AS _words FROM __THIS__"),
        SQLTransformer(
            statement=f"SELECT * EXCEPT (_words), concat({', '.join(sizes)}) AS _terms FROM __THIS__"
        ),
    ]


def weighting_stages(vocabulary_rows: list, documents: int, text: str, low: int = 1, high: int = 2) -> list:
    """Row-local stages that add ``_weighted``, the TF-IDF of a text before it is scaled to length one."""
    rows = sorted(vocabulary_rows, key=lambda r: r["idx"])
    weights = [math.log((1 + documents) / (1 + r["df"])) + 1 for r in rows]
    return [
        *_term_stages(text, low, high),
        CountVectorizerModel.from_vocabulary(
            [r["term"] for r in rows], inputCol="_terms", outputCol="_counts"
        ),
        ElementwiseProduct(
            scalingVec=Vectors.dense(weights), inputCol="_counts", outputCol="_weighted"
        ),
    ]


def tfidf_model(
    vocabulary_rows: list, documents: int, text: str, output: str, low: int = 1, high: int = 2
) -> PipelineModel:
    """A fitted, row-local TF-IDF model from vocabulary rows (``term, df, idx``)."""
    return PipelineModel(
        [
            *weighting_stages(vocabulary_rows, documents, text, low, high),
            Normalizer(p=2.0, inputCol="_weighted", outputCol=output),
            SQLTransformer(
                statement="SELECT * EXCEPT (_terms, _counts, _weighted) FROM __THIS__"
            ),
        ]
    )


def frequent_counts(df: DataFrame, high: int, n: int) -> DataFrame | None:
    """``term, cf, df`` of at least the ``n`` most frequent n-grams of one to ``high`` words, and the total.

    Each of them occurs as often as the ``n``-th word or more often; so do its words, and so does the counter that it
    shares with others by its hash. Only n-grams that pass both are counted, so the others are not moved. ``df`` has
    ``terms``, without blanks. None if there are fewer than ``n`` words, or too many that occur as often as the ``n``-th.
    """
    bounds = staged(
        df.select("terms").mapInArrow(grams.bounds_task(high), "term string, cf long, df long, slot int, counts binary"), "bounds"
    )
    counted = bounds.where(F.col("term").isNotNull()).repartition("term").groupBy("term")
    words = staged(counted.agg(F.sum("cf").alias("cf"), F.sum("df").alias("df")), "word-counts")
    spoken = words.where("term != ''")
    # a row per number of occurrences
    ranked = [tuple(r) for r in spoken.groupBy("cf").agg(F.count("*")).collect()]
    least, above = None, 0
    for cf, terms in sorted(ranked, reverse=True):
        above += terms
        if above >= n:
            least = cf
            break
    if least is None or above > MOST_FEATURES:
        return None
    listed = spoken.where(F.col("cf") >= least).select("term").toArrow().column("term").combine_chunks()
    enough = np.zeros(grams.SLOTS, bool)
    sums = bounds.where(F.col("slot").isNotNull()).groupBy("slot").applyInArrow(grams.sum_slots, "slot int, counts binary")
    for r in sums.toLocalIterator():
        enough[r["slot"] : r["slot"] + grams.SLOTS_AT_ONCE] = np.frombuffer(r["counts"], np.int64) >= least
    sent = df.sparkSession.sparkContext.broadcast((listed, enough))
    found = df.select("terms").mapInArrow(grams.likely_task(high, sent), "term string, cf long, df long")
    added = found.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))
    return words.where((F.col("term") == "") | (F.col("cf") >= least)).unionByName(added)


def fit_tfidf(
    df: DataFrame,
    text: str = "text",
    output: str = "tfidf",
    low: int = 1,
    high: int = 2,
    max_features: int = MAX_FEATURES,
) -> tuple[PipelineModel, list]:
    """Fit TF-IDF; returns the model and its vocabulary rows.

    The corpus is read for the counts, twice if more words than ``max_features`` are in it.
    The driver holds the vocabulary, at most ``max_features`` rows; applying the model moves no data.
    """
    if max_features > MOST_FEATURES:
        raise ValueError(f"a model holds at most {MOST_FEATURES} terms; use joined_tfidf")
    words = with_terms(df, text, 1, 1)
    counts = frequent_counts(words, high, max_features) if low <= 1 < high else None
    if counts is None:
        counts = corpus_counts(words, with_total=True, low=low, high=high)
    total_first = (F.col("term") != "").asc()
    best = counts.orderBy(total_first, F.desc("cf"), F.asc("term")).limit(max_features + 1)
    found = best.collect()
    if len(found) < 2:
        raise ValueError("empty vocabulary: the texts hold no terms")
    total, *terms = found
    rows = [
        {"term": r["term"], "cf": r["cf"], "df": r["df"], "idx": i}
        for i, r in enumerate(sorted(terms, key=lambda r: r["term"]))
    ]
    return tfidf_model(rows, total["df"], text, output, low, high), rows


def vocabulary_table(df: DataFrame, rows: list) -> DataFrame:
    """The collected vocabulary as a DataFrame again, ``idx`` as in the vectors."""
    return df.sparkSession.createDataFrame(
        [(r["idx"], r["term"], r["cf"], r["df"]) for r in rows],
        "idx int, term string, cf long, df long",
    )


def sparse_entries(df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """Long form of a sparse vector column: ``keep, idx, value``. No shuffle."""
    parts = F.unwrap_udt(F.col(vector))
    rows = df.select(*keep, parts.alias("_v"))
    pairs = F.arrays_zip(F.col("_v.indices").alias("idx"), F.col("_v.values").alias("value"))
    entries = rows.select(*keep, F.inline_outer(pairs).alias("idx", "value"))
    return entries.where(F.col("idx").isNotNull())


def tfidf_entries(
    df: DataFrame, model: PipelineModel, vocabulary_rows: list, keep: list[str], output: str = "tfidf"
) -> DataFrame:
    """``keep, term, tfidf`` for each term of a text that is in the vocabulary."""
    names = vocabulary_table(df, vocabulary_rows).select("idx", "term")
    entries = sparse_entries(model.transform(df), output, keep)
    named = entries.join(names, "idx")
    return named.select(*keep, "term", F.col("value").alias("tfidf"))


def joined_tfidf(
    df: DataFrame,
    keep: list[str],
    text: str = "text",
    low: int = 1,
    high: int = 2,
    max_features: int | None = None,
    fit: DataFrame | None = None,
) -> DataFrame:
    """``keep, term, tfidf`` for a vocabulary of any size, without a model.

    The vocabulary (all terms of ``fit``, by default of ``df``, or its ``max_features`` most
    frequent) stays a table that the terms of the texts are joined with. ``keep`` tells
    texts apart.
    """
    if fit is None and max_features is None:
        return _block_tfidf(with_terms(df, text, 1, 1).select(*keep, "terms"), keep, low, high)
    fit = df if fit is None else fit
    counts = corpus_counts(with_terms(fit, text, 1, 1), low=low, high=high)
    terms = counts if max_features is None else top_terms(counts, max_features)
    documents = fit.agg(F.count("*").alias("n")).scalar()
    weights = terms.select("term", idf(documents, F.col("df")).alias("idf"))
    counted = unnest_structs(
        with_terms(df, text, low, high), tx.term_frequencies(F.col("terms")), keep, "term"
    )
    weighted = counted.join(weights, "term").withColumn("x", F.col("n") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(*keep)))
    return weighted.select(*keep, "term", (F.col("x") / norm).alias("tfidf"))


def _block_tfidf(words: DataFrame, keep: list[str], low: int, high: int, block_words: int = grams.PART_WORDS) -> DataFrame:
    """``keep, term, tfidf`` of all n-grams of ``words`` (``keep, terms``), by blocks of texts.

    A block sends each of its terms once, and gets back a number for those that other blocks
    hold too; so neither terms nor weights are moved for every text that holds them.
    """
    texts, total = words.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(1, -(-total // block_words))
    joined = F.array_join("terms", " ").alias("terms")
    dealt = words.select(F.pmod(F.xxhash64(*keep), F.lit(blocks)).alias("_block"), *keep, joined)
    asked = dealt.groupBy("_block").applyInArrow(
        grams.asked_task(max(low, 1), high, blocks),
        "_bucket long, _block long, words int, names string, texts array<int>",
    )
    answers = asked.groupBy("_bucket").applyInArrow(
        grams.answers_task, "_of long, bucket long, words int, places array<int>, texts array<int>"
    )
    schema = T.StructType(
        [*words.select(*keep).schema.fields, T.StructField("term", T.StringType()), T.StructField("tfidf", T.DoubleType())]
    )
    together = dealt.groupBy("_block").cogroup(answers.groupBy("_of"))
    return together.applyInArrow(grams.tfidf_task(keep, max(low, 1), high, blocks, texts), schema)


def class_term_gaps(
    df: DataFrame, model: PipelineModel, vocabulary_rows: list, author: str, output: str = "tfidf"
) -> DataFrame:
    """``author, term, gap``: mean TF-IDF of the author's texts minus that of the others."""
    entries = sparse_entries(model.transform(df), output, [author])
    sums = entries.groupBy(author, "idx").agg(F.sum("value").alias("s"))
    sizes = df.groupBy(author).agg(F.count("*").alias("n"))
    documents = sizes.agg(F.sum("n").alias("n")).scalar()
    # one row per author and term by now, so a term's window holds a row per author
    rest = F.sum("s").over(Window.partitionBy("idx")) - F.col("s")
    names = vocabulary_table(df, vocabulary_rows).select("idx", "term")
    gap = F.col("s") / F.col("n") - F.coalesce(
        F.try_divide(F.col("rest"), documents - F.col("n")), F.lit(0.0)
    )
    return (
        sums.withColumn("rest", rest)
        .join(sizes, author)
        .join(names, "idx")
        .select(author, "term", gap.alias("gap"))
    )
