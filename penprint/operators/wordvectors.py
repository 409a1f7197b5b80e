"""Word vectors: lookups, unknown words, pooled text vectors.

Words are counted inside each text first, so a join with the vectors moves one row per
text and word. Joins are left to Spark: it copies a vector table that it has measured to
be small, and otherwise splits the rows of a word that most texts hold. For weighted means
the words that most texts hold are sent to the tasks, a bounded number of them, and added up
where a text is read; the other words go by blocks of texts: a block gets the vector of each
of its words once, so vectors are not moved for every text that holds the word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penprint.functions import text as tx
from penprint.operators import grams
from penprint.operators.rows import unnest_structs
from penprint.operators.vocabulary import corpus_counts, idf
from penprint.session import staged

# texts and words of a block, as pairs of them, and pairs whose vectors a task adds up at once
BLOCK_PAIRS = 2_000_000
_PAIRS_AT_ONCE = 1 << 17
# words whose vectors are sent to the tasks, and what these vectors may take
FREQUENT_WORDS, FREQUENT_BYTES = 1 << 17, 1 << 25


def plain_mean(value: Column, weight: Column) -> Column:
    """Mean over distinct words, however often they occur."""
    return F.avg(value)


def word_counts(df: DataFrame, words: str, keep: list[str]) -> DataFrame:
    """``keep, word, n``: the distinct words of each text with their occurrences."""
    counted = unnest_structs(df, tx.term_frequencies(F.col(words)), keep, "term")
    return counted.withColumnRenamed("term", "word")


def known_counts(df: DataFrame, words: str, vectors: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, word, n, vec`` of the words that have a vector."""
    return word_counts(df, words, keep).join(vectors, "word")


def unknown_counts(df: DataFrame, words: str, vectors: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, word, n`` of the words without a vector."""
    counted = word_counts(df, words, keep)
    return counted.join(vectors.select("word"), "word", "left_anti").select(*keep, "word", "n")


def unknown_occurrences(df: DataFrame, words: str, vectors: DataFrame, keep: list[str]) -> DataFrame:
    """Occurrences without a vector: ``keep, word``, repeats included."""
    unknown = unknown_counts(df, words, vectors, keep)
    return unknown.select(*keep, F.explode(F.array_repeat("word", F.col("n").cast("int"))).alias("word"))


def _sought_counts(df: DataFrame, words: str, vectors: DataFrame, low: int, high: int) -> DataFrame:
    """``term, cf`` of the n-grams that may have a vector, by parts of the texts; all others are counted without a term."""
    phrases = vectors.where(F.contains("word", F.lit(" "))).select(F.split("word", " ").alias("words"))
    marked = np.zeros(grams.SLOTS, bool)
    marked[[r["slot"] for r in phrases.mapInArrow(grams.phrase_slots(high), "slot long").distinct().collect()]] = True
    sent = df.sparkSession.sparkContext.broadcast(marked)
    return df.select(words).mapInArrow(grams.sought_task(low, high, sent), "term string, cf long")


def unknown_word_rate(df: DataFrame, words: str, vectors: DataFrame, low: int = 1, high: int = 1) -> DataFrame:
    """One row: unknown occurrences and their mean per text.

    N-grams of ``low`` to ``high`` words should be made here, of ``words`` without blanks: tasks count them by parts of
    the texts, and only those that may have a vector are looked up by their text.
    """
    if (low, high) == (1, 1):
        unknown = unknown_counts(df, words, vectors, [])
    else:
        counted = _sought_counts(df, words, vectors, low, high).withColumnRenamed("cf", "n")
        unknown = counted.join(vectors.select(F.col("word").alias("term")), "term", "left_anti")
    unknown = unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unknown_words"))
    texts = df.agg(F.count("*").alias("n")).scalar()
    return unknown.select(
        "unknown_words", F.try_divide("unknown_words", texts).alias("unknown_per_text")
    )


def _pooled(known: DataFrame, key: str, dims: int, pool: Callable[[Column, Column], Column]) -> DataFrame:
    """``pool`` of the vectors of a text, for each dimension."""
    columns = [
        pool(F.col("vec")[i].cast("double"), F.col("weight")).alias(f"v{i}") for i in range(dims)
    ]
    pooled = known.groupBy(key).agg(*columns)
    return pooled.select(key, F.array(*[F.col(f"v{i}") for i in range(dims)]).alias("vector"))


def counted_texts(df: DataFrame, words: str, keep: list[str]) -> DataFrame:
    """``keep, pairs``: each text with its distinct words and their occurrences."""
    return df.select(*keep, tx.term_frequencies(F.col(words)).alias("pairs"))


def _values(words: pa.Table, dims: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of ``word, vec, weight``, and what each adds per occurrence: its weight and its weighted vector.

    A word with several vectors adds all of them.
    """
    words = words.combine_chunks()
    gain = words.column("weight").to_numpy().copy()
    vec = words.column("vec").combine_chunks()
    if vec.null_count or vec.flatten().null_count or (np.diff(vec.offsets.to_numpy()) != dims).any():
        raise ValueError(f"a word vector is null, holds a null or has not {dims} values")
    values = vec.flatten().to_numpy().reshape(-1, dims).astype(np.float64) * gain[:, None]
    coded = words.column("word").combine_chunks().dictionary_encode()
    if len(coded.dictionary) < words.num_rows:
        code = coded.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        first = np.flatnonzero(np.diff(code[order], prepend=-1))
        gain, values = (np.add.reduceat(x[order], first) for x in (gain, values))
    return coded.dictionary, gain, values


def _add_up(sums: np.ndarray, totals: np.ndarray, text: np.ndarray, word: np.ndarray, n: np.ndarray, gain, values) -> None:
    """Add what the words of texts give, ordered by text, a bounded number of pairs at a time."""
    for i in range(0, len(text), _PAIRS_AT_ONCE):
        own, at, times = text[i : i + _PAIRS_AT_ONCE], word[i : i + _PAIRS_AT_ONCE], n[i : i + _PAIRS_AT_ONCE]
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        sums[own[heads]] += np.add.reduceat(values[at] * times[:, None], heads)
        totals[own[heads]] += np.add.reduceat(gain[at] * times, heads)


def _frequent_sums(keep: list[str], dims: int, power: int, sent):
    """Task that adds up the frequent words of each text; the others go on as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, place, gain, values = sent.value
        for batch in batches:
            held = batch.column("pairs")
            pairs, row = held.flatten(), pc.list_parent_indices(held).to_numpy()
            term, n = pairs.field("term"), pairs.field("n")
            at = pc.index_in(term, listed).fill_null(-1).to_numpy()
            sums, totals = np.zeros((batch.num_rows, dims)), np.zeros(batch.num_rows)
            known = np.flatnonzero(place[at] >= 0)
            times = n.to_numpy()[known].astype(np.float64) ** power
            _add_up(sums, totals, row[known], place[at[known]], times, gain, values)
            rest = np.flatnonzero(at < 0)
            edges = pa.array(np.searchsorted(row[rest], np.arange(batch.num_rows + 1)), pa.int32())
            ends = pa.array(np.arange(batch.num_rows + 1) * dims, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in keep],
                    pa.ListArray.from_arrays(ends, pa.array(sums.ravel())),
                    pa.array(totals),
                    pa.ListArray.from_arrays(edges, term.take(pa.array(rest))),
                    pa.ListArray.from_arrays(edges, n.take(pa.array(rest))),
                ],
                [*keep, "_sums", "_total", "_words", "_n"],
            )

    return run


def _common_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that several texts of a part hold, and their number."""
    for lists in grams.parts(batches):
        if len(lists):
            found = pc.value_counts(lists.flatten().drop_null())
            common = found.filter(pc.greater(found.field("counts"), 1))
            yield pa.RecordBatch.from_arrays([common.field("values").cast(pa.string()), common.field("counts")], ["word", "n"])


def _frequent_words(counted: DataFrame, vectors: DataFrame, weights: DataFrame | None, dims: int, most: int) -> tuple:
    """Words that many texts hold, the place of the vector of each or -1, and weights and weighted vectors.

    Which words these are changes no result, so those that a part of the texts holds once are left out.
    """
    spark = counted.sparkSession
    common = counted.select(F.transform("pairs", lambda p: p["term"]).alias("words")).mapInArrow(_common_words, "word string, n long")
    best = common.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    listed = best.select("word").toArrow()
    # a bounded list of words
    known = spark.createDataFrame(listed)
    if weights is not None:
        known = spark.createDataFrame(weights.join(F.broadcast(known), "word").toArrow())
    own, gain, values = _values(vectors.join(F.broadcast(known), "word").select("word", "vec", "weight").toArrow(), dims)
    names = listed.column("word").combine_chunks()
    # the last place is that of words that are not among them
    return names, np.append(pc.index_in(names, own).fill_null(-1).to_numpy(), -1), gain, values


def weighted_means(
    counted: DataFrame,
    vectors: DataFrame,
    keep: list[str],
    dims: int,
    by_idf: bool = False,
    block_pairs: int = BLOCK_PAIRS,
    frequent: int | None = None,
    weights: DataFrame | None = None,
) -> DataFrame:
    """``keep, vector`` for each row of ``counted``: the weighted mean of its word vectors, zeros without any.

    The weight of a word is n, its occurrences, or n * n * idf with ``by_idf``. ``counted`` is as from
    :func:`counted_texts`; ``vectors``: ``word, vec`` and, with ``by_idf``, ``idf``, unless ``weights`` has it
    (``word, idf``). Rows that agree in ``keep`` are one text, unless a key is null: it has no words. The vectors of the
    ``frequent`` words that most texts hold are sent to the tasks, by default as many as fit in ``FREQUENT_BYTES``.
    """
    most = min(FREQUENT_WORDS, max(1, FREQUENT_BYTES // (4 * dims))) if frequent is None else frequent
    power = 2 if by_idf else 1
    weight = (F.col("idf").cast("double") if by_idf else F.lit(1.0)).alias("weight")
    if weights is None:
        weighted = vectors.select("word", "vec", weight)
    else:
        weighted, weights = vectors.select("word", "vec"), weights.select("word", weight)
    sent = counted.sparkSession.sparkContext.broadcast(_frequent_words(counted, weighted, weights, dims, most))
    kept = counted.select(*keep).schema
    numbers = T.ArrayType(T.DoubleType())
    added = T.StructType(
        [
            *kept.fields,
            T.StructField("_sums", numbers),
            T.StructField("_total", T.DoubleType()),
            T.StructField("_words", T.ArrayType(T.StringType())),
            T.StructField("_n", T.ArrayType(T.IntegerType())),
        ]
    )
    rows = staged(counted.select(*keep, "pairs").mapInArrow(_frequent_sums(keep, dims, power, sent), added), "word-sums")
    sent.destroy()
    size = rows.agg(F.coalesce(F.sum(F.size("_words") + dims), F.lit(1)).alias("n")).first()["n"]
    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(*keep), F.lit(-(-size // block_pairs))))
    asked = dealt.select("_block", F.explode_outer("_words").alias("word")).where(F.col("word").isNotNull()).distinct()
    # a row per block and word that it has; the texts of a block get them together
    found = asked.join(weighted, "word")
    found = found if weights is None else found.join(weights, "word")
    found = found.select(F.col("_block").alias("_of"), "word", "vec", "weight")
    schema = T.StructType([*kept.fields, T.StructField("vector", numbers)])
    together = dealt.select("_block", *added.names).groupBy("_block").cogroup(found.groupBy("_of"))
    return together.applyInArrow(_block_means(keep, dims, power), schema)


def _block_means(keep: list[str], dims: int, power: int):
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        texts, words = texts.combine_chunks(), words.combine_chunks()
        # rows that agree in all keys are one text; those with a null among them have no words
        text, valid = np.zeros(texts.num_rows, np.int64), np.ones(texts.num_rows, bool)
        for name in keep:
            codes = texts.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            valid &= texts.column(name).is_valid().to_numpy(zero_copy_only=False)
            text = np.unique(text * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1].reshape(-1)
        count = int(text.max(initial=-1)) + 1
        totals, sums = np.zeros(count), np.zeros((count, dims))
        np.add.at(totals, text, texts.column("_total").to_numpy())
        np.add.at(sums, text, texts.column("_sums").combine_chunks().flatten().to_numpy().reshape(-1, dims))
        if texts.num_rows and words.num_rows:
            names, gain, values = _values(words, dims)
            held = texts.column("_words").combine_chunks()
            at = pc.index_in(held.flatten(), names).fill_null(-1).to_numpy()
            row = pc.list_parent_indices(held).to_numpy()
            n = texts.column("_n").combine_chunks().flatten().to_numpy().astype(np.float64) ** power
            known = np.flatnonzero((at >= 0) & valid[row])
            known = known[np.argsort(text[row[known]], kind="stable")]
            _add_up(sums, totals, text[row[known]], at[known], n[known], gain, values)
        means = np.divide(sums, totals[:, None], out=np.zeros_like(sums), where=totals[:, None] != 0)
        means = means[text]
        means[~valid] = 0
        offsets = pa.array(np.arange(texts.num_rows + 1) * dims, pa.int32())
        vector = pa.ListArray.from_arrays(offsets, pa.array(means.ravel()))
        return pa.Table.from_arrays([*[texts.column(k) for k in keep], vector], [*keep, "vector"])

    return run


def _with_zero_rows(df: DataFrame, pooled: DataFrame, key: str, dims: int) -> DataFrame:
    zeros = F.array(*[F.lit(0.0)] * dims)
    return df.select(key).join(pooled, key, "left").select(
        key, F.coalesce("vector", zeros).alias("vector")
    )


def mean_vectors(
    df: DataFrame,
    words: str,
    vectors: DataFrame,
    key: str,
    dims: int,
    pool: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """``key, vector``: the mean word vector of each text, zeros when no word is known.

    ``key`` tells texts apart. ``pool`` combines the values of one dimension in another
    way; it gets value and weight, here the number of occurrences of the word.
    """
    if pool is None:
        return weighted_means(counted_texts(df, words, [key]), vectors.select("word", "vec"), [key], dims)
    known = known_counts(df, words, vectors, [key]).withColumnRenamed("n", "weight")
    return _with_zero_rows(df, _pooled(known, key, dims, pool), key, dims)


def word_weights(df: DataFrame, words: str, documents: Column) -> DataFrame:
    """``word, idf`` over the single words of all texts."""
    return corpus_counts(df, words).select(
        F.col("term").alias("word"), idf(documents, F.col("df")).alias("idf")
    )


def weighted_vectors(
    df: DataFrame,
    words: str,
    vectors: DataFrame,
    key: str,
    dims: int,
    pool: Callable[[Column, Column], Column] | None = None,
    fit: DataFrame | None = None,
) -> DataFrame:
    """``key, vector``: word vectors weighted by TF-IDF, per occurrence.

    The weight of a word in a text is n * idf, and each of its n occurrences
    counts, which gives n * n * idf per distinct word. The norm of the TF-IDF
    row cancels out in the mean. The idf comes from the texts of ``fit``, by
    default all; words that these do not hold have no weight.
    """
    fit = df if fit is None else fit
    weights = word_weights(fit, words, fit.agg(F.count("*").alias("n")).scalar())
    weights = staged(weights, "word-weights")
    if pool is None:
        return weighted_means(counted_texts(df, words, [key]), vectors, [key], dims, by_idf=True, weights=weights)
    known = word_counts(df, words, [key]).join(vectors.join(weights, "word"), "word")
    weighted = known.withColumn("weight", F.col("n") * F.col("n") * F.col("idf"))
    return _with_zero_rows(df, _pooled(weighted, key, dims, pool), key, dims)


def remove_words(df: DataFrame, text: str, word_list: DataFrame, key: str) -> DataFrame:
    """``key, text``: the terms of each text without the listed words, in order.

    ``key`` tells texts apart; ``word_list`` has one distinct ``word`` per row. A text gives
    one row per distinct term with the places where it stands; the rows of listed words go,
    and the others are put back in the order of their places. The work grows with the
    number of terms, whatever the number of listed words.
    """
    terms = df.select(F.col(key).alias("_key"), tx.terms(F.col(text)).alias("_terms"))
    # a row without a word keeps texts that lose all of them
    own = F.array(F.struct(F.lit(None).cast("string").alias("word"), F.array().cast("array<int>").alias("places")))
    placed = terms.select("_key", F.inline(F.concat(own, tx.term_places(F.col("_terms")))))
    kept = placed.join(word_list.select("word"), "word", "left_anti")
    at = F.transform("places", lambda i: F.struct(i.alias("i"), F.col("word").alias("word")))
    ordered = F.sort_array(F.flatten(F.collect_list("at")))
    rows = kept.select("_key", at.alias("at")).groupBy("_key").agg(ordered.alias("_kept"))
    return rows.select(
        F.col("_key").alias(key), F.array_join(F.transform("_kept", lambda t: t["word"]), " ").alias("text")
    )


def encode_fixed_length(
    df: DataFrame, words: str, vocabulary: DataFrame, key: str, max_length: int = 128
) -> DataFrame:
    """``key, input_ids, attention_mask``: word numbers cut or padded to ``max_length``.

    0 is padding and 1 an unknown word; ``vocabulary`` has ``term`` and ``idx``.
    """
    numbers = vocabulary.select(F.col("term").alias("word"), (F.col("idx") + 2).alias("number"))
    first = df.select(key, F.slice(words, 1, max_length).alias("_w"))
    rows = first.select(key, F.posexplode_outer("_w").alias("pos", "word"))
    found = rows.join(numbers, "word", "left")
    number = F.coalesce(F.col("number").cast("int"), F.lit(1))
    pairs = F.array_sort(
        F.collect_list(F.when(F.col("word").isNotNull(), F.struct("pos", number.alias("number"))))
    )
    encoded = found.groupBy(key).agg(F.transform(pairs, lambda p: p["number"]).alias("_ids"))
    pad = F.lit(max_length) - F.size("_ids")
    return encoded.select(
        key,
        F.concat("_ids", F.array_repeat(F.lit(0), pad)).alias("input_ids"),
        F.concat(
            F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), pad)
        ).alias("attention_mask"),
    )
