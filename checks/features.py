"""Vocabulary, TF-IDF and word vectors."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import sqltext as q
from checks.registry import check, fixture, table
from penprint.functions import keys
from penprint.functions import text as tx
from penprint.operators import vocabulary as vo
from penprint.operators import wordvectors as wv
from penprint.operators.rows import unnest
from penprint.session import staged

DIMS = 64


def documents(spark, sf):
    return table(spark, sf, "documents")


def doc_words(spark, sf):
    return documents(spark, sf).select("doc_id", "lang", tx.terms(F.col("text")).alias("words"))


@fixture
def word_vectors(spark, sf):
    """A vector table: each term points to an embedding by its hash, about half of them hit one."""
    embeddings = table(spark, sf, "embeddings")
    slots = embeddings.agg((2 * F.count("*")).alias("n")).scalar()
    words = unnest(doc_words(spark, sf), F.col("words"), [], "word").distinct()
    placed = words.withColumn("vec_id", keys.hash_bucket(F.col("word"), slots))
    return placed.join(embeddings, "vec_id").select("word", F.col("embedding").alias("vec"))


def long_vectors(df):
    rows = unnest(df, F.col("vector"), ["doc_id"], "value", "dim")
    return rows.select(
        "doc_id", F.col("dim").cast("long").alias("dim"), (F.round("value", 6) + 0.0).alias("value")
    )


@check(f"WITH {q.DOC_TERMS} SELECT term, cf, df FROM vocab")
def vocabulary_topk(spark, sf):
    return vo.top_terms(vo.corpus_counts(vo.with_terms(documents(spark, sf), "text", 1, 2)))


@check(f"WITH {q.DOC_TERMS} SELECT term, idx FROM vocab")
def vocabulary_index(spark, sf):
    return vo.vocabulary(vo.with_terms(documents(spark, sf), "text", 1, 2)).select("term", "idx")


@check(f"""WITH words AS (SELECT doc_id, {q.terms()} AS w FROM documents)
SELECT term, count(*) AS cf, count(DISTINCT doc_id) AS df, row_number() OVER (ORDER BY term) - 1 AS idx
FROM (SELECT doc_id, unnest(w) AS term FROM words) GROUP BY term""")
def vocabulary_all(spark, sf):
    return vo.vocabulary(
        vo.with_terms(documents(spark, sf), "text", 1, 1), max_features=None
    ).select("term", "cf", "df", "idx")


@check(f"WITH {q.TFIDF} SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf")
def tfidf_features(spark, sf):
    docs = documents(spark, sf)
    model, rows = vo.fit_tfidf(docs)
    entries = vo.tfidf_entries(docs, model, rows, ["doc_id"])
    return entries.withColumn("tfidf", F.round("tfidf", 6))


@check(f"""
WITH words AS (SELECT doc_id, lang, {q.terms()} AS w FROM documents),
doc_terms AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(w) AS term FROM words UNION ALL SELECT doc_id, unnest({q.grams('w', 2)}) FROM words
    UNION ALL SELECT doc_id, unnest({q.grams('w', 3)}) FROM words) GROUP BY ALL),
counts AS (SELECT term, count(*) AS df FROM doc_terms GROUP BY term),
weighted AS (
  SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS x
  FROM doc_terms JOIN counts USING (term)),
scaled AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS tfidf FROM weighted)
SELECT doc_id, count(*) AS terms, round(max(tfidf), 6) AS largest, round(sum(tfidf), 5) AS total FROM scaled GROUP BY doc_id""")
def tfidf_all_terms(spark, sf):
    """TF-IDF over all terms of one to three words, without a model."""
    entries = vo.joined_tfidf(documents(spark, sf), ["doc_id"], low=1, high=3)
    return entries.groupBy("doc_id").agg(
        F.count("*").alias("terms"),
        F.round(F.max("tfidf"), 6).alias("largest"),
        F.round(F.sum("tfidf"), 5).alias("total"),
    )


@check(f"""
WITH {q.DOC_TERMS},
size AS (SELECT count(*) AS n FROM documents),
bwords AS (SELECT item_id, {q.terms()} AS w FROM benchmark),
bterms AS (
  SELECT item_id, term, count(*) AS tf FROM (
    SELECT item_id, unnest(w) AS term FROM bwords UNION ALL SELECT item_id, unnest({q.grams('w', 2)}) FROM bwords)
  GROUP BY ALL),
weighted AS (SELECT item_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS x FROM bterms JOIN vocab USING (term), size)
SELECT item_id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY item_id)), 6) AS tfidf FROM weighted""")
def tfidf_transform(spark, sf):
    model, rows = vo.fit_tfidf(documents(spark, sf))
    entries = vo.tfidf_entries(table(spark, sf, "benchmark"), model, rows, ["item_id"])
    return entries.withColumn("tfidf", F.round("tfidf", 6))


@check(f"""
WITH {q.TFIDF},
sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
sums AS (SELECT lang, term, sum(tfidf) AS s FROM tfidf GROUP BY lang, term),
overall AS (SELECT term, sum(s) AS all_s FROM sums GROUP BY term),
gaps AS (
  SELECT lang, term, round(s / n - coalesce((all_s - s) / nullif((SELECT count(*) FROM documents) - n, 0), 0), 9) AS gap
  FROM sums JOIN overall USING (term) JOIN sizes USING (lang)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY gap DESC, term) AS rank FROM gaps)
SELECT lang, rank, term, round(gap, 6) AS gap FROM ranked WHERE rank <= 20""")
def top_terms_by_author(spark, sf):
    docs = documents(spark, sf)
    model, rows = vo.fit_tfidf(docs)
    gaps = vo.class_term_gaps(docs, model, rows, "lang").withColumn("gap", F.round("gap", 9))
    best = Window.partitionBy("lang").orderBy(F.desc("gap"), F.asc("term"))
    ranked = gaps.withColumn("rank", F.row_number().over(best).cast("long"))
    return ranked.where(F.col("rank") <= 20).select(
        "lang", "rank", "term", F.round("gap", 6).alias("gap")
    )


@check(f"""WITH {q.VECTORS}
SELECT doc_id, word, n, round(CAST(vec[1] AS DOUBLE), 6) AS first_value FROM doc_words JOIN vectors USING (word)""")
def word_vector_join(spark, sf):
    known = wv.known_counts(doc_words(spark, sf), "words", word_vectors(spark, sf), ["doc_id"])
    return known.select(
        "doc_id",
        "word",
        F.col("n").cast("long").alias("n"),
        F.round(F.col("vec")[0].cast("double"), 6).alias("first_value"),
    )


@check(f"""WITH {q.VECTORS}
SELECT word, CAST(sum(n) AS BIGINT) AS n FROM doc_words ANTI JOIN vectors USING (word) GROUP BY word""")
def oov_words(spark, sf):
    unknown = wv.unknown_occurrences(
        doc_words(spark, sf), "words", word_vectors(spark, sf), ["doc_id"]
    )
    return unknown.groupBy("word").agg(F.count("*").alias("n"))


@check(f"""WITH {q.VECTORS}
SELECT CAST(sum(n) AS BIGINT) AS unknown_words, round(sum(n) / (SELECT n FROM size), 6) AS unknown_per_text
FROM doc_words ANTI JOIN vectors USING (word)""")
def oov_rate(spark, sf):
    rate = wv.unknown_word_rate(doc_words(spark, sf), "words", word_vectors(spark, sf))
    return rate.withColumn("unknown_per_text", F.round("unknown_per_text", 6))


@check(f"""WITH {q.VECTORS}
SELECT CAST(u + b AS BIGINT) AS unknown_words, round((u + b) / (SELECT n FROM size), 6) AS unknown_per_text
FROM (SELECT sum(n) AS u FROM doc_words ANTI JOIN vectors USING (word)),
  (SELECT sum(greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0)) AS b FROM words)""")
def oov_rate_ngrams(spark, sf):
    """Pairs and triples never have a vector, so they all count as unknown."""
    rows = vo.with_terms(documents(spark, sf), "text", 1, 1)
    rate = wv.unknown_word_rate(rows, "terms", word_vectors(spark, sf), 1, 3)
    return rate.withColumn("unknown_per_text", F.round("unknown_per_text", 6))


@check(f"WITH {q.MEANS} SELECT doc_id, dim, round(value, 6) + 0.0 AS value FROM means")
def mean_doc_vector(spark, sf):
    return long_vectors(
        wv.mean_vectors(doc_words(spark, sf), "words", word_vectors(spark, sf), "doc_id", DIMS)
    )


@check(f"""WITH {q.VECTORS},
best AS (SELECT doc_id, dim, max(CAST(vec[dim + 1] AS DOUBLE)) AS value FROM doc_words JOIN vectors USING (word), dims GROUP BY ALL)
SELECT doc_id, dim, round(coalesce(value, 0), 6) + 0.0 AS value
FROM (SELECT doc_id, dim FROM documents, dims) LEFT JOIN best USING (doc_id, dim)""")
def max_doc_vector(spark, sf):
    rows = wv.mean_vectors(
        doc_words(spark, sf),
        "words",
        word_vectors(spark, sf),
        "doc_id",
        DIMS,
        pool=lambda value, weight: F.max(value),
    )
    return long_vectors(rows)


def _weighted_sql(fitted: str) -> str:
    """Vectors weighted by the idf of the texts in ``fitted``."""
    return f"""WITH {q.VECTORS},
fitted AS (SELECT * FROM doc_words WHERE {fitted}),
weights AS (
  SELECT word, ln((1 + (SELECT count(*) FROM documents WHERE {fitted})) / (1 + count(*))) + 1 AS idf FROM fitted GROUP BY word),
sums AS (
  SELECT doc_id, dim, sum(n * n * idf * CAST(vec[dim + 1] AS DOUBLE)) / sum(n * n * idf) AS value
  FROM doc_words JOIN vectors USING (word) JOIN weights USING (word), dims GROUP BY doc_id, dim)
SELECT doc_id, dim, round(coalesce(value, 0), 6) + 0.0 AS value
FROM (SELECT doc_id, dim FROM documents, dims) LEFT JOIN sums USING (doc_id, dim)"""


@check(_weighted_sql("true"))
def weighted_doc_vector(spark, sf):
    return long_vectors(
        wv.weighted_vectors(doc_words(spark, sf), "words", word_vectors(spark, sf), "doc_id", DIMS)
    )


@check(_weighted_sql(f"{q.bucket('doc_id', '100')} < 80"))
def weighted_doc_vector_train(spark, sf):
    """The idf comes from the training rows alone."""
    words = doc_words(spark, sf)
    train = words.where(keys.is_train_row(F.col("doc_id")))
    return long_vectors(
        wv.weighted_vectors(words, "words", word_vectors(spark, sf), "doc_id", DIMS, fit=train)
    )


@check(f"""WITH {q.VECTORS},
known AS (SELECT doc_id, word, i FROM (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM words) SEMI JOIN vectors USING (word)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM known GROUP BY doc_id)
SELECT doc_id, coalesce(text, '') AS text FROM documents LEFT JOIN kept USING (doc_id)""".replace(
    "coalesce(text, '')", "coalesce(kept.text, '')"
))
def remove_oov(spark, sf):
    vectors = word_vectors(spark, sf)
    unknown = (
        wv.unknown_counts(doc_words(spark, sf), "words", vectors, [])
        .select("word")
        .distinct()
    )
    return wv.remove_words(documents(spark, sf), "text", staged(unknown, "unknown"), "doc_id")
