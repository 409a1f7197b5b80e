"""Sources and sinks: tables written to the shared folder and read back by the readers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sqltext as q
from checks.corpus import CATALOG, DATASET, dataset_build, raw_catalog
from checks.evaluation import GAUSSIAN, gaussian_nb, metrics_table
from checks.features import DIMS, doc_words, long_vectors, tfidf_features, word_vectors
from checks.registry import check, table
from penprint.functions import text as tx
from penprint.operators import catalog
from penprint.operators import vocabulary as vo
from penprint.operators import wordvectors as wv
from penprint.session import new_path
from penprint.sources import readers, writers


def documents(spark, sf):
    return table(spark, sf, "documents")


@check("""
SELECT c_name || ' "' || c_mktsegment || '"' AS author, c_mktsegment || ', part ' || CAST(c_nationkey AS VARCHAR) AS title,
  'file:/' || CAST(c_custkey AS VARCHAR) AS url FROM customer""")
def sources_csv(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.format_string('%s "%s"', "c_name", "c_mktsegment").alias("author"),
        F.format_string("%s, part %d", "c_mktsegment", "c_nationkey").alias("title"),
        F.concat(F.lit("file:/"), F.col("c_custkey").cast("string")).alias("url"),
    )
    path = new_path(spark, "sources")
    writers.write_catalog(rows, path)
    return readers.read_sources(spark, path)


@check(f"WITH {CATALOG} SELECT * FROM filtered")
def catalog_csv(spark, sf):
    rows = raw_catalog(spark, sf).select(
        "id",
        "title",
        "author",
        F.lit(1800.0).alias("authoryearofbirth"),
        F.lit(None).cast("double").alias("authoryearofdeath"),
        "language",
        F.lit(5).alias("downloads"),
        F.lit("{'Fiction', 'Crime'}").alias("subjects"),
        "type",
    )
    path = new_path(spark, "catalog")
    writers.write_catalog(rows, path)
    return catalog.filter_catalog(readers.read_catalog(spark, path)).select(
        "title", "author", "pg_code"
    )


@check(r"""
SELECT CAST(doc_id AS INTEGER) AS pg_code, len(w) AS n_tokens, array_to_string(w, ' ') AS tokens
FROM (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents)""")
def token_files(spark, sf):
    """One file per document, one token per line."""
    rows = documents(spark, sf).select(
        F.concat(F.lit("PG"), F.col("doc_id").cast("string"), F.lit("_tokens")).alias("name"),
        F.array_join(tx.space_words(F.col("text")), "\n").alias("value"),
    )
    path = new_path(spark, "tokens")
    writers.write_texts(rows, path)
    return readers.read_token_files(spark, path).select(
        "pg_code",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.array_join("tokens", " ").alias("tokens"),
    )


@check(f"""WITH {q.VECTORS}
SELECT word, round(CAST(vec[1] AS DOUBLE), 6) AS first_value, round(CAST(vec[64] AS DOUBLE), 6) AS last_value FROM vectors""")
def word_vector_file(spark, sf):
    """Vectors as text lines, with a malformed copy of each line that must be skipped."""
    vectors = word_vectors(spark, sf)
    numbers = F.transform("vec", lambda x: x.cast("string"))
    lines = vectors.select(
        F.explode(
            F.array(
                F.concat_ws(" ", "word", F.array_join(numbers, " ")),
                F.concat_ws(" ", "word", F.lit("x"), F.array_join(F.slice(numbers, 2, 63), " ")),
                F.concat_ws(" ", "word", F.array_join(F.slice(numbers, 1, 10), " ")),
            )
        ).alias("value")
    )
    path = new_path(spark, "vectors")
    lines.write.text(path)
    read = readers.read_word_vectors(spark, path, 64)
    return read.select(
        "word",
        F.round(F.col("vec")[0].cast("double"), 6).alias("first_value"),
        F.round(F.col("vec")[63].cast("double"), 6).alias("last_value"),
    )


@check("""
SELECT 'author=' || source AS author, 'book=' || CAST(doc_id % 50 AS VARCHAR) AS book, CAST(doc_id AS INTEGER) AS chapter_num, text
FROM documents WHERE lang <> 'de'""")
def chapter_files(spark, sf):
    """Chapter tables per author and book as CSV; rows with an empty text drop out."""
    rows = documents(spark, sf).select(
        F.lit(0).alias("section_num"),
        F.col("doc_id").cast("int").alias("chapter_num"),
        F.lit('A "name", quoted').alias("name"),
        F.when(F.col("lang") != "de", F.col("text")).otherwise("").alias("text"),
        F.lit(1).alias("wc"),
        F.col("source").alias("author"),
        (F.col("doc_id") % 50).alias("book"),
    )
    path = new_path(spark, "chapters")
    rows.repartition("author", "book").write.partitionBy("author", "book").option(
        "header", True
    ).option("escape", '"').csv(path)
    return readers.read_chapter_files(spark, path).select("author", "book", "chapter_num", "text")


@check(f"""WITH words AS (SELECT {q.terms()} AS w FROM documents)
SELECT DISTINCT term AS word FROM (SELECT unnest(w) AS term FROM words)""")
def word_list_file(spark, sf):
    path = new_path(spark, "words")
    terms = vo.corpus_counts(vo.with_terms(documents(spark, sf), "text", 1, 1))
    writers.write_word_list(terms.select(F.concat(F.lit("  "), "term", F.lit(" ")).alias("word")), path)
    return readers.read_word_list(spark, path)


@check("SELECT doc_id, lang, source, text FROM documents")
def texts_table(spark, sf):
    """Parquet by author and book, read back by the declared schema."""
    path = new_path(spark, "texts")
    rows = documents(spark, sf).select("doc_id", "lang", "source", "text")
    writers.write_chapters(
        rows.withColumnRenamed("lang", "author").withColumnRenamed("source", "book"), path
    )
    read = spark.read.schema("doc_id long, text string, author string, book string").parquet(path)
    return read.select("doc_id", F.col("author").alias("lang"), F.col("book").alias("source"), "text")


@check(f"WITH {DATASET} SELECT author_id, book_id, CAST(chunk AS INTEGER) AS chunk, text FROM dataset")
def dataset_sink(spark, sf):
    """The chunk dataset, written and read by its declared schema."""
    path = new_path(spark, "dataset")
    writers.write_table(dataset_build(spark, sf).withColumn("chunk", F.col("chunk").cast("int")), path)
    return readers.read_dataset(spark, path)


@check(f"WITH {q.TFIDF} SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf")
def features_sink(spark, sf):
    path = new_path(spark, "features")
    writers.write_table(tfidf_features(spark, sf), path)
    return spark.read.schema("doc_id long, term string, tfidf double").parquet(path)


@check(f"WITH {q.DOC_TERMS} SELECT term FROM vocab")
def vocabulary_sink(spark, sf):
    path = new_path(spark, "vocabulary")
    writers.write_vocabulary(vo.vocabulary(vo.with_terms(documents(spark, sf), "text", 1, 2)), path)
    return spark.read.text(path).select(F.col("value").alias("term"))


@check(f"WITH {q.MEANS} SELECT doc_id, dim, round(value, 6) + 0.0 AS value FROM means")
def vectors_sink(spark, sf):
    path = new_path(spark, "vectors")
    pooled = wv.mean_vectors(doc_words(spark, sf), "words", word_vectors(spark, sf), "doc_id", DIMS)
    writers.write_table(pooled, path)
    return long_vectors(readers.read_vectors(spark, path, "doc_id", T.LongType()))


@check(f"""WITH {GAUSSIAN}
SELECT 'gaussian' AS model, 'glove' AS embedding_type, 'true' AS multiclass,
  round(sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) / count(*), 6) AS accuracy, 2::BIGINT AS n FROM predicted""")
def metrics_sink(spark, sf):
    """A fresh metrics table, and one more row added to it."""
    path = new_path(spark, "metrics")
    row = metrics_table(spark, sf)
    writers.append_metrics(row.unionAll(row), path, fresh=True)
    writers.append_metrics(row, path, fresh=True)
    writers.append_metrics(row, path)
    read = spark.read.option("header", True).csv(path)
    return read.groupBy("model", "embedding_type", "multiclass").agg(
        F.max(F.col("accuracy").cast("double")).alias("accuracy"), F.count("*").alias("n")
    )


@check("""
SELECT run, lang, count(*) AS texts, max(n_chars) AS longest FROM documents, (VALUES ('first'), ('second')) r(run)
GROUP BY run, lang""")
def metrics_rerun(spark, sf):
    """Two runs; the first is written again, with its rows in other files, and stays one copy."""
    path = new_path(spark, "metrics")
    rows = documents(spark, sf).groupBy("lang").agg(F.count("*").alias("texts"), F.max("n_chars").alias("longest"))
    writers.write_metrics(rows.where("lang = 'en'"), path, "first")
    writers.write_metrics(rows, path, "second")
    writers.write_metrics(rows.repartition(3), path, "first")
    read = spark.read.schema("lang string, texts long, longest long, run_id string").option("header", True).csv(path)
    return read.select(F.col("run_id").alias("run"), "lang", "texts", "longest")


@check(f"""WITH {GAUSSIAN} SELECT doc_id, label, prediction FROM predicted""")
def predictions_sink(spark, sf):
    path = new_path(spark, "predictions")
    writers.write_predictions(gaussian_nb(spark, sf).select("doc_id", "label", "prediction"), path)
    return spark.read.schema("doc_id long, label int, prediction int").option("header", True).csv(path)


@check("SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def existing_sink(spark, sf):
    """An output that is there is not written again."""
    path = new_path(spark, "existing")
    rows = documents(spark, sf).select("doc_id", "lang")
    writers.write_table(rows.where("lang = 'en'"), path, mode="ignore")
    writers.write_table(rows, path, mode="ignore")
    return spark.read.schema("doc_id long, lang string").parquet(path)


@check(r"SELECT regexp_replace(text, '\s+', ' ', 'g') AS line, count(*) AS n FROM documents GROUP BY line")
def corpus_sink(spark, sf):
    """The running corpus: one line per text."""
    path = new_path(spark, "corpus")
    writers.write_corpus(documents(spark, sf), path)
    lines = spark.read.text(path).groupBy(F.col("value").alias("line"))
    return lines.agg(F.count("*").alias("n"))


@check("""SELECT CAST(doc_id AS VARCHAR) AS name, text FROM documents WHERE text <> ''""")
def texts_folder(spark, sf):
    """A folder with a file per text, as it is read for scoring."""
    path = new_path(spark, "folder")
    rows = documents(spark, sf).where("text <> ''").select(F.col("doc_id").alias("name"), F.col("text").alias("value"))
    writers.write_texts(rows, path)
    read = readers.read_texts(spark, path)
    return read.select(
        # the name of the file, or of its folder
        F.regexp_extract("file_path", r"/(?:name=)?([0-9]+)(?:\.txt|/[^/]*)$", 1).alias("name"),
        # the writer ends the line
        F.substring("text", F.lit(1), F.length("text") - 1).alias("text"),
    )
