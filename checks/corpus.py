"""Catalogue, corpus reports, splits and plain joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as q
from checks.registry import check, table
from penprint.functions import keys
from penprint.functions import text as tx
from penprint.operators import catalog, reports, split
from penprint.operators.rows import with_labels
from penprint.session import staged

AUTHOR_NAMES = {"src0": "Source Zero", "src1": "Source One"}


def documents(spark, sf):
    return table(spark, sf, "documents")


WC = f"len(list_filter(string_split(text, ' '), lambda x: {q.strip_ends('x')} <> ''))"


def _book_words(spark, sf):
    rows = documents(spark, sf).withColumn("wc", tx.naive_word_count(F.col("text")))
    return reports.word_counts(rows, "source", "doc_id")


@check(f"SELECT source, doc_id, CAST(sum({WC}) AS BIGINT) AS wc FROM documents GROUP BY source, doc_id")
def token_count_by_author(spark, sf):
    return _book_words(spark, sf)


@check(f"""
WITH books AS (SELECT source, doc_id, sum({WC}) AS wc FROM documents GROUP BY source, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM books)
SELECT CASE source WHEN 'src0' THEN 'Source Zero' WHEN 'src1' THEN 'Source One' ELSE source END AS source,
  {", ".join(f"CAST(sum(CASE WHEN rank = {i} THEN wc END) AS BIGINT) AS book_{i}" for i in range(1, 5))},
  CAST(sum(wc) AS BIGINT) AS total_wc,
  CASE source WHEN 'src0' THEN 1 WHEN 'src1' THEN 2 END AS place
FROM ranked GROUP BY source""")
def author_book_pivot(spark, sf):
    return reports.author_book_pivot(
        _book_words(spark, sf), "source", "doc_id", names=AUTHOR_NAMES
    )


@check("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def class_counts(spark, sf):
    return reports.class_counts(documents(spark, sf), "lang")


@check("SELECT conv_id, role, count(text) AS n_rows FROM conversations GROUP BY conv_id, role")
def book_row_counts(spark, sf):
    return split.book_row_counts(table(spark, sf, "conversations"), "conv_id", "role")


@check("""SELECT doc_id, text FROM (SELECT doc_id, CASE WHEN lang = 'de' THEN NULL WHEN lang = 'es' THEN '' ELSE text END AS text
FROM documents) WHERE text IS NOT NULL AND text <> ''""")
def drop_empty_rows(spark, sf):
    text = F.when(F.col("lang") == "de", None).when(F.col("lang") == "es", "").otherwise(F.col("text"))
    rows = documents(spark, sf).select("doc_id", text.alias("text"))
    return catalog.drop_empty(rows, ["text"])


def raw_catalog(spark, sf):
    """A catalogue made from documents: some placeholder authors, missing titles, audio works."""
    d = documents(spark, sf)
    author = (
        F.when(F.col("doc_id") % 31 == 0, "Various")
        .when(F.col("doc_id") % 37 == 0, "Unknown")
        .when(F.col("doc_id") % 41 == 0, None)
        .when(F.col("doc_id") % 29 == 0, F.concat(F.lit("solo"), F.col("doc_id").cast("string")))
        .otherwise(F.col("source"))
    )
    title = F.when(F.col("doc_id") % 43 != 0, F.concat(F.lit("Title "), F.col("n_chars").cast("string")))
    kind = F.when(F.col("doc_id") % 23 == 0, "Sound").otherwise("Text")
    return d.select(
        F.concat(F.lit("PG"), F.col("doc_id").cast("string")).alias("id"),
        title.alias("title"),
        author.alias("author"),
        F.concat(F.lit("['"), F.col("lang"), F.lit("']")).alias("language"),
        kind.alias("type"),
    )


CATALOG = """
raw AS (
  SELECT doc_id, CASE WHEN doc_id % 43 <> 0 THEN 'Title ' || CAST(n_chars AS VARCHAR) END AS title,
    CASE WHEN doc_id % 31 = 0 THEN 'Various' WHEN doc_id % 37 = 0 THEN 'Unknown' WHEN doc_id % 41 = 0 THEN NULL
      WHEN doc_id % 29 = 0 THEN 'solo' || CAST(doc_id AS VARCHAR) ELSE source END AS author,
    lang AS language, CASE WHEN doc_id % 23 = 0 THEN 'Sound' ELSE 'Text' END AS type FROM documents),
filtered AS (
  SELECT title, author, CAST(doc_id AS INTEGER) AS pg_code FROM raw
  WHERE language = 'en' AND type = 'Text' AND author NOT IN ('Various', 'Anonymous', 'Unknown')
    AND author IS NOT NULL AND title IS NOT NULL),
with_ids AS (
  SELECT *, dense_rank() OVER (ORDER BY author) - 1 AS author_id,
    row_number() OVER (PARTITION BY author ORDER BY pg_code) - 1 AS book_id FROM filtered),
several AS (SELECT * FROM with_ids WHERE author IN (SELECT author FROM filtered GROUP BY author HAVING count(*) > 1))"""


@check(f"WITH {CATALOG} SELECT * FROM filtered")
def catalog_filter(spark, sf):
    return catalog.filter_catalog(raw_catalog(spark, sf)).select("title", "author", "pg_code")


@check(f"WITH {CATALOG} SELECT * FROM with_ids")
def catalog_ids(spark, sf):
    rows = catalog.assign_ids(catalog.filter_catalog(raw_catalog(spark, sf)))
    return rows.select("title", "author", "pg_code", "author_id", "book_id")


@check(f"WITH {CATALOG} SELECT title, author, pg_code FROM several")
def multi_book_authors(spark, sf):
    rows = catalog.filter_catalog(raw_catalog(spark, sf))
    return catalog.multi_book_authors(rows).select("title", "author", "pg_code")


@check(f"WITH {CATALOG} SELECT * FROM several")
def catalog_build(spark, sf):
    return catalog.build_catalog(raw_catalog(spark, sf))


def token_books(spark, sf):
    """Token lists of the documents that have a label; the others count as absent files."""
    present = table(spark, sf, "labels").select("doc_id")
    rows = documents(spark, sf).join(present, "doc_id", "left_semi")
    return rows.select(
        F.col("doc_id").cast("int").alias("pg_code"), tx.space_words(F.col("text")).alias("tokens")
    )


@check(f"WITH {CATALOG} SELECT * FROM several WHERE pg_code NOT IN (SELECT doc_id FROM labels)")
def missing_books(spark, sf):
    return catalog.missing_books(catalog.build_catalog(raw_catalog(spark, sf)), token_books(spark, sf))


@check(f"WITH {CATALOG} SELECT * FROM several WHERE pg_code IN (SELECT doc_id FROM labels)")
def present_books(spark, sf):
    return catalog.present_books(catalog.build_catalog(raw_catalog(spark, sf)), token_books(spark, sf))


DATASET = CATALOG + r""",
books AS (
  SELECT author_id, book_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w
  FROM several JOIN documents ON doc_id = pg_code WHERE doc_id IN (SELECT doc_id FROM labels)),
dataset AS (
  SELECT author_id, book_id, i AS chunk, array_to_string(w[i * 500 + 1:(i + 1) * 500], ' ') AS text
  FROM (SELECT *, unnest(range(CAST(ceil(len(w) / 500) AS BIGINT))) AS i FROM books))"""


@check(f"WITH {DATASET} SELECT * FROM dataset")
def dataset_build(spark, sf):
    rows = catalog.build_dataset(
        catalog.build_catalog(raw_catalog(spark, sf)), token_books(spark, sf)
    )
    return rows.withColumn("chunk", F.col("chunk").cast("long"))


def _greedy(table_name, author, book):
    """Books in hash order, each taken if it fits into what is left; one of each author first."""
    return f"""
counts AS (SELECT {author}, {book}, count(text) AS n FROM {table_name} GROUP BY {author}, {book}),
hashed AS (SELECT *, md5('42|' || {author} || '|' || CAST({book} AS VARCHAR)) AS h FROM counts),
firsts AS (SELECT *, row_number() OVER (PARTITION BY {author} ORDER BY h) = 1 AS first FROM hashed),
ordered AS (SELECT *, row_number() OVER (ORDER BY h) AS i FROM firsts WHERE NOT first),
fill(i, room, taken) AS (
  SELECT 0::BIGINT, (floor(sum(n) * 0.2) - sum(CASE WHEN first THEN n ELSE 0 END))::BIGINT, false FROM firsts
  UNION ALL
  SELECT o.i, CASE WHEN n <= room THEN room - n ELSE room END, n <= room FROM fill JOIN ordered o ON o.i = fill.i + 1),
chosen AS (
  SELECT {author}, {book}, n, first OR coalesce(taken, false) AS test
  FROM firsts LEFT JOIN ordered USING ({author}, {book}) LEFT JOIN fill ON fill.i = ordered.i)"""


GREEDY_ROLES = _greedy("conversations", "role", "conv_id").replace("n, first OR", "firsts.n, firsts.first OR")
GREEDY_SOURCES = _greedy("documents", "source", "doc_id").replace("n, first OR", "firsts.n, firsts.first OR")


@check(f"WITH RECURSIVE {GREEDY_SOURCES} SELECT source, doc_id, NOT test AS is_train FROM chosen")
def book_split(spark, sf):
    rows = split.split_by_book(documents(spark, sf), "source", "doc_id", margin=0.01)
    return rows.select("source", "doc_id", "is_train")


@check("""
SELECT DISTINCT source AS entry, true AS holds FROM documents
UNION ALL SELECT 'all books are whole', true UNION ALL SELECT 'within the margin', true
UNION ALL SELECT 'outside before', true""")
def book_split_repaired(spark, sf):
    """Few, large books: the first fill leaves the margin, moves bring it back, every author has a test book."""
    docs = documents(spark, sf)
    before = split.test_share(split.split_by_book(docs, "source", "lang"))
    rows = staged(split.split_by_book(docs, "source", "lang", margin=0.001), "repaired")
    authors = rows.groupBy(F.col("source").alias("entry")).agg(F.bool_or(~F.col("is_train")).alias("holds"))
    whole = rows.groupBy("source", "lang").agg((F.count_distinct("is_train") == 1).alias("one"))
    return (
        authors.unionByName(whole.agg(F.lit("all books are whole").alias("entry"), F.bool_and("one").alias("holds")))
        .unionByName(
            split.test_share(rows).select(
                F.lit("within the margin").alias("entry"), (F.abs(F.col("test_share") - 0.2) <= 0.001).alias("holds")
            )
        )
        .unionByName(
            before.select(F.lit("outside before").alias("entry"), (F.abs(F.col("test_share") - 0.2) > 0.001).alias("holds"))
        )
    )


@check(f"""WITH RECURSIVE {GREEDY_ROLES}
SELECT round(sum(CASE WHEN test THEN n ELSE 0 END) / sum(n), 6) AS test_share FROM chosen""")
def book_split_share(spark, sf):
    rows = split.split_by_book(table(spark, sf, "conversations"), "role", "conv_id")
    return split.test_share(rows).select(F.round("test_share", 6).alias("test_share"))


@check(f"SELECT doc_id, {q.bucket('doc_id', '100')} < 80 AS is_train FROM documents")
def row_split(spark, sf):
    return split.split_rows(documents(spark, sf), "doc_id").select("doc_id", "is_train")


@check(f"""SELECT doc_id, {q.bucket('doc_id', '(SELECT greatest(CAST(ceil(count(*) / 16) AS BIGINT), 1) FROM documents)')} AS batch
FROM documents""")
def assign_batches(spark, sf):
    return split.assign_batches(documents(spark, sf), "doc_id", 16).select("doc_id", "batch")


@check("""
SELECT 'documents' AS corpus, doc_id AS id, text FROM documents
UNION ALL SELECT 'benchmark', item_id, text FROM benchmark""")
def union_corpora(spark, sf):
    first = documents(spark, sf).select(
        F.lit("documents").alias("corpus"), F.col("doc_id").alias("id"), "text"
    )
    second = table(spark, sf, "benchmark").select(
        F.lit("benchmark").alias("corpus"), F.col("item_id").alias("id"), "text"
    )
    return first.unionByName(second)


@check("""
SELECT doc_id, lang, quality, toxic, n_chars FROM documents JOIN labels USING (doc_id)""")
def features_labels(spark, sf):
    features = documents(spark, sf).select("doc_id", "lang", "n_chars")
    return with_labels(features, table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "lang", "quality", "toxic", "n_chars"
    )


@check(f"""
SELECT source, count(*) AS books, CAST(sum({WC}) AS BIGINT) AS wc, count(DISTINCT lang) AS languages
FROM documents GROUP BY source HAVING count(*) > 1""")
def author_totals(spark, sf):
    rows = documents(spark, sf).withColumn("wc", tx.naive_word_count(F.col("text")))
    return (
        rows.groupBy("source")
        .agg(
            F.count("*").alias("books"),
            F.sum("wc").alias("wc"),
            F.countDistinct("lang").alias("languages"),
        )
        .where(F.col("books") > 1)
    )
