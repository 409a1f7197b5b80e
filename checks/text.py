"""Text functions and chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as q
from checks.registry import check, table
from penprint.functions import keys
from penprint.functions import lexicon as lex
from penprint.functions import text as tx
from penprint.operators import chunks as ck
from penprint.operators import reports, vocabulary, wordvectors
from penprint.settings import Settings, sweep


def documents(spark, sf):
    return table(spark, sf, "documents")


def tokens_sql(keep_punctuation=True, remove_stopwords=False, source="text"):
    tokens = q.raw_tokens(source)
    if not keep_punctuation:
        tokens = q.no_punctuation(tokens)
    if remove_stopwords:
        tokens = q.no_stop_words(tokens)
    return q.lowered(tokens)


@check("""
SELECT c_custkey, replace(replace(lower(c_name || ', St. ' || c_mktsegment), ' ', '_'), '.', '') AS author_slug,
  replace(replace(replace(lower(c_name || ': ' || c_mktsegment || ', Part'), ' ', '_'), ':', '_'), ',', '') AS title_slug
FROM customer""")
def slug_names(spark, sf):
    c = table(spark, sf, "customer")
    author = F.concat_ws(", St. ", "c_name", "c_mktsegment")
    title = F.concat(F.col("c_name"), F.lit(": "), F.col("c_mktsegment"), F.lit(", Part"))
    return c.select(
        "c_custkey",
        keys.author_slug(author).alias("author_slug"),
        keys.title_slug(title).alias("title_slug"),
    )


@check("""
SELECT page_id, p[len(p)] AS file, p[len(p) - 1] AS book, p[len(p) - 2] AS author
FROM (SELECT page_id, string_split(url, '/') AS p FROM pages)""")
def path_keys(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        keys.path_part(url, 1).alias("file"),
        keys.path_part(url, 2).alias("book"),
        keys.path_part(url, 3).alias("author"),
    )


@check("SELECT doc_id, CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS label FROM documents")
def label_binary(spark, sf):
    return documents(spark, sf).select(
        "doc_id", keys.binary_label(F.col("lang"), "fr").alias("label")
    )


CLASSES = {"de": 0, "en": 1, "es": 2, "fr": 3}


@check("""SELECT doc_id, CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 END AS label
FROM documents""")
def label_multiclass(spark, sf):
    return documents(spark, sf).select(
        "doc_id", keys.class_label(F.col("lang"), CLASSES).alias("label")
    )


@check("""SELECT c_custkey, CAST(substr(c_name, 10) AS INTEGER) AS code FROM customer""")
def code_from_id(spark, sf):
    c = table(spark, sf, "customer")
    pg = F.concat(F.lit("PG"), F.regexp_extract("c_name", r"(\d+)$", 1))
    return c.select("c_custkey", keys.code_from_id(pg).alias("code"))


@check(f"""
SELECT doc_id, len(list_filter(string_split(text, ' '), lambda x: {q.strip_ends('x')} <> '')) AS wc
FROM documents""")
def word_count(spark, sf):
    return documents(spark, sf).select(
        "doc_id", tx.naive_word_count(F.col("text")).cast("long").alias("wc")
    )


@check(f"SELECT doc_id, {q.strip_ends(q.rules('text', lex.NORMALIZE_RULES))} AS text FROM documents")
def normalize_text(spark, sf):
    return documents(spark, sf).select("doc_id", tx.normalize(F.col("text")).alias("text"))


@check(f"""
SELECT conv_id, turn, text, len(list_filter(string_split(text, ' '), lambda x: {q.strip_ends('x')} <> '')) AS wc
FROM (SELECT conv_id, turn, {q.clean('text')} AS text FROM conversations)""")
def turn_table(spark, sf):
    """Conversations as books, their turns as chapters: normalised text and word count."""
    turns = table(spark, sf, "conversations").select(
        "conv_id", "turn", tx.clean(F.col("text")).alias("text")
    )
    return turns.withColumn("wc", tx.naive_word_count(F.col("text")).cast("long"))


@check(f"SELECT doc_id, {q.strip_ends(q.rules('text', lex.COMPACT_RULES))} AS text FROM documents")
def normalize_compact(spark, sf):
    return documents(spark, sf).select(
        "doc_id", tx.normalize_compact(F.col("text")).alias("text")
    )


CONTRACTED_SQL = """replace(replace(replace(replace(text, 'and ', 'don''t '), 'of ', 'it''s '),
  'le ', 'we''ll '), 'que ', 'can''t ')"""


@check(f"SELECT doc_id, {q.contractions(CONTRACTED_SQL)} AS text FROM documents")
def expand_contractions(spark, sf):
    text = F.col("text")
    for word, short in (("and ", "don't "), ("of ", "it's "), ("le ", "we'll "), ("que ", "can't ")):
        text = F.replace(text, F.lit(word), F.lit(short))
    return documents(spark, sf).select("doc_id", tx.expand_contractions(text).alias("text"))


@check(f"""
SELECT doc_id, len(w) AS n_tokens, array_to_string(w, ' ') AS tokens
FROM (SELECT doc_id, {tokens_sql()} AS w FROM documents)""")
def word_tokens(spark, sf):
    return _tokens(spark, sf)


@check(f"""
SELECT doc_id, len(w) AS n_tokens, array_to_string(w, ' ') AS tokens
FROM (SELECT doc_id, {tokens_sql(keep_punctuation=False)} AS w FROM documents)""")
def drop_punctuation(spark, sf):
    return _tokens(spark, sf, keep_punctuation=False)


@check(f"""
SELECT doc_id, len(w) AS n_tokens, array_to_string(w, ' ') AS tokens
FROM (SELECT doc_id, {tokens_sql(remove_stopwords=True)} AS w FROM documents)""")
def drop_stopwords(spark, sf):
    return _tokens(spark, sf, remove_stopwords=True)


def _tokens(spark, sf, **options):
    rows = documents(spark, sf).select(
        "doc_id", tx.word_tokens(F.col("text"), **options).alias("w")
    )
    return rows.select(
        "doc_id", F.size("w").cast("long").alias("n_tokens"), F.array_join("w", " ").alias("tokens")
    )


@check(f"""
SELECT doc_id, len(w) AS n_terms, array_to_string(w, ' ') AS terms
FROM (SELECT doc_id, {q.terms()} AS w FROM documents)""")
def analyzer_tokens(spark, sf):
    rows = documents(spark, sf).select("doc_id", tx.terms(F.col("text")).alias("w"))
    return rows.select(
        "doc_id", F.size("w").cast("long").alias("n_terms"), F.array_join("w", " ").alias("terms")
    )


@check(r"""
SELECT doc_id, regexp_replace(replace(text, 'e ', 'e- '), '([\p{L}\p{N}_])-\s', '\1 ', 'g') AS text FROM documents""")
def fix_hyphen(spark, sf):
    broken = F.replace(F.col("text"), F.lit("e "), F.lit("e- "))
    return documents(spark, sf).select("doc_id", tx.fix_hyphen_tail(broken).alias("text"))


def _chunks_sql(length, tail, tokens):
    count = f"ceil(len(w) / {length})" if tail else f"len(w) // {length}"
    return f"""
SELECT doc_id, i AS chunk, array_to_string(w[i * {length} + 1:(i + 1) * {length}], ' ') AS text
FROM (SELECT doc_id, w, unnest(range(CAST({count} AS BIGINT))) AS i
      FROM (SELECT doc_id, {tokens} AS w FROM (SELECT doc_id, {q.clean('text')} AS text FROM documents)))"""


@check(_chunks_sql(100, False, tokens_sql(keep_punctuation=False)))
def chunk_fixed(spark, sf):
    settings = Settings(group_by_length=True, group_length=100)
    rows = ck.prepare_chunks(documents(spark, sf), settings, "text", ["doc_id"])
    return rows.withColumn("chunk", F.col("chunk").cast("long"))


@check(f"""
SELECT doc_id, i - 1 AS chunk, regexp_replace(array_to_string({tokens_sql(remove_stopwords=True, source='p[i]')}, ' '),
  '([\\p{{L}}\\p{{N}}_])-\\s', '\\1 ', 'g') AS text
FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i
  FROM (SELECT doc_id, list_filter(string_split({q.clean('text')}, chr(10)), lambda x: x <> '') AS p FROM documents))""")
def chunk_paragraph(spark, sf):
    settings = Settings(group_by_paragraph=True, keep_punctuation=True, remove_stopwords=True)
    rows = ck.prepare_chunks(
        documents(spark, sf), settings, "text", ["doc_id"], paragraph_separator="\n"
    )
    return rows.withColumn("chunk", F.col("chunk").cast("long"))


@check(f"""
SELECT doc_id, 0::BIGINT AS chunk, array_to_string({tokens_sql(keep_punctuation=False)}, ' ') AS text
FROM (SELECT doc_id, {q.clean('text')} AS text FROM documents)""")
def chunk_whole(spark, sf):
    rows = ck.prepare_chunks(documents(spark, sf), Settings(), "text", ["doc_id"])
    return rows.withColumn("chunk", F.col("chunk").cast("long"))


@check(r"""
SELECT doc_id, i AS chunk, array_to_string(w[i * 500 + 1:(i + 1) * 500], ' ') AS text
FROM (SELECT doc_id, w, unnest(range(CAST(ceil(len(w) / 500) AS BIGINT))) AS i
      FROM (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents))""")
def chunk_keep_tail(spark, sf):
    rows = documents(spark, sf).select("doc_id", tx.space_words(F.col("text")).alias("w"))
    chunks = ck.chunk_by_length(rows, "w", ["doc_id"], 500, drop_tail=False)
    return chunks.withColumn("chunk", F.col("chunk").cast("long"))


@check("""
SELECT doc_id, i - 1 AS chunk, p[i] AS text
FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i
  FROM (SELECT doc_id, string_split(text, '|') AS p FROM documents))""")
def explode_delimited(spark, sf):
    rows = ck.explode_delimited(documents(spark, sf), "text", ["doc_id"])
    return rows.withColumn("chunk", F.col("chunk").cast("long"))


@check(f"""
WITH words AS (SELECT doc_id, {q.terms()} AS w FROM documents),
occurrences AS (
  SELECT doc_id, unnest(w) AS term FROM words
  UNION ALL SELECT doc_id, unnest({q.grams('w', 2)}) FROM words
  UNION ALL SELECT doc_id, unnest({q.grams('w', 3)}) FROM words)
SELECT term, count(*) AS cf, count(DISTINCT doc_id) AS df FROM occurrences GROUP BY term""")
def ngram_counts(spark, sf):
    rows = vocabulary.with_terms(documents(spark, sf), "text", 1, 1)
    return vocabulary.corpus_counts(rows, low=1, high=3)


def _sweep_sql():
    parts = []
    for name, s in sweep().items():
        tokens = tokens_sql(s.keep_punctuation, s.remove_stopwords)
        if s.group_by_length:
            count = f"sum(len({tokens}) // {s.group_length})"
            total = f"sum(len({tokens}) // {s.group_length} * {s.group_length})"
        elif s.group_by_paragraph:
            paragraphs = "list_filter(string_split(text, chr(10)), lambda x: x <> '')"
            count = f"sum(len({paragraphs}))"
            total = f"sum(list_sum(list_transform({paragraphs}, lambda p: len({tokens_sql(s.keep_punctuation, s.remove_stopwords, 'p')}))))"
        else:
            count, total = "count(*)", f"sum(len({tokens}))"
        parts.append(
            f"SELECT '{name}' AS settings_id, CAST({count} AS BIGINT) AS chunks, "
            f"CAST({total} AS BIGINT) AS tokens FROM cleaned"
        )
    return f"WITH cleaned AS (SELECT {q.clean('text')} AS text FROM documents) " + " UNION ALL ".join(parts)


@check(_sweep_sql())
def settings_sweep(spark, sf):
    chunks = ck.sweep_chunks(
        documents(spark, sf), sweep(), "text", ["doc_id"], paragraph_separator="\n"
    )
    words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    return chunks.groupBy("settings_id").agg(
        F.count("*").alias("chunks"), F.sum(words).cast("long").alias("tokens")
    )


@check(rf"""
WITH parts AS (
  SELECT lang,
    len(list_filter(string_split_regex(text, '[.!?]+'), lambda s: regexp_matches(s, '[\p{{L}}\p{{N}}_]'))) AS sentences,
    regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+(?:[-''][\p{{L}}\p{{N}}_]+)*') AS w,
    len(list_filter({q.raw_tokens('text')}, lambda t: strpos({q.quoted(lex.PUNCTUATION)}, t) > 0)) AS marks
  FROM documents),
figures AS (
  SELECT lang, coalesce(len(w) / nullif(sentences, 0), 0) AS sl,
    coalesce(length(array_to_string(w, '')) / nullif(len(w), 0), 0) AS wl,
    coalesce(marks / nullif(len(w), 0), 0) AS mw
  FROM parts)
SELECT lang, count(*) AS texts, round(avg(sl), 6) AS sentence_length, round(avg(wl), 6) AS word_length,
  round(avg(mw), 6) AS marks_per_word
FROM figures GROUP BY lang""")
def stylometry(spark, sf):
    rows = reports.style_by_author(documents(spark, sf), "text", "lang")
    return rows.select(
        "lang",
        "texts",
        *[F.round(c, 6).alias(c) for c in ("sentence_length", "word_length", "marks_per_word")],
    )


@check(f"""
WITH {q.DOC_TERMS},
first AS (SELECT doc_id, w[1:128] AS w FROM words),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM first),
ids AS (SELECT doc_id, i, coalesce(idx + 2, 1) AS number FROM pos LEFT JOIN vocab ON term = w[i]),
joined AS (SELECT doc_id, string_agg(CAST(number AS VARCHAR), ' ' ORDER BY i) AS s, count(*) AS n FROM ids GROUP BY doc_id)
SELECT d.doc_id,
  trim(coalesce(s, '') || repeat(' 0', CAST(128 - coalesce(n, 0) AS BIGINT))) AS input_ids,
  trim(repeat('1 ', coalesce(n, 0)) || repeat('0 ', CAST(128 - coalesce(n, 0) AS BIGINT))) AS attention_mask
FROM documents d LEFT JOIN joined USING (doc_id)""")
def encode_fixed_length(spark, sf):
    docs = documents(spark, sf)
    top = vocabulary.vocabulary(vocabulary.with_terms(docs, "text", 1, 2))
    rows = docs.select("doc_id", tx.terms(F.col("text")).alias("w"))
    encoded = wordvectors.encode_fixed_length(rows, "w", top, "doc_id", 128)
    return encoded.select(
        "doc_id",
        F.array_join(F.transform("input_ids", lambda x: x.cast("string")), " ").alias("input_ids"),
        F.array_join(F.transform("attention_mask", lambda x: x.cast("string")), " ").alias(
            "attention_mask"
        ),
    )
