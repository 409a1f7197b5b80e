"""SQL pieces shared by several comparison queries."""

from __future__ import annotations

import re

from penprint.functions import lexicon as lex


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rules(expression: str, pairs, flags: str = "(?m)") -> str:
    for pattern, replacement, *_ in pairs:
        # no look-ahead here; the ones in the rules only save time
        pattern = re.sub(r"^\(\?=(?:\\p\{Nd\}|\[\$£0-9\]\|.*?\[0-9\])\)", "", pattern)
        expression = "regexp_replace({}, {}, {}, 'g')".format(
            expression, quoted(flags + pattern), quoted(replacement)
        )
    return expression


def strip_ends(expression: str) -> str:
    return f"trim({expression}, {quoted(lex.WHITESPACE)})"


def contractions(expression: str) -> str:
    # the boundary is part of the match here, so each rule runs twice for neighbours
    edge = r"[^\p{L}\p{N}_]"
    for pattern, replacement, _ in lex.CONTRACTED_WORDS:
        pair = (f"(^|{edge}){pattern}($|{edge})", replacement.replace("$1", r"\1\2") + r"\3")
        expression = rules(expression, [pair, pair], "")
    for pattern, replacement, _ in lex.CONTRACTED_ENDINGS:
        pair = (f"{pattern}($|{edge})", replacement + r"\1")
        expression = rules(expression, [pair, pair], "")
    return expression


def clean(expression: str, pairs=lex.NORMALIZE_RULES) -> str:
    return contractions(strip_ends(rules(expression, pairs)))


def raw_tokens(expression: str) -> str:
    return f"regexp_extract_all({expression}, {quoted(lex.TOKEN)})"


def no_punctuation(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: strpos({quoted(lex.PUNCTUATION)}, t) = 0)"


def no_stop_words(tokens: str) -> str:
    words = ", ".join(quoted(w) for w in lex.STOP_WORDS)
    return f"list_filter({tokens}, lambda t: t NOT IN ({words}))"


def lowered(tokens: str) -> str:
    return f"list_transform({tokens}, lambda t: lower(t))"


def terms(expression: str = "text") -> str:
    return rf"regexp_extract_all(lower({expression}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def bucket(key: str, buckets: str) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 15))::BIGINT % {buckets})"


def grams(words: str, n: int) -> str:
    """N-grams of a list column; ``words`` must be a plain column."""
    return (
        f"list_transform(range(1, greatest(len({words}) - {n - 1}, 0) + 1), "
        f"lambda i: array_to_string({words}[i:i + {n - 1}], ' '))"
    )


# occurrences of each term per document, for 1- and 2-grams
DOC_TERMS = f"""
words AS (SELECT doc_id, lang, {terms()} AS w FROM documents),
occurrences AS (
  SELECT doc_id, lang, unnest(w) AS term FROM words
  UNION ALL
  SELECT doc_id, lang, unnest({grams('w', 2)}) AS term FROM words),
doc_terms AS (
  SELECT doc_id, lang, term, count(*) AS tf FROM occurrences GROUP BY ALL),
counts AS (
  SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM doc_terms GROUP BY term),
vocab AS (
  SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx
  FROM (SELECT * FROM counts ORDER BY cf DESC, term LIMIT 10000))
"""

TFIDF = (
    DOC_TERMS
    + """,
size AS (SELECT count(*) AS n FROM documents),
weighted AS (
  SELECT doc_id, lang, term, tf * (ln((1 + n) / (1 + df)) + 1) AS x
  FROM doc_terms JOIN vocab USING (term), size),
tfidf AS (
  SELECT doc_id, lang, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS tfidf
  FROM weighted)
"""
)

# word vectors: a term has the vector its hash points to, about half have one
VECTORS = f"""
words AS (SELECT doc_id, lang, {terms()} AS w FROM documents),
occurrences AS (SELECT doc_id, unnest(w) AS word FROM words),
size AS (SELECT count(*) AS n FROM documents),
vectors AS (
  SELECT word, embedding AS vec
  FROM (SELECT word, {bucket('word', '(2 * (SELECT count(*) FROM embeddings))')} AS vec_id
        FROM (SELECT DISTINCT word FROM occurrences))
  JOIN embeddings USING (vec_id)),
doc_words AS (SELECT doc_id, word, count(*) AS n FROM occurrences GROUP BY ALL),
dims AS (SELECT unnest(range(64)) AS dim)
"""

MEANS = (
    VECTORS
    + """,
sums AS (
  SELECT doc_id, dim, sum(n * CAST(vec[dim + 1] AS DOUBLE)) / sum(n) AS value
  FROM doc_words JOIN vectors USING (word), dims GROUP BY doc_id, dim),
means AS (
  SELECT d.doc_id, d.lang, dims.dim, coalesce(s.value, 0) AS value
  FROM documents d CROSS JOIN dims LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.dim = dims.dim)
"""
)
