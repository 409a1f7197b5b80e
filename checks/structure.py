"""Book structure. Each document becomes a raw book file first: its lines are the chapters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as q
from checks.registry import check, fixture, table
from penprint.functions import lexicon as lex
from penprint.functions import text as tx
from penprint.operators import structure as st
from penprint.operators.rows import computed_once, unnest_structs

ROMAN = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split()

# how the headers of each kind of book look; the kind is the language
PATTERNS = (
    ("en", r"^~ \w+ \w+ ~\n{00}"),
    ("fr", r"^=+ \d+ =+\n{00}\n"),
    ("es", r"{00}"),
)


@fixture
def raw_books(spark, sf):
    """Books made from documents: two parts (en), numbered (fr), plain contents (es), none (de).

    Every tenth book lacks its end marker.
    """
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    docs = table(spark, sf, "documents").select("doc_id", "lang", lines.alias("lines"))
    docs = docs.withColumn(
        "titles",
        F.transform("lines", lambda x: F.array_join(F.slice(F.split(x, " "), 1, 3), " ")),
    ).withColumn("half", F.ceil(F.size("lines") / 2).cast("int"))
    roman = F.array(*[F.lit(r) for r in ROMAN])

    def number(i):
        return F.get(roman, i % 20)

    def join(parts):
        return F.array_join(parts, "")

    def toc_en(t, i):
        part = F.when(i == F.col("half"), F.lit("PART II. The Close\n")).otherwise(F.lit(""))
        return F.concat(part, F.lit("CHAPTER "), number(i), F.lit(". "), t, F.lit(" 12\n"))

    def body_en(x, i):
        part = F.when(i == F.col("half"), F.lit("~ Part Two ~\nThe Close\n\n")).otherwise(F.lit(""))
        head = F.concat(part, F.lit("~ Chapter "), number(i), F.lit(" ~\n"), F.get("titles", i))
        return F.concat(head, F.lit("\n"), x, F.lit("\n\n"))

    def toc_fr(t, i):
        return F.concat((i + 1).cast("string"), F.lit(". "), t, F.lit("\n"))

    def body_fr(x, i):
        head = F.concat(F.lit("== "), (i + 1).cast("string"), F.lit(" ==\n"), F.get("titles", i))
        return F.concat(head, F.lit("\n"), x, F.lit("\n"))

    def toc_es(t, i):
        return F.concat(F.lit("  "), t, F.lit("\n"))

    def body_es(x, i):
        return F.concat(F.upper(F.get("titles", i)), F.lit("\n"), x, F.lit("\n"))

    gap = F.lit("\n\n\n\n\n")
    content = (
        F.when(
            F.col("lang") == "en",
            F.concat(
                F.lit("Contents\n\nPART I. The Opening\n"),
                join(F.transform("titles", toc_en)),
                gap,
                F.lit("~ Part One ~\nThe Opening\n\n"),
                join(F.transform("lines", body_en)),
            ),
        )
        .when(
            F.col("lang") == "fr",
            F.concat(
                F.lit("CONTENTS\n"),
                join(F.transform("titles", toc_fr)),
                gap,
                join(F.transform("lines", body_fr)),
            ),
        )
        .when(
            F.col("lang") == "es",
            F.concat(
                F.lit("Contents\n"),
                join(F.transform("titles", toc_es)),
                gap,
                join(F.transform("lines", body_es)),
            ),
        )
        .otherwise(F.array_join("lines", "\n"))
    )

    def marker(kind):
        return F.concat(
            F.lit(f"*** {kind} OF THE PROJECT GUTENBERG EBOOK "),
            F.col("doc_id").cast("string"),
            F.lit(" ***\n"),
        )

    end = F.when(F.col("doc_id") % 10 == 9, F.lit("")).otherwise(marker("END"))
    raw = F.concat(
        F.lit("Produced by hand\n"), marker("START"), content, F.lit("\n"), end, F.lit("Notice\n")
    )
    return computed_once(docs, raw=raw).select("doc_id", "lang", "raw")


# the same books, in SQL
_ROMAN = "[" + ", ".join(f"'{r}'" for r in ROMAN) + "]"
_NL = "chr(10)"
BOOKS = f"""
lines AS (
  SELECT doc_id, lang, list_filter(string_split(text, {_NL}), lambda x: trim(x) <> '') AS l FROM documents),
titled AS (
  SELECT *, list_transform(l, lambda x: array_to_string(string_split(x, ' ')[1:3], ' ')) AS t,
    CAST(ceil(len(l) / 2) AS INTEGER) AS half FROM lines),
content AS (
  SELECT doc_id, lang, CASE lang
    WHEN 'en' THEN 'Contents' || {_NL} || {_NL} || 'PART I. The Opening' || {_NL}
      || array_to_string(list_transform(t, lambda x, i:
           CASE WHEN i - 1 = half THEN 'PART II. The Close' || {_NL} ELSE '' END
           || 'CHAPTER ' || {_ROMAN}[(i - 1) % 20 + 1] || '. ' || x || ' 12' || {_NL}), '')
      || repeat({_NL}, 5) || '~ Part One ~' || {_NL} || 'The Opening' || repeat({_NL}, 2)
      || array_to_string(list_transform(l, lambda x, i:
           CASE WHEN i - 1 = half THEN '~ Part Two ~' || {_NL} || 'The Close' || repeat({_NL}, 2) ELSE '' END
           || '~ Chapter ' || {_ROMAN}[(i - 1) % 20 + 1] || ' ~' || {_NL} || t[i] || {_NL} || x || repeat({_NL}, 2)), '')
    WHEN 'fr' THEN 'CONTENTS' || {_NL}
      || array_to_string(list_transform(t, lambda x, i: CAST(i AS VARCHAR) || '. ' || x || {_NL}), '')
      || repeat({_NL}, 5)
      || array_to_string(list_transform(l, lambda x, i:
           '== ' || CAST(i AS VARCHAR) || ' ==' || {_NL} || t[i] || {_NL} || x || {_NL}), '')
    WHEN 'es' THEN 'Contents' || {_NL}
      || array_to_string(list_transform(t, lambda x: '  ' || x || {_NL}), '')
      || repeat({_NL}, 5)
      || array_to_string(list_transform(l, lambda x, i: upper(t[i]) || {_NL} || x || {_NL}), '')
    ELSE array_to_string(l, {_NL}) END AS c
  FROM titled),
raw_books AS (
  SELECT doc_id, lang, 'Produced by hand' || {_NL}
    || '*** START OF THE PROJECT GUTENBERG EBOOK ' || CAST(doc_id AS VARCHAR) || ' ***' || {_NL} || c || {_NL}
    || CASE WHEN doc_id % 10 = 9 THEN '' ELSE '*** END OF THE PROJECT GUTENBERG EBOOK ' || CAST(doc_id AS VARCHAR) || ' ***' || {_NL} END
    || 'Notice' || {_NL} AS raw
  FROM content),
parts AS (
  SELECT doc_id, lang, string_split_regex(raw, '(?m)(?:^\\s+THE END(?s:.*?)^)?\\*{{3}} (?:START|END) OF THE PROJECT GUTENBERG .+ \\*{{3}}$') AS p
  FROM raw_books),
bodies AS (SELECT doc_id, lang, CASE WHEN len(p) >= 3 THEN p[2] END AS body FROM parts)"""

_SECTION = r"(?m)^\s*(?:PART (?:I[XV]|V?I{0,3})|(?:FIRST|SECOND) EPISODE)[.:](.*)$"
_UNITS = "(?:I[XV]|V?I{0,3})"
_TENS = "(?:X[CL]|L?X{0,3})"
# a roman number that is not empty, as there is no look-ahead here
_NUMERAL = (
    f"(?:M+(?:C[MD]|D?C{{0,3}}){_TENS}{_UNITS}|(?:C[MD]|DC{{0,3}}|C{{1,3}}){_TENS}{_UNITS}"
    f"|(?:X[CL]|LX{{0,3}}|X{{1,3}}){_UNITS}|(?:I[XV]|VI{{0,3}}|I{{1,3}})|\\d{{1,3}})"
)
_CHAPTER = rf"(?m)^\s*(?:CHAPTER|Chapter)?\s*{_NUMERAL}\.? (.*?)\d{{0,3}}$"

CONTENTS = f"""
{BOOKS},
contents AS (
  SELECT doc_id, lang, body,
    regexp_extract(body, '(?:Contents|CONTENTS)([\\s\\S]*?)\\n{{4}}', 1) AS toc,
    regexp_matches(body, '(?:Contents|CONTENTS)([\\s\\S]*?)\\n{{4}}') AS has_contents,
    regexp_replace(body, '(?s)\\A.*?(?:Contents|CONTENTS).*?\\n{{4}}', '') AS rest
  FROM bodies WHERE body IS NOT NULL),
sections AS (
  SELECT doc_id, list_transform(regexp_extract_all(toc, '{_SECTION}', 1), lambda x: {q.strip_ends('x')}) AS titles,
    string_split_regex(toc, '{_SECTION.replace("(.*)", ".*")}') AS blocks
  FROM contents WHERE has_contents),
section_rows AS (
  SELECT doc_id, unnest(range(CASE WHEN len(blocks) > 1 THEN len(blocks) - 1 ELSE 1 END)) AS section_num,
    titles, blocks FROM sections),
section_names AS (
  SELECT doc_id, section_num, titles[section_num + 1] AS title,
    CASE WHEN len(blocks) > 1 THEN blocks[section_num + 2] ELSE blocks[1] END AS block FROM section_rows),
chapter_lists AS (
  SELECT doc_id, section_num, title,
    CASE WHEN regexp_matches(block, '{_CHAPTER}')
      THEN list_transform(regexp_extract_all(block, '{_CHAPTER}', 1), lambda x: {q.strip_ends('x')})
      ELSE list_filter(list_transform(string_split(block, {_NL}), lambda x: {q.strip_ends('x')}), lambda x: x <> '') END AS names
  FROM section_names),
entries AS (
  SELECT doc_id, section_num, 0 AS chapter_num, title AS name FROM chapter_lists WHERE title IS NOT NULL
  UNION ALL
  SELECT doc_id, section_num, i AS chapter_num, names[i] AS name
  FROM (SELECT doc_id, section_num, names, unnest(range(1, len(names) + 1)) AS i FROM chapter_lists))"""

_PATTERN = "CASE lang " + " ".join(
    f"WHEN '{lang}' THEN '{pattern}'" for lang, pattern in PATTERNS
) + " END"
HEADERS = f"""
{CONTENTS},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section_num, chapter_num) AS k FROM entries),
located(doc_id, k, section_num, chapter_num, name, start, stop) AS (
  SELECT doc_id, 0::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::VARCHAR, NULL::BIGINT, 1::BIGINT
  FROM contents WHERE has_contents
  UNION ALL
  SELECT doc_id, k, section_num, chapter_num, name, start, start + len
  FROM (
    SELECT doc_id, k, section_num, chapter_num, name,
      CASE WHEN regexp_matches(rest, '(?mi:' || pat || ')')
        THEN begin_at + length(regexp_extract(rest, '\\A((?s:.*?))(?mi:' || pat || ')', 1)) END AS start,
      length(regexp_extract(rest, '(?mi:' || pat || ')')) AS len
    FROM (
      SELECT n.doc_id, n.k, n.section_num, n.chapter_num, n.name, l.stop AS begin_at, substr(c.rest, l.stop) AS rest,
        replace({_PATTERN}, '{{00}}', '\\Q' || replace(n.name, '  ', ' ') || '\\E') AS pat
      FROM located l JOIN numbered n ON n.doc_id = l.doc_id AND n.k = l.k + 1
      JOIN contents c ON c.doc_id = l.doc_id WHERE l.stop IS NOT NULL))),
complete AS (
  SELECT n.doc_id, count(l.start) = count(*) AS whole
  FROM numbered n LEFT JOIN located l ON l.doc_id = n.doc_id AND l.k = n.k GROUP BY n.doc_id)"""

CHAPTERS = f"""
{HEADERS},
chapters AS (
  SELECT l.doc_id, l.section_num, l.chapter_num, l.name,
    CASE WHEN l.chapter_num = 0 THEN ''
      ELSE substr(c.rest, l.stop, coalesce(lead(l.start) OVER (PARTITION BY l.doc_id ORDER BY l.k), length(c.rest) + 1) - l.stop) END AS text
  FROM located l JOIN contents c USING (doc_id) JOIN complete USING (doc_id) WHERE whole AND l.k > 0
  UNION ALL
  SELECT doc_id, 0, 1, '', body FROM contents WHERE NOT has_contents)"""


def _structured(spark, sf):
    return st.read_structure(raw_books(spark, sf))


def _found(spark, sf):
    patterns = spark.createDataFrame(list(PATTERNS), "lang string, pattern string")
    return st.find_headers(_structured(spark, sf), patterns, "lang")


def _entries(spark, sf):
    rows = unnest_structs(
        _structured(spark, sf), F.col("entries"), ["doc_id", "has_contents"], "section_num"
    )
    return rows.where("has_contents").select(
        "doc_id",
        F.col("section_num").cast("long").alias("section_num"),
        F.col("chapter_num").cast("long").alias("chapter_num"),
        "name",
    )


@check(f"WITH {BOOKS} SELECT doc_id, body FROM bodies")
def strip_boilerplate(spark, sf):
    return raw_books(spark, sf).select("doc_id", st.body(F.col("raw")).alias("body"))


@check(f"WITH {CONTENTS} SELECT doc_id, section_num, chapter_num, name FROM entries")
def toc_entries(spark, sf):
    return _entries(spark, sf)


@check(f"WITH {CONTENTS} SELECT doc_id, section_num, title FROM section_names WHERE title IS NOT NULL")
def toc_sections(spark, sf):
    sections = _entries(spark, sf).where(F.col("chapter_num") == 0)
    return sections.select("doc_id", "section_num", F.col("name").alias("title"))


@check(f"WITH RECURSIVE {HEADERS} SELECT doc_id, section_num, chapter_num, start, stop FROM located WHERE k > 0 AND start IS NOT NULL")
def header_positions(spark, sf):
    rows = unnest_structs(
        _found(spark, sf), F.col("headers"), ["doc_id", "has_contents"], "start"
    )
    return rows.where("has_contents").select(
        "doc_id",
        *[F.col(c).cast("long").alias(c) for c in ("section_num", "chapter_num", "start", "stop")],
    )


@check(f"WITH RECURSIVE {CHAPTERS} SELECT * FROM chapters")
def split_chapters(spark, sf):
    rows = st.split_chapters(_found(spark, sf), ["doc_id"])
    return rows.withColumn("section_num", F.col("section_num").cast("long")).withColumn(
        "chapter_num", F.col("chapter_num").cast("long")
    )


@check(f"""
WITH RECURSIVE {CHAPTERS},
cleaned AS (SELECT doc_id, section_num, chapter_num, {q.clean('text')} AS text FROM chapters)
SELECT *, len(list_filter(string_split(text, ' '), lambda x: {q.strip_ends('x')} <> '')) AS wc FROM cleaned""")
def chapter_table(spark, sf):
    rows = st.chapter_table(_found(spark, sf), ["doc_id"])
    return rows.select(
        "doc_id",
        F.col("section_num").cast("long").alias("section_num"),
        F.col("chapter_num").cast("long").alias("chapter_num"),
        "text",
        F.col("wc").cast("long").alias("wc"),
    )


@check(f"""
WITH RECURSIVE {HEADERS},
first_missing AS (
  SELECT n.doc_id, arg_min(n.name, n.k) AS name FROM numbered n LEFT JOIN located l ON l.doc_id = n.doc_id AND l.k = n.k
  WHERE l.start IS NULL GROUP BY n.doc_id)
SELECT doc_id, 'start or end marker missing' AS reason FROM bodies WHERE body IS NULL
UNION ALL SELECT doc_id, 'header not found: ' || name FROM first_missing""")
def rejected_books(spark, sf):
    return st.rejected_books(_found(spark, sf), ["doc_id"])


@check(f"""
WITH RECURSIVE {CHAPTERS},
framed AS (
  SELECT doc_id, section_num, chapter_num, CASE WHEN chapter_num = 0
    THEN repeat('-', 25) || ' SECTION ' || name || ' ' || repeat('-', 25) || {_NL}
    ELSE repeat('-', 25) || ' BEGIN CHAPTER ' || name || ' ' || repeat('-', 25) || {_NL} || {q.clean('text')} || {_NL}
      || repeat('-', 25) || ' END CHAPTER ' || name || ' ' || repeat('-', 25) || {_NL} END AS part
  FROM chapters)
SELECT doc_id, section_num, string_agg(part, '' ORDER BY chapter_num) AS value FROM framed GROUP BY doc_id, section_num""")
def section_dump(spark, sf):
    dump = st.section_dump(_found(spark, sf), ["doc_id"])
    return dump.withColumn("section_num", F.col("section_num").cast("long"))
