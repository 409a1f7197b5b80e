"""Book structure: body, table of contents, headers, chapters.

A book is one row. Everything below is an expression over that row, so books
are worked on in parallel and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import lexicon as lex
from penprint.functions import text as tx
from penprint.operators.rows import computed_once, unnest_structs
from penprint.session import staged

ENTRY = "struct<section_num:int,chapter_num:int,name:string>"
PLACE = "struct<start:int,stop:int,start_block:int,start_offset:int,stop_block:int,stop_offset:int>"
# least characters of a block in which headers are looked for; blocks end at line ends
BLOCK = 8192


def body(raw: Column) -> Column:
    """Text between the end of the first marker and the start of the second; null without both."""
    parts = F.split(raw, lex.FLAGS + lex.BODY_MARKER, 3)
    return F.when(F.size(parts) >= 3, F.element_at(parts, 2))


def contents_block(text: Column) -> Column:
    """The table of contents, up to four line feeds; null when there is none."""
    found = F.regexp_extract(text, lex.FLAGS + lex.CONTENTS_BLOCK, 2)
    return F.when(F.regexp_like(text, F.lit(lex.FLAGS + lex.CONTENTS_BLOCK)), found)


def after_contents(text: Column) -> Column:
    """The text that follows the table of contents, or the whole text."""
    parts = F.split(text, lex.FLAGS + lex.CONTENTS_BLOCK, 2)
    return F.element_at(parts, -1)


def section_titles(contents: Column) -> Column:
    """Titles of the section headings in a table of contents."""
    found = F.regexp_extract_all(contents, F.lit(lex.FLAGS + lex.CONTENTS_SECTION), F.lit(4))
    return F.transform(found, tx.strip_ends)


def section_blocks(contents: Column) -> Column:
    """The part of the contents below each section heading; one block when there is none."""
    parts = F.split(contents, lex.FLAGS + lex.CONTENTS_SECTION)
    return F.when(F.size(parts) > 1, F.slice(parts, F.lit(2), F.size(parts) - 1)).otherwise(parts)


def chapter_names(block: Column) -> Column:
    """Names of numbered entries; without any, each line that is not empty."""
    numbered = F.transform(
        F.regexp_extract_all(block, F.lit(lex.FLAGS + lex.CONTENTS_CHAPTER), F.lit(6)),
        tx.strip_ends,
    )
    lines = F.filter(F.transform(F.split(block, "\n"), tx.strip_ends), lambda x: x != "")
    return F.when(F.size(numbered) > 0, numbered).otherwise(lines)


def contents_entries(contents: Column) -> Column:
    """Array of (section_num, chapter_num, name); chapter 0 is the section itself."""
    titles = section_titles(contents)

    def entry(section, chapter, name):
        return F.struct(
            section.cast("int").alias("section_num"),
            chapter.cast("int").alias("chapter_num"),
            name.alias("name"),
        )

    def of_section(block, section):
        chapters = F.transform(
            chapter_names(block), lambda name, i: entry(section, i + 1, name)
        )
        head = F.when(
            F.size(titles) > 0, F.array(entry(section, F.lit(0), F.get(titles, section)))
        ).otherwise(F.array().cast(f"array<{ENTRY}>"))
        return F.concat(head, chapters)

    return F.flatten(F.transform(section_blocks(contents), of_section))


def whole_book_entry() -> Column:
    """The entries of a book without a table of contents: one chapter."""
    return F.array(
        F.struct(
            F.lit(0).alias("section_num"), F.lit(1).alias("chapter_num"), F.lit("").alias("name")
        )
    )


def read_structure(books: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``content`` (text after the contents) and ``entries``.

    Books without both markers get a null ``content``; see :func:`rejected_books`.
    """
    with_body = computed_once(books, _body=body(F.col(raw)))
    with_contents = computed_once(with_body, _contents=contents_block(F.col("_body")))
    none = F.col("_contents").isNull()
    structured = computed_once(
        with_contents,
        content=F.when(none, F.col("_body")).otherwise(after_contents(F.col("_body"))),
        entries=F.when(none, whole_book_entry()).otherwise(
            contents_entries(F.col("_contents"))
        ),
    )
    return structured.select(
        *books.columns, "content", "entries", (~none).alias("has_contents")
    )


def header_pattern(pattern: Column, name: Column) -> Column:
    """The pattern with the title, taken literally, put in for ``{00}``; case is ignored."""
    # a title may hold the sign that ends a quotation
    literal = F.replace(F.replace(name, F.lit("  "), F.lit(" ")), F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    quoted = F.concat(F.lit(r"\Q"), literal, F.lit(r"\E"))
    return F.concat(F.lit("(?mdiu)"), F.replace(pattern, F.lit("{00}"), quoted))


def line_blocks(content: Column) -> Column:
    """The text cut at line ends into pieces of at least ``BLOCK`` characters."""
    return F.regexp_extract_all(content, F.lit(rf"(?s).{{{BLOCK},}}?(?:\n|\z)|.+\z"), F.lit(0))


def locate_headers(blocks: Column, entries: Column, pattern: Column) -> Column:
    """Find the entries one after the other: each search starts behind the last hit.

    Gives an array with the places of the entries found, which ends before the first title
    that is missing. ``start`` and ``stop`` (behind the header) count characters of the
    text from 1; ``block`` and ``offset`` tell the same by block, from 0.

    The text comes in ``blocks``. A step looks for the next title in one block and the
    one after it and ends with a hit or at the next block, so it costs as much as
    two blocks, however long the book is; what is handed on are numbers. A header
    may start anywhere and must end within the block after the one where it starts.
    """
    none = F.array().cast(f"array<{PLACE}>")

    def step(state, _):
        block = F.coalesce(F.get(blocks, state["block"]), F.lit(""))
        rest = F.substring(block, state["offset"] + 1, F.length(block))
        window = F.concat(rest, F.coalesce(F.get(blocks, state["block"] + 1), F.lit("")))
        regex = header_pattern(pattern, F.get(entries, F.size(state["hits"]))["name"])

        def look(w):
            # the text before and after the header; an empty title stands where the search starts
            return F.when(w["regex"] == header_pattern(F.lit("{00}"), F.lit("")), F.array(F.lit(""), w["window"])).otherwise(
                F.split(w["window"], w["regex"], 2)
            )

        def move(w):
            return tx.bound(F.struct(look(w).alias("parts"), w["window"].alias("window"), w["rest"].alias("rest")), settle)

        def settle(w):
            before = F.length(F.get(w["parts"], F.lit(0)))
            last = state["block"] >= F.size(blocks) - 1
            hit = (F.size(w["parts"]) == 2) & ((before < F.length(w["rest"])) | last | (w["rest"] == w["window"]))
            stop = F.length(w["window"]) - F.length(F.get(w["parts"], F.lit(1)))
            over = stop > F.length(w["rest"])
            size = state["offset"] + F.length(w["rest"])

            def state_of(block, offset, passed, hits):
                return F.struct(
                    block.alias("block"), offset.alias("offset"), passed.alias("passed"), hits.alias("hits")
                )

            place = F.struct(
                (state["passed"] + state["offset"] + before + 1).alias("start"),
                (state["passed"] + state["offset"] + stop + 1).alias("stop"),
                state["block"].alias("start_block"),
                (state["offset"] + before).alias("start_offset"),
                F.when(over, state["block"] + 1).otherwise(state["block"]).alias("stop_block"),
                F.when(over, stop - F.length(w["rest"])).otherwise(state["offset"] + stop).alias("stop_offset"),
            )
            return F.when(
                hit,
                state_of(
                    place["stop_block"],
                    place["stop_offset"],
                    F.when(over, state["passed"] + size).otherwise(state["passed"]),
                    F.concat(state["hits"], F.array(place)),
                ),
            ).otherwise(state_of(state["block"] + 1, F.lit(0), state["passed"] + size, state["hits"]))

        asked = F.struct(window.alias("window"), rest.alias("rest"), regex.alias("regex"))
        done = (F.size(state["hits"]) >= F.size(entries)) | (
            (state["block"] >= F.size(blocks)) & (regex != header_pattern(F.lit("{00}"), F.lit("")))
        )
        return F.when(done | pattern.isNull(), state).otherwise(tx.bound(asked, move))

    begin = F.struct(F.lit(0).alias("block"), F.lit(0).alias("offset"), F.lit(0).alias("passed"), none.alias("hits"))
    steps = F.sequence(F.lit(1), F.greatest(F.size(entries) + F.size(blocks), F.lit(1)))
    return F.aggregate(steps, begin, step, lambda state: state["hits"])


def _text_from(blocks: Column, place: Column, upto: Column) -> Column:
    """The text behind the header at ``place`` and before the one at ``upto``, or to the end."""
    first, last = F.get(blocks, place["stop_block"]), F.get(blocks, upto["start_block"])
    inner = F.slice(
        blocks,
        place["stop_block"] + 2,
        F.greatest(F.coalesce(upto["start_block"], F.size(blocks)) - place["stop_block"] - 1, F.lit(0)),
    )
    head = F.substring(first, place["stop_offset"] + 1, F.length(first))
    return (
        F.when(
            upto["start_block"] == place["stop_block"],
            F.substring(first, place["stop_offset"] + 1, upto["start_offset"] - place["stop_offset"]),
        )
        .when(upto.isNull(), F.concat(F.coalesce(head, F.lit("")), F.array_join(inner, "")))
        .otherwise(F.concat(head, F.array_join(inner, ""), F.substring(last, F.lit(1), upto["start_offset"])))
    )


def _headers(blocks: Column, entries: Column, places: Column) -> Column:
    """The entries with ``start``, ``stop`` and the ``text`` up to the next header; null from the first missing title on."""
    complete = F.size(places) == F.size(entries)

    def header(e, i):
        place, following = F.get(places, i), F.get(places, i + 1)
        text = F.when(e["chapter_num"] == 0, F.lit("")).otherwise(_text_from(blocks, place, following))
        return F.struct(
            e["section_num"].alias("section_num"),
            e["chapter_num"].alias("chapter_num"),
            e["name"].alias("name"),
            place["start"].alias("start"),
            place["stop"].alias("stop"),
            F.when(complete, text).alias("text"),
        )

    return F.transform(entries, header)


def _broken(patterns: DataFrame) -> list[str]:
    """Patterns that do not compile. The table is small: a row per book, few distinct patterns."""
    regex = patterns.sparkSession._jvm.java.util.regex.Pattern
    broken = []
    for (pattern,) in patterns.select("pattern").where("pattern IS NOT NULL").distinct().collect():
        try:
            regex.compile("(?mdiu)" + pattern.replace("{00}", "x"))
        except IllegalArgumentException:
            broken.append(pattern)
    return broken


def find_headers(books: DataFrame, patterns: DataFrame, on: str) -> DataFrame:
    """Add ``headers`` to books with ``content`` and ``entries``.

    ``patterns`` (``on``, ``pattern``) has one row per book or kind of book. A
    book without a contents block needs no pattern: its one chapter is the text. A
    pattern that does not compile counts as missing; ``bad_pattern`` tells so.
    """
    bad = F.coalesce(F.col("pattern").isin(_broken(patterns)), F.lit(False))
    checked = patterns.select(
        on, F.when(~bad, F.col("pattern")).alias("pattern"), bad.alias("bad_pattern")
    )
    # written, so that Spark knows how small it is and copies it: books moved by their kind go to a task per kind
    matched = books.join(staged(checked, "patterns"), on, "left")
    whole = F.transform(
        F.col("entries"),
        lambda e: F.struct(
            e["section_num"].alias("section_num"),
            e["chapter_num"].alias("chapter_num"),
            e["name"].alias("name"),
            F.lit(1).alias("start"),
            F.lit(1).alias("stop"),
            F.col("content").alias("text"),
        ),
    )
    cut = computed_once(matched, _blocks=F.when(F.col("has_contents"), line_blocks(F.col("content"))))
    found = computed_once(cut, _places=locate_headers(F.col("_blocks"), F.col("entries"), F.col("pattern")))
    located = _headers(F.col("_blocks"), F.col("entries"), F.coalesce("_places", F.array().cast(f"array<{PLACE}>")))
    headers = F.when(F.col("has_contents"), located).otherwise(whole)
    return computed_once(found, headers=headers).drop("_blocks", "_places")


def _complete(headers: Column) -> Column:
    return F.forall(headers, lambda h: h["start"].isNotNull())


def rejected_books(books: DataFrame, key: list[str]) -> DataFrame:
    """Books that cannot be split, with the reason."""
    missing = F.element_at(F.filter(F.col("headers"), lambda h: h["start"].isNull()), 1)["name"]
    reason = (
        F.when(F.col("content").isNull(), F.lit("start or end marker missing"))
        .when(F.col("has_contents") & F.col("bad_pattern"), F.lit("header pattern does not compile"))
        .when(F.col("has_contents") & F.col("pattern").isNull(), F.lit("no header pattern"))
        .when(~_complete(F.col("headers")), F.concat(F.lit("header not found: "), missing))
    )
    return computed_once(books.select(*key, "content", "has_contents", "pattern", "bad_pattern", "headers"), reason=reason).select(
        *key, "reason"
    ).where(F.col("reason").isNotNull())


def chapter_array() -> Column:
    """The entries of a complete book with their ``text``; null for other books.

    A chapter runs from its header to the next one. Sections have an empty
    text, and text before the first chapter of a section is left out.
    """
    headers = F.col("headers")

    def chapter(h):
        return F.struct(*[h[name].alias(name) for name in ("section_num", "chapter_num", "name", "text")])

    return F.when(F.col("content").isNotNull() & _complete(headers), F.transform(headers, chapter))


def split_chapters(books: DataFrame, keep: list[str]) -> DataFrame:
    """One row per entry of the complete books: ``keep, section_num, chapter_num, name, text``."""
    return unnest_structs(books, chapter_array(), keep, "section_num")


def chapter_table(books: DataFrame, keep: list[str], rules=lex.NORMALIZE_RULES) -> DataFrame:
    """Chapters with normalised text and the naive word count ``wc``."""
    chapters = split_chapters(books, keep)
    return chapters.withColumn("text", tx.clean(F.col("text"), rules)).withColumn(
        "wc", tx.naive_word_count(F.col("text"))
    )


def section_dump(
    books: DataFrame, keep: list[str], prepare: Callable[[Column], Column] = tx.clean
) -> DataFrame:
    """One readable text per section: ``keep, section_num, value``, chapters framed and in order.

    Made inside the row of the book; ``prepare`` is applied to each chapter.
    """
    # fixed values: the frame of a chapter in the dump, which readers of it rely on
    pad = "-" * 25

    def line(before, name):
        return F.concat(F.lit(f"{pad} {before} "), name, F.lit(f" {pad}\n"))

    def framed(c):
        chapter = F.concat(
            line("BEGIN CHAPTER", c["name"]),
            prepare(c["text"]),
            F.lit("\n"),
            line("END CHAPTER", c["name"]),
        )
        return F.when(c["chapter_num"] == 0, line("SECTION", c["name"])).otherwise(chapter)

    def dump(chapters):
        sections = F.array_distinct(F.transform(chapters, lambda c: c["section_num"]))
        return F.transform(
            sections,
            lambda s: F.struct(
                s.alias("section_num"),
                F.array_join(
                    F.transform(F.filter(chapters, lambda c: c["section_num"] == s), framed), ""
                ).alias("value"),
            ),
        )

    return unnest_structs(books, tx.bound(chapter_array(), dump), keep, "section_num")
