"""Book structure on small hand-written books."""

import time

import pytest
from pyspark.sql import functions as F

from penprint.operators import structure as st

START = "*** START OF THE PROJECT GUTENBERG EBOOK X ***"
END = "*** END OF THE PROJECT GUTENBERG EBOOK X ***"


def book(contents, text, end=END):
    toc = f"Contents\n{contents}\n\n\n\n" if contents else ""
    return f"front matter\n{START}\n{toc}{text}\n{end}\nlicence"


TWO_PARTS = book(
    """
  PART I. The Crime
  CHAPTER I. A Start 3
  CHAPTER II. The Clue 17
  PART II. The End
  CHAPTER I. A Turn 40
""",
    """<PART I>
The Crime
dropped
<CHAPTER I>
A Start
first text, about The Clue
<CHAPTER II>
The Clue
second text
<PART II>
The End
<CHAPTER I>
A Turn
third text""",
)
NUMBERED = book(
    "Chapter 1. Who (was) [it]? \n Chapter 2. O'Brien ",
    "== 1 ==\nWHO (WAS) [IT]?\none\n== 2 ==\nO'Brien\ntwo",
)
LINES = book("\n The Blue Cross\n\n The Garden\n", "THE BLUE CROSS\nalpha\nThe Garden\nbeta")
NO_CONTENTS = book("", "only text here")
ONE_MARKER = f"{START}\nno end"
LOST = book("Chapter 1. Here\nChapter 2. Gone", "== 1 ==\nHere\nx")
QUOTED = book(r"Chapter 1. A \E. (b" + "\nChapter 2. C", "== 1 ==\nA \\E. (b\none\n== 2 ==\nC\ntwo")
TAIL = f"{START}\nbody\n   THE END\nnotes\n{END}\n"

BOOKS = {
    "two_parts": TWO_PARTS,
    "numbered": NUMBERED,
    "lines": LINES,
    "none": NO_CONTENTS,
    "one_marker": ONE_MARKER,
    "lost": LOST,
    "no_pattern": NUMBERED,
    "broken": NUMBERED,
    "quoted": QUOTED,
    "tail": TAIL,
}
PATTERNS = {
    "two_parts": r"^<\w+ \w+>\n{00}",
    "numbered": r"^=+ \d+ =+\n{00}\n",
    "lines": "{00}",
    "quoted": r"^=+ \d+ =+\n{00}\n",
    "broken": r"^(=+ {00}",
    "lost": r"^=+ \d+ =+\n{00}\n",
}


@pytest.fixture(scope="module")
def found(spark):
    books = spark.createDataFrame(list(BOOKS.items()), "book string, raw string")
    patterns = spark.createDataFrame(list(PATTERNS.items()), "book string, pattern string")
    return st.find_headers(st.read_structure(books), patterns, "book").cache()


def chapters(found, name):
    rows = st.split_chapters(found, ["book"]).where(F.col("book") == name).collect()
    return [
        (r["section_num"], r["chapter_num"], r["name"], r["text"].strip())
        for r in sorted(rows, key=lambda r: (r["section_num"], r["chapter_num"]))
    ]


def test_two_parts(found):
    assert chapters(found, "two_parts") == [
        (0, 0, "The Crime", ""),
        (0, 1, "A Start", "first text, about The Clue"),
        (0, 2, "The Clue", "second text"),
        (1, 0, "The End", ""),
        (1, 1, "A Turn", "third text"),
    ]


def test_numbered_titles_are_taken_literally(found):
    assert chapters(found, "numbered") == [
        (0, 1, "Who (was) [it]?", "one"),
        (0, 2, "O'Brien", "two"),
    ]


def test_a_title_that_ends_a_quotation(found):
    assert chapters(found, "quoted") == [(0, 1, r"A \E. (b", "one"), (0, 2, "C", "two")]


def test_contents_without_numbers(found):
    assert chapters(found, "lines") == [
        (0, 1, "The Blue Cross", "alpha"),
        (0, 2, "The Garden", "beta"),
    ]


def test_no_contents_is_one_chapter(found):
    assert chapters(found, "none") == [(0, 1, "", "only text here")]


def test_the_end_tail_is_cut(found):
    assert chapters(found, "tail") == [(0, 1, "", "body")]


def test_rejected_books(found):
    reasons = {r["book"]: r["reason"] for r in st.rejected_books(found, ["book"]).collect()}
    assert reasons == {
        "one_marker": "start or end marker missing",
        "lost": "header not found: Gone",
        "no_pattern": "no header pattern",
        "broken": "header pattern does not compile",
    }


def test_rejected_books_have_no_chapters(found):
    names = {r["book"] for r in st.split_chapters(found, ["book"]).collect()}
    assert names == {"two_parts", "numbered", "lines", "none", "tail", "quoted"}


def test_chapter_table_and_dump(found):
    table = st.chapter_table(found, ["book"]).where(F.col("book") == "two_parts")
    counts = {(r["section_num"], r["chapter_num"]): r["wc"] for r in table.collect()}
    assert counts == {(0, 0): 0, (0, 1): 5, (0, 2): 2, (1, 0): 0, (1, 1): 2}
    dumps = st.section_dump(found, ["book"]).where(F.col("book") == "two_parts")
    dump = {r["section_num"]: r["value"] for r in dumps.collect()}
    pad = "-" * 25
    assert dump[1] == (
        f"{pad} SECTION The End {pad}\n{pad} BEGIN CHAPTER A Turn {pad}\nthird text\n"
        f"{pad} END CHAPTER A Turn {pad}\n"
    )


def long_book(chapters, words=160):
    names = [f"Part {i} of the tale" for i in range(chapters)]
    toc = "\n".join(f"Chapter {i}. {name}" for i, name in enumerate(names, 1))
    texts = [" ".join(f"word{(i * j) % 97}" for j in range(words)) + ("\nline" * (i % 5)) for i in range(chapters)]
    body = "".join(f"== {i} ==\n{name.upper()}\n{text}\n" for i, (name, text) in enumerate(zip(names, texts), 1))
    return book(toc, body), names, texts


@pytest.mark.parametrize("block", [1, 40, 700, 1 << 20])
def test_blocks_of_any_size_give_the_same_chapters(spark, monkeypatch, block):
    monkeypatch.setattr(st, "BLOCK", block)
    raw, names, texts = long_book(12, 60)
    frame = spark.createDataFrame([("b", raw)], "book string, raw string")
    patterns = spark.createDataFrame([("b", r"^=+ \d+ =+\n{00}\n")], "book string, pattern string")
    found = st.find_headers(st.read_structure(frame), patterns, "book")
    if block == 1:
        # a header over two line ends needs the block after its first one
        assert {r["reason"] for r in st.rejected_books(found, ["book"]).collect()} <= {f"header not found: {n}" for n in names}
        return
    rows = sorted(st.split_chapters(found, ["book"]).collect(), key=lambda r: r["chapter_num"])
    assert [(r["name"], r["text"].strip()) for r in rows] == list(zip(names, texts))
    content = found.select("content").first()[0]
    for h in found.select("headers").first()[0]:
        assert content[h["start"] - 1 : h["stop"] - 1].endswith(h["name"].upper() + "\n")


def test_twice_the_chapters_take_about_twice_the_time(spark):
    patterns = spark.createDataFrame([("b", r"^=+ \d+ =+\n{00}\n")], "book string, pattern string")
    seconds = []
    for chapters in (20, 300, 600):
        raw, names, texts = long_book(chapters)
        frame = spark.createDataFrame([("b", raw)], "book string, raw string")
        start = time.perf_counter()
        rows = st.split_chapters(st.find_headers(st.read_structure(frame), patterns, "book"), ["book"]).collect()
        seconds.append(time.perf_counter() - start)
        assert [r["text"].strip() for r in sorted(rows, key=lambda r: r["chapter_num"])] == texts
    # quadratic work would take four times as long
    assert seconds[2] < 3 * seconds[1] + 2


def test_books_are_not_moved_by_their_kind(spark, tmp_path):
    names = [f"b{i}" for i in range(40)]
    rows = [("one", n, f"*** START OF THE PROJECT GUTENBERG EBOOK X ***\n{n} body\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\n") for n in names]
    spark.createDataFrame(rows, "kind string, book string, raw string").repartition(4).write.parquet(str(tmp_path / "books"))
    books = spark.read.parquet(str(tmp_path / "books"))
    patterns = spark.createDataFrame([("one", "{00}"), ("two", "x")], "kind string, pattern string")
    dump = st.section_dump(st.find_headers(st.read_structure(books), patterns, "kind"), ["book"])
    assert {r["book"] for r in dump.collect()} == set(names)
    plan = dump._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
