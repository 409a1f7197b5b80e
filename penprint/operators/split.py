"""Reproducible splits: by row, by book, and into batches."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.functions import keys
from penprint.operators.ordering import running_totals
from penprint.session import staged


def split_rows(df: DataFrame, key: str, percent: int = 80) -> DataFrame:
    """Add ``is_train``, true for about ``percent`` per cent of the rows."""
    return df.withColumn("is_train", keys.is_train_row(F.col(key), percent))


def book_row_counts(
    df: DataFrame, author: str = "author_id", book: str = "book_id", text: str = "text"
) -> DataFrame:
    """Number of texts per author and book."""
    return df.groupBy(author, book).agg(F.count(text).alias("n_rows"))


def choose_test_books(
    counts: DataFrame, author: str, book: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Test books: one of each author, then more in hash order as long as the share of rows allows.

    ``counts`` has one row per book with ``n_rows``. A book that would exceed the share
    is skipped and smaller ones after it are still taken. In each round a running total
    takes all books up to the first that does not fit; books too large for what is left
    do not come back, so a few rounds reach the end of the order.
    """
    hashed = staged(
        counts.withColumn("_h", keys.hash_key(F.lit(seed), F.col(author), F.col(book))), "books"
    )
    first = hashed.groupBy(F.col(author).alias("_author")).agg(F.min("_h").alias("_first"))
    same = F.col(author).eqNullSafe(F.col("_author")) & (F.col("_h") == F.col("_first"))
    marked = staged(hashed.join(first, same, "left").drop("_author"), "books")
    total, fixed = marked.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("_first").isNotNull(), F.col("n_rows"))), F.lit(0)),
    ).first()
    taken = [marked.where(F.col("_first").isNotNull()).select(author, book)]
    left, after = math.floor(total * test_share) - fixed, ""
    while left >= 0:
        open_books = marked.where(
            F.col("_first").isNull() & (F.col("_h") > after) & (F.col("n_rows") <= left)
        ).select(author, book, "_h", "n_rows")
        running = staged(running_totals(open_books, "_h", {"_up_to": "n_rows"}), "filled")
        fits = running.where(F.col("_up_to") <= left)
        used, next_book = running.agg(
            F.max(F.when(F.col("_up_to") <= left, F.col("_up_to"))),
            F.min(F.when(F.col("_up_to") > left, F.col("_h"))),
        ).first()
        if used is not None:
            taken.append(fits.select(author, book))
            left -= used
        if next_book is None:
            break
        after = next_book
    return reduce(DataFrame.union, taken)


def split_by_book(
    df: DataFrame,
    author: str = "author_id",
    book: str = "book_id",
    text: str = "text",
    test_share: float = 0.2,
    seed: int = 42,
    margin: float | None = None,
) -> DataFrame:
    """Add ``is_train``: all rows of a book are on the same side.

    Every author has a test book. With a ``margin`` a share of test rows that is further
    from ``test_share`` is repaired by :func:`repair_test_books`, and an error if that
    does not reach it.
    """
    counts = book_row_counts(df, author, book, text)
    chosen = staged(choose_test_books(counts, author, book, test_share, seed), "test-books")
    if margin is not None:
        chosen, reached = repair_test_books(counts, chosen, author, book, test_share, margin, seed)
        if reached is not None and abs(reached - test_share) > margin:
            raise ValueError(f"the test books hold {reached:.4f} of the rows, not {test_share} within {margin}")
    picked = chosen.select(F.col(author).alias("_author"), F.col(book).alias("_book"))
    same = F.col(author).eqNullSafe(F.col("_author")) & F.col(book).eqNullSafe(F.col("_book"))
    flagged = df.join(picked.withColumn("_test", F.lit(True)), same, "left")
    return flagged.withColumn("is_train", F.col("_test").isNull()).drop("_test", "_author", "_book")


MOST_MOVES = 50


def best_exchange(out_sizes: list[int], in_sizes: list[int], gap: int) -> tuple[int, int, int] | None:
    """Sizes (distance, out, in), both lists sorted, whose exchange brings ``gap`` nearest to zero."""
    best, j = None, 0
    for size in out_sizes:
        # the wanted size grows with the one that leaves
        while j + 1 < len(in_sizes) and in_sizes[j + 1] <= size + gap:
            j += 1
        for k in (j, j + 1):
            if k < len(in_sizes):
                move = (abs(gap - (in_sizes[k] - size)), size, in_sizes[k])
                best = move if best is None or move < best else best
    return best


def repair_test_books(
    counts: DataFrame, chosen: DataFrame, author: str, book: str, test_share: float, margin: float, seed: int = 42
) -> tuple[DataFrame, float | None]:
    """Test books whose share of the rows lies within the margin, if moves lead there, and the share.

    A move adds a test book, takes one away, or exchanges two, and is the one that brings the
    share nearest to ``test_share``; equal ones go by the hash order of the books. Every author
    keeps a test book: the only one of an author goes only for another one of that author.
    Every move comes nearer, so the search ends, and it makes at most ``MOST_MOVES``.

    A move needs one pass over the books. For exchanges the driver holds one book per
    size, and the sizes add up to the rows at most, so there are no more than the square root of
    twice the rows.
    """
    picked = chosen.select(F.col(author).alias("_author"), F.col(book).alias("_book"), F.lit(True).alias("_test"))
    same = F.col(author).eqNullSafe(F.col("_author")) & F.col(book).eqNullSafe(F.col("_book"))
    books = counts.join(picked, same, "left").select(
        author,
        book,
        "n_rows",
        F.coalesce("_test", F.lit(False)).alias("_test"),
        keys.hash_key(F.lit(seed), F.col(author), F.col(book)).alias("_h"),
    )
    books = staged(books, "books")
    total, reached = books.agg(F.sum("n_rows"), F.sum(F.when(F.col("_test"), F.col("n_rows")).otherwise(0))).first()
    if not total:
        return chosen, None
    goal, moved = round(total * test_share), []
    while abs(reached / total - test_share) > margin and len(moved) < 2 * MOST_MOVES:
        move = _best_move(_after(books, moved), author, goal - reached)
        if move is None:
            break
        gained, changed = move
        reached, moved = reached + gained, moved + changed
    after = _after(books, moved).where("_test").select(author, book)
    return (staged(after, "test-books") if moved else chosen), reached / total


def _after(books: DataFrame, moved: list[str]) -> DataFrame:
    """The books after moves; a book that is moved twice is back."""
    odd = [h for h in set(moved) if moved.count(h) % 2]
    return books.withColumn("_test", F.col("_test") != F.col("_h").isin(odd)) if odd else books


def _best_move(books: DataFrame, author: str, gap: int) -> tuple[int, list[str]] | None:
    """Rows gained and hashes of the books of the best move; None if no move comes nearer. ``gap``: rows wanted."""
    tested = books.where("_test").groupBy(F.col(author).alias("_of"))
    only = tested.agg(F.count("*").alias("_tests"), F.first("n_rows").alias("_size"), F.first("_h").alias("_only"))
    rows = books.join(only, F.col(author).eqNullSafe(F.col("_of")), "left")
    n, free = F.col("n_rows"), F.col("_tests") > 1
    none = F.lit(None).cast("string")

    def move(allowed, gained, other):
        return F.when(
            allowed,
            F.struct(F.abs(gap - gained).alias("left"), gained.alias("gained"), F.col("_h").alias("h"), other.alias("other")),
        )

    single = F.array(
        move(~F.col("_test"), n, none),
        move(F.col("_test") & free, -n, none),
        move(~F.col("_test") & (F.col("_tests") == 1), n - F.col("_size"), F.col("_only")),
    )
    marked = staged(rows.select("n_rows", "_test", "_h", free.alias("_free"), F.array_min(F.array_compact(single)).alias("_move")), "moves")
    best = marked.agg(F.min("_move")).first()[0]
    per_size = marked.where("NOT _test OR _free").groupBy("_test", "n_rows").agg(F.min("_h").alias("h")).collect()
    out = {r["n_rows"]: r["h"] for r in per_size if r["_test"]}
    into = {r["n_rows"]: r["h"] for r in per_size if not r["_test"]}
    pair = best_exchange(sorted(out), sorted(into), gap)
    if pair is not None and (best is None or pair[0] < best["left"]):
        left, gained, changed = pair[0], pair[2] - pair[1], [out[pair[1]], into[pair[2]]]
    elif best is not None:
        left, gained, changed = best["left"], best["gained"], [h for h in (best["h"], best["other"]) if h is not None]
    else:
        return None
    return (gained, changed) if left < abs(gap) else None


def test_share(split: DataFrame) -> DataFrame:
    """Share of test rows reached by a split."""
    return split.agg(
        (F.sum(F.when(F.col("is_train"), 0).otherwise(1)) / F.count("*")).alias("test_share")
    )


def assign_batches(df: DataFrame, key: str, size: int = 16) -> DataFrame:
    """Add ``batch``: shuffled batches of ``size`` rows on average, without a sort."""
    count = F.greatest(F.ceil(df.agg(F.count("*").alias("n")).scalar() / size), F.lit(1))
    return df.withColumn("batch", keys.hash_bucket(F.col(key), count))
