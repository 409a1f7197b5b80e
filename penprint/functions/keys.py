"""Names, path parts, labels and hash-based choices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def author_slug(name: Column) -> Column:
    """``Sir Arthur C. Doyle`` to ``sir_arthur_c_doyle``."""
    return F.translate(F.lower(name), " .", "_")


def title_slug(title: Column) -> Column:
    """Lower case, space and colon to underscore, commas removed."""
    return F.translate(F.lower(title), " :,", "__")


def path_part(path: Column, from_end: int) -> Column:
    """The part of a path counted from its end, 1 = last; null when absent."""
    return F.try_element_at(F.split(F.translate(path, "\\", "/"), "/"), F.lit(-from_end))


def code_from_id(book_id: Column) -> Column:
    """``PG123`` to 123."""
    return F.substring(book_id, F.lit(3), F.length(book_id)).cast("int")


def binary_label(author: Column, target: str) -> Column:
    """1 for the target author, 0 for the others."""
    return F.coalesce((author == target).cast("int"), F.lit(0))


def class_label(author: Column, classes: dict[str, int]) -> Column:
    """Class number of an author; an unknown author is an error."""
    pairs = [F.lit(x) for pair in classes.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), author)
    return F.coalesce(
        found, F.raise_error(F.concat(F.lit("author without a class: "), author)).cast("int")
    )


def display_name(author: Column, names: dict[str, str]) -> Column:
    """The name to show for an author key, or the key itself."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), author), author)


def hash_key(*parts: Column) -> Column:
    """32 hexadecimal digits that depend only on the values of ``parts``; a null has its own place."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def hash_bucket(key: Column, buckets: int | Column) -> Column:
    """A bucket number below ``buckets`` that depends only on the key."""
    digits = F.substring(hash_key(key), 1, 15)
    return F.conv(digits, 16, 10).cast("long") % buckets


def is_train_row(key: Column, percent: int = 80) -> Column:
    """True for about ``percent`` per cent of keys, whatever the partitioning."""
    return hash_bucket(key, F.lit(100)) < percent
