"""Text to text and text to tokens."""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from penprint.functions import lexicon as lex

_TERMS_AT_ONCE = 1 << 20
_PAIRS = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int32())]))

# tasks may run without this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def strip_ends(text: Column) -> Column:
    """Remove white space from both ends."""
    return F.btrim(text, F.lit(lex.WHITESPACE))


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def contains_any(text: Column, pieces) -> Column:
    """Whether one of the strings is part of the text."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in pieces])


def apply_rules(text: Column, rules, flags: str = lex.FLAGS) -> Column:
    """Apply (pattern, replacement, needed strings) rules one after the other.

    A plain search for the needed strings is much cheaper than the pattern, so
    a rule that cannot match a text is skipped for it.
    """

    def step(value, rule):
        pattern, replacement, needed = rule
        if not needed:
            return F.regexp_replace(value, flags + pattern, replacement)
        return bound(
            value,
            lambda t: F.when(
                contains_any(t, needed), F.regexp_replace(t, flags + pattern, replacement)
            ).otherwise(t),
        )

    return reduce(step, rules, text)


def normalize(text: Column, rules=lex.NORMALIZE_RULES) -> Column:
    """Remove notes, drawings, numbers and odd characters; strip the ends."""
    return strip_ends(apply_rules(text, rules))


def normalize_compact(text: Column) -> Column:
    """The shorter rule list, for texts to be scored."""
    return normalize(text, lex.COMPACT_RULES)


def expand_contractions(text: Column) -> Column:
    """``don't`` to ``do not`` and the like, by rule; texts without an apostrophe pass as they are."""
    words = [(lex.WORD_START + p + lex.WORD_END, r, n) for p, r, n in lex.CONTRACTED_WORDS]
    endings = [(p + lex.WORD_END, r, n) for p, r, n in lex.CONTRACTED_ENDINGS]
    return bound(
        text,
        lambda t: F.when(
            F.contains(t, F.lit("'")), apply_rules(t, words + endings, flags="")
        ).otherwise(t),
    )


def clean(text: Column, rules=lex.NORMALIZE_RULES) -> Column:
    """Normalise, then expand contractions."""
    return expand_contractions(normalize(text, rules))


def raw_tokens(text: Column) -> Column:
    """Words and punctuation marks in their own case."""
    return F.regexp_extract_all(text, F.lit(lex.TOKEN), F.lit(0))


def drop_punctuation(tokens: Column) -> Column:
    """Remove tokens that are a piece of the punctuation string; ``--`` and ``...`` stay."""
    return F.filter(tokens, lambda t: F.instr(F.lit(lex.PUNCTUATION), t) == 0)


def drop_stop_words(tokens: Column, fold_case: bool = False) -> Column:
    """Remove English stop words; ``The`` stays unless ``fold_case``."""
    return F.filter(
        tokens, lambda t: ~(F.lower(t) if fold_case else t).isin(*lex.STOP_WORDS)
    )


def word_tokens(
    text: Column,
    keep_punctuation: bool = True,
    remove_stopwords: bool = False,
    fold_case: bool = False,
) -> Column:
    """Lower-case tokens of cleaned text; filters look at the original case."""
    tokens = raw_tokens(text)
    if not keep_punctuation:
        tokens = drop_punctuation(tokens)
    if remove_stopwords:
        tokens = drop_stop_words(tokens, fold_case)
    return F.transform(tokens, F.lower)


def terms(text: Column) -> Column:
    """Feature terms: lower case, runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(lex.TERM), F.lit(0))


def space_words(text: Column) -> Column:
    """White-space separated words, empty ones removed."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def naive_word_count(text: Column) -> Column:
    """Number of pieces between single spaces that hold more than white space."""
    return F.size(F.filter(F.split(text, " "), lambda w: strip_ends(w) != ""))


def fix_hyphen_tail(text: Column) -> Column:
    """Remove a hyphen between a word character and white space."""
    return F.regexp_replace(text, rf"([\p{{L}}\p{{N}}_])-{lex.SPACE}", "$1 ")


def _text_ids(lists: pa.ListArray) -> np.ndarray:
    """The row of each element of the flattened lists."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes)


def _lists(values: pa.Array, rows: np.ndarray, absent: np.ndarray) -> pa.ListArray:
    """One list per row of the values, whose rows are in order; null where ``absent``."""
    offsets = np.searchsorted(rows, np.arange(len(absent) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(absent))


def _grams(low: int, high: int):
    def run(words: pa.Array) -> pa.Array:
        flat, rows = words.flatten(), _text_ids(words)
        grams, owners = [flat.slice(0, 0)], [rows[:0]]
        for n in range(low, high + 1):
            # the places that n words of the same text begin at
            at = np.flatnonzero(rows[n - 1 :] == rows[: len(rows) - n + 1]) if n > 1 else np.arange(len(rows))
            parts = [flat.take(pa.array(at + i)) for i in range(n)]
            grams.append(pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0])
            owners.append(rows[at])
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        values = pa.concat_arrays(grams).take(pa.array(order))
        return _lists(values, owner[order], pc.is_null(words).to_numpy(zero_copy_only=False))

    return run


def ngrams(words: Column, low: int, high: int) -> Column:
    """All n-grams of ``low`` to ``high`` words, the shorter ones first.

    Made from whole columns of a batch of texts; lambdas take several times as long.
    """
    return F.arrow_udf(_grams(max(low, 1), high), "array<string>")(words)


def _counted(terms: pa.Array) -> pa.Array:
    terms = terms.cast(pa.list_(pa.string()))
    sizes = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
    # texts in parts of a bounded number of terms
    part_of = np.cumsum(sizes) // _TERMS_AT_ONCE
    edges = [*np.flatnonzero(np.diff(part_of, prepend=-1)).tolist(), len(terms)]
    out = [pa.array([], _PAIRS)]
    for start, stop in zip(edges, edges[1:]):
        part = terms.slice(start, stop - start)
        coded = part.flatten().dictionary_encode()
        present = coded.is_valid().to_numpy(zero_copy_only=False)
        rows = _text_ids(part)[present]
        code = coded.indices.drop_null().to_numpy()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        pairs, n = np.unique(rows * len(order) + rank[code], return_counts=True)
        text, term = np.divmod(pairs, max(len(order), 1))
        names = coded.dictionary.take(pa.array(order[term]))
        values = pa.StructArray.from_arrays([names, pa.array(n.astype(np.int32))], fields=list(_PAIRS.value_type.fields))
        out.append(_lists(values, text, ~np.isin(np.arange(len(part)), text)))
    return pa.concat_arrays(out)


def term_frequencies(terms: Column) -> Column:
    """Array of (term, n): each distinct term with its number of occurrences, in the order of the term.

    Null without any term; null terms do not count. The counting stays inside the row: the terms
    of a batch of texts are numbered, and the pairs of text and number counted.
    """
    return F.arrow_udf(_counted, "array<struct<term:string,n:int>>")(terms)


def term_places(terms: Column) -> Column:
    """Array of (word, places): each distinct term with the places where it stands, from 0, in order.

    Like :func:`term_frequencies` it sorts the list and cuts it into runs. Null counts as empty.
    """
    none = F.array().cast("array<struct<word:string,places:array<int>>>")
    pairs = F.transform(terms, lambda t, i: F.struct(t.alias("word"), i.alias("place")))

    def runs(ordered):
        starts = F.filter(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: (i == 1) | (F.get(ordered, i - 1)["word"] != F.get(ordered, i - 2)["word"]),
        )

        def cut(starts):
            def run(start, k):
                stop = F.coalesce(F.get(starts, k + 1), F.size(ordered) + 1)
                places = F.transform(F.slice(ordered, start, stop - start), lambda x: x["place"])
                return F.struct(F.get(ordered, start - 1)["word"].alias("word"), places.alias("places"))

            return F.transform(starts, run)

        return F.when(F.size(ordered) > 0, bound(starts, cut)).otherwise(none)

    return F.coalesce(bound(F.sort_array(pairs), runs), none)
