"""N-grams of lists of words, counted as numbers.

Words are numbered within a part of the texts, n-grams by the number of their beginning and
that of their last word, so that a string is made once per distinct n-gram of a part.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# words of the texts that are counted together
PART_WORDS = 1_000_000
# counters that n-grams share by their hash, and those of them in a row
SLOTS, SLOTS_AT_ONCE = 1 << 20, 1 << 15

# tasks may run without this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def sizes_of(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def parts(batches: Iterator[pa.RecordBatch], column: int = 0, most: int = PART_WORDS) -> Iterator[pa.ListArray]:
    """The lists of a column, in parts of about ``most`` words; a part holds whole lists."""
    held, words = [], 0
    for batch in batches:
        lists = batch.column(column)
        part_of = (words + np.cumsum(sizes_of(lists))) // most
        edges = [0, *(np.flatnonzero(np.diff(part_of)) + 1).tolist(), len(lists)]
        for start, stop in zip(edges, edges[1:]):
            some = lists.slice(start, stop - start)
            held.append(some)
            words += int(sizes_of(some).sum())
            if words >= most:
                yield pa.concat_arrays(held)
                held, words = [], 0
    if held:
        yield pa.concat_arrays(held)


class Grams:
    """The n-grams of one size: of each, in the order of the texts, its number and text; a name and a hash per number."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, names: pa.Array, hashes: np.ndarray):
        self.ids, self.rows, self.names, self.hashes = ids, rows, names, hashes

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, number and occurrences of each distinct pair of text and n-gram, ordered by both."""
        width = max(len(self.names), 1)
        keys = np.sort(self.rows * width + self.ids)
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        text, gram = np.divmod(keys[first], width)
        return text, gram, np.diff(first, append=len(keys))


def grams_of(lists: pa.ListArray, low: int, high: int) -> Iterator[Grams]:
    """The n-grams of ``low`` to ``high`` words of each list, by size; those with a null word are left out."""
    coded = lists.flatten().dictionary_encode()
    # numbers in the order of the words: the same words give the same numbers, however the lists are ordered
    order = pc.sort_indices(coded.dictionary)
    words, width = coded.dictionary.take(order), max(len(order), 1)
    place = np.full(len(order) + 1, -1)
    place[order.to_numpy()] = np.arange(len(order))
    code = place[coded.indices.cast(pa.int64()).fill_null(len(order)).to_numpy(zero_copy_only=False)]
    rows = np.repeat(np.arange(len(lists)), sizes_of(lists))
    # of each place: the number of the n-gram that begins there, or -1
    at, names = code, words
    crc = np.array([zlib.crc32(w.encode()) for w in words.to_pylist()], np.uint64)
    hashes = crc
    for n in range(1, high + 1):
        if n > 1:
            last = code[n - 1 :]
            at = at[: len(last)]
            whole = (at >= 0) & (last >= 0) & (rows[n - 1 :] == rows[: len(last)])
            found, number = np.unique(at[whole] * width + last[whole], return_inverse=True)
            at = np.full(len(last), -1)
            at[whole] = number
            head, tail = np.divmod(found, width)
            names = pc.binary_join_element_wise(names.take(pa.array(head)), words.take(pa.array(tail)), " ")
            hashes = hashes[head] * np.uint64(0x9E3779B97F4A7C15) + crc[tail]
        if n >= low:
            valid = np.flatnonzero(at >= 0)
            yield Grams(at[valid], rows[valid], names, hashes)


def counts_task(low: int, high: int, with_total: bool):
    """Task that turns lists of words into ``term, cf, df`` by parts of them."""

    def batch(names, occurrences, texts):
        columns = [names, pa.array(occurrences, pa.int64()), pa.array(texts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["term", "cf", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in parts(batches):
            if with_total and len(lists):
                yield batch(pa.array([""]), [len(lists)], [len(lists)])
            for grams in grams_of(lists, low, high):
                occurrences = np.bincount(grams.ids, minlength=len(grams.names))
                texts = np.bincount(grams.pairs()[1], minlength=len(grams.names))
                yield batch(grams.names, occurrences, texts)

    return run


def _places(lists: pa.ListArray, listed: pa.Array | None = None):
    """The text and the code of each place (-1 if null or not listed), and a hash by code."""
    flat = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), sizes_of(lists))
    if listed is None:
        coded = flat.dictionary_encode()
        code, words = coded.indices.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False), coded.dictionary
    else:
        code, words = pc.index_in(flat, listed).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False), listed
    # the last one is that of -1, and of no use
    return rows, code, np.array([*(zlib.crc32(w.encode()) for w in words.to_pylist()), 0], np.uint64)


def _slots_of(rows: np.ndarray, code: np.ndarray, crc: np.ndarray, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By size from 2: the places at which an n-gram begins, and the counters of these n-grams."""
    at, hashes = np.flatnonzero(code >= 0), crc[code[code >= 0]]
    for n in range(2, high + 1):
        inside = at + n - 1 < len(code)
        at, hashes = at[inside], hashes[inside]
        last = code[at + n - 1]
        whole = (last >= 0) & (rows[at + n - 1] == rows[at])
        at, hashes = at[whole], hashes[whole] * np.uint64(0x9E3779B97F4A7C15) + crc[last[whole]]
        mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        yield n, at, (mixed >> np.uint64(40)).astype(np.int64) % SLOTS


def bounds_task(high: int):
    """Task that counts words as ``term, cf, df``, and n-grams of two words or more in counters that they share.

    Counters are rows without a term: ``slot`` is the number of the first one, ``counts`` holds them.
    """

    def batch(names, occurrences, texts, slots, counts):
        columns = [names, pa.array(occurrences, pa.int64()), pa.array(texts, pa.int64()), slots, counts]
        return pa.RecordBatch.from_arrays(columns, ["term", "cf", "df", "slot", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(SLOTS, np.int64)

        def words(names, occurrences, texts):
            return batch(names, occurrences, texts, pa.nulls(len(names), pa.int32()), pa.nulls(len(names), pa.binary()))

        for lists in parts(batches):
            if len(lists):
                yield words(pa.array([""]), [len(lists)], [len(lists)])
            rows, code, crc = _places(lists)
            for grams in grams_of(lists, 1, 1):
                occurrences = np.bincount(grams.ids, minlength=len(grams.names))
                yield words(grams.names, occurrences, np.bincount(grams.pairs()[1], minlength=len(grams.names)))
            for _, _, slots in _slots_of(rows, code, crc, high):
                counters += np.bincount(slots, minlength=SLOTS)
        for start in range(0, SLOTS, SLOTS_AT_ONCE):
            some = counters[start : start + SLOTS_AT_ONCE]
            if some.any():
                yield batch(
                    pa.nulls(1, pa.string()), [0], [0], pa.array([start], pa.int32()), pa.array([some.tobytes()], pa.binary())
                )

    return run


def sum_slots(table: pa.Table) -> pa.Table:
    """The sum of the counters of one ``slot``."""
    total = np.zeros(SLOTS_AT_ONCE, np.int64)
    for counts in table.column("counts").to_pylist():
        total += np.frombuffer(counts, np.int64)
    return pa.table({"slot": table.column("slot").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def likely_task(high: int, sent):
    """Task that counts the n-grams of two words or more whose words are listed and whose counter is high enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, enough = sent.value
        width = len(listed) + 1
        for lists in parts(batches):
            rows, code, crc = _places(lists, listed)
            for n, at, slots in _slots_of(rows, code, crc, high):
                at = at[enough[slots]]
                if not len(at):
                    continue
                # numbers of the beginnings, then of the n-grams
                gram, names = code[at], listed
                for k in range(1, n):
                    found, gram = np.unique(gram * width + code[at + k], return_inverse=True)
                    head, tail = np.divmod(found, width)
                    names = pc.binary_join_element_wise(names.take(pa.array(head)), listed.take(pa.array(tail)), " ")
                found = Grams(gram, rows[at], names, None)
                occurrences, texts = (np.bincount(x, minlength=len(names)) for x in (gram, found.pairs()[1]))
                yield pa.RecordBatch.from_arrays([names, pa.array(occurrences, pa.int64()), pa.array(texts, pa.int64())], ["term", "cf", "df"])

    return run


def phrase_slots(high: int):
    """Task that gives the counters of word lists that are n-grams of two to ``high`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in parts(batches):
            rows, code, crc = _places(lists)
            sizes = sizes_of(lists)
            for n, at, slots in _slots_of(rows, code, crc, high):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(slots[sizes[rows[at]] == n]), pa.int64())], ["slot"])

    return run


def sought_task(low: int, high: int, sent):
    """Task that counts the n-grams of ``low`` to ``high`` words as ``term, cf``, those that are surely not sought without their names.

    An n-gram of two words or more may be sought if its counter is marked; a row without a term counts all others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(names, occurrences):
            return pa.RecordBatch.from_arrays([names, pa.array(occurrences, pa.int64())], ["term", "cf"])

        for lists in parts(batches):
            if low <= 1:
                for grams in grams_of(lists, 1, 1):
                    yield batch(grams.names, np.bincount(grams.ids, minlength=len(grams.names)))
            rows, code, crc = _places(lists)
            names = lists.flatten()
            for n, at, slots in _slots_of(rows, code, crc, high):
                if n >= low:
                    likely = at[sent.value[slots]]
                    yield batch(pa.nulls(1, pa.string()), [len(at) - len(likely)])
                    words = [names.take(pa.array(likely + k)) for k in range(n)]
                    found = pc.value_counts(pc.binary_join_element_wise(*words, " "))
                    yield batch(found.field("values"), found.field("counts"))

    return run


def _cut(values: pa.Array, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)


def _words(table: pa.Table) -> pa.ListArray:
    """The words of each row, which come as one string between blanks."""
    texts = table.column("terms").combine_chunks()
    return pc.split_pattern(pc.if_else(pc.equal(texts, ""), pa.scalar(None, pa.string()), texts), " ")


def _by_bucket(found: Grams, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams in the order of their buckets, and these; the same for the same words."""
    bucket = ((found.hashes ^ (found.hashes >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def asked_task(low: int, high: int, buckets: int):
    """Task that lists the n-grams of a block of texts by buckets of their hash, with the texts that hold them."""

    def run(table: pa.Table) -> pa.Table:
        block, out = table.column("_block")[0].as_py(), []
        for n, found in enumerate(grams_of(_words(table), low, high), low):
            texts = np.bincount(found.pairs()[1], minlength=len(found.names))
            order, bucket = _by_bucket(found, buckets)
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            edges = np.append(first, len(order))
            columns = {
                "_bucket": pa.array(bucket[first], pa.int64()),
                "_block": pa.array(np.full(len(first), block, np.int64)),
                "words": pa.array(np.full(len(first), n, np.int32)),
                # one string, as a list of them takes twice the space
                "names": pc.binary_join(_cut(found.names.take(pa.array(order)), edges), "\n"),
                "texts": _cut(pa.array(texts[order], pa.int32()), edges),
            }
            out.append(pa.table(columns))
        return pa.concat_tables(out)

    return run


def answers_task(table: pa.Table) -> pa.Table:
    """The texts with an n-gram in all blocks, for those that more than one block holds: by block their places in the bucket."""
    column = {name: table.column(name).combine_chunks() for name in table.column_names}
    code = pc.split_pattern(column["names"], "\n").flatten().dictionary_encode().indices.to_numpy()
    sizes = sizes_of(column["texts"])
    # a block holds an n-gram once, so the numbers of texts add up and those of rows are of blocks
    texts = np.bincount(code, weights=column["texts"].flatten().to_numpy()).astype(np.int64)
    shared = np.flatnonzero(np.bincount(code)[code] > 1)
    row = np.repeat(np.arange(table.num_rows), sizes)[shared]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    edges, at = np.append(first, len(row)), shared - (np.cumsum(sizes) - sizes)[row]
    held = pa.array(row[first])
    return pa.table(
        {
            "_of": column["_block"].take(held),
            "bucket": column["_bucket"].take(held),
            "words": column["words"].take(held),
            "places": _cut(pa.array(at, pa.int32()), edges),
            "texts": _cut(pa.array(texts[code[shared]], pa.int32()), edges),
        }
    )


def tfidf_task(keep: list[str], low: int, high: int, buckets: int, documents: int):
    """Task that weighs the n-grams of a block of texts; rows that agree in ``keep`` are scaled together."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        key = np.zeros(table.num_rows, np.int64)
        for name in keep:
            codes = table.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            key = np.unique(key * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1].reshape(-1)
        rows, names, values = [], [], []
        squares = np.zeros(int(key.max(initial=-1)) + 1)
        for size, found in enumerate(grams_of(_words(table), low, high), low):
            row, gram, n = found.pairs()
            texts = np.bincount(gram, minlength=len(found.names))
            order, bucket = _by_bucket(found, buckets)
            told = answers.filter(pc.equal(answers.column("words"), size))
            places = told.column("places").combine_chunks()
            starts = np.searchsorted(bucket, told.column("bucket").to_numpy())
            at = np.repeat(starts, sizes_of(places)) + places.flatten().to_numpy()
            texts[order[at]] = told.column("texts").combine_chunks().flatten().to_numpy()
            x = n * (np.log((1 + documents) / (1 + texts)) + 1)[gram]
            squares += np.bincount(key[row], weights=x * x, minlength=len(squares))
            rows.append(row)
            names.append(found.names.take(pa.array(gram)))
            values.append(x)
        row = np.concatenate(rows)
        tfidf = np.concatenate(values) / np.sqrt(squares)[key[row]]
        kept = [table.column(k).take(pa.array(row)) for k in keep]
        return pa.Table.from_arrays([*kept, pa.chunked_array(names, pa.string()), pa.array(tfidf)], [*keep, "term", "tfidf"])

    return run
