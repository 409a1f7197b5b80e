"""Texts with much alike sets of word shingles: all pairs with a Jaccard index of 0.8 or more.

Shingles are put in one order for all texts, rare ones before frequent ones. Two sets with
an index of 0.8 share one of the first ``n // 5 + 1`` of their ``n`` shingles, so only
these are brought together, and every pair of that index is found. The texts that hold a
shingle are counted over all texts, and the order goes by the power of two that the count reaches. A
shingle of one text only brings nothing together and is left out. What reaches a power is
passed on as a bit table of bounded size; where one fills up, a shingle may count as more
frequent than it is. Any order finds the same pairs, a good one brings fewer other texts together.

In a group that shares a shingle, all are compared with one first: the text with the fewest
shingles before the shared one, which is the original rather than one of its edited copies. Those that now
are in its component need no comparison with each other, so a large group of copies costs one
comparison each; the others are compared with all that are in other components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, LongType

from penprint.llm.common import bit_table, in_table, slices, text_bytes
from penprint.llm.components import components
from penprint.session import staged

WIDTH = 5
SEED = 42
# powers of two up to this one tell shingles apart by the number of their texts
LEVELS = 12
# bits of a table for each shingle in it, and the most it has (as a power of two)
TABLE_BITS, MOST_BITS = 16, 29
# shingles that are counted in one group, and bytes of text that a task counts at once
GROUP = 4_000_000
SLICE = 4 << 20
# a shingle of more texts of a slice counts as this many of them
_REPEATS = 64
# longs of parity bits per text
BIT_WORDS = 16
# row numbers that are copied to all tasks at most; more are joined by a shuffle
COPIED_ROWS = 2_000_000


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of the word shingles of a text in order; a shorter text is one shingle, one without words has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(flat, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[width - 1 :].tolist())
    return np.fromiter((digest(flat[a:b], SEED) for a, b in spans), np.uint64, len(words) - width + 1)


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Distinct shingle hashes as signed numbers in order."""
    return np.unique(shingle_hashes(text, width).view(np.int64))


def place_of(shingles: np.ndarray) -> np.ndarray:
    """The upper 44 bits of shingles, by which they are counted."""
    return shingles.view(np.uint64) >> np.uint64(20)


def levels_of(shingles: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """For each shingle the number of tables, from the first on, that know it: 0 if only one text has it."""
    level = np.zeros(len(shingles), np.int64)
    left, places = np.arange(len(shingles)), place_of(shingles)
    for table in tables:
        left = left[in_table(table, places[left])]
        level[left] += 1
    return level


def prefix_of(shingles: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of a set in the common order that other texts may have, and their places in that order."""
    level = levels_of(shingles, tables)
    order = np.lexsort((shingles, level))[: len(shingles) // 5 + 1 if len(shingles) else 0]
    places = np.flatnonzero(level[order] > 0)
    return shingles[order[places]], places


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each of ``64 * BIT_WORDS`` classes of hashes, a bit: whether a set has an odd number of them."""
    counts = np.bincount(shingles & (64 * BIT_WORDS - 1), minlength=64 * BIT_WORDS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([np.zeros(0, np.int64), *arrays])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))


@arrow_udf(ArrayType(LongType()))
def _sets(text: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    return _lists([shingle_set(t) for t in text_bytes(batch)])


def _prefixes(tables):
    @arrow_udf("struct<n: bigint, first: array<bigint>, pos: array<bigint>, bits: array<bigint>>")
    def run(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        sizes, firsts, places, bits = [], [], [], []
        for t in text_bytes(batch):
            shingles = shingle_set(t)
            first, place = prefix_of(shingles, tables.value)
            sizes.append(len(shingles))
            firsts.append(first)
            places.append(place)
            bits.append(parities(shingles))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), _lists(firsts), _lists(places), _lists(bits)], ["n", "first", "pos", "bits"]
        )

    return run


def shared_places(docs: DataFrame) -> DataFrame:
    """``place, level`` of the shingles of two texts or more; the level is the power of two that their number reaches.

    A task counts the shingles of a slice of texts and sends their places, by their groups, in one binary.
    """
    # words have two letters and a blank at least in most texts; the number only sets the size of a group
    letters = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    bits = min(max((letters // 3 // GROUP).bit_length(), 4), 20)
    down = np.uint64(44 - bits)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sets = [shingle_set(t) for t in text_bytes(part)]
                places, n = np.unique(place_of(np.concatenate([np.zeros(0, np.int64), *sets])), return_counts=True)
                places = np.repeat(places, np.minimum(n, _REPEATS))
                # sorted, so groups follow each other
                group = (places >> down).astype(np.int64)
                heads = np.flatnonzero(np.diff(group, prepend=-1))
                cuts = [*heads.tolist(), len(places)]
                low = (places & ((np.uint64(1) << down) - np.uint64(1))).astype(np.uint64)
                low = low.view(np.uint8).reshape(-1, 8)[:, :_width(bits)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[heads]), pa.array([low[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                    ["part", "places"],
                )

    def merged(table: pa.Table) -> pa.Table:
        own = np.frombuffer(b"".join(table.column("places").to_pylist()), np.uint8).reshape(-1, _width(bits))
        whole = np.zeros((len(own), 8), np.uint8)
        whole[:, : _width(bits)] = own
        found, n = np.unique(whole.view(np.uint64).ravel(), return_counts=True)
        found, n = found[n > 1], n[n > 1]
        found |= np.uint64(table.column("part")[0].as_py()) << down
        level = np.minimum(np.log2(n).astype(np.int64), LEVELS)
        return pa.table({"place": pa.array(found.astype(np.int64)), "level": pa.array(level)})

    sent = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(counted, "part bigint, places binary")
    return sent.groupBy("part").applyInArrow(merged, "place bigint, level bigint")


def _width(bits: int) -> int:
    """Bytes of a place without its first bits."""
    return -(-(44 - bits) // 8)


def level_tables(docs: DataFrame) -> list[np.ndarray]:
    """A bit table for each level that some shingle reaches, of the shingles that reach it."""
    found = staged(shared_places(docs), "shared-places")
    sizes = dict(found.groupBy("level").count().collect())
    tables = []
    for level in range(1, max(sizes, default=0) + 1):
        n = sum(k for own, k in sizes.items() if own >= level)
        bits = min(max((TABLE_BITS * n).bit_length(), 6), MOST_BITS)
        place = F.col("place").bitwiseAND(F.lit((1 << bits) - 1))
        tables.append(bit_table(found.where(F.col("level") >= level).select(place.alias("place")), bits))
    return tables


def with_prefixes(docs: DataFrame, name: str) -> DataFrame:
    """Add a struct ``name``: the size ``n`` of each text's set, its ``first`` shingles, their ``pos`` and parity ``bits``."""
    tables = docs.sparkSession.sparkContext.broadcast(level_tables(docs))
    return docs.withColumn(name, _prefixes(tables)("text"))


def of_rows(table: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``table`` joined with written row numbers, by their column; its texts are not shuffled for a few of them."""
    return table.join(F.broadcast(rows) if rows.count() <= COPIED_ROWS else rows, rows.columns[0], how)


def _may_be_alike(a: Column, b: Column) -> Column:
    # no shingle before a pair's first common one is shared: what follows bounds the overlap
    return 9 * F.least(a.n - a.pos, b.n - b.pos) >= 4 * (a.n + b.n)


def _pairs(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _rows(pairs: DataFrame) -> DataFrame:
    return staged(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "candidates")


def _both(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """``pairs`` with the ``value`` of each row as ``x`` and ``y``."""
    first = values.select(F.col("row").alias("a"), F.col("value").alias("x"))
    return pairs.join(first, "a").join(values.select(F.col("row").alias("b"), F.col("value").alias("y")), "b")


def _alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the written ``pairs`` of rows whose sets have an index of 0.8 or more.

    Parity bits differ for at most as many classes as there are shingles in one set only,
    so most other pairs are left out before whole sets are brought together.
    """
    x, y = F.col("x"), F.col("y")
    prefixes = of_rows(texts.select("row", F.struct("prefix.n", "prefix.bits").alias("value")), _rows(pairs), "left_semi")
    unlike = F.aggregate(
        F.zip_with(x.bits, y.bits, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, k: n + k
    )
    close = _both(pairs, staged(prefixes, "bits")).where(9 * unlike <= x.n + y.n).select("a", "b")
    close = staged(close, "close")
    sets = of_rows(texts.select("row", "text"), _rows(close), "left_semi").select("row", _sets("text").alias("value"))
    shared = F.size(F.array_intersect("x", "y"))
    return _both(close, staged(sets, "sets")).where(9 * shared >= 4 * (F.size("x") + F.size("y"))).select("a", "b")


def checked_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the ``pairs`` of rows, columns ``a`` and ``b``, that have an index of 0.8 or more."""
    return _alike(staged(pairs.select(*_pairs(F.col("a"), F.col("b"))).distinct(), "pairs"), texts)


def alike_links(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` of rows, with the components of all pairs of an index of 0.8 or more.

    ``texts`` is a written table with ``row``, ``text`` and ``prefix`` (see ``with_prefixes``), ``known`` one of
    checked links: texts that these bring together are not compared with each other. Texts without words are alike.
    """
    entries = (
        texts.select("row", F.col("prefix.n").alias("n"), F.inline(F.arrays_zip("prefix.pos", F.col("prefix.first").alias("key"))))
        .select("key", F.struct("row", "n", "pos").alias("own"))
        .repartition("key")  # both sides of the join below read this one shuffle
    )
    nearest = F.min_by("own", F.struct("own.pos", "own.row"))
    groups = entries.groupBy("key").agg(nearest.alias("first"), F.count("*").alias("texts"))
    shared = staged(entries.join(groups.where("texts > 1"), "key"), "shared")
    own, first = F.col("own"), F.col("first")
    near = shared.where((own.row != first.row) & _may_be_alike(own, first)).select(*_pairs(own.row, first.row)).distinct()
    group = staged(components(known), "components")
    for end in ("a", "b"):
        near = near.join(group.select(F.col("node").alias(end), F.col("root").alias(f"{end}_group")), end, "left")
    apart = F.coalesce("a_group", "a") != F.coalesce("b_group", "b")
    tested = staged(near.where(apart).select("a", "b"), "pairs")
    links = staged(known.select("a", "b").union(_alike(tested, texts)), "alike")

    # what is left: pairs across components, at least one of them not in that of the first
    roots = staged(components(links), "components")

    def root(name: str) -> DataFrame:
        return roots.select(F.col("node").alias(f"{name}_node"), F.col("root").alias(f"{name}_root"))

    many = shared.where("texts > 2")
    many = many.join(root("own"), F.col("own.row") == F.col("own_node"), "left")
    many = many.join(root("first"), F.col("first.row") == F.col("first_node"), "left")
    many = staged(
        many.select(
            "key",
            "own",
            F.coalesce("own_root", "own.row").alias("root"),
            F.coalesce("first_root", "first.row").alias("first_root"),
        ),
        "rooted",
    )
    outside = many.where("root != first_root").select("key", F.col("own").alias("x"), F.col("root").alias("x_root"))
    x, y = F.col("x"), F.col("own")
    across = outside.join(many.select("key", "own", "root"), "key").where(
        (F.col("x_root") != F.col("root")) & _may_be_alike(x, y)
    )
    rest = staged(across.select(*_pairs(x.row, y.row)).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
    links = links.union(_alike(rest, texts))

    empty = texts.where("prefix.n = 0").select("row")
    least = empty.agg(F.min("row").alias("a"))
    return links.union(empty.crossJoin(F.broadcast(least)).select("a", F.col("row").alias("b")))
