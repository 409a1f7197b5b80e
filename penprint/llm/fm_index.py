"""Benchmark passages in training texts, found with an FM-index per shard of documents.

A benchmark item gives windows of ``WIDTH`` words (a shorter item gives one window).
The texts of a shard are written as numbers of benchmark words; a word that the
benchmark lacks cannot be in a window, so only stretches of benchmark words that are as
long as the shortest window are indexed, with separators between them. The index is the
Burrows-Wheeler transform in a wavelet matrix with bit ranks, and text positions sampled
every few places. All windows are searched backwards at once, word by word; the
occurrences of those that are left are located by walking back to a sampled position.

Shards are slices of the Arrow batches of a task, so nothing is shuffled. The benchmark
is sent to the tasks in blocks of about ``BLOCK_BYTES``; one pass is made per block.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from penprint.llm.common import slices, text_bytes
from penprint.session import staged

WIDTH = 13
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
SAMPLE = 8
_LOCATE = 1 << 18

# bytes that are in words: digits, letters in lower case, all of non-ASCII characters
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


# --- index ------------------------------------------------------------------


class BitRanks:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    """Ranks and symbols of a sequence of numbers, one row of bits per binary digit."""

    def __init__(self, values: np.ndarray, digits: int):
        self.levels = []
        for d in range(digits - 1, -1, -1):
            bits = (values >> d) & 1
            self.levels.append((d, BitRanks(bits), len(values) - int(bits.sum())))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        start = np.zeros_like(at)
        for d, bits, zeros in self.levels:
            one = ((symbol >> d) & 1).astype(bool)
            low, high = bits.ones(start), bits.ones(at)
            start = np.where(one, zeros + low, start - low)
            at = np.where(one, zeros + high, at - high)
        return at - start

    def symbol_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its occurrences before it."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for d, bits, zeros in self.levels:
            one = bits.get(at).astype(bool)
            low, high = bits.ones(start), bits.ones(at)
            start = np.where(one, zeros + low, start - low)
            at = np.where(one, zeros + high, at - high)
            symbol |= one.astype(symbol.dtype) << d
        return symbol, at - start


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes; each 0 counts as a smaller symbol than all others, unlike any other 0."""
    n = len(text)
    ends = text == 0
    n_ends = int(ends.sum())
    rank = text.astype(np.int64) + n_ends
    rank[ends] = np.arange(n_ends)
    width = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[:-width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2
        if width >= n:
            return order


class FmIndex:
    """Backward search over a text of numbers in which 0 separates stretches; it ends with 0."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        order = suffix_order(text)
        last = text[order - 1]  # of the first suffix: the 0 at the end
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.size = len(text)
        self.bwt = WaveletMatrix(last.astype(np.int64), max(1, math.ceil(math.log2(symbols))))
        # walks stop at the latest where a stretch begins
        kept = (order % sample == 0) | (last == 0)
        self.kept = BitRanks(kept)
        self.positions = order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Patterns (rows of symbols) that occur: their numbers, and the ranges of their suffixes."""
        which = np.arange(len(patterns))
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[which, k]
            low = self.first[symbol] + self.bwt.rank(symbol, low)
            high = self.first[symbol] + self.bwt.rank(symbol, high)
            live = low < high
            which, low, high = which[live], low[live], high[live]
            if not len(which):
                break
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes."""
        out = np.empty(len(rows), np.int64)
        at, place = rows.copy(), np.arange(len(rows))
        steps = 0
        while len(place):
            hit = self.kept.get(at).astype(bool)
            out[place[hit]] = self.positions[self.kept.ones(at[hit])] + steps
            at, place = at[~hit], place[~hit]
            symbol, rank = self.bwt.symbol_rank(at)
            at = self.first[symbol] + rank
            steps += 1
        return out


# --- benchmark --------------------------------------------------------------


def benchmark_block(items: list[tuple[str, bytes]], width: int = WIDTH) -> dict:
    """Words of a block of items and their windows, by length, with the items of each window."""
    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for name, text in items:
        words = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        if words:
            span = min(width, len(words))
            for i in range(len(words) - span + 1):
                owners[tuple(words[i : i + span])].add(name)
    by_length: dict[int, list] = defaultdict(list)
    for window, names in owners.items():
        by_length[len(window)].append((window, sorted(names)))
    return {
        "numbers": numbers,
        "windows": {k: (np.array([w for w, _ in v], np.int64), [n for _, n in v]) for k, v in by_length.items()},
    }


def benchmark_blocks(benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> list[dict]:
    """The benchmark in blocks of about ``block_bytes`` of text. Null ids and texts count as empty."""
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text")
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    return [
        benchmark_block([(r.item, r.text.encode()) for r in rows.where(block == b).collect()], width)
        for b in range(blocks)
    ]


# --- search -----------------------------------------------------------------

_HITS = (
    "struct<n_words: bigint, n_hit: bigint, items: array<string>, "
    "spans: array<struct<start: bigint, stop: bigint>>>"
)
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def search_shard(texts: list[bytes], block: dict) -> list[dict]:
    """For each text: its words, the words inside windows, the items, and the merged spans of words."""
    get, windows = block["numbers"].get, block["windows"]
    coded = []
    for text in texts:
        words = words_of(text)
        coded.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
    sizes = np.array([len(c) for c in coded], np.int64)
    starts = np.cumsum(sizes) - sizes
    found = [{"n_words": int(n), "n_hit": 0, "items": [], "spans": []} for n in sizes]
    if not windows or not sizes.sum():
        return found
    flat = np.concatenate(coded)
    shortest = min(windows)

    # stretches of benchmark words within a text
    inside = flat > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    texts_begin = starts[sizes > 0]
    begins[texts_begin] = inside[texts_begin]
    first = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    text_ends = (starts + sizes - 1)[sizes > 0]
    stops[text_ends] = inside[text_ends]
    last = np.flatnonzero(stops)
    long = last - first + 1 >= shortest
    first, last = first[long], last[long]
    if not len(first):
        return found
    lengths = last - first + 1
    at = np.cumsum(lengths + 1) - lengths - 1
    text = np.zeros(int(lengths.sum()) + len(lengths), np.int64)
    origin = np.repeat(first - at, lengths + 1) + np.arange(len(text))
    keep = np.ones(len(text), bool)
    keep[at + lengths] = False
    text[keep] = flat[origin[keep]]

    index = FmIndex(text, len(block["numbers"]) + 1)
    change = np.zeros(len(flat) + 1, np.int64)
    owners: dict[int, set[str]] = defaultdict(set)
    for width, (patterns, names) in windows.items():
        which, low, high = index.search(patterns)
        counts = high - low
        for part in _parts(counts):
            n = counts[part]
            rows = np.repeat(low[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            places = origin[index.locate(rows)]
            np.add.at(change, places, 1)
            np.add.at(change, places + width, -1)
            docs = np.searchsorted(starts, places, side="right") - 1
            pairs = np.unique(np.stack([docs, np.repeat(which[part], n)]), axis=1)
            for doc, window in pairs.T.tolist():
                owners[doc].update(names[window])
    covered = np.cumsum(change)[:-1] > 0
    for doc, items in owners.items():
        own = covered[starts[doc] : starts[doc] + sizes[doc]].astype(np.int8)
        edges = np.flatnonzero(np.diff(own, prepend=0, append=0))
        found[doc] |= {
            "n_hit": int(own.sum()),
            "items": sorted(items),
            "spans": [{"start": a, "stop": b} for a, b in edges.reshape(-1, 2).tolist()],
        }
    return found


def _parts(counts: np.ndarray, limit: int = _LOCATE):
    """Slices of windows that occur about ``limit`` times together."""
    if len(counts):
        group = (np.cumsum(counts) - 1) // limit
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(counts)]):
            yield slice(a, b)


def _searcher(block):
    @arrow_udf(_HITS)
    def run(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        found = []
        for part in slices(batch, "text", SHARD_BYTES):
            found += search_shard(text_bytes(part), block.value)
        return pa.StructArray.from_arrays(
            [
                pa.array([f["n_words"] for f in found], pa.int64()),
                pa.array([f["n_hit"] for f in found], pa.int64()),
                pa.array([f["items"] for f in found], pa.list_(pa.string())),
                pa.array([f["spans"] for f in found], pa.list_(_SPAN)),
            ],
            ["n_words", "n_hit", "items", "spans"],
        )

    return run


def _covered(spans):
    """Words in a union of sorted spans, as a column."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("stop"))
    return F.aggregate(
        spans,
        start,
        lambda a, s: F.struct(
            (a.n + F.greatest(F.lit(0), s.stop - F.greatest(s.start, a.stop))).alias("n"),
            F.greatest(a.stop, s.stop).alias("stop"),
        ),
        lambda a: a.n,
    )


def with_hits(docs: DataFrame, benchmark: DataFrame, name: str, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add the column ``name``: n_words, n_hit, items and merged spans (of words) of each text.

    ``docs`` needs ``text``, ``benchmark`` needs ``item_id`` and ``text``; all other
    columns of ``docs`` are kept, but one called ``name`` is replaced. A null text has no words, an empty benchmark hits none.
    """
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(b) for b in benchmark_blocks(benchmark, width, block_bytes)]
    if len(blocks) == 1:
        return docs.withColumn(name, _searcher(blocks[0])("text"))
    row = name + "_row"
    while row in docs.columns:
        row = "_" + row
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    parts = None
    for block in blocks:
        part = staged(numbered.select(row, _searcher(block)("text").alias("f")), "hits")
        parts = part if parts is None else parts.union(part)
    spans = F.sort_array(F.flatten(F.collect_list("f.spans")))
    joined = parts.groupBy(row).agg(
        F.max("f.n_words").alias("n_words"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("f.items")))).alias("items"),
        spans.alias("spans"),
    )
    found = F.struct("n_words", _covered(F.col("spans")).alias("n_hit"), "items", "spans").alias(name)
    return numbered.join(joined.select(row, found), row).drop(row)


def contaminated(hits):
    """At least a twentieth of the words lies in benchmark windows."""
    return (hits.n_hit > 0) & (20 * hits.n_hit >= hits.n_words)
