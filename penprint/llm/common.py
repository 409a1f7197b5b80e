"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# word separators of the tokenisers here: blank and the control characters 9 to 13,
# the set that ``bytes.split`` uses as well
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(key: Column, folds: int) -> Column:
    """Fold number of a key: crc32 of its text; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def held_out(key: Column, folds: int, fold: int) -> Column:
    return fold_of(key, folds) == fold


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes; no row is cut."""
    if batch.num_rows == 0:
        return
    sizes = np.diff(text_offsets(batch.column(batch.schema.get_field_index(column))))
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)


def text_offsets(values: pa.Array) -> np.ndarray:
    """Byte offsets of the rows of a string or binary array."""
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(values.buffers()[1], dtype=kind)
    return raw[values.offset : values.offset + len(values) + 1].astype(np.int64)


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch in UTF-8; null counts as empty."""
    values = batch.column(batch.schema.get_field_index(column))
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return [x or b"" for x in values.cast(kind).to_pylist()]


def joined_bytes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch as one byte array, and the offsets of the rows in it. No nulls."""
    values = batch.column(batch.schema.get_field_index(column))
    offsets = text_offsets(values)
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def run_sums(data: np.ndarray, lengths: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit polynomial of each run of bytes; the runs follow each other and none is empty."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    powers = np.full(int(lengths.max()), base, np.uint64).cumprod(dtype=np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(data), dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    place -= np.repeat(first.astype(place.dtype), lengths)
    terms = powers[place]
    del place
    terms *= data.astype(np.uint64) + np.uint64(1)
    return np.add.reduceat(terms, first)


def bit_table(places: DataFrame, bits: int) -> np.ndarray:
    """A table of ``2 ** bits`` bits, at least 64, with those at the written ``place`` numbers set.

    The driver gets a long per 64 bits at most.
    """
    rows = places.selectExpr("shiftright(place, 6) AS at", "shiftleft(1L, cast(place & 63 AS int)) AS bit")
    found = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint8)


def in_table(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the bits at these places, counted modulo its size, are set."""
    place = places & np.uint64(8 * len(table) - 1)
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
