"""Web archives: write captures as WARC records, read them back, index their history.

Writing is Spark's text writer with the record end as line separator, so archives can
lie in any store that Spark writes to. Each file is one gzip stream of records. Reading
takes whole files (their number of records is bounded when they are written) and
follows the lengths in the record headers.

The index of captures is made by external merging. Reading a file gives a run, sorted by
URL key, time and page. Runs are dealt to key ranges, and in each range a loser tree
merges them; ranges follow each other, so the whole is in global order. Ranges include
time and page, so a URL with very many captures is cut like any other stretch of keys.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.session import new_path, staged

LEAST_BYTES = 100
FILE_RECORDS = 2000
RANGE_ROWS = 500_000
FIRST_TIME = 1_600_000_000
END = "\r\n\r\n"

_CAPTURE = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("url_key", pa.string()), ("captured", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_id", pa.string()), ("file", pa.string()), ("at", pa.int64()),
    ]
)
_CAPTURE_DDL = (
    "page_id long, url string, url_key string, captured string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, record_id string, file string, at long"
)
_ORDER = ("url_key", "captured", "page_id", "payload_digest", "file", "at")


# --- writing ----------------------------------------------------------------


def with_payload(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its bytes and its digest; null html is an empty payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )


def revisits(payloads: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id and digest of the records that repeat an earlier payload, and the page that has it."""
    small = staged(payloads.select("page_id", "digest", "bytes").where(F.col("bytes") >= least), "payloads")
    groups = small.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    shared = staged(groups.where("n > 1").drop("n"), "payload-groups")
    return staged(
        small.join(shared, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to").distinct(),
        "revisits",
    )


def _line(name: str, value) -> F.Column:
    """A header line, or nothing when the value is null."""
    value = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """One WARC record per page, without its end, as column ``value``.

    Of pages with equal payloads of at least ``least`` bytes the smallest page_id is a
    response and the others revisit it, without the payload.
    """
    payloads = with_payload(pages)
    repeated = revisits(payloads, least)
    same = payloads["page_id"].eqNullSafe(repeated["_page"]) & (payloads["digest"] == repeated["_digest"])
    rows = payloads.join(repeated, same, "left")
    again = F.col("_digest").isNotNull()
    length = F.col("bytes").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit(END)
    )
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    page = F.col("page_id").cast("string")
    time = F.timestamp_seconds(F.lit(FIRST_TIME) + F.coalesce(F.pmod("page_id", F.lit(1 << 30)), F.lit(0)))
    name = F.md5(F.concat_ws("|", page, F.col("digest"), F.monotonically_increasing_id().cast("string")))
    uuid = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))),
        _line("WARC-Date", F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line(
            "WARC-Profile",
            F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ),
        _line("WARC-Refers-To-Page", F.col("refers_to").cast("string")),
        _line("WARC-Page", page),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(head, F.lit("\r\n"), block).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, file_records: int = FILE_RECORDS) -> None:
    """Write the captures to gzip-compressed WARC files of at most ``file_records`` records."""
    records(pages, least).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", file_records
    ).text(path)


# --- reading ----------------------------------------------------------------


def url_key(url: str | None) -> str:
    """Sort key of a URL: host parts from the right, then path and query, without scheme and fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, headers and block of each record; lengths in the headers lead from one to the next."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} has no end")
        yield at, headers, data[start:stop]
        at = stop + 4


def inflated(raw: bytes) -> bytes:
    """The records of an archive that is plain or has any number of gzip members."""
    if not raw.startswith(b"\x1f\x8b"):
        return raw
    parts = []
    while raw:
        member = zlib.decompressobj(31)
        parts += [member.decompress(raw), member.flush()]
        if not member.eof:
            raise ValueError("a gzip member has no end")
        # anything but another member is padding
        raw = member.unused_data if member.unused_data.startswith(b"\x1f\x8b") else b""
    return b"".join(parts)


def _capture(file: str, at: int, headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = headers.get("WARC-Payload-Digest", "")
    digest = digest.removeprefix("sha256:") if digest.startswith("sha256:") else None
    kind = headers["WARC-Type"]
    if kind == "response":
        found = hashlib.sha256(payload).hexdigest()
        if digest is not None and found != digest:
            raise ValueError(f"{file} at {at}: payload does not match its digest")
        size, digest = len(payload), found
    else:
        length = re.search(rb"(?i)Content-Length: *(\d+)", head)
        size = int(length[1]) if length else None
    page, first, url = headers.get("WARC-Page"), headers.get("WARC-Refers-To-Page"), headers.get("WARC-Target-URI")
    return (
        int(page) if page is not None else None, url, url_key(url), headers["WARC-Date"], kind,
        int(first) if first is not None else None, size, digest, headers["WARC-Record-ID"], file, at,
    )


def order_of(row: tuple, places: tuple[int, ...]) -> tuple:
    """Comparable key of a capture; nulls come first."""
    return tuple((row[i] is not None, row[i]) for i in places)


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places = tuple(_CAPTURE.get_field_index(n) for n in _ORDER)
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            file = path.as_py().rsplit("/", 1)[-1]
            # archives of other writers hold further kinds of records
            found = parse_records(inflated(content.as_py()))
            run = [_capture(file, *record) for record in found if record[1]["WARC-Type"] in ("response", "revisit")]
            run.sort(key=lambda row: order_of(row, places))
            if run:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in zip(zip(*run), _CAPTURE)], schema=_CAPTURE
                )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures in all archives of a folder; those of one file are a sorted run.

    Archives may be plain or compressed, by record or as a whole. Records that are no
    captures are left out. Digests are SHA-256; a revisit with another kind of digest has none.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read_files, _CAPTURE_DDL)


# --- merging ----------------------------------------------------------------


class LoserTree:
    """Merges sorted iterators of (key, value): each inner place holds the loser of its match."""

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        k = len(self.runs)
        self.tree = [-1] * max(k, 1)  # place 0 is the winner
        for i in range(k):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, i: int) -> None:
        place = (i + len(self.runs)) // 2
        while place > 0:
            other = self.tree[place]
            if other < 0:
                self.tree[place] = i  # waits for its opponent
                return
            if self._before(other, i):
                self.tree[place], i = i, other
            place //= 2
        self.tree[0] = i

    def __iter__(self):
        while self.runs and self.heads[self.tree[0]] is not None:
            winner = self.tree[0]
            yield self.heads[winner][1]
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of one key range, which come one after the other."""
    places = tuple(_CAPTURE.get_field_index(n) for n in _ORDER)
    file = _CAPTURE.get_field_index("file")
    runs: list[list[tuple]] = []
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            if not runs or runs[-1][-1][file] != row[file]:
                runs.append([])
            runs[-1].append(row)
    merged: list[tuple] = []

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*merged), _CAPTURE)], schema=_CAPTURE
        )

    for row in LoserTree([((order_of(r, places), r) for r in run) for run in runs]):
        merged.append(row)
        if len(merged) == 10_000:
            yield rows()
            merged.clear()
    if merged:
        yield rows()


def merged_history(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures in global order of URL key, time and page, with ``capture_order`` that rises along it.

    ``runs`` is written data; a file's captures form one run. Key ranges hold about
    ``range_rows`` rows, whatever the number of captures of one URL.
    """
    ranges = max(1, -(-runs.count() // range_rows), int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = runs.repartitionByRange(ranges, *_ORDER).sortWithinPartitions("file", *_ORDER)
    return dealt.mapInArrow(_merge, _CAPTURE_DDL).withColumn("capture_order", F.monotonically_increasing_id())


def archive(pages: DataFrame, path: str | None = None, least: int = LEAST_BYTES) -> DataFrame:
    """Write pages to archives, read them back and give their merged history.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are not read. Null
    html is an empty payload, a null url or page_id is left out of the headers and comes
    back null. Repeated rows each give a record; a null page_id is never the one that
    others refer to. Columns: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url_key, captured, record_id, file, at, capture_order.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_archives(pages, path, least)
    history = merged_history(staged(read_archives(spark, path), "captures"))
    return history.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url_key", "captured", "record_id", "file", "at", "capture_order",
    )
