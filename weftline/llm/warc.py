"""WARC archives with payload dedup, and a two-level capture index.

Archives are plain WARC/1.1 files written by Spark's text writer (a record's last CRLF is the line
separator), so writing goes through the commit protocol and works on any store Spark can write to.
Reading is by ``Content-Length``, never by searching for markers that a payload could contain.

Index, two levels: a scan of the archives reads headers and steps over payloads, and gives one line per
capture, whose key is the reversed-host key of its URL and the page's id.  Lines sorted by key are cut into
compressed blocks; a sparse directory holds the first and last key of each block and, above it, of each
part of the sorted order.  A lookup searches the parts, then one part's directory, by bisection, opens
only the blocks it names and reads the records by byte range.  Single lookups run on the driver
(``CaptureIndex``); ``look_up`` resolves a table of keys on the executors, the keys of a part together, and
``read_ranges`` reads what was found, file by file.  The registered query gets its rows that way.

Executors read files through Arrow's file systems (local or mounted folders, HDFS, S3, GCS).

Dedup: of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest
page_id is a response and the others are revisits that refer to it.  Only digests are grouped (summed
on the map side); the groups with more than one page go back by a broadcast while they are few, else
by a join that Spark may split where a digest is hot.

Defined results: null html is an empty payload; a null page_id sorts last and is written without an
id; rows that repeat the smallest page_id with the same payload are all responses; a null url is an
empty URL; very long pages are one record each, of which only one is held at a time; a URL captured very
often is spread over blocks and parts by page; empty tables give an empty archive; columns other than
page_id, url and html are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyarrow import NativeFile
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.scratch import Scratch
from weftline.sources.stores import open_file

MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 4_000
BLOCK_LINES = 3_000
BROADCAST_ROWS = 100_000
#: Bytes that a scan reads at once, and rows that are handed on at once.
SCAN_BYTES, FRAME_ROWS = 1 << 20, 5_000
#: Fixed value: the profile of revisits by digest in the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SURT = re.compile(r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?(.*)$", re.IGNORECASE | re.DOTALL)


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then ``)`` and the rest; no scheme, user, www or fragment."""
    host, port, rest = _SURT.match(url or "").groups()
    labels = host.lower().strip(".").split(".")
    if len(labels) > 1 and re.fullmatch(r"www\d*", labels[0]):
        labels = labels[1:]
    port = f":{port}" if port and port not in ("80", "443") else ""
    return ",".join(reversed(labels)) + port + ")" + (rest.split("#")[0] or "/").lower()


def _header(url: Column) -> Column:
    """A URL that cannot end a header line."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", scratch: Scratch | None = None) -> DataFrame:
    """One column ``value``: a whole record per page, without its last CRLF."""
    scratch = scratch or Scratch(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), _header(F.col(url_col)).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html"))
    groups = scratch.write(
        rows.filter(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first"),
        "groups",
    )
    if groups.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    rows = rows.join(groups, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")), F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn(F.col("first")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit("\r\n\r\n"),
    )
    return rows.select(F.concat(head, block, F.lit("\r\n")).alias("value"))


def write_archives(recs: DataFrame, path: str) -> None:
    """Write records as ``*.txt`` files in WARC format, at most ``RECORDS_PER_FILE`` records a file."""
    recs.write.mode("overwrite").option("lineSep", "\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


PLACES = "file string, offset long, length long, url string, page_id long, record_type string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record begins with {lines[0][:40]!r}")
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])


def scan(f: NativeFile) -> Iterator[tuple[int, int, dict[str, str]]]:
    """(offset, length, headers) of each record of an archive; payloads are stepped over, so a file may be of any size."""
    at, size, base, data = 0, f.size(), 0, b""
    while at < size:
        if at >= base + len(data):
            base, data = at, b""
        end = data.find(b"\r\n\r\n", at - base)
        while end < 0:
            data, base = data[at - base :] + f.read_at(SCAN_BYTES, base + len(data)), at
            end = data.find(b"\r\n\r\n")
            if end < 0 and base + len(data) >= size:
                raise ValueError(f"a record at byte {at} has no end")
        headers = _headers(data[at - base : end])
        length = base + end + 4 + int(headers["Content-Length"]) + 4 - at
        yield at, length, headers
        at += length


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of the record that ``data`` begins with."""
    end = data.index(b"\r\n\r\n")
    headers = _headers(data[:end])
    return headers, data[end + 4 : end + 4 + int(headers["Content-Length"])]


def _urn(value: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(m[1]) if m else None


def _record(h: dict[str, str], block: bytes) -> tuple:
    """A row of ``RECORDS``."""
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"Content-Length: (\d+)", head)[1])
    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
    page, url = _urn(h["WARC-Record-ID"]), h["WARC-Target-URI"]
    if h["WARC-Type"] == "response":
        read = hashlib.sha256(payload).hexdigest()
        return page, url, len(payload), read, "response", None, read == digest and stated == len(payload)
    return page, url, stated, digest, "revisit", _urn(h["WARC-Refers-To"]), True


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    fields = [x.split() for x in schema.split(", ")]
    pdf = pd.DataFrame(rows, columns=[n for n, _ in fields], dtype=object)
    return pdf.astype({n: {"long": "Int64", "int": "Int32", "boolean": "boolean"}[k] for n, k in fields if k in ("long", "int", "boolean")})


def _framed(rows: Iterator[tuple], schema: str) -> Iterator[pd.DataFrame]:
    while some := list(itertools.islice(rows, FRAME_ROWS)):
        yield _frame(some, schema)


def _scan_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for pdf in batches:
            for file in pdf["path"]:
                with open_file(file) as f:
                    for offset, length, h in scan(f):
                        yield file, offset, length, h["WARC-Target-URI"], _urn(h["WARC-Record-ID"]), h["WARC-Type"]

    yield from _framed(rows(), PLACES)


def captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, by a scan of their headers (files are dealt out one by one)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    return files.filter("length > 0").repartition("path").mapInPandas(_scan_all, PLACES)


BLOCKS = "part int, block int, first_key string, last_key string, n long, data binary"


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, number, lines, keys = TaskContext.get().partitionId(), 0, [], []

    def block() -> pd.DataFrame:
        data = zlib.compress("\n".join(lines).encode("utf-8"))
        return pd.DataFrame([(part, number, keys[0], keys[-1], len(lines), data)], columns=[x.split()[0] for x in BLOCKS.split(", ")])

    for pdf in batches:
        for key, line in zip(pdf["key"], pdf["line"], strict=True):
            keys.append(key)
            lines.append(f"{key}\t{line}")
            if len(lines) >= BLOCK_LINES:
                yield block()
                number, lines, keys = number + 1, [], []
    if lines:
        yield block()


@F.pandas_udf(T.StringType())
def _surts(url: pd.Series) -> pd.Series:
    return url.map(surt)


def capture_key(url: Column, page_id: Column) -> Column:
    """What captures are sorted and looked up by."""
    return F.concat(F.regexp_replace(_surts(url), " ", "%20"), F.lit(" "), F.coalesce(page_id.cast("string"), F.lit("-")))


def write_index(places: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    """Sort captures by key and write compressed blocks with their directory columns."""
    line = F.to_json(F.struct("url", "page_id", "file", "offset", "length", "record_type"))
    rows = places.select(capture_key(F.col("url"), F.col("page_id")).alias("key"), "file", "offset", line.alias("line"))
    by = ("key", "file", "offset")
    ranged = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    blocks = ranged.sortWithinPartitions(*by).select("key", "line").mapInPandas(_pack, BLOCKS)
    blocks.write.mode("overwrite").parquet(path)
    return places.sparkSession.read.schema(BLOCKS).parquet(path)


ENTRIES = "key string, url string, page_id long, file string, offset long, length long, record_type string"


def _unpack_block(data: bytes) -> list[tuple]:
    """Capture lines of a block, in order of their keys."""
    out = []
    for line in zlib.decompress(data).decode("utf-8").split("\n"):
        key, _, rest = line.partition("\t")
        x = json.loads(rest)
        out.append((key, x["url"], x.get("page_id"), x["file"], x["offset"], x["length"], x["record_type"]))
    return out


def covering(spans: list[tuple], low: str, high: str) -> list[tuple]:
    """Spans (first, last, ...) that may hold a key from ``low`` to ``high``; spans are sorted and overlap only at their ends."""
    return spans[bisect_left(spans, low, key=lambda x: x[1]) : bisect_right(spans, high, key=lambda x: x[0])]


def part_spans(blocks: DataFrame) -> list[tuple[str, str, int]]:
    """(first key, last key, part) of each part of the index: as many rows as it was written by tasks."""
    found = blocks.groupBy("part").agg(F.min("first_key").alias("a"), F.max("last_key").alias("z")).collect()
    return sorted((r.a, r.z, r.part) for r in found)


def _look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of keys; the blocks of a part come before its keys, both in order."""

    def rows() -> Iterator[tuple]:
        part, directory, opened, lines = None, [], None, []
        for pdf in batches:
            for p, key, first, last, block, data in zip(pdf["part"], pdf["key"], pdf["first_key"], pdf["last_key"], pdf["block"], pdf["data"], strict=True):
                if p != part:
                    part, directory, opened = p, [], None
                if key is None:
                    directory.append((first, last, block, data))
                    continue
                for span in covering(directory, key, key):
                    if opened != span[2]:
                        opened, lines = span[2], _unpack_block(span[3])
                    at = bisect_left(lines, key, key=lambda x: x[0])
                    while at < len(lines) and lines[at][0] == key:
                        yield lines[at]
                        at += 1

    yield from _framed(rows(), ENTRIES)


def look_up(blocks: DataFrame, keys: DataFrame) -> DataFrame:
    """Capture entries of all keys of a table with one column ``key``."""
    parts = part_spans(blocks)

    @F.pandas_udf("array<int>")
    def parts_of(key: pd.Series) -> pd.Series:
        return key.map(lambda k: [p for _, _, p in covering(parts, k, k)])

    asked = keys.distinct().select("key", F.explode(parts_of("key")).alias("part"))
    directory = blocks.select("part", "block", "first_key", "last_key", "data", F.lit(None).cast("string").alias("key"))
    both = directory.unionByName(asked, allowMissingColumns=True)
    return both.repartition("part").sortWithinPartitions("part", F.col("key").isNotNull(), "block", "key").mapInPandas(_look_up, ENTRIES)


def _read_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        name, f = None, None
        try:
            for pdf in batches:
                for file, offset, length in zip(pdf["file"], pdf["offset"], pdf["length"], strict=True):
                    if file != name:
                        if f:
                            f.close()
                        name, f = file, open_file(file)
                    yield _record(*parse_record(f.read_at(int(length), int(offset))))
        finally:
            if f:
                f.close()

    yield from _framed(rows(), RECORDS)


def read_ranges(found: DataFrame) -> DataFrame:
    """The records of capture entries (file, offset, length), read by byte range, a file's in order."""
    ranges = found.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return ranges.mapInPandas(_read_all, RECORDS)


class CaptureIndex:
    """Lookups by URL from the driver: parts, then one part's directory, then blocks, then byte ranges."""

    def __init__(self, blocks: DataFrame):
        self.blocks, self.parts = blocks, part_spans(blocks)
        self._directory: dict[int, list[tuple[str, str, int]]] = {}

    def directory(self, part: int) -> list[tuple[str, str, int]]:
        """(first key, last key, block) of one part, in order; read when first needed."""
        if part not in self._directory:
            rows = self.blocks.filter(F.col("part") == part).select("first_key", "last_key", "block").collect()
            self._directory[part] = sorted((r.first_key, r.last_key, r.block) for r in rows)
        return self._directory[part]

    def captures(self, url: str) -> Iterator[tuple]:
        """Capture entries of a URL, a block at a time."""
        key = surt(url).replace(" ", "%20")
        low, high = key + " ", key + "!"
        for _, _, part in covering(self.parts, low, high):
            for _, _, block in covering(self.directory(part), low, high):
                data = self.blocks.filter((F.col("part") == part) & (F.col("block") == block)).select("data").first()[0]
                yield from (x for x in _unpack_block(bytes(data)) if low <= x[0] < high)

    def read(self, url: str) -> Iterator[tuple[dict[str, str], bytes]]:
        """(headers, block) of the URL's records, read by byte range."""
        for _, _, _, file, offset, length, _ in self.captures(url):
            yield parse_record(read_range(self.blocks.sparkSession, file, offset, length))


def read_range(spark: SparkSession, file: str, offset: int, length: int) -> bytes:
    """Bytes of a file through Hadoop's file system, from whatever store it is in."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        stream.seek(offset)
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()


def archive(pages: DataFrame, scratch: Scratch | None = None, parts: int | None = None) -> DataFrame:
    """Write archives and their index; the index's blocks."""
    spark = pages.sparkSession
    scratch = scratch or Scratch(spark, "warc")
    path = scratch.path("archives")
    write_archives(records(pages, scratch=scratch), path)
    # Written once, as sorting by ranges reads its input twice.
    return write_index(scratch.write(captures(spark, path), "captures"), scratch.path("index"), parts)


def op9(pages: DataFrame) -> DataFrame:
    """The contract's columns: each page is looked up in the index and its record read by byte range."""
    blocks = archive(pages)
    keys = pages.select(capture_key(_header(F.col("url")), F.col("page_id").cast("long")).alias("key"))
    return read_ranges(look_up(blocks, keys)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS dg FROM pages),
g AS (SELECT dg, min(page_id) AS first FROM p WHERE n >= {MIN_REVISIT} GROUP BY dg)
SELECT page_id, n::BIGINT AS payload_bytes, p.dg AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact
FROM p LEFT JOIN g ON p.dg = g.dg
"""
