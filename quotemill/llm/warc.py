"""Web archives: writing WARC records, reading them back, and a merged capture index.

Writing. Each page is one WARC/1.1 record, with the HTTP header and, for a response, the
page's bytes. Of pages with equal payloads the one with the smallest id is a response, the
others are revisits that refer to it. Every record is a gzip member of its own, so that it can be read by its place alone.
Tasks put members together to files of about FILE_BYTES, by bytes and not by number, and Spark's text writer
writes each as one value and commits it as any output. A longer record is a file of its own.

Reading. A file is one row of Spark's binaryFile source. Members are unpacked one at a time and their records cut by
their Content-Length, so payloads may hold anything; digests are taken again from the bytes.

Index. The captures of one file, sorted by URL key, timestamp and page, are a run. Runs are
written, dealt into ranges of that order of about RANGE_ROWS captures each, and in each range its slices of all runs are merged
with a loser tree: k-way, one comparison per level and capture, over an iterator a run. A task holds one range and no more, however many
captures there are. The ranges, one after the other, are the
capture histories of all URLs in order. A URL with very many captures spreads over ranges by
its timestamps, pages and places.

Defined cases. A null html is an empty payload. A null id is greater than all others, and is
written as an empty name. Rows that repeat the smallest id of a payload are all responses. A null URL has no
header and the empty key. Spaces and control characters in URLs are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
import zlib
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import release
from .loser_tree import merge
from .scratch import fresh, kept

FILE_BYTES = 8 << 20  # packed bytes of a file
RANGE_ROWS = 50_000  # captures of a range of the index
CHUNK = 1 << 16
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Fixed value: the profile of revisit records of equal payloads.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:x-page:"
LINE = "\r\n"
INDEX = (
    "page_id long, url string, url_key string, timestamp string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, file string, offset long, length long")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: forty hexadecimal digits, ten to eight."""
    digest = F.sha1(payload)
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    return F.concat(*[
        F.translate(F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0"), digits, BASE32) for i in range(4)])


def _escaped(url: Column) -> Column:
    out = url
    for code in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), out).otherwise(url)


def write_warc(
    pages: DataFrame, path: str, *, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html",
    captured: Column | None = None,
) -> None:
    """Write one record a page below ``path``. ``captured`` is the time of capture; without it, the
    id in seconds after the start of 2024."""
    rows = pages.select(
        pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"),
        F.coalesce(pages[html], F.lit("")).alias("payload"),
        (F.timestamp_seconds(F.lit(1704067200) + F.coalesce(F.pmod(pages[page_id], F.lit(31536000)), F.lit(0)))
         if captured is None else captured).alias("captured"))
    sized = rows.withColumn("n", F.octet_length("payload").cast("long")).withColumn("digest", base32_sha1(F.col("payload")))
    narrow = kept(sized.select("page_id", "n", "digest"), "warc-payloads")
    shared = kept(
        narrow.where(F.col("n") >= least_bytes).groupBy("digest", "n")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("pages")).where("pages > 1").drop("pages"),
        "warc-shared")
    joined = sized.join(shared.withColumnsRenamed({"digest": "_digest", "n": "_n"}), (F.col("digest") == F.col("_digest")) & (F.col("n") == F.col("_n")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.concat(F.lit(f"<{NAME}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("n").cast("string"), F.lit(LINE + LINE))
    header = F.concat_ws(
        LINE, F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name),
        F.concat(F.lit("WARC-Date: "), F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), _escaped(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {SAME_PAYLOAD}")),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{NAME}"), F.col("first").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))).cast("string")))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(header, F.lit(LINE + LINE), block, F.lit(LINE + LINE)).cast("binary")
    files = joined.select(record.alias("record")).mapInArrow(_packed(FILE_BYTES), "value binary")
    # Bytes pass as they are; what the writer puts behind each value is the last byte of its last member, see _packed.
    files.select(F.col("value").cast("string").alias("value")).write.option("lineSep", PAD).option("maxRecordsPerFile", 1).text(path)


PAD = "\0"


def _packed(file_bytes: int):
    """Files as values: members put together up to ``file_bytes``.

    A member ends with the size of its record, least byte first, so its last byte is 0 below 16 MB: that byte is left to
    the writer's separator. Behind a longer record the separator is padding, which readers of gzip pass over.
    """
    def pack(batches):
        parts, size = [], 0

        def value():
            whole = b"".join(parts)
            parts.clear()
            whole = whole[:-1] if whole.endswith(b"\0") else whole
            return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], names=["value"])

        for batch in batches:
            for record in batch.column("record"):
                parts.append(gzip.compress(record.as_py(), 6, mtime=0))
                size += len(parts[-1])
                if size >= file_bytes:
                    yield value()
                    size = 0
        if parts:
            yield value()
        batch = None
        release()

    return pack


def url_key(url: str | None) -> str:
    """Host labels in reverse order, then path and query, in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    labels = [x for x in host.split(".") if x]
    if labels[:1] == ["www"]:
        labels = labels[1:]
    return ",".join(reversed(labels)) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def members(content: bytes):
    """(offset, length, unpacked bytes) of every gzip member."""
    at, whole = 0, memoryview(content)
    while at < len(whole):
        if whole[at] == 0:  # padding
            at += 1
            continue
        unpack, begin, parts = zlib.decompressobj(31), at, []
        while not unpack.eof:
            if at >= len(whole):
                raise ValueError(f"the member at {begin} is cut short")
            parts.append(unpack.decompress(whole[at:at + CHUNK]))
            at += CHUNK
        at = min(at, len(whole)) - len(unpack.unused_data)
        yield begin, at - begin, b"".join(parts)


def record(data: bytes) -> tuple[dict, bytes]:
    """(header, block) of the record of one member."""
    if not data.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    end = data.index(b"\r\n\r\n")
    fields = {m[1].lower().decode(): m[2].decode() for m in _FIELD.finditer(data, 0, end)}
    stop = end + 4 + int(fields["content-length"])
    if data[stop:] != b"\r\n\r\n":
        raise ValueError("the record is cut short, or goes on")
    return fields, data[end + 4:stop]


def _number(name: str | None) -> int | None:
    digits = name.strip("<>").removeprefix(NAME) if name else ""
    return int(digits) if digits else None


def _captures(batches):
    """Index entries of each file, sorted: one run a file."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            found = []
            for offset, length, data in members(content):
                fields, block = record(data)
                head = block.index(b"\r\n\r\n") + 4
                kind = fields["warc-type"]
                stated = fields["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response":
                    payload = block[head:]
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if digest != stated:
                        raise ValueError(f"{path}: the payload at {offset} does not have its digest")
                else:
                    size = int(next(m[2] for m in _FIELD.finditer(block, 0, head) if m[1].lower() == b"content-length"))
                    digest = stated
                url = fields.get("warc-target-uri")
                found.append((
                    _number(fields["warc-record-id"]), url, url_key(url), re.sub(r"\D", "", fields["warc-date"]), kind,
                    size, digest, _number(fields.get("warc-refers-to")), path.rsplit("/", 1)[-1], offset, length))
            found.sort(key=_order)
            for begin in range(0, len(found), 10_000):
                yield _frame(found[begin:begin + 10_000])
    batch = content = data = block = payload = found = None
    release()


def _order(entry: tuple) -> tuple:
    """URL key, timestamp, page (null last), place."""
    return entry[2], entry[3], entry[0] is None, entry[0] or 0, entry[8], entry[9]


def _frame(entries: list) -> pd.DataFrame:
    names = [part.split()[0] for part in INDEX.split(", ")]
    frame = pd.DataFrame(entries, columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def _merged(batches):
    """The entries of one range, in order, from its slices of the runs."""
    runs: dict[str, list] = {}
    for batch in batches:
        for entry in batch.astype(object).where(batch.notna(), None).itertuples(index=False, name=None):
            runs.setdefault(entry[8], []).append(entry)
    for entries in runs.values():  # the shuffle may deliver parts of a run in any order
        if any(_order(b) < _order(a) for a, b in zip(entries, entries[1:])):
            entries.sort(key=_order)
    out = []
    for _, entry in merge([((_order(e), e) for e in entries) for entries in runs.values()]):
        out.append(entry)
        if len(out) == 10_000:
            yield _frame(out)
            out = []
    yield _frame(out)
    batch = runs = entries = out = None
    release()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all records below ``path``, sorted within each file (a run each)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(_captures, INDEX)


def capture_index(runs: DataFrame) -> DataFrame:
    """The sorted runs merged into capture histories: ordered within and between partitions."""
    order = ["url_key", "timestamp", F.col("page_id").asc_nulls_last(), "file", "offset"]
    written = kept(runs, "warc-runs")
    ranges = max(1, math.ceil(written.count() / RANGE_ROWS))
    return written.repartitionByRange(ranges, *order).mapInPandas(_merged, INDEX)


def archived(pages: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """The pages written as archives below the shared folder, and the index of these as read back."""
    path = fresh(pages.sparkSession, "warc")
    write_warc(pages, path, least_bytes=least_bytes)
    return capture_index(read_warc(pages.sparkSession, path))
