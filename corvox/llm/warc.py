"""WARC records: reading, writing, and resolution of not-modified revisits.

A server-not-modified revisit holds no body. It is resolved by an as-of join on canonical
URL to the latest earlier full response, its validators are checked against that
response's, and the headers that a 304 may update are merged over the response's.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.llm._shared import materialize

#: Headers that describe the body sent, which a 304 may not replace, and those of one connection.
KEPT_HEADERS = [
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
]
SPAN = 1024
RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("profile", T.StringType()), T.StructField("status", T.IntegerType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("body", T.BinaryType()),
])


def _fields(block: bytes) -> dict[str, str]:
    """Header lines as a map of lower-cased names; a repeated name's values are joined by commas."""
    out: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            key = name.strip().lower()
            out[key] = f"{out[key]}, {value.strip()}" if key in out else value.strip()
    return out


class Inflated(io.RawIOBase):
    """What can be read of gzip members one after another; it ends where they are broken."""

    def __init__(self, data: bytes):
        self.rest, self.member = data, None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while self.rest:
            self.member = self.member or zlib.decompressobj(31)
            try:
                part = self.member.decompress(self.rest, len(buffer))
            except zlib.error:
                self.rest = b""
                break
            if self.member.eof:
                self.rest, self.member = self.member.unused_data, None
            else:
                self.rest = self.member.unconsumed_tail
            if part:
                buffer[: len(part)] = part
                return len(part)
        return 0


def parse_warc(data: bytes) -> Iterator[tuple]:
    """Records of a WARC file's bytes, plain or gzipped a record at a time. What isn't a whole
    record ends the file: other text, a length that is no number, a block or a compressed
    stream that is cut off. The records before it are kept."""
    stream = io.BufferedReader(Inflated(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line.startswith(b"WARC/"):
            return
        head = b""
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            head += line
        if not line:
            return
        named = _fields(head)
        length = named.get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            return
        block = stream.read(int(length))
        if len(block) < int(length):
            return
        status, headers, body = None, {}, block
        if block.startswith(b"HTTP/"):
            top, _, body = block.partition(b"\r\n\r\n")
            first, _, rest = top.partition(b"\r\n")
            code = first.split(b" ")
            status = int(code[1]) if len(code) > 1 and code[1].isdigit() else None
            headers = _fields(rest)
        yield (named.get("warc-record-id"), named.get("warc-type"), named.get("warc-target-uri"), named.get("warc-date"), named.get("warc-profile"), status, headers, body)


def format_record(record_id: str, kind: str, url: str, date: str, status: int | None, headers: dict[str, str], body: bytes, profile: str | None = None) -> bytes:
    """One WARC/1.1 record."""
    http = b"" if status is None else (f"HTTP/1.1 {status} -\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n").encode()
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Target-URI": url, "WARC-Date": date, "WARC-Profile": profile, "Content-Length": len(http) + len(body)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + http + body + b"\r\n\r\n"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records (``RECORD``) of the WARC files under ``path``; a file is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 5 + [pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                rows: list = []
                for row in [*parse_warc(content.as_py()), None]:
                    if row is not None:
                        rows.append((*row[:6], list(row[6].items()), row[7]))
                    if rows and (row is None or len(rows) == 256):
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=RECORD.names)
                        rows = []

    return files.mapInArrow(run, RECORD)


def canonical_url(url: Column) -> Column:
    """Scheme and host lower-cased, default ports, fragments and ``utm_`` parameters dropped,
    an empty path made ``/``; what has no ``scheme://host`` stays as it is."""
    plain = F.regexp_replace(url, r"#[\s\S]*$", "")
    start = F.lower(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0))
    rest = F.substring(plain, F.length(start) + 1, F.length(plain))
    start = F.regexp_replace(F.regexp_replace(start, r"^(http://[^/?]*):80$", "$1"), r"^(https://[^/?]*):443$", "$1")
    path = F.regexp_extract(rest, r"^[^?]*", 0)
    query = F.substring(rest, F.length(path) + 1, F.length(rest))
    query = F.regexp_replace(F.regexp_replace(query, r"([?&])utm_[^&]*", "$1"), r"&+", "&")
    query = F.regexp_replace(F.regexp_replace(query, r"^\?&", "?"), r"[?&]$", "")
    whole = F.concat(start, F.when(path == "", "/").otherwise(path), query)
    return F.when(start == "", url).otherwise(whole)


def header(headers: Column, name: str) -> Column:
    return F.element_at(headers, name)


def weak(tag: Column) -> Column:
    """An entity tag without its weakness mark: validators are compared weakly."""
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def resolve_revisits(records: DataFrame, time_col: str, id_col: str = "record_id", bucket: int = 86_400) -> DataFrame:
    """One row per not-modified revisit: id, canonical_url, source_id, outcome, headers.

    ``records`` has id, ``url``, ``type``, ``status``, ``headers`` (names in lower case) and a whole-number
    time. Full responses are type ``response`` with status 200; revisits are type ``revisit`` with
    status 304. Of responses at the revisit's own time none counts as earlier; of several at
    one earlier time the one with the largest id is taken. outcome: ``merged``; ``mismatch``
    (an ETag differs, or Last-Modified where an ETag is missing on either side);
    ``unchecked`` (no validator in common); ``orphan`` (no earlier response). Merged headers
    are given for ``merged`` and ``unchecked``: the response's, overlaid by the revisit's but
    for ``KEPT_HEADERS``. Null urls, times or ids make a revisit an orphan, and such a
    response is no source. Repeated rows are resolved each for itself; of responses alike in URL,
    time and id the one whose headers come last in order counts. Very long URLs and headers
    are taken whole. An empty table gives no rows, and other columns are not read.

    The join is in steps, so that no URL's records need to come into one task: records are
    ordered within their (URL, ``bucket`` of time) only; the latest response of each bucket is
    carried forward within ``SPAN`` buckets, and that of each span over spans.
    """
    when = F.col(time_col).cast("long")
    base = materialize(records.select(
        F.col(id_col).alias("_id"), canonical_url(F.col("url")).alias("_url"), when.alias("_t"), F.floor(when / bucket).alias("_bucket"),
        F.coalesce((F.col("type") == "response") & (F.col("status") == 200) & F.col(id_col).isNotNull() & F.col("url").isNotNull() & when.isNotNull(), F.lit(False)).alias("_full"),
        F.coalesce((F.col("type") == "revisit") & (F.col("status") == 304), F.lit(False)).alias("_revisit"),
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("_headers"),
    ).where("_full or _revisit"), "warc-records")
    found = F.when(F.col("_full"), F.struct("_t", "_id"))
    able = base.where("_url is not null and _bucket is not null")
    last = able.groupBy("_url", "_bucket").agg(F.max(found).alias("_last"), F.max("_revisit").alias("_asked")).withColumn("_span", F.floor(F.col("_bucket") / SPAN))
    earlier = lambda *by, order: F.max("_last").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    spans = last.groupBy("_url", "_span").agg(F.max("_last").alias("_last")).select("_url", "_span", earlier("_url", order="_span").alias("_far"))
    near = last.select("_url", "_bucket", "_span", "_asked", earlier("_url", "_span", order="_bucket").alias("_near")).where("_asked")
    before = near.join(spans, ["_url", "_span"]).select("_url", "_bucket", F.coalesce("_near", "_far").alias("_before"))
    within = Window.partitionBy("_url", "_bucket").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    latest = able.select("_id", "_url", "_bucket", "_headers", "_revisit", F.max(found).over(within).alias("_own")).where("_revisit")
    pointed = latest.join(before, ["_url", "_bucket"], "left").select("_id", "_url", "_headers", F.coalesce("_own", "_before").alias("_source"))
    lost = base.where("_revisit and (_url is null or _bucket is null)").select("_id", "_url", "_headers", F.lit(None).cast(pointed.schema["_source"].dataType).alias("_source"))
    pointed = pointed.union(lost)
    sources = able.where("_full").groupBy(F.col("_url").alias("_su"), F.struct("_t", "_id").alias("_sk")).agg(F.max_by("_headers", F.array_sort(F.map_entries("_headers"))).alias("_old"))
    joined = pointed.join(sources, (F.col("_url") == F.col("_su")) & (F.col("_source") == F.col("_sk")), "left")

    tag, old_tag = weak(header(F.col("_headers"), "etag")), weak(header(F.col("_old"), "etag"))
    changed, old_changed = header(F.col("_headers"), "last-modified"), header(F.col("_old"), "last-modified")
    outcome = (
        F.when(F.col("_old").isNull(), "orphan")
        .when(tag.isNotNull() & old_tag.isNotNull(), F.when(tag == old_tag, "merged").otherwise("mismatch"))
        .when(changed.isNotNull() & old_changed.isNotNull(), F.when(changed == old_changed, "merged").otherwise("mismatch"))
        .otherwise("unchecked")
    )
    kept = F.array(*map(F.lit, KEPT_HEADERS))
    update = F.map_filter("_headers", lambda k, _: ~F.array_contains(kept, k))
    merged = F.map_concat(F.map_filter("_old", lambda k, _: ~F.map_contains_key(update, k)), update)
    return joined.withColumn("outcome", outcome).select(
        F.col("_id").alias(id_col), F.col("_url").alias("canonical_url"), F.col("_source._id").alias("source_id"), "outcome",
        F.when(F.col("outcome").isin("merged", "unchecked"), merged).alias("headers"),
    )
