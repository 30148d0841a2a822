"""WARC archives written and read by Spark, and captures put together from their records.

Each capture is written as a request, a response or revisit, and a metadata
record; request and metadata name the response in WARC-Concurrent-To. Records are gzip
members of their own, as WARC tools expect, written through Spark's text
writer with an empty gzip member as the line separator: the bytes reach any
store that Spark can write to, and the write is committed like any other.

Reading parses each file's records by their lengths and brings requests and
metadata together with responses by concurrent-to identifiers, one nested row per capture however many
records of a kind it has.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.scratch import cut

#: Smallest payload that may be stored as a revisit, bytes wanted in a file, and lines that many are written in.
MIN_REVISIT = 100
FILE_BYTES = 32 << 20
FILE_LINES = 32
# An empty gzip member; the WARC profile of a revisit with the same payload.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- records --------------------------------------------------------------------------------------

def record(headers: list[tuple[str, str]], block: bytes, level: int = 1) -> bytes:
    """One record as a gzip member. Line breaks in header values become spaces."""
    lines = ["WARC/1.1", *[f"{k}: {' '.join(v.splitlines())}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", level, mtime=0)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an uncompressed stream.

    A header that is repeated has its values in order, each on a line of its own.
    """
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            name, value = name.strip().lower(), value.strip()
            headers[name] = f"{headers[name]}\n{value}" if name in headers else value
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("a WARC record is cut short")
        yield headers, block


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """Head and body of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    return head, body


# -- writing --------------------------------------------------------------------------------------

def _members(page_id, url: str, html: bytes, digest: str, first_url: str | None, uid: str, date: str) -> Iterator[bytes]:
    ids = {k: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uid}/{k}')}>" for k in ("request", "capture", "metadata")}
    host, _, path = url.partition("://")[2].partition("/") if "://" in url else ("", "", url)
    common = [("WARC-Target-URI", url), ("WARC-Date", date)]
    yield record([("WARC-Type", "request"), ("WARC-Record-ID", ids["request"]), ("WARC-Concurrent-To", ids["capture"]), *common,
                  ("Content-Type", "application/http; msgtype=request")], f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    if first_url is None:
        kind, more, body = "response", [], html
    else:
        kind, more, body = "revisit", [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To-Target-URI", first_url)], b""
    yield record([("WARC-Type", kind), ("WARC-Record-ID", ids["capture"]), *common, ("WARC-Payload-Digest", f"sha256:{digest}"), *more,
                  ("Content-Type", "application/http; msgtype=response")], head + body)
    fields = "" if page_id is None else f"page-id: {page_id}\r\n"
    yield record([("WARC-Type", "metadata"), ("WARC-Record-ID", ids["metadata"]), ("WARC-Concurrent-To", ids["capture"]), *common,
                  ("Content-Type", "application/warc-fields")], fields.encode())


def write_pages(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Archive ``pages`` (page_id, url, html; further columns are left out) under ``path``.

    Of pages with equal payloads of at least ``MIN_REVISIT`` bytes, those of the
    smallest id are written whole and the others as revisits of it (a null id
    comes last). Null html counts as empty, a null url as an empty one.

    Payloads stay where they are read unless very many are met again: the table of
    those is written first, so that its size decides how it is joined. Files are cut by the bytes written: records
    go out in lines of at least ``file_bytes`` / ``FILE_LINES``, and a longer one is followed by as many empty lines as it
    is worth, so that a file ends soon behind ``file_bytes`` wherever large pages lie.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    narrow = cut(rows.select("page_id", "url", "digest", F.octet_length("html").alias("n")), "payloads")
    order = F.struct(F.col("page_id").isNull().alias("missing"), "page_id")
    firsts = cut(narrow.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(
        F.min(order).alias("first"), F.min_by("url", F.struct(order.alias("o"), "url")).alias("first_url"), F.count("*").alias("copies")
    ).where("copies > 1").drop("copies"), "payloads-met-again")
    marked = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(~order.eqNullSafe(F.col("first")), F.col("first_url")).alias("first_url"))
    salt, line = uuid.uuid4().hex, max(1024, file_bytes // FILE_LINES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def lines() -> pa.RecordBatch:
            nonlocal held, size
            out = pa.RecordBatch.from_arrays([pa.array([b"".join(held), *[b""] * (size // line - 1)], pa.binary())], ["value"])
            held, size = [], 0
            return out

        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("page_id", "url", "digest", "first_url")]
            for html, page_id, url, digest, first in zip(b.column("html").cast(pa.binary()), *columns):
                n += 1
                for member in _members(page_id, url, html.as_py(), digest, first, f"{salt}/{part}/{n}", date):
                    held.append(member)
                    size += len(member)
                    if size >= line:
                        yield lines()
        if held:
            yield lines()

    members = marked.mapInArrow(run, T.StructType([T.StructField("value", T.BinaryType())]))
    members.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_LINES).option(
        "encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


# -- reading --------------------------------------------------------------------------------------

_RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("concurrent_to", T.ArrayType(T.StringType())),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to_uri", T.StringType()), T.StructField("content_type", T.StringType()),
    T.StructField("head", T.StringType()), T.StructField("payload", T.BinaryType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_sha256", T.StringType())])


def _parsed(headers: dict[str, str], block: bytes, keep: bool) -> tuple:
    kind = headers.get("content-type", "")
    head, payload = http_parts(block) if kind.startswith("application/http") else (b"", block)
    get = headers.get
    return (get("warc-record-id"), get("warc-type"), get("warc-concurrent-to", "").split("\n") if get("warc-concurrent-to") else None, get("warc-target-uri"), get("warc-date"),
            get("warc-payload-digest"), get("warc-refers-to-target-uri"), kind, head.decode("utf-8", "replace"),
            payload if keep or headers.get("warc-type") == "metadata" else None, len(payload),
            hashlib.sha256(payload).hexdigest())


def read_records(spark: SparkSession, path: str, payloads: bool = True, glob: str | None = None) -> DataFrame:
    """Every record of the archives under ``path`` whose names match ``glob`` (by default all data files), plain or gzip, one row each.

    ``payload_sha256`` is of the payload as stored; without ``payloads`` only
    those of metadata records are returned. A file is held in memory
    while its records are parsed one by one, so archives should be of the usual
    size, a gigabyte at most.
    """
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                raw = io.BytesIO(content.as_py())
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if raw.getvalue()[:2] == b"\x1f\x8b" else raw
                out, held = [], 0
                for headers, block in parse(stream):
                    out.append(_parsed(headers, block, payloads))
                    held += len(block)
                    if held > 8 << 20 or len(out) >= 5000:
                        yield _batch(out)
                        out, held = [], 0
                yield _batch(out)

    return files.mapInArrow(run, _RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.LongType(): pa.int64(), T.ArrayType(T.StringType()): pa.list_(pa.string())}
    columns = list(zip(*rows)) or [()] * len(_RECORD)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType]) for c, f in zip(columns, _RECORD)], _RECORD.names)


def captures(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture_id``, ``response`` (a struct) and the arrays ``requests``, ``metadata`` and ``others``.

    A record belongs to the responses and revisits whose ids it names in WARC-Concurrent-To, or that name its
    id there; one that names none and is named by none (a warcinfo, a lone request) is a capture of its own
    id. Records that name an id no response has are together under that id, without a
    response. A second response of one id is among the others. Records without an id that name none come singly, with a
    null capture id. Arrays are sorted, and empty where there is nothing.
    """
    whole = F.struct(*records.columns)
    is_response = F.coalesce(F.col("type").isin("response", "revisit"), F.lit(False))
    naming = records.where(is_response & F.col("concurrent_to").isNotNull()).select(F.explode("concurrent_to").alias("_id"), F.col("record_id").alias("_by"))
    naming = naming.groupBy("_id").agg(F.collect_set("_by").alias("_by"))
    rest = records.where(~is_response).join(naming, F.col("record_id") == F.col("_id"), "left")
    none = F.array().cast("array<string>")
    named = F.array_distinct(F.concat(F.coalesce("concurrent_to", none), F.coalesce("_by", none)))
    kind = F.when(F.col("type") == "request", "requests").when(F.col("type") == "metadata", "metadata").otherwise("others")
    rest = rest.select(F.explode(F.when(F.size(named) > 0, named).otherwise(F.array("record_id"))).alias("capture_id"), kind.alias("kind"), whole.alias("part"))
    members = records.where(is_response).select(F.col("record_id").alias("capture_id"), F.lit("response").alias("kind"), whole.alias("part")).union(rest)
    of = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("part")))).alias(kind)
    found = members.where(F.col("capture_id").isNotNull()).groupBy("capture_id").agg(of("response"), of("requests"), of("metadata"), of("others"))
    found = found.select("capture_id", F.get("response", F.lit(0)).alias("response"), "requests", "metadata",
                         F.concat("others", F.slice("response", 2, F.greatest(F.size("response"), F.lit(1)))).alias("others"))
    lone = members.where(F.col("capture_id").isNull())
    only = lambda kind: F.when(F.col("kind") == kind, F.array("part")).otherwise(F.array().cast(found.schema["others"].dataType)).alias(kind)
    return found.unionByName(lone.select("capture_id", F.when(F.col("kind") == "response", F.col("part")).alias("response"), only("requests"), only("metadata"), only("others")))


def page_captures(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Captures under ``path`` with page_id, payload_bytes, payload_digest, record_type and refers_to.

    The parsed records are written once and brought together from there; without
    ``payloads`` they are a few hundred bytes each. The page id is the first that the capture's metadata name.

    A revisit gets length and digest of the response with the same payload
    digest, and that response's page id as ``refers_to``. A response's digest is
    taken of the payload read, and a difference from its header raises.
    """
    whole = captures(cut(read_records(spark, path, payloads), "warc-records")).where("response is not null")
    page = F.regexp_extract(F.array_join(F.transform("metadata", lambda m: m["payload"].cast("string")), "\n"), r"(?m)^page-id: (-?\d+)", 1)
    rows = whole.select(
        F.when(page != "", page).cast("long").alias("page_id"), "requests", "response", "metadata",
        F.col("response.type").alias("record_type"), F.col("response.payload_bytes").alias("stored"),
        F.substring_index("response.payload_digest", ":", -1).alias("payload_digest"), F.col("response.payload_sha256").alias("sha"))
    is_response = F.col("record_type") == "response"
    rows = rows.withColumn("payload_digest", F.when(is_response & (F.col("sha") != F.col("payload_digest")), F.raise_error(
        F.concat(F.lit("payload digest differs in "), F.col("response.record_id")))).otherwise(F.col("payload_digest")))
    firsts = rows.where(is_response & (F.col("stored") >= MIN_REVISIT)).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.max("stored").alias("length"))
    again = rows.where(~is_response).join(firsts, "payload_digest", "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "requests", "response", "metadata"]
    own = rows.where(is_response).withColumn("payload_bytes", F.col("stored")).withColumn("refers_to", F.lit(None).cast("long")).select(names)
    return own.union(again.withColumnRenamed("length", "payload_bytes").withColumnRenamed("first", "refers_to").select(names))
