"""WARC archives: written by Spark tasks, read back and joined into captures.

Every page becomes three records: the response (or a revisit, if an earlier page has the same
payload), its request and its metadata; the latter two name the first in ``WARC-Concurrent-To``.
Records are written through Spark's text writer, whose line separator is the empty line pair that
ends a WARC record, so archives go wherever Spark can write. They are gzip files: not split, so
one task reads an archive from its start, record by record by ``Content-Length``, and a payload that
itself holds WARC records does no harm. Records of a transaction are then brought together by the
identifier they share, wherever in the archives they lie, and give one nested row per capture.

Defined results: null html is the empty payload; a null url gives no target header. Equal payloads
are told by SHA-1 and length. Of equal payloads the rows with the smallest page_id are responses,
also if several rows share that id; null page_ids are revisits unless all are null. Control
characters in a url are percent-encoded. Other columns of the input are dropped, whatever their
names. Records without a partner give a capture with empty lists; requests and metadata without a
capture give no row. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.arrow import slices
from tillmart.sources.shared import stored

MARK = b"WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Digests of repeated payloads are broadcast up to this many (about 60 bytes each).
MOST_BROADCAST = 200_000

RECORD = (
    "record_id string, type string, concurrent_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, http_header string, payload binary, fields string"
)


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(kind: str, record_id: str, lines: list[tuple[str, str | None]], block: str) -> str:
    given = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", DATE),
        *lines,
        ("Content-Length", str(len(block.encode()))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in given if value is not None)
    return f"{MARK.decode()}{head}\r\n{block}"


def _records(
    name: str, page_id: int | None, url: str | None, html: str | None, first: bool
) -> list[str]:
    """The records of a page, without the line pair at their end."""
    html = html or ""
    payload = html.encode()
    url = url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    try:
        parts = urlsplit(url or "")
    except ValueError:
        parts = urlsplit("")
    ids = [
        f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{name}/{kind}')}"
        for kind in ("capture", "request", "metadata")
    ]
    target = ("WARC-Target-URI", url)
    join = ("WARC-Concurrent-To", f"<{ids[0]}>")
    answer = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    )
    about = [
        target,
        ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"),
        ("WARC-Profile", None if first else PROFILE),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    asked = f"GET {parts.path or '/'} HTTP/1.1\r\nHost: {parts.netloc}\r\n\r\n"
    fields = "" if page_id is None else f"page-id: {page_id}\r\n"
    return [
        _header(
            "request",
            ids[1],
            [target, join, ("Content-Type", "application/http; msgtype=request")],
            asked,
        ),
        _header(
            "response" if first else "revisit", ids[0], about, answer + (html if first else "")
        ),
        _header(
            "metadata", ids[2], [target, join, ("Content-Type", "application/warc-fields")], fields
        ),
    ]


def write(pages: DataFrame, path: str) -> None:
    """Archives of ``pages`` (page_id, url, html) in the folder ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    body = F.coalesce("html", F.lit(""))
    rows = rows.withColumns({"_d": F.sha1(body.cast("binary")), "_n": F.octet_length(body)})
    again = stored(
        rows.groupBy("_d", "_n")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_rows"))
        .where("_rows > 1")
        .select(F.col("_d").alias("_rd"), F.col("_n").alias("_rn"), "_first"),
        "repeated-payloads",
    )
    if again.count() <= MOST_BROADCAST:
        again = F.broadcast(again)
    rows = rows.join(again, (F.col("_d") == F.col("_rd")) & (F.col("_n") == F.col("_rn")), "left")
    rows = rows.select(
        "page_id",
        "url",
        "html",
        F.expr("_rd IS NULL OR page_id <=> _first").alias("first"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = f"{path}/{TaskContext.get().partitionId()}", 0
        for batch in slices(batches, "html"):
            out = []
            for row in batch.to_pylist():
                out += _records(f"{task}/{n}", row["page_id"], row["url"], row["html"], row["first"])
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    rows.mapInArrow(run, "value string").write.text(path, compression="gzip", lineSep=END)


def _head(raw: bytes) -> tuple[dict[str, str], int, int] | None:
    """Named fields of the record that begins ``raw`` (without its first line), and where its block
    begins and ends; None if the fields go on."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    named = {}
    for line in raw[:end].decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        named[name.strip().lower()] = value.strip()
    return named, end + 4, end + 4 + int(named.get("content-length") or 0)


class _Pieces:
    """What stands between marks, put together once it holds as much as its record says."""

    def __init__(self) -> None:
        self.pieces: list[bytes] = []
        self.size, self.needed = -len(MARK), None

    def add(self, piece: bytes) -> bool:
        """Whether the record is complete with this piece."""
        self.pieces.append(piece)
        self.size += len(MARK) + len(piece)
        if self.needed is None:
            head = _head(self.whole())
            self.needed = head[2] if head else None
        return self.needed is not None and self.size >= self.needed

    def whole(self) -> bytes:
        return MARK.join(self.pieces)


def _parsed(raw: bytes) -> dict:
    """The complete record that begins ``raw``."""
    named, begin, end = _head(raw)
    kind, block = named.get("warc-type"), raw[begin:end]
    out = {
        "record_id": (named.get("warc-record-id") or "").strip("<>") or None,
        "type": kind,
        "concurrent_to": (named.get("warc-concurrent-to") or "").strip("<>") or None,
        "target_uri": named.get("warc-target-uri"),
        "date": named.get("warc-date"),
        "payload_digest": (named.get("warc-payload-digest") or "").rpartition(":")[2] or None,
    }
    if kind in ("response", "revisit", "request"):
        head, _, payload = block.partition(b"\r\n\r\n")
        out["http_header"] = head.decode("utf-8", "replace")
        if kind == "response":
            out |= {
                "payload": payload,
                "payload_bytes": len(payload),
                "payload_digest": sha1(payload),
            }
        elif said := re.search(r"(?im)^content-length:\s*(\d+)", out["http_header"]):
            out["payload_bytes"] = int(said[1])
    else:
        out["fields"] = block.decode("utf-8", "replace")
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in ``path``, one row each."""
    lines = spark.read.text(path, lineSep=MARK.decode()).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")
    )
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held = None, _Pieces()
        for batch in slices(batches, "value"):
            found = []
            for name, piece in zip(
                batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True
            ):
                if name != file:  # what stands before the first mark of a file is no record
                    file, held = name, _Pieces()
                    continue
                if held.add(piece):
                    found.append(_parsed(held.whole()))
                    held = _Pieces()
            if found:
                yield pa.RecordBatch.from_pylist(found, schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD.split(", ")])
    return lines.mapInArrow(run, RECORD).select(*names)


def captures(records: DataFrame) -> DataFrame:
    """One row per capture: the response or revisit, its requests and its metadata.

    Either side of a transaction may name the other in ``concurrent_to``.
    """
    record = F.struct(*(c for c in records.columns))
    keyed = records.withColumn("_key", F.coalesce("concurrent_to", "record_id"))
    grouped = keyed.where("_key IS NOT NULL").groupBy("_key").agg(F.collect_list(record).alias("_all"))
    # Records without any id belong to no other: each is a transaction of its own.
    alone = keyed.where("_key IS NULL").select("_key", F.array(record).alias("_all"))
    grouped = grouped.unionByName(alone)
    of = lambda *kinds: F.filter("_all", lambda r: r["type"].isin(*kinds))
    bare = lambda rows, *names: F.transform(
        rows, lambda r: F.struct(*(r[n].alias(n) for n in names))
    )
    rows = grouped.select(
        F.explode(of("response", "revisit")).alias("capture"),
        bare(of("request"), "record_id", "date", "http_header").alias("requests"),
        bare(of("metadata"), "record_id", "date", "fields").alias("metadata"),
    )
    return rows.select(
        *(F.col(f"capture.{c}").alias(c) for c in records.columns if c not in ("fields", "concurrent_to")),
        "requests",
        "metadata",
    )


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write archives of ``pages``, read them back, and report each capture.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    spark = pages.sparkSession
    write(pages, path)
    noted = F.regexp_extract(F.array_join("metadata.fields", "\n"), r"page-id: (-?\d+)", 1)
    found = captures(read(spark, path)).select(
        F.when(noted != "", noted).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
    )
    found = stored(found, "captures")
    first = (
        found.where("record_type = 'response'")
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("_page"))
    )
    # By the reversed digest, so that both sides move and a very common payload can be split.
    first = first.select(F.reverse("payload_digest").alias("_d"), F.col("payload_bytes").alias("_n"), "_page")
    same = (F.reverse("payload_digest") == F.col("_d")) & (F.col("payload_bytes") == F.col("_n"))
    return found.join(first, same, "left").select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("_page")).alias("refers_to"),
    )
