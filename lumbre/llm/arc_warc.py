"""Legacy ARC archives to WARC.

An ARC file opens with a version block (`filedesc://`, an address, a 14-digit date, a type, a length, then a line of version number,
reserved number and origin, then the names of the header fields). Version 1 headers have five fields, version 2 headers ten; fields
are told apart by spaces, the last is always the declared length, and that many bytes follow, then a line feed. The converter synthesises for
every record a WARC identifier (a name-based UUID of archive name and offset), an ISO timestamp, a type (the version block becomes
warcinfo, http records response or revisit, others resource) and block and payload digests.

Very long payloads: an archive is closed once it has ARCHIVE bytes, so it holds one such record. Clashing names: only page_id, url and html are read.
Nulls: a null payload is empty; a null URL becomes `urn:page:<id>`; a null id is left out of the record and read back as null. Empty table: no
archives. Repeated rows: each is a record; of equal payloads from `least` bytes on, the one with the largest id is the response (all rows
with that id), the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import column, skew_join, small_batches, stage

FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
#: Bytes after which an archive is closed.
ARCHIVE = 8 << 20
SCHEMA_ARC = "name string, refers array<struct<page_id:long,offset:long>>, arc binary"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def arc_head(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 lumbre\n{FIELDS[version]}\n".encode()
    if version == 1:
        return f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n".encode() + body + b"\n"
    return f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str, date: str, kind: str, content: bytes, offset: int, name: str, status: int = 200) -> bytes:
    url = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if version == 1:
        line = f"{url} 0.0.0.0 {date} {kind} {len(content)}\n"
    else:
        line = f"{url} 0.0.0.0 {date} {kind} {status} {hashlib.md5(content, usedforsecurity=False).hexdigest()} - {offset} {name} {len(content)}\n"
    return line.encode() + content + b"\n"


def parse_arc(blob: bytes) -> Iterator[tuple[int, dict[str, str], memoryview]]:
    """(offset, header fields, content) of every record, the version block first. Raises ValueError where a length doesn't hold."""
    view, at, names = memoryview(blob), 0, []
    while at < len(blob):
        if blob[at : at + 1] in b"\r\n":  # spare line ends between records
            at += 1
            continue
        to = blob.find(b"\n", at)
        if to < 0:
            raise ValueError(f"unended header at {at}")
        parts = blob[at:to].decode("utf-8", "replace").rstrip("\r").split(" ")
        if not parts[-1].isdigit():
            raise ValueError(f"no length at {at}")
        content = view[to + 1 : to + 1 + int(parts[-1])]
        if len(content) != int(parts[-1]):
            raise ValueError(f"record at {at} is cut short")
        if not names:
            if not parts[0].startswith("filedesc://"):
                raise ValueError("no version block")
            lines = bytes(content).decode("ascii", "replace").splitlines()
            version = int(lines[0].split(" ")[0])
            names = (lines[1] if len(lines) > 1 else FIELDS[version]).split(" ")
            if names[-1] != "Archive-length" or len(names) < 5:
                raise ValueError("unknown header fields")
        # A URL or type may hold spaces in old files: what is over belongs to the first field.
        over = len(parts) - len(names)
        if over < 0:
            raise ValueError(f"{len(parts)} fields at {at}, {len(names)} declared")
        yield at, dict(zip(names, [" ".join(parts[: over + 1]), *parts[over + 1 :]], strict=True)), content
        at = to + 1 + len(content)


def sha1(data: bytes | memoryview) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def record_id(name: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{name}#{offset}')}>"


def iso(date: str) -> str:
    d = (date + "00000000000000")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: dict[str, str], block: bytes | memoryview) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def http_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}


def convert(name: str, blob: bytes, refers: dict[int, int]) -> bytes:
    """The WARC archive of an ARC archive. refers: by a record's offset, the page id of the response that it repeats."""
    out = []
    for offset, fields, content in parse_arc(blob):
        date = iso(fields["Archive-date"])
        base = {"WARC-Record-ID": record_id(name, offset), "WARC-Date": date}
        if fields["URL"].startswith("filedesc://"):
            out.append(warc_record({"WARC-Type": "warcinfo", **base, "WARC-Filename": name, "Content-Type": "application/warc-fields"}, b"software: lumbre\r\nconversionOf: " + name.encode() + b"\r\n"))
            continue
        base |= {"WARC-Target-URI": fields["URL"], "WARC-IP-Address": fields["IP-address"]}
        cut = bytes(content[:65536]).find(b"\r\n\r\n") if bytes(content[:5]) == b"HTTP/" else -1
        if cut < 0:
            out.append(warc_record({"WARC-Type": "resource", **base, "WARC-Block-Digest": sha1(content), "Content-Type": fields["Content-type"]}, content))
            continue
        head, payload = bytes(content[: cut + 4]), content[cut + 4 :]
        about = http_headers(head)
        base |= {"WARC-Payload-Digest": sha1(payload), "Content-Type": "application/http; msgtype=response"}
        if "x-page-id" in about:
            base["X-Page-Id"] = about["x-page-id"]
        if (to := refers.get(offset)) is None:
            out.append(warc_record({"WARC-Type": "response", **base, "WARC-Block-Digest": sha1(content)}, content))
        else:
            out.append(warc_record({"WARC-Type": "revisit", **base, "WARC-Profile": REVISIT_PROFILE, "X-Refers-To-Page-Id": str(to), "WARC-Block-Digest": sha1(head)}, head))
    return b"".join(out)


def parse_warc(blob: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    view, at = memoryview(blob), 0
    while at < len(blob):
        to = blob.index(b"\r\n\r\n", at)
        lines = blob[at:to].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        yield fields, view[to + 4 : to + 4 + n]
        at = to + 4 + n + 4


def with_refers(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, payload, date, refers_to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long = rows.where(F.octet_length("payload") >= least)
    groups = stage(long.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1"), "arc-repeats")
    joined = skew_join(rows, groups, ["digest"], "n", F.xxhash64("page_id", "url"))
    return joined.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def pages_to_arc(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Legacy archives of pages: name, refers (offsets of repeats), arc. Tasks of even number write version 1, the others version 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        version = 1 + part % 2
        out, refers, size = [], [], 0
        name = ""

        def close() -> pa.RecordBatch:
            kind = pa.list_(pa.struct([("page_id", pa.int64()), ("offset", pa.int64())]))
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([refers], kind), pa.array([b"".join(out)], pa.binary())], ["name", "refers", "arc"])

        for batch in batches:
            for page_id, url, payload, to in zip(*(column(batch, c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                if not out:
                    name = f"lumbre-{part:06d}-{seq:05d}.arc"
                    out.append(arc_head(name, version, "19970101000000"))
                    size = len(out[0])
                page_id, body = page_id.as_py(), payload.as_py()
                mark = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
                content = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n{mark}\r\n".encode() + body
                record = arc_record(version, url.as_py() or f"urn:page:{page_id}", "19970101000000", "text/html", content, size, name)
                if (repeats := to.as_py()) is not None:
                    refers.append({"page_id": repeats, "offset": size})
                out.append(record)
                size += len(record)
                if size > ARCHIVE:
                    yield close()
                    out, refers, seq = [], [], seq + 1
        if out:
            yield close()

    small_batches(pages.sparkSession)
    return with_refers(pages, least).mapInArrow(run, SCHEMA_ARC)


def arc_to_warc(arcs: DataFrame) -> DataFrame:
    """name and warc of each archive (columns name, refers, arc), written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, refers, arc in zip(*(column(batch, c) for c in ("name", "refers", "arc")), strict=True):
                offsets = {r["offset"]: r["page_id"] for r in refers.as_py() or ()}
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py().removesuffix(".arc") + ".warc"]), pa.array([convert(name.as_py(), arc.as_py(), offsets)], pa.binary())], ["name", "warc"])

    return stage(arcs.mapInArrow(run, "name string, warc binary"), "warc")


def read_warc(archives: DataFrame) -> DataFrame:
    """One row a response or revisit: page_id, payload_bytes, payload_digest, record_type, refers_to, and the record's URL, id and date."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_id string, record_date string"
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for warc in column(batch, "warc"):
                rows = []
                for fields, block in parse_warc(warc.as_py()):
                    if fields["WARC-Type"] not in ("response", "revisit"):
                        continue
                    head = bytes(block[:65536])
                    cut = head.index(b"\r\n\r\n") + 4
                    if fields["WARC-Type"] == "response":
                        size, digest = len(block) - cut, sha1(block[cut:])
                        if digest != fields["WARC-Payload-Digest"]:
                            raise ValueError(f"digest of {fields['WARC-Record-ID']} doesn't hold")
                    else:
                        size = int(http_headers(head[:cut])["content-length"])
                    number = lambda k, fields=fields: int(fields[k]) if k in fields else None
                    rows.append((number("X-Page-Id"), size, base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(), fields["WARC-Type"], number("X-Refers-To-Page-Id"), fields["WARC-Target-URI"], fields["WARC-Record-ID"], fields["WARC-Date"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return archives.select("warc").mapInArrow(run, schema)


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q
"""
