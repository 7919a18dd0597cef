"""WARC archives with a two-level capture index.

Writing: Arrow tasks write gzip members, one record each, to archive files below the shared
folder; payloads that equal an earlier capture's are written as revisit records. Indexing:
capture lines are range-sorted by reversed-host URL key and written as compressed blocks with
a sparse directory (first key, offset, length of each block), one index file and one
directory per range. Reading: a capture's range is found among the ranges' first keys (as
many as partitions), its block by binary search of the directory, its line by binary search
of the block, and the record by one range read of the archive.

Files are written under attempt-unique names and only those named in a committed table are
read, so a lost or repeated task leaves nothing but an unused file.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import uuid
import zlib
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from faresight.llm.common import Workspace, join_back, shuffle_partitions

ROTATE = 64 << 20
BLOCK_LINES = 1000
MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"


def _open(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder)


def surt(url: str | None) -> str:
    """Reversed-host key: scheme dropped, host labels reversed, path and query kept;
    ``https://www.a.org/x?y`` is ``org,a,www)/x?y``. Not a URL: the text itself."""
    if not url:
        return ""
    try:
        p = urlsplit(url.strip())
        host = (p.hostname or "").rstrip(".")
        port = f":{p.port}" if p.port else ""
    except ValueError:
        return url
    if not host:
        return url
    return ",".join(reversed(host.split("."))) + port + ")" + (p.path or "/") + (f"?{p.query}" if p.query else "")


def key_of(url: str | None, page: str) -> str:
    return f"{surt(url)} {page}".replace("\n", "%0A").replace("\r", "%0D").replace("\t", "%09")


def record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header alone, whose Content-Length is
    the full payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if refers_to:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


_PAGE = re.compile(r"<urn:page:(.*)>")


def parse(member: bytes) -> dict:
    """Headers, type, page, payload size and digest of a record; a response's payload is
    hashed again and must agree with its header."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(h["Content-Length"])]
    if len(block) != int(h["Content-Length"]):
        raise ValueError("record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
    page = _PAGE.match(h["WARC-Record-ID"])[1]
    if h["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of page {page} does not agree with its header")
    refers = h.get("WARC-Refers-To")
    return {"page": page, "type": h["WARC-Type"], "size": size, "digest": digest, "refers_to": _PAGE.match(refers)[1] if refers else None,
            "url": h.get("WARC-Target-URI"), "payload": payload if h["WARC-Type"] == "response" else None}


def _write(folder: str):
    def run(batches):
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        out, name, at = None, None, 0
        for b in batches:
            rows = []
            for page, pid, url, payload, digest, refers in zip(*(b.column(i).to_pylist() for i in range(6))):
                if out is None or at >= ROTATE:
                    if out is not None:
                        out.close()
                    name, at = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:10]}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                m = gzip_member(record(page, url, payload or b"", digest, refers))
                out.write(m)
                rows.append((pid, page, key_of(url, page), name, at, len(m)))
                at += len(m)
            c = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(c, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             names=["page_id", "page", "key", "file", "offset", "length"])
        if out is not None:
            out.close()
    return run


def _index(folder: str):
    def run(batches):
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        stem = f"index-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:10]}"
        out, at, directory, lines, first = None, 0, [], [], None

        def flush():
            nonlocal at, lines, first
            data = zlib.compress("\n".join(lines).encode())
            out.write(data)
            directory.append((first, at, len(data)))
            at += len(data)
            lines, first = [], None

        n = 0
        for b in batches:
            for key, file, offset, length in zip(*(b.column(i).to_pylist() for i in range(4))):
                if out is None:
                    out = system.open_output_stream(f"{path}/{stem}.cdx", compression=None)
                first = key if first is None else first
                lines.append(f"{key}\t{file}\t{offset}\t{length}")
                n += 1
                if len(lines) >= BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            with system.open_output_stream(f"{path}/{stem}.dir", compression=None) as d:
                d.write(json.dumps(directory).encode())
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([stem]), pa.array([n], pa.int64())], names=["first", "stem", "n"])
    return run


class CaptureIndex:
    """Reader of one range's index file: directory, then block, then line, by binary search."""

    def __init__(self, folder: str, stem: str):
        self.system, self.path = _open(folder)
        self.stem = stem
        with self.system.open_input_file(f"{self.path}/{stem}.dir") as f:
            self.directory = json.loads(f.read())
        self.firsts = [d[0] for d in self.directory]
        self.file = self.system.open_input_file(f"{self.path}/{stem}.cdx")
        self.block_no, self.keys, self.lines = -1, [], []

    def find(self, key: str):
        k = bisect.bisect_right(self.firsts, key) - 1
        if k < 0:
            return None
        if k != self.block_no:
            _, offset, length = self.directory[k]
            self.file.seek(offset)
            self.lines = [x.split("\t") for x in zlib.decompress(self.file.read(length)).decode().split("\n")]
            self.keys, self.block_no = [x[0] for x in self.lines], k
        i = bisect.bisect_left(self.keys, key)
        if i == len(self.keys) or self.keys[i] != key:
            return None
        _, file, offset, length = self.lines[i]
        return file, int(offset), int(length)

    def close(self):
        self.file.close()


def _read(archives: str, index: str, stems: list[str]):
    def run(batches):
        system, path = _open(archives)
        held: dict = {}
        ix = None
        for b in batches:
            rows = []
            for page_id, key, part in zip(*(b.column(i).to_pylist() for i in range(3))):
                if ix is None or ix.stem != stems[part]:
                    if ix is not None:
                        ix.close()
                    ix = CaptureIndex(index, stems[part])
                hit = ix.find(key)
                if hit is None:
                    raise LookupError(f"no capture of {key!r}")
                file, offset, length = hit
                if file not in held:
                    if len(held) >= 64:
                        held.pop(next(iter(held))).close()
                    held[file] = system.open_input_file(f"{path}/{file}")
                held[file].seek(offset)
                r = parse(held[file].read(length))
                rows.append((page_id, r["size"], r["digest"], r["type"], int(r["refers_to"]) if r["refers_to"] else None))
            c = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(c, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        for f in held.values():
            f.close()
        if ix is not None:
            ix.close()
    return run


def write_archives(pages: DataFrame, ws: Workspace) -> tuple[DataFrame, str]:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns the captures
    (page_id, page, key, file, offset, length) and the archives' folder.

    Of rows with equal payloads of at least 100 bytes the one with the smallest page_id is a
    response and the others revisit it; shorter payloads are all responses. A null html is an
    empty payload, a null url has an empty key. Rows of a null page_id are always responses;
    rows that repeat the smallest page_id are responses too."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256)).withColumn("row", F.monotonically_increasing_id())
    narrow = ws.table(src.filter((F.octet_length("payload") >= MIN_REVISIT) & F.col("page_id").isNotNull())
                      .groupBy("digest").agg(F.min("page_id").alias("response"), F.count(F.lit(1)).alias("cnt")).filter("cnt > 1"), "repeated")
    total = narrow.agg(F.sum("cnt")).first()[0] or 1
    j = join_back(src, narrow, ["digest"], total, how="left")
    own = (F.col("page_id") == F.col("response")) | F.col("response").isNull() | F.col("page_id").isNull() | (F.octet_length("payload") < MIN_REVISIT)
    page = F.concat_ws(".", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.col("row").cast("string"))
    folder = ws.folder("archives")
    rows = j.select(page.alias("page"), "page_id", "url", "payload", "digest", F.when(~own, F.col("response").cast("string")).alias("refers"))
    return ws.table(rows.mapInArrow(_write(folder), "page_id long, page string, key string, file string, offset long, length long"), "captures"), folder


def build_index(captures: DataFrame, ws: Workspace) -> tuple[str, list[tuple[str, str]]]:
    """Writes the two-level index; returns its folder and (first key, index file) by range,
    at most as many as shuffle partitions."""
    folder = ws.folder("index")
    n = shuffle_partitions(captures.sparkSession)
    parts = captures.select("key", "file", "offset", "length").repartitionByRange(n, "key").sortWithinPartitions("key") \
        .mapInArrow(_index(folder), "first string, stem string, n long")
    rows = ws.table(parts, "ranges").select("first", "stem").collect()
    return folder, sorted((r["first"], r["stem"]) for r in rows)


def read_back(wanted: DataFrame, archives: str, index: str, ranges: list[tuple[str, str]]) -> DataFrame:
    """Records of the captures ``wanted`` (page_id, key) through the index; a key without a
    capture is an error."""
    firsts, stems = [f.encode() for f, _ in ranges], [s for _, s in ranges]

    def place(batches):
        for b in batches:
            part = [max(0, bisect.bisect_right(firsts, k.encode()) - 1) for k in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part, pa.int32())], names=["page_id", "key", "part"])

    placed = wanted.select("page_id", "key").mapInArrow(place, "page_id long, key string, part int")
    return placed.repartition(max(1, len(ranges)), "part").sortWithinPartitions("part", "key").mapInArrow(
        _read(archives, index, stems), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from
    archives that are written, indexed and read back record by record."""
    ws = Workspace(pages.sparkSession, "warc")
    captures, archives = write_archives(pages, ws)
    index, ranges = build_index(captures, ws)
    return read_back(captures, archives, index, ranges)
