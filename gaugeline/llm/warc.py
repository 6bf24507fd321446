"""Web archives: writing captures as WARC files, reading them back, and assembling each capture from its records.

Files. A capture is three records: the request, the response (or, for a payload that is stored already, a revisit without it)
and metadata, the latter tied to the response by WARC-Concurrent-To. Each record is a gzip member of its own, each file
begins with a warcinfo record and is closed at `FILE_BYTES`. Files go to the shared work folder, on any store that Arrow
can open, under names that no other attempt uses; a table of files lists those of successful tasks alone, so repeated
or speculative tasks leave at most unlisted files. The reader takes that list (or any other), a file a task, and
holds one record at a time. It reads any WARC file, compressed by record, as a whole, or not at all.

Revisits. Of equal payloads of `MIN_BYTES` or more the one with the smallest key is stored; the others refer to it. Digests
are merged before they are shuffled. Digests with more than one in `HOT_SHARE` of all rows are at most `HOT_SHARE`, so they
are sent to all tasks; rows of all others meet their digest by a join, in which no group is larger than that share.

Assembly. Record identifiers and the identifiers they name as concurrent are links, read in both directions. Requests
and metadata linked to a response belong to its capture, then those linked to these, until no more are found; payloads stay
out of these joins. Each capture becomes one nested row, with the record of smallest identifier of each kind and
the number of records of each kind; `capture_of` lists where each record belongs, further ones included.

Cases: null and empty payloads are empty responses; a null key stands for no number: such rows revisit the smallest key of their
payload or, without one, are responses; rows that repeat the smallest key are all responses; a null address leaves the
target out; control characters, spaces and characters beyond ASCII in addresses and keys are percent-encoded; an empty
table gives no files and no captures; requests and metadata without a response give a row whose response is null; a broken
file fails with its name and place. Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.tables import stored
from gaugeline.session import work_dir

MIN_BYTES = 100
HOT_SHARE = 10_000
FILE_BYTES = 32 << 20
UNKNOWN_DATE = "1970-01-01T00:00:00Z"
ANCHORS = ("response", "revisit", "resource")
MEMBERS = ("request", "metadata")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SAFE = "".join(map(chr, range(33, 127)))
_KEY_SAFE = _SAFE.replace("%", "")


# --- which captures are revisits

def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """key, url, payload, digest, refers_to: the key of the response that a revisit refers to, null for responses."""
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), text.alias("payload"), F.sha2(text, 256).alias("digest"),
                        (F.octet_length(text) >= min_bytes).alias("shared"))
    firsts = rows.filter("shared").groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    firsts = stored(firsts, "payloads")
    hot = F.col("n") > pages.count() / HOT_SHARE
    rows = rows.join(F.broadcast(firsts.filter(hot).select("digest", F.col("first").alias("hot"))), "digest", "left")
    alone = F.concat_ws(":", "digest", F.xxhash64("key", "url"))
    rows = rows.withColumn("met", F.when(F.col("shared") & F.col("hot").isNull(), F.col("digest")).otherwise(alone))
    rows = rows.join(firsts.filter(~hot).select(F.col("digest").alias("met"), "first"), "met", "left")
    first = F.when(F.col("shared"), F.coalesce("hot", "first"))
    return rows.select("key", "url", "payload", "digest", F.when(~F.col("key").eqNullSafe(first), first).alias("refers_to"))


# --- writing

def _record(kind: str, record_id: str, block: bytes, *headers: tuple[str, str | None]) -> bytes:
    lines = [f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {record_id}\r\n", *(f"{k}: {v}\r\n" for k, v in headers if v is not None),
             f"Content-Length: {len(block)}\r\n\r\n"]
    return gzip.compress("".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


class _Writer:
    """The files of one task."""

    def __init__(self, folder: str, date: str, file_bytes: int):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.folder, self.date, self.limit, self.file, self.done = folder, date, file_bytes, None, []

    def open(self) -> None:
        name = uuid.uuid4().hex
        self.store.create_dir(self.path, recursive=True)
        self.prefix, self.n, self.bytes, self.name = name[:16], 0, 0, f"{self.folder}/{name}.warc.gz"
        self.file = self.store.open_output_stream(f"{self.path}/{name}.warc.gz", compression=None)
        self.put("warcinfo", self.next_id(), b"format: WARC File Format 1.1\r\n", ("Content-Type", "application/warc-fields"))

    def next_id(self) -> str:
        self.n += 1
        h = f"{self.prefix}{self.n:016x}"
        return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"

    def put(self, kind: str, record_id: str, block: bytes, *headers: tuple[str, str | None]) -> None:
        data = _record(kind, record_id, block, ("WARC-Date", self.date), *headers)
        self.file.write(data)
        self.bytes += len(data)

    def capture(self, key, url: str | None, payload: bytes, digest: str, refers_to) -> None:
        if self.file is None:
            self.open()
        target = quote(url, safe=_SAFE) if url else None
        try:
            parts = urlsplit(target or "")
            asked, host = (parts.path or "/") + (f"?{parts.query}" if parts.query else ""), parts.netloc
        except ValueError:  # not an address that can be taken apart
            asked, host = "/", ""
        uri, main = ("WARC-Target-URI", target), self.next_id()
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        http, summed = ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")
        fields = [("key", key), ("refers-to", refers_to)]
        self.put("request", self.next_id(), f"GET {asked} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode(), uri, ("WARC-Concurrent-To", main),
                 ("Content-Type", "application/http; msgtype=request"))
        if refers_to is None:
            self.put("response", main, head + payload, uri, summed, http)
        else:
            self.put("revisit", main, head, uri, summed, http, ("WARC-Profile", PROFILE))
        self.put("metadata", self.next_id(), "".join(f"{k}: {quote(str(v), safe=_KEY_SAFE)}\r\n" for k, v in fields if v is not None).encode(), uri,
                 ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields"))
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.name, self.n, self.bytes))
            self.file = None


def write_archives(captures: DataFrame, folder: str | None = None, date: str = UNKNOWN_DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the rows of `with_revisits`; returns the stored list of files: path, n_records, n_bytes."""
    folder = folder or work_dir(captures.sparkSession, "archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder, date, file_bytes)
        for batch in batches:
            for i in range(batch.num_rows):
                key, url, payload, digest, refers_to = (c[i] for c in batch.columns)
                writer.capture(key.as_py(), url.as_py(), payload.as_buffer().to_pybytes(), digest.as_py(), refers_to.as_py())
        writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in writer.done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         names=["path", "n_records", "n_bytes"])

    rows = captures.select("key", "url", F.col("payload").cast("binary"), "digest", "refers_to")
    return stored(rows.mapInArrow(run, "path string, n_records bigint, n_bytes bigint"), "archive-files")


# --- reading

_FIELDS = pa.map_(pa.string(), pa.string())
_READ = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())),
    ("target_uri", pa.string()), ("date", pa.string()), ("headers", _FIELDS), ("fields", _FIELDS), ("start_line", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_right", pa.bool_()), ("payload", pa.binary())])
_READ_DDL = ("file string, place bigint, record_id string, type string, concurrent_to array<string>, target_uri string, date string, "
             "headers map<string,string>, fields map<string,string>, start_line string, payload_bytes bigint, payload_digest string, "
             "digest_right boolean, payload binary")


def _fields(raw: bytes) -> list[tuple[str, str]]:
    """name: value lines, names in lower case; a line that begins with white space continues the one before."""
    out: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").splitlines():
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip().lower(), value.strip()))
    return out


def records_of(file) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and block of each record of an open file."""
    begin = file.read(2)
    file.seek(0)
    stream = gzip.GzipFile(fileobj=file) if begin == b"\x1f\x8b" else io.BufferedReader(file)
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = []
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError("the file ends within headers")
            head.append(line)
        headers = _fields(b"".join(head))
        size = int(dict(headers)["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the file ends within a block")
        yield headers, block


def _row(path: str, place: int, headers: list[tuple[str, str]], block: bytes, payloads: bool) -> tuple:
    one = dict(headers)
    kind, content = one.get("warc-type", ""), one.get("content-type", "")
    fields, start, payload = [], None, block
    if content.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        first, _, rest = head.partition(b"\r\n")
        start, fields = first.decode("utf-8", "replace"), _fields(rest)
    elif content.startswith("application/warc-fields"):
        fields = _fields(block)
    stated = one.get("warc-payload-digest", "")
    if kind == "revisit":  # the payload is elsewhere; what is known of it stands in the headers
        length = dict(fields).get("content-length", "")
        size, digest, right = int(length) if length.isdigit() else None, stated.partition(":")[2] or None, None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        right = stated == f"sha256:{digest}" if stated.startswith("sha256:") else None
    return (path, place, one.get("warc-record-id"), kind, [v for k, v in headers if k == "warc-concurrent-to"], one.get("warc-target-uri"),
            one.get("warc-date"), list(one.items()), list(dict(fields).items()), start, size, digest, right, payload if payloads else None)


def read_records(files: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives named in `path`, without payloads if not wanted; sizes and digests are of the payloads read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inner = fs.FileSystem.from_uri(path)
                held, size, place = [], 0, 0
                with store.open_input_file(inner) as file:
                    try:
                        for headers, block in records_of(file):
                            held.append(_row(path, place, headers, block, payloads))
                            place += 1
                            size += 1000 + (len(block) if payloads else 0)
                            if size > 4 << 20:
                                yield batch_of(held)
                                held, size = [], 0
                    except (ValueError, KeyError, EOFError, OSError) as wrong:
                        raise ValueError(f"{path}, record {place}: {wrong}") from wrong
                if held:
                    yield batch_of(held)

    tasks = max(1, files.count())
    dealt = files.select("path").repartitionByRange(tasks, "path") if tasks > 1 else files.select("path")
    return dealt.mapInArrow(run, _READ_DDL)


# --- assembling

def capture_of(records: DataFrame) -> DataFrame:
    """record_id and capture_id of every request and metadata record; the capture is the response they are linked to, however
    far, or, without a response, the smallest identifier among themselves and their neighbours."""
    named = records.filter(F.col("record_id").isNotNull()).select(F.col("record_id").alias("member"), F.explode("concurrent_to").alias("target"))
    links = named.unionByName(named.select(F.col("target").alias("member"), F.col("member").alias("target")))
    anchors = records.filter(F.col("type").isin(*ANCHORS)).select(F.col("record_id").alias("target"))
    members = records.filter(F.col("type").isin(*MEMBERS)).select("record_id").distinct()
    links = stored(links.join(members.withColumnRenamed("record_id", "member"), "member", "left_semi"), "links")
    found = stored(links.join(anchors, "target", "left_semi").groupBy("member").agg(F.min("target").alias("capture_id")), "captures")
    while True:
        left = links.join(found, "member", "left_anti")
        more = left.join(found.select(F.col("member").alias("target"), "capture_id"), "target").groupBy("member").agg(F.min("capture_id").alias("capture_id"))
        more = stored(more, "captures")
        if more.isEmpty():
            break
        found = stored(found.unionByName(more), "captures")
    alone = left.groupBy("member").agg(F.least(F.min("target"), F.first("member")).alias("capture_id"))
    known = found.unionByName(alone)
    return members.join(known, members["record_id"] == known["member"], "left").select(
        "record_id", F.coalesce("capture_id", "record_id").alias("capture_id"))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id; response, request, metadata, each a struct of the record's columns; n_responses, n_requests,
    n_metadata. The records are read more than once: store them first."""
    columns = [c for c in records.columns if c not in ("concurrent_to",)]
    owned = records.filter(F.col("type").isin(*MEMBERS)).join(capture_of(records), "record_id", "left")
    own = records.filter(F.col("type").isin(*ANCHORS)).withColumn("capture_id", F.col("record_id"))
    rows = own.unionByName(owned).select("capture_id", F.struct(*columns).alias("r"))
    out = []
    for name, plural, kinds in (("response", "n_responses", ANCHORS), ("request", "n_requests", ("request",)), ("metadata", "n_metadata", ("metadata",))):
        mine = F.col("r.type").isin(*kinds)
        out += [F.min_by("r", F.when(mine, F.struct("r.record_id", "r.file", "r.place"))).alias(name), F.count_if(mine).alias(plural)]
    return rows.groupBy("capture_id").agg(*out)


def key_of(metadata_field: str):
    """A field of the metadata record as it was given to the writer, as a string."""
    return F.url_decode(F.replace(F.col("metadata.fields")[metadata_field], F.lit("+"), F.lit("%2B")))


#: The registered query in DuckDB's SQL.
SQL = """
WITH sums AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM sums WHERE payload_bytes >= 100 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN f.first IS NULL OR page_id IS NOT DISTINCT FROM f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM sums LEFT JOIN firsts f USING (payload_digest)
"""
