"""Web archives: one gzip member per record, written by tasks to the shared folder and read back in sequence.

Writing: payloads are identified by their digests; of equal ones the page with the least id holds the payload
(``response``), the others refer to it (``revisit``). Each task streams its records into archives of
bounded size. A file gets its name from the attempt that wrote it, and only files of successful attempts are in the
manifest, a small table; a lost executor leaves files that nobody reads.

Reading: an archive is one stream. Members are inflated in small steps, records are framed by their content length,
and both digests are verified, so one record's payload is held at a time at most, or none.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalograph.llm.tables import written
from catalograph.session import scratch_path

CHUNK = 1 << 16
ARCHIVE_BYTES = 256 << 20
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:catalograph:page")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"  # the pages carry no date


class CorruptArchive(ValueError):
    """What was read is not what was written."""


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def record_id(page_id: int | None, digest: str) -> str:
    """The id of the one record of a page id and payload."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {digest}')}>"


# ---------------------------------------------------------------- writing

def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
           repeated: bool = False, vague: bool = False) -> bytes:
    """One record as a gzip member. A revisit has the response's header only, with the full payload's length.

    A ``repeated`` record, one of several with its page id and payload, has a random id. Where the response is such a
    one (``vague``), a revisit names its page but no record.
    """
    digest = base32_sha1(hashlib.sha1(payload).digest())
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>" if repeated else record_id(page_id, digest)),
              ("WARC-Date", _DATE),
              ("WARC-Target-URI", urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else "urn:unknown"),
              ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Block-Digest", "sha1:" + base32_sha1(hashlib.sha1(block).digest())),
              ("WARC-Payload-Digest", "sha1:" + digest)]
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("Refers-To-Page-ID", str(refers_to))]
        fields += [] if vague else [("WARC-Refers-To", record_id(refers_to, digest))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join((pack.compress(head.encode()), pack.compress(block), pack.compress(b"\r\n\r\n"), pack.flush()))


def _store(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder's URI; a plain path is a mounted one."""
    return pyarrow.fs.FileSystem.from_uri(folder)


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        done: list[tuple[str, int, int]] = []
        stream, name, records, size = None, "", 0, 0
        for batch in batches:
            for page_id, url, html, *role in zip(*(column for column in batch.columns)):
                if stream is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    stream, records, size = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                payload = (html.as_py() or "").encode()
                member = record(page_id.as_py(), url.as_py(), payload, *(value.as_py() for value in role))
                stream.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    stream.close()
                    done.append((name, records, size))
                    stream = None
        if stream is not None:
            stream.close()
            done.append((name, records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["archive", "records", "bytes"])

    return run


def roles(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page, payload, first, repeated, vague)`` of all records that are more than a response of their own: the payload's
    hash; of a revisit the least page id with that payload, else null; whether several rows have this page id and payload,
    and whether several have the least page id.

    Payloads below ``least_bytes`` never refer to another. The payload itself is hashed and not moved.
    """
    hashes = pages.select(F.col(id_col).alias("page"), F.sha2(F.coalesce(html_col, F.lit("")), 256).alias("payload"),
                          F.octet_length(F.coalesce(html_col, F.lit(""))).alias("n"))
    copies = hashes.groupBy("page", "payload").agg(F.count("*").alias("copies"), F.max("n").alias("n"))
    first = copies.where(F.col("n") >= least_bytes).groupBy("payload").agg(
        F.min("page").alias("first"), F.min_by("copies", "page").alias("first_copies"), F.count("*").alias("pages")).where("pages > 1")
    known = copies.join(first.drop("pages"), "payload", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")) & (F.col("n") >= least_bytes)
    known = known.select("page", "payload", F.when(revisit, F.col("first")).alias("first"), (F.col("copies") > 1).alias("repeated"),
                         F.coalesce(revisit & (F.col("first_copies") > 1), F.lit(False)).alias("vague"))
    return written(known.where("first IS NOT NULL OR repeated"), "revisits")


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row of ``pages`` and return the manifest ``(archive, records, bytes)``, itself written.

    ``archive`` is a full path. A null html is an empty payload, a null url ``urn:unknown``. Rows that repeat the
    least page id of a payload are all responses; a null id refers to the least id if there is one. Record ids are unique:
    made of page id and payload, random for rows that repeat both. An empty table gives no archive. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = (folder or scratch_path(spark, "llm-warc")).rstrip("/")
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    known = roles(pages, least_bytes, id_col, html_col)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        F.sha2(F.coalesce(html_col, F.lit("")), 256).alias("hash"))
    # the table of revisits is read with its true size, so Spark broadcasts it only where it is small
    joined = rows.join(known, F.col("page_id").eqNullSafe(F.col("page")) & (F.col("hash") == F.col("payload")), "left")
    rows = joined.select("page_id", "url", "html", F.col("first").alias("refers_to"), F.col("first").isNotNull().alias("revisit"),
                         F.coalesce("repeated", F.lit(False)).alias("repeated"), F.coalesce("vague", F.lit(False)).alias("vague"))
    manifest = rows.mapInArrow(_writer(folder, archive_bytes), "archive string, records long, bytes long")
    return written(manifest.withColumn("archive", F.concat(F.lit(folder + "/"), "archive")), "manifest")


# ---------------------------------------------------------------- reading

@dataclass
class Record:
    """A verified record. ``payload`` is None where it was not asked for, and for revisits."""

    fields: dict[str, str]
    payload_bytes: int
    payload_digest: str
    payload: bytes | None = field(default=None, repr=False)
    offset: int = 0


class _Members:
    """Inflated bytes of one gzip member after the other from a stream, a chunk at a time."""

    def __init__(self, stream):
        self.stream, self.raw, self.read_bytes = stream, b"", 0

    def open(self) -> bool:
        """Begin the next member; False at the end of the archive."""
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
            self.read_bytes += len(self.raw)
        self.offset = self.read_bytes - len(self.raw)
        self.inflate = zlib.decompressobj(31)
        self.ready = b""
        return bool(self.raw)

    def _more(self) -> bool:
        while not self.ready and not self.inflate.eof:
            raw = self.inflate.unconsumed_tail or self.raw
            if not self.inflate.unconsumed_tail:
                self.raw = b""
                if not raw:
                    raw = self.stream.read(CHUNK)
                    self.read_bytes += len(raw)
                if not raw:
                    raise CorruptArchive("the archive ends inside a member")
            try:
                self.ready = self.inflate.decompress(raw, CHUNK)
            except zlib.error as problem:
                raise CorruptArchive(f"no gzip data: {problem}") from problem
            if self.inflate.eof:
                self.raw = self.inflate.unused_data
        return bool(self.ready)

    def take(self, most: int) -> bytes:
        """Up to ``most`` bytes, at least one; raises at the member's end."""
        if not self._more():
            raise CorruptArchive("the member ends inside a record")
        out, self.ready = self.ready[:most], self.ready[most:]
        return out

    def head(self, most: int = 1 << 20) -> bytes:
        """Everything up to an empty line."""
        out = b""
        while b"\r\n\r\n" not in out:
            if len(out) > most:
                raise CorruptArchive("a header without end")
            out += self.take(CHUNK)
        head, _, rest = out.partition(b"\r\n\r\n")
        self.ready = rest + self.ready
        return head

    def close(self) -> None:
        if self._more():
            raise CorruptArchive("a member holds more than its record")


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    return first, {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not value.isdigit():
        raise CorruptArchive("a record without content length")
    return int(value)


def read_records(stream, keep_payload: bool = True) -> Iterator[Record]:
    """All records of an archive in sequence, each verified before the next is read."""
    members = _Members(stream)
    while members.open():
        version, fields = _fields(members.head())
        if not version.startswith("WARC/1."):
            raise CorruptArchive("no WARC record")
        left = _length(fields)
        revisit = fields.get("warc-type") == "revisit"
        block, payload, parts, size = hashlib.sha1(), hashlib.sha1(), [], 0
        head = b""  # of the HTTP message, up to its empty line
        while left:
            part = members.take(left)
            left -= len(part)
            block.update(part)
            if head is not None:
                head += part
                if b"\r\n\r\n" not in head:
                    continue
                http, _, part = head.partition(b"\r\n\r\n")
                head = None
            size += len(part)
            payload.update(part)
            if keep_payload:
                parts.append(part)
        end = b""
        while len(end) < 4:
            end += members.take(4 - len(end))
        if end != b"\r\n\r\n" or head is not None:
            raise CorruptArchive("a block that does not have its content length")
        members.close()
        if fields.get("warc-block-digest") != "sha1:" + base32_sha1(block.digest()):
            raise CorruptArchive("a block digest differs")
        given = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        whole = _length(_fields(http)[1])
        if revisit and size or not revisit and (size != whole or given != base32_sha1(payload.digest())):
            raise CorruptArchive("a payload digest or length differs")
        yield Record(fields, whole, given, b"".join(parts) if keep_payload and not revisit else None, members.offset)


_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "archive string, position long")


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _SCHEMA.split(", ")] + ["payload"] * with_payload
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        types += [pa.binary()] * with_payload
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = _store(path)
                with store.open_input_stream(place, compression=None) as stream:
                    rows, held = [], 0
                    for r in read_records(stream, with_payload):
                        number = r.fields.get
                        rows.append((_int(number("page-id")), number("warc-target-uri"), r.payload_bytes, r.payload_digest,
                                     number("warc-type"), _int(number("refers-to-page-id")), path, r.offset,
                                     *[r.payload] * with_payload))
                        held += len(r.payload or b"") + 200
                        if held > 8 << 20:
                            yield _batch(rows, names, types)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names, types)

    return run


def _int(value: str | None) -> int | None:
    return None if value is None else int(value)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the archives in ``manifest(archive, ...)``, an archive a task; a damaged archive raises.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, for revisits too; ``refers_to`` is null
    for responses. ``position`` is the member's place in the archive.
    """
    archives = max(1, manifest.count())
    schema = _SCHEMA + (", payload binary" if with_payload else "")
    return manifest.select("archive").repartition(archives).mapInArrow(_reader(with_payload), schema)
