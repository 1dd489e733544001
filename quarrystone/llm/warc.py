"""WARC archives: writing, normalising whole-file gzip streams, reading by offset.

``write_archives`` writes one gzip stream over a whole archive, as careless tools
do; no record can be read from it without inflating all before. The normaliser
inflates each such stream once, piece by piece, rewrites every record as a gzip
member of its own and writes a sidecar index of offsets. ``read_archives`` seeks
each member by the index.

Files are reached through pyarrow's file systems by URI, so the folder can be in
any store that executors share. A task that is run again writes under another
name, and only the names that committed tasks returned are read.

An archive can be one gzip stream or several behind each other; records can go
across their borders. Archives of other tools are read as they come: field names in
any case, folded lines, any bytes in headers (what isn't UTF-8 is read as Latin-1),
bare newlines for line ends, blank lines between records, records of any type, and
responses without a digest or with one in another alphabet; those are made anew. Of
their records, ids that aren't this module's are told as text. A record without a
length, or an archive that ends within a stream or a record, is a named error.

Defined cases: a null payload is an empty one; white space in a url is written as
%XX; ids are whole numbers; of rows with equal payloads and
the same largest page_id each is a response; rows whose group has no id at all
are responses; payloads shorter than ``min_revisit_bytes`` are never revisits;
null urls are written as empty; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, new_path, ship

ARCHIVE_BYTES = 64 << 20  # an archive is closed once it holds so many bytes before compression
PIECE = 1 << 20
MOST_HEAD = 16 << 20  # bytes of a record's header
HEAD_END = re.compile(rb"\r?\n\r?\n")
BLANK = re.compile(rb"[\r\n]*")
LINE_END = re.compile(r"\r?\n")
OWN_ID = re.compile(r"<urn:page:(-?[0-9]+)>")
SPACES = re.compile(r"[\s\x00-\x1F]+")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit carries the payload's digest and length, not the payload."""
    block = HTTP + (b"" if revisit else payload)
    heads = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {SPACES.sub(lambda m: quote(m[0]), url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(heads).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BrokenArchive(ValueError):
    """An archive that can't be read to its end; the text tells where and why."""


def parse_heads(data: bytes) -> dict[str, str]:
    """Fields of a header by their names in small letters; of a repeated one the first."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        text = data.decode("latin-1")
    lines: list[str] = []
    for line in LINE_END.split(text):
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()  # goes on with the line before
        elif line:
            lines.append(line)
    if not lines or not lines[0].upper().startswith("WARC/"):
        raise BrokenArchive(f"not a WARC record: {data[:40]!r}")
    heads: dict[str, str] = {}
    for k, _, v in (x.partition(":") for x in lines[1:]):
        heads.setdefault(k.strip().lower(), v.strip())
    return heads


def split_record(data: bytes | bytearray) -> tuple[dict[str, str], int, int] | None:
    """(fields, start of the block, its length) of what begins with a record; None if its header isn't whole yet."""
    m = HEAD_END.search(data)
    if not m:
        return None
    heads = parse_heads(bytes(data[: m.start()]))
    length = heads.get("content-length", "")
    if not length.isdigit() or not length.isascii():
        raise BrokenArchive(f"record {heads.get('warc-record-id')} has no length")
    return heads, m.end(), int(length)


class RecordCutter:
    """Cuts whole records, header and block, out of a stream that is fed in pieces."""

    def __init__(self) -> None:
        self.rest = bytearray()
        self.need = 0
        self.looked = 0  # no header ends before here

    def feed(self, data: bytes) -> Iterator[bytes]:
        self.rest += data
        while True:
            if not self.need:
                blank = BLANK.match(self.rest).end()  # what divides records
                del self.rest[:blank]
                if blank:
                    self.looked = 0
                if not HEAD_END.search(self.rest, max(0, self.looked - 3)):
                    self.looked = len(self.rest)
                    if self.looked > MOST_HEAD:
                        raise BrokenArchive("a header without an end")
                    return
                _, start, length = split_record(self.rest)
                self.need = start + length
            if len(self.rest) < self.need:
                return
            yield bytes(self.rest[: self.need])
            del self.rest[: self.need]
            self.need = self.looked = 0


def _open(uri: str):  # noqa: ANN202
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _rows(columns: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(columns.values())], [*columns])


def plan_records(pages: DataFrame, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to, revisit): the kind of record of each page."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    last = rows.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 and last is not null").drop("n")
    last = materialize(last, "warc-last", compact=True)  # apart, so that Spark can split a hot payload in the join
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")) & (F.length("payload") >= min_revisit_bytes)
    return rows.join(last, "digest", "left").select("page_id", "url", "payload", F.when(revisit, F.col("last")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write whole-file gzip archives below folder: (archive, records)."""
    ship(planned.sparkSession)
    out = {"archive": pa.string(), "records": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        state: list = []

        def close() -> tuple[str, int]:
            sink, squeeze, name, n, _ = state
            sink.write(squeeze.flush())
            sink.close()
            state.clear()
            return name, n

        for b in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not state:
                    name = f"whole-{uuid.uuid4().hex}.warc.gz"
                    state[:] = [store.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), name, 0, 0]
                data = record(page_id, url, payload, refers_to, revisit)
                state[0].write(state[1].compress(data))
                state[3] += 1
                state[4] += len(data)
                if state[4] >= archive_bytes:
                    yield _rows(out, [close()])
        if state:
            yield _rows(out, [close()])

    return planned.mapInArrow(run, "archive string, records long")


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with a gzip member for each record, and a sidecar index: (archive, idx, records)."""
    ship(archives.sparkSession)
    out = {"archive": pa.string(), "idx": pa.string(), "records": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        for b in batches:
            for name in b["archive"].to_pylist():
                to = f"members-{uuid.uuid4().hex}.warc.gz"
                at = n = 0
                inflate, cut = zlib.decompressobj(31), RecordCutter()  # a new inflater for each member of the archive
                with store.open_input_stream(f"{base}/{name}", compression=None) as source, store.open_output_stream(f"{base}/{to}", compression=None) as sink, store.open_output_stream(f"{base}/{to}.idx", compression=None) as side:
                    while piece := source.read(PIECE):
                        while piece:
                            if inflate.eof:  # another member follows
                                if not (piece := piece.lstrip(b"\0")):  # padding behind a member
                                    break
                                inflate = zlib.decompressobj(31)
                            data = inflate.decompress(piece, 4 * PIECE)
                            piece = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                            for whole in cut.feed(data):
                                squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
                                member = squeeze.compress(whole) + squeeze.compress(b"\r\n\r\n") + squeeze.flush()
                                heads = split_record(whole)[0]
                                sink.write(member)
                                side.write((json.dumps({"offset": at, "length": len(member), "id": heads.get("warc-record-id"), "type": heads.get("warc-type"), "digest": heads.get("warc-payload-digest")}) + "\n").encode())
                                at += len(member)
                                n += 1
                if not inflate.eof or cut.rest.strip(b"\r\n"):
                    raise BrokenArchive(f"{name} is cut short")
                yield _rows(out, [(to, f"{to}.idx", n)])

    return archives.select("archive").mapInArrow(run, "archive string, idx string, records long")


def _payload(heads: dict[str, str], block: bytes) -> bytes:
    """What a record carries: of an HTTP message its body, else the whole block."""
    if not heads.get("content-type", "").lower().startswith("application/http"):
        return block
    m = HEAD_END.search(block)
    return block[m.end() :] if m else b""


def _told_digest(text: str) -> tuple[str, bytes] | None:
    """(algorithm, digest) of a field such as ``sha1:...``, in base32 or hexadecimal; None if it is neither."""
    kind, _, value = text.strip().partition(":")
    kind, size = kind.strip().lower().replace("-", ""), {"sha1": 20, "md5": 16, "sha256": 32}.get(kind.strip().lower().replace("-", ""))
    value = value.strip()
    if size is None:
        return None
    try:
        if len(value) == 2 * size:
            return kind, bytes.fromhex(value)
        found = base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except ValueError:
        return None
    return (kind, found) if len(found) == size else None


_RECORD = "record_id string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_to_id string, payload binary"


def read_archives(normalised: DataFrame, folder: str) -> DataFrame:
    """Read every record by its offset: (record_id, page_id, url, payload_bytes, payload_digest, record_type, refers_to, refers_to_id, payload).

    A payload whose digest isn't the one that its record tells is a named error. A
    revisit has no payload; its length and digest are the ones told, or null.
    """
    ship(normalised.sparkSession)
    out = {"record_id": pa.string(), "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "refers_to_id": pa.string(), "payload": pa.binary()}

    def number(x: str | None) -> int | None:
        m = OWN_ID.fullmatch(x or "")
        return int(m[1]) if m else None

    def told(name: str, data: bytes) -> tuple:
        heads, start, length = split_record(data)
        payload = _payload(heads, data[start : start + length])
        kind, own = heads.get("warc-type", ""), heads.get("warc-record-id")
        said = _told_digest(heads.get("warc-payload-digest", ""))
        size = heads.get("x-payload-length", "")
        if kind == "revisit":
            to = heads.get("warc-refers-to")
            digest = base64.b32encode(said[1]).decode() if said and said[0] == "sha1" else None
            return own, number(own), heads.get("warc-target-uri", ""), int(size) if size.isdigit() else None, digest, kind, number(to), to, None
        if said and hashlib.new(said[0], payload).digest() != said[1] or size.isdigit() and int(size) != len(payload):
            raise BrokenArchive(f"{name}: payload of {own} is damaged")
        return own, number(own), heads.get("warc-target-uri", ""), len(payload), base32_sha1(payload), kind, None, None, payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        for b in batches:
            for name, idx in zip(b["archive"].to_pylist(), b["idx"].to_pylist(), strict=True):
                rows: list[tuple] = []
                held = 0
                with store.open_input_file(f"{base}/{name}") as f, store.open_input_stream(f"{base}/{idx}", compression=None) as side:
                    for line in io.BufferedReader(side):
                        entry = json.loads(line)
                        f.seek(entry["offset"])
                        rows.append(told(name, zlib.decompress(f.read(entry["length"]), 31)))
                        held += len(rows[-1][-1] or b"")
                        if held >= 8 << 20:
                            yield _rows(out, rows)
                            rows, held = [], 0
                if rows:
                    yield _rows(out, rows)

    return normalised.select("archive", "idx").mapInArrow(run, _RECORD)


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages as whole-file archives, normalise those, and read the records back."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    whole = materialize(write_archives(plan_records(pages, min_revisit_bytes), folder, archive_bytes), "warc-whole")
    members = materialize(normalise_archives(whole.repartition(spread), folder), "warc-members")
    return read_archives(members.repartition(spread), folder)
