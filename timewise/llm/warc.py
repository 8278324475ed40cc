"""Zstandard WARC archives: written from a table, read back record by record.

An archive is a ``.warc.zst`` file: a leading skippable frame that holds the
dictionary, then one Zstandard frame per WARC record, each with its content
size and checksum and decodable on its own.  The reader loads the dictionary
from the leading frame, finds the frames by their block headers, decodes one
frame at a time and validates what it finds: frame sizes, the version line,
mandatory fields, ``Content-Length`` of record and HTTP block, the closing
line ends and the payload digest.

Archives are written by Spark's own writer, so they land in any store Spark
can write to, and a lost task leaves no half file.  That writer ends a file
with a line end; the last frame is a skippable one of one byte, and the line
end is that byte.  A file holds about ``archive_bytes``; a larger record has a
file of its own.

Of records with equal payloads of at least ``min_bytes`` the one with the
least id is a response and the others are revisits that refer to it.  The
least id of every payload comes from an aggregation by SHA-256 (combined
map-side, so a payload that fills a third of the table is one row per task);
only payloads that occur twice are joined back, by broadcast up to a counted
size and shuffled beyond it.

Edge cases: a null payload is an empty payload; a null url leaves the field
out; control characters, spaces and non-ASCII characters of a url are percent-encoded; a
null id is a record without a number, always a revisit where its payload has
a numbered record, else a response; rows that repeat the least id of their
payload are all responses; an empty table writes no archive and reads as an
empty table; extra columns are ignored; a very long payload is one record.
"""
from __future__ import annotations

import base64
import hashlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small
from .textblock import lean

#: Fixed values of the formats.
FRAME, SKIPPABLE, DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"

ARCHIVE_BYTES = 16 << 20


class BadArchive(ValueError):
    """What an archive breaks of its format."""


# --- frames ---------------------------------------------------------------

def skippable(payload_size: int, magic: int = SKIPPABLE) -> bytes:
    return magic.to_bytes(4, "little") + payload_size.to_bytes(4, "little")


def frame_end(data: bytes, at: int) -> tuple[int, int]:
    """(magic, end) of the frame at ``at``, from its header and its block
    headers; nothing is decoded."""
    import zstandard
    if at + 8 > len(data):
        raise BadArchive("frame header cut off")
    magic = int.from_bytes(data[at:at + 4], "little")
    if magic & 0xFFFFFFF0 == SKIPPABLE:
        end = at + 8 + int.from_bytes(data[at + 4:at + 8], "little")
    elif magic == FRAME:
        try:
            end = at + zstandard.frame_header_size(data[at:at + 18])
        except zstandard.ZstdError as e:
            raise BadArchive("frame header cut off") from e
        last = False
        while not last:
            if end + 3 > len(data):
                raise BadArchive("frame cut off")
            head = int.from_bytes(data[end:end + 3], "little")
            last, kind = head & 1, head >> 1 & 3
            if kind == 3:
                raise BadArchive("reserved block type")
            end += 3 + (1 if kind == 1 else head >> 3)
        end += 4 if data[at + 4] & 4 else 0
    else:
        raise BadArchive("no frame starts here")
    if end > len(data):
        raise BadArchive("frame cut off")
    return magic, end


def frames(data: bytes):
    """(offset, dictionary or None, frame) of every record frame of a file."""
    import zstandard
    at, dictionary = 0, None
    while at < len(data):
        magic, end = frame_end(data, at)
        if magic == FRAME:
            yield at, dictionary, data[at:end]
        elif at == 0 and magic == DICTIONARY:
            dictionary = data[at + 8:end]
            if dictionary[:4] == FRAME.to_bytes(4, "little"):
                dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
        at = end


# --- records --------------------------------------------------------------

def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]")


def record_bytes(ident: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: <{ID}{quote(ident or '', safe='')}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        head.insert(2, f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{ID}{quote(refers_to, safe='')}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadArchive("field without a name")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def _number(fields: dict[str, str], name: str) -> int:
    if not fields.get(name, "").isascii() or not fields.get(name, "").isdigit():
        raise BadArchive(f"no number in {name}")
    return int(fields[name])


def _ident(uri: str) -> str | None:
    if not uri.startswith(f"<{ID}") or not uri.endswith(">"):
        return uri
    return unquote(uri[len(ID) + 1:-1]) or None


def parse_record(data: bytes) -> dict:
    """The record of one decoded frame; BadArchive says what is wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in VERSIONS:
        raise BadArchive("no WARC version line")
    f = _fields(lines[1:])
    if missing := [m for m in MANDATORY if m not in f]:
        raise BadArchive(f"field missing: {missing[0]}")
    if len(rest) != _number(f, "content-length") + 4 or not rest.endswith(b"\r\n\r\n"):
        raise BadArchive("Content-Length differs from the block")
    kind, block = f["warc-type"], rest[:-4]
    out = {"record_id": _ident(f["warc-record-id"]), "record_type": kind, "url": f.get("warc-target-uri"), "date": f["warc-date"],
           "payload_bytes": len(block), "payload_digest": f.get("warc-payload-digest", "").removeprefix("sha1:") or None,
           "refers_to": _ident(f["warc-refers-to"]) if "warc-refers-to" in f else None, "payload": block}
    if not f.get("content-type", "").startswith("application/http"):
        return out
    http, found, payload = block.partition(b"\r\n\r\n")
    lines = http.split(b"\r\n")
    if not found or not lines[0].startswith(b"HTTP/"):
        raise BadArchive("no HTTP status line")
    size = _number(_fields(lines[1:]), "content-length")
    out |= {"payload_bytes": size, "payload": payload}
    if kind == "revisit":
        if payload or not out["payload_digest"] or "warc-refers-to" not in f:
            raise BadArchive("revisit with a payload, or without digest or reference")
    elif len(payload) != size:
        raise BadArchive("HTTP Content-Length differs from the payload")
    elif out["payload_digest"] and out["payload_digest"] != digest_of(payload):
        raise BadArchive("payload digest differs")
    return out


# --- Spark ----------------------------------------------------------------

def train_dictionary(pages: DataFrame, payload_col: str = "html", sample_rows: int = 400, piece: int = 8192, size: int = 32 << 10) -> bytes:
    """A dictionary from the beginnings of at most ``sample_rows`` payloads
    (at most ``sample_rows * piece`` bytes reach the driver).  It only bears
    on how small archives are.  Empty where there is too little to learn."""
    import zstandard
    rows = pages.select(F.col(f"`{payload_col}`").cast("binary").alias("p")).where("octet_length(p) >= 64").limit(sample_rows)
    pieces = [bytes(r["p"]) for r in rows.select(F.substring("p", 1, piece).alias("p")).collect()]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes() if len(pieces) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(id, url, payload, refers_to): refers_to is the least id of an equal
    payload, null for the record that is the response."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.expr("cast('' as binary)")).alias("payload"))
    key = F.sha2("payload", 256).alias("sha")
    twice = (rows.where(F.octet_length("payload") >= min_bytes).select("id", key).groupBy("sha")
             .agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1 and least is not null").select("sha", "least"))
    return (rows.withColumn("sha", F.sha2("payload", 256)).join(small(twice), "sha", "left")
            .select("id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("least")), F.col("least")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
                   dictionary: bytes | None = None, archive_bytes: int = ARCHIVE_BYTES, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row of ``pages``, in archives below ``folder``."""
    words = train_dictionary(pages, payload_col) if dictionary is None else dictionary
    rows = with_revisits(pages, id_col, url_col, payload_col, min_bytes)

    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(words) if words else None,
                                        write_checksum=True, write_content_size=True)
        first = skippable(len(words), DICTIONARY) + words if words else b""
        held, size = [first], 0

        def closed():
            return pa.RecordBatch.from_arrays([pa.array([b"".join([*held, skippable(1)])], pa.binary())], ["archive"])

        for batch in batches:
            for ident, url, payload, refers in zip(*(batch.column(c) for c in ("id", "url", "payload", "refers_to"))):
                frame = pack.compress(record_bytes(ident.as_py(), url.as_py(), payload.as_py(), refers.as_py(), date))
                if size and size + len(frame) > archive_bytes:
                    yield closed()
                    held, size = [first], 0
                held.append(frame)
                size += len(frame)
        if size:
            yield closed()

    (rows.select(F.col("id").cast("string"), "url", "payload", F.col("refers_to").cast("string")).mapInArrow(lean(run, 200), "archive binary")
     .select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(folder))


RECORD = ("path string, offset long, record_id string, record_type string, url string, date string, payload_bytes long, "
          "payload_digest string, refers_to string, error string")


def read_archives(spark: SparkSession, folder: str, payloads: bool = True, strict: bool = True) -> DataFrame:
    """One row per record of the archives below ``folder``: path, offset,
    record_id, record_type, url, date, payload_bytes, payload_digest,
    refers_to, error and, with ``payloads``, the payload.

    ``strict`` fails on the first broken record.  Otherwise a broken record is
    a row that says in ``error`` what is wrong; reading goes on behind its
    frame, or ends with the file where no frame can be made out."""
    names = [c.split()[0] for c in RECORD.split(", ")] + (["payload"] if payloads else [])
    types = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, types.get(n, pa.string())) for n in names])

    def records(path: str, data: bytes):
        import zstandard
        at, reader, words = 0, None, b""
        walk = frames(data)
        while True:
            try:
                at, dictionary, frame = next(walk)
            except StopIteration:
                return
            except BadArchive as e:
                yield {"path": path, "offset": at, "error": str(e)}
                return
            if reader is None or dictionary is not words:
                words = dictionary
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
            try:
                raw = reader.decompressobj().decompress(frame)
                size = zstandard.get_frame_parameters(frame).content_size
                if size < 1 << 63 and size != len(raw):
                    raise BadArchive("frame content size differs")
                yield {"path": path, "offset": at, **parse_record(raw)}
            except (BadArchive, zstandard.ZstdError) as e:
                yield {"path": path, "offset": at, "error": str(e)}

    def run(batches):
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                for r in records(path, content.as_py()):
                    if strict and "error" in r:
                        raise BadArchive(f"{r['error']}: {r['path']} at {r['offset']}")
                    if not payloads:
                        r.pop("payload", None)
                    rows.append(r)
                    held += len(r.get("payload", b""))
                    if len(rows) >= 2000 or held > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")
    return files.mapInArrow(lean(run), RECORD + (", payload binary" if payloads else ""))
