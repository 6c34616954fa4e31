"""WARC archives: written in one gzip stream, then normalised record by record.

* :func:`write_archives` writes rows as WARC/1.1 records, one archive for each
  task, in Spark's text format: a record ends with two line ends, which is the
  writer's line separator, and gzip runs over the whole file. Spark's own commit
  keeps only what finished tasks wrote.
* :func:`normalise` inflates each such file once, as a stream, and writes every
  record as a gzip member of its own, with a sidecar index of offsets beside the
  archive. A task names its output anew and returns the index rows; only the
  rows of tasks that finished count, so a lost or repeated task leaves nothing
  but an unnamed file. Records of any size pass through in pieces.
* :func:`read_records` reads records back through the index: members are dealt
  to tasks by bytes, each is sought, inflated and measured anew.

Payloads are any bytes; in :func:`write_archives` the UTF-8 of a text, null as
empty. Of equal payloads those with the smallest id are responses, the others
revisit them; a row without an id comes after all ids. Rows that repeat id and
payload are alike: all responses or all revisits. No rows, no records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable

#: Fixed values of the format.
LINE, RECORD_END = "\r\n", "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Bytes read at a time, and bytes of members that one task reads back.
PIECE_BYTES, READ_BYTES = 1 << 20, 128 << 20
MOST_HEADER_BYTES = 1 << 20


# ---------------------------------------------------------------- writing
def sha1_base32(payload: Column) -> Column:
    """The payload's SHA-1 in upper-case base32: 40 bits make eight characters."""
    low = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(low, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _record_id(page: Column, digest: Column) -> Column:
    """A name that follows from id and payload, in the form of a UUID."""
    h = F.sha2(F.concat(digest, F.coalesce(F.concat(F.lit(":"), page.cast("string")), F.lit(""))), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``value``: each row as a WARC record without its end."""
    rows = pages.select(F.col(page_id).alias("page"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("body"))
    rows = rows.withColumn("digest", sha1_base32(F.encode("body", "UTF-8")))
    # only payloads that occur more than once need a partner; one row for each
    shared = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("page").alias("first")).where("n > 1").select(F.col("digest").alias("_digest"), "first")
    rows = rows.join(shared, F.col("digest") == F.col("_digest"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    address = F.col("url")
    for bad, good in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        address = F.replace(address, F.lit(bad), F.lit(good))
    size = F.octet_length("body").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=UTF-8{LINE}Content-Length: "), size, F.lit(RECORD_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    header = F.concat_ws(
        LINE, F.lit(VERSION), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page"), F.col("digest"))), F.lit(f"WARC-Date: {date}"),
        _line("WARC-Target-URI", address), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")), F.when(revisit, _line("WARC-Refers-To", _record_id(F.col("first"), F.col("digest")))),
        F.lit("Content-Type: application/http; msgtype=response"), _line("Content-Length", F.octet_length(block).cast("string")),
        _line("X-Source-Id", F.col("page").cast("string")))
    return rows.select(F.concat(header, F.lit(RECORD_END), block).alias("value"))


def write_archives(pages: DataFrame, folder: str, **columns) -> None:
    """One gzip stream for each task under ``folder``, which must be new."""
    records(pages, **columns).write.option("lineSep", RECORD_END).option("compression", "gzip").text(folder)


# ------------------------------------------------------------ normalising
def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path)


def inflated(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The content of a gzip file of one member or many, piece by piece."""
    engine, begun = zlib.decompressobj(31), False
    while piece := read(PIECE_BYTES):
        while piece:
            if engine.eof:
                piece = piece.lstrip(b"\0")
                if not piece:
                    break
                engine = zlib.decompressobj(31)
            begun = True
            out = engine.decompress(piece, PIECE_BYTES)
            if out:
                yield out
            piece = engine.unused_data if engine.eof else engine.unconsumed_tail
    if begun and not engine.eof:
        raise ValueError("the gzip stream is cut short")


class Stream:
    """Bytes asked for one run after another from pieces of any size."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held = pieces, b""

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def header(self) -> bytes | None:
        """Up to and with the empty line that ends a header; None at the end.
        Line ends before it are passed over."""
        while True:
            self.held = self.held.lstrip(b"\r\n")
            if self.held or not self._more():
                break
        if not self.held:
            return None
        searched = 0
        while (end := self.held.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(self.held) - 3)
            if len(self.held) > MOST_HEADER_BYTES or not self._more():
                raise ValueError("a record's header does not end")
        head, self.held = self.held[: end + 4], self.held[end + 4 :]
        return head

    def run(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.held and not self._more():
                raise ValueError("a record is cut short")
            piece, self.held = self.held[:size], self.held[size:]
            size -= len(piece)
            yield piece


def fields(head: bytes) -> dict[str, str]:
    """A WARC header's named fields, names in lower case."""
    first, *lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    pairs = (x.partition(":") for x in lines if ":" in x)
    return {a.strip().lower(): b.strip() for a, _, b in pairs}


def rewrite(pieces: Iterator[bytes], write: Callable[[bytes], None]) -> Iterator[dict]:
    """Every record of a stream as its own gzip member; its index row."""
    stream, offset = Stream(pieces), 0
    while (head := stream.header()) is not None:
        f = fields(head)
        size = int(f.get("content-length", "0"))
        packer, length = zlib.compressobj(6, zlib.DEFLATED, 31), 0
        for piece in [head], stream.run(size), [b"\r\n\r\n"]:
            for x in piece:
                if out := packer.compress(x):
                    write(out)
                    length += len(out)
        out = packer.flush()
        write(out)
        length += len(out)
        yield {"offset": offset, "length": length, "record_type": f.get("warc-type"), "record_id": f.get("warc-record-id"), "block_bytes": size}
        offset += length


_INDEX = "archive string, offset long, length long, record_type string, record_id string, block_bytes long"
_INDEX_KINDS = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("block_bytes", pa.int64())])


def normalise(spark: SparkSession, source: str, target: str, pattern: str = "*.gz") -> DataFrame:
    """Rewrites every file under ``source`` into ``target`` (both on storage that
    all executors share) and returns the index: ``(archive, offset, length,
    record_type, record_id, block_bytes)``. Beside each archive lies its
    sidecar, ``<archive>.idx``, one JSON object a line."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source).select("path")
    files = max(1, listed.count())
    folder, place = _place(target)
    folder.create_dir(place, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = _place(path)
                out, base = _place(target)
                name = f"{path.rsplit('/', 1)[-1].split('.')[0]}-{uuid.uuid4().hex}.warc.gz"
                with store.open_input_stream(at, compression=None) as source_, out.open_output_stream(f"{base}/{name}", compression=None) as written, out.open_output_stream(f"{base}/{name}.idx", compression=None) as sidecar:
                    held = []
                    for row in rewrite(inflated(source_.read), written.write):
                        sidecar.write(json.dumps(row).encode() + b"\n")
                        held.append({"archive": f"{target}/{name}", **row})
                        if len(held) == 4096:
                            yield pa.RecordBatch.from_pylist(held, schema=_INDEX_KINDS)
                            held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=_INDEX_KINDS)

    return durable(listed.repartition(files).mapInArrow(run, _INDEX))


# ---------------------------------------------------------------- reading
_RECORD = "archive string, offset long, record_type string, record_id string, source_id string, url string, refers_to string, stated_digest string, payload_digest string, payload_bytes long"
_RECORD_KINDS = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in _RECORD.split(", ")])


def parsed(member: bytes, with_payload: bool = False) -> dict:
    """A record from its gzip member. The payload is what follows the HTTP
    header, or the whole block of a record without one."""
    raw = zlib.decompress(member, 31)
    end = raw.index(b"\r\n\r\n") + 4
    f = fields(raw[:end])
    block = raw[end : end + int(f.get("content-length", "0"))]
    http = f.get("content-type", "").startswith("application/http")
    payload = block.partition(b"\r\n\r\n")[2] if http else block
    stated = f.get("warc-payload-digest")
    row = {
        "record_type": f.get("warc-type"), "record_id": f.get("warc-record-id"), "source_id": f.get("x-source-id"), "url": f.get("warc-target-uri"),
        "refers_to": f.get("warc-refers-to"), "stated_digest": stated.rpartition(":")[2] if stated else None,
        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(), "payload_bytes": len(payload),
    }
    return row | {"payload": payload} if with_payload else row


def read_records(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of an index, each read from its member: digest and size are
    those of the payload found there (for a revisit: of none)."""
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // READ_BYTES))
    dealt = index.select("archive", "offset", "length").withColumn("_part", F.floor(F.col("offset") / READ_BYTES))
    dealt = dealt.repartition(max(tasks, index.sparkSession.sparkContext.defaultParallelism), "archive", "_part").sortWithinPartitions("archive", "offset").drop("_part")
    kinds = _RECORD_KINDS.append(pa.field("payload", pa.binary())) if with_payload else _RECORD_KINDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, held, size = None, None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["archive"] != name:
                    if file is not None:
                        file.close()
                    name = row["archive"]
                    store, at = _place(name)
                    file = store.open_input_file(at)
                file.seek(row["offset"])
                got = parsed(file.read(row["length"]), with_payload)
                held.append({"archive": name, "offset": row["offset"], **got})
                size += got["payload_bytes"] if with_payload else 512
                if size >= 8 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)
                    held, size = [], 0
        if file is not None:
            file.close()
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=kinds)

    return dealt.mapInArrow(run, _RECORD + (", payload binary" if with_payload else ""))


#: Parts into which the revisits of one response are dealt.
SALTS = 64


def resolved(found: DataFrame) -> DataFrame:
    """Records with a revisit's payload size and digest taken from the response
    that it refers to, and that response's ``refers_source_id``. However many
    revisits one response has, they are dealt to ``SALTS`` parts; the response
    goes to each part that holds any."""
    answers = found.where("record_type = 'response'").groupBy(F.col("record_id").alias("_to")).agg(
        F.max("source_id").alias("_source"), F.max("payload_digest").alias("_digest"), F.max("payload_bytes").alias("_bytes"))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("archive", "offset"), F.lit(SALTS)))
    asked = salted.where("record_type = 'revisit'").select(F.col("refers_to").alias("_asked"), F.col("_salt").alias("_part")).distinct()
    given = asked.join(answers, F.col("_asked") == F.col("_to"))
    joined = salted.join(given, (F.col("refers_to") == F.col("_asked")) & (F.col("_salt") == F.col("_part")), "left")
    revisit = F.col("record_type") == "revisit"
    own = [c for c in found.columns if c not in ("payload_digest", "payload_bytes")]
    return joined.select(
        *own, F.when(revisit, F.col("_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), F.when(revisit, F.col("_source")).alias("refers_source_id"))
