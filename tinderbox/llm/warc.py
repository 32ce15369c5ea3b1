"""WARC archives: a writer of one gzip member per record, and a splittable reader.

The reader gives tasks byte ranges of the files. A task looks for gzip magic in its range; a candidate is a record
if it decodes to a WARC head and a block of the stated length. The first one must also be followed by another record's
head or the end of the file, whole members of other kinds between them aside; if it is not, it may lie inside a record
that is stored uncompressed, and records are walked to it from one before it that is in no doubt, to tell. From there
on records follow each other, read through one buffer. A task owns the records that start inside its
range, wherever they end, and reports stretches after them that hold no record. Only several records in a row, stored
uncompressed inside another one, could still pass for records of their own; what `write_warc` writes cannot hold
them, as UTF-8 text never contains gzip magic.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize, slices

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 18
FIRST_PIECE = 1 << 12
SPLIT_BYTES = 4 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = {n.lower(): n for n in (
    "WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Refers-To", "WARC-Payload-Digest", "WARC-Profile",
    "Content-Type", "Content-Length",
)}
DATE = "1970-01-01T00:00:00Z"
RECORDS = "path string, member_start long, headers map<string,string>, http_headers map<string,string>, payload binary, error string"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (local, HDFS, object stores) or an absolute path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit keeps the head of its response, but no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def writer(folder: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = open_folder(folder)
        final = f"{base}/part-{task.partitionId():06d}.warc.gz"
        draft = f"{base}/_draft-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, n = None, 0
        for batch in slices(batches):
            if out is None:
                out = store.open_output_stream(draft, compression=None)
            for row in batch.to_pylist():
                out.write(record(row["page_id"], row["url"], row["payload"], row["refers_to"]))
                n += 1
        if out is not None:
            out.close()
            store.move(draft, final)  # a repeated attempt puts the same file in the same place
            yield pa.RecordBatch.from_pydict({"file": [final], "records": [n]})

    return write


def write_warc(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> int:
    """Write a record per page (page_id, url, html) below `folder`; the number of records.

    Of pages with equal payloads of at least `min_revisit_bytes` bytes, the one with the smallest id is
    the response and the others revisit it; rows that share this id are all responses, and null ids
    come after all others. Payloads count as equal by SHA-256. Those that several pages share are written
    as a table first, so that Spark can split the join where a third of all pages share one.
    """
    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    shared = (
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("same")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    records = rows.join(materialize(shared, "shared-payloads"), "same", "left").select("page_id", "url", "payload", refers.alias("refers_to"))
    written = materialize(records.mapInArrow(writer(folder), "file string, records long"), "warc-manifest")
    return written.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


def _head(data: bytes) -> dict[str, str]:
    """Fields of a head by name. Names are told apart without case and written as in NAMES or as first met; values of
    a repeated name are joined by newlines, which no value contains."""
    fields: dict[str, list[str]] = {}
    names, last = dict(NAMES), None
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and last is not None:
            last[-1] += " " + line.strip()
        elif colon:
            last = fields.setdefault(names.setdefault(name.strip().lower(), name.strip()), [])
            last.append(value.strip())
    return {name: "\n".join(values) for name, values in fields.items()}


class Buffered:
    """A file read by position. The last two stretches fetched are kept, so going on, or a little back, fetches nothing twice."""

    def __init__(self, file, size: int):
        self.file, self.size, self.held = file, size, [(0, b""), (0, b"")]

    def read(self, at: int, n: int) -> bytes:
        """Up to `n` bytes from `at`, none at the end of the file only."""
        for start, data in self.held:
            if start <= at < start + len(data):
                return data[at - start : at - start + n]
        self.file.seek(at)
        data = self.file.read(min(CHUNK, self.size - at))
        self.held = [(at, data), self.held[0]]
        return data[:n]

    def pieces(self, at: int) -> Iterator[bytes]:
        """The bytes from `at` on, in pieces that begin small: many records are."""
        n = FIRST_PIECE
        while at < self.size and (piece := self.read(at, n)):
            yield piece
            at += len(piece)
            n = min(2 * n, CHUNK)


def opens_record(file: Buffered, at: int) -> bool:
    """Whether a gzip member starts at `at` that decodes to the first word of a record."""
    decoder, data = zlib.decompressobj(31), b""
    try:
        for piece in file.pieces(at):
            data += decoder.decompress(piece, 5 - len(data))
            if len(data) == 5 or decoder.eof:
                break
    except zlib.error:
        return False
    return data == b"WARC/"


def member(file: Buffered, at: int) -> tuple[int, dict[str, str], bytes] | None:
    """(end, headers, block) of the record that starts at `at`, or None if none does."""
    decoder, data, pos = zlib.decompressobj(31), bytearray(), at
    try:
        for piece in file.pieces(at):
            pos += len(piece)
            data += decoder.decompress(piece)
            if decoder.eof or (len(data) >= 5 and not data.startswith(b"WARC/")):
                break
    except zlib.error:
        return None
    cut = data.find(b"\r\n\r\n")
    if not decoder.eof or cut < 0 or not data.startswith(b"WARC/"):
        return None
    headers = _head(bytes(data[:cut]))
    block = bytes(data[cut + 4 :])
    length = headers.get("Content-Length", "")
    if not length.isdigit() or len(block) != int(length) + 4:
        return None
    return pos - len(decoder.unused_data), headers, block[:-4]


def _member_end(file: Buffered, at: int) -> int | None:
    """The end of the gzip member that starts at `at`, whatever it holds, or None if none does."""
    decoder = zlib.decompressobj(31)
    try:
        for piece in file.pieces(at):
            at += len(piece)
            decoder.decompress(piece)
            if decoder.eof:
                return at - len(decoder.unused_data)
    except zlib.error:
        pass
    return None


def _next_magic(file: Buffered, pos: int, limit: int) -> int:
    """The first gzip magic in [pos, limit), else `limit`."""
    last = b""
    while pos < limit:
        window = last + file.read(pos, limit - pos)
        hit = window.find(MAGIC)
        if hit >= 0:
            return pos - len(last) + hit
        pos += len(window) - len(last)
        last = window[1 - len(MAGIC) :]
    return limit


def _in_sequence(file: Buffered, pos: int) -> Iterator[tuple[int, tuple[int, dict[str, str], bytes] | int]]:
    """(start, record) of all records from `pos` on, where a record starts or ended, and (start, end) of stretches without."""
    while pos < file.size:
        found = member(file, pos)
        if found is not None:
            yield pos, found
            pos = found[0]
            continue
        at = pos
        while at < file.size and found is None:
            at = _member_end(file, at) or _next_magic(file, at + 1, file.size)
            found = member(file, at) if at < file.size else None
        yield pos, at
        pos = at


def _followed(file: Buffered, at: int) -> bool:
    """Whether a record or the end of the file comes at `at`, or after whole gzip members that hold no record."""
    while at < file.size:
        if opens_record(file, at):
            return True
        end = _member_end(file, at)
        if end is None:
            return False
        at = end
    return True


def _candidates(file: Buffered, pos: int, end: int) -> Iterator[tuple[int, bool]]:
    """Starts of sound records in [pos, end) that lie in no other one of them, and whether each is followed as records are."""
    while pos < end and (at := _next_magic(file, pos, min(end + 2, file.size))) < end:
        found = member(file, at)
        if found is None:
            pos = at + 1
        else:
            yield at, _followed(file, found[0])
            pos = found[0]


def _first_start(file: Buffered, start: int, end: int) -> int:
    """Where a sequence that covers the records starting in [start, end) begins.

    If what follows the first candidate leaves in doubt whether it is a record of its own, records are walked
    to it from the nearest place before it that is in no doubt, looked for in stretches that double.
    """
    at, sure = next(_candidates(file, start, end), (file.size, True))
    if sure:
        return at
    back = CHUNK
    while True:
        low = max(0, start - back)
        origin = next((s for s, proven in _candidates(file, low, start) if proven), None) if low else 0
        if origin is not None:
            return next((s for s, _ in _in_sequence(file, origin) if s >= start), file.size)
        back *= 2


def records_between(file, start: int, end: int, size: int) -> Iterator[tuple[int, dict[str, str] | None, bytes]]:
    """(start, headers, block) of the records that start in [start, end); and (start, None, message) of each stretch
    without a record that follows one of them, or the start of the file."""
    reports, file = start == 0, Buffered(file, size)
    for at, found in _in_sequence(file, _first_start(file, start, end) if start else 0):
        if isinstance(found, int):
            if reports:
                yield at, None, f"no record in bytes {at} to {found}".encode()
        elif at < end:
            reports = True
            yield at, found[1], found[2]
        if at >= end:
            return


def _range_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("path", pa.string()), ("member_start", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
         ("http_headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("error", pa.string())]
    )

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        for job in batch.to_pylist():
            store, path = open_folder(job["path"])
            rows, held = [], 0
            with store.open_input_file(path) as file:
                for at, headers, block in records_between(file, job["start"], job["end"], job["length"]):
                    if headers is None:
                        rows.append((job["path"], at, None, None, None, block.decode()))
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
                    revisit = headers.get("WARC-Type") == "revisit"
                    digest = headers.get("WARC-Payload-Digest", "")
                    if not revisit and digest.startswith("sha1:") and digest[5:] != sha1_base32(payload):
                        raise ValueError(f"payload of {path} at {at} does not match its digest")
                    rows.append((job["path"], at, list(headers.items()), list(_head(head).items()), None if revisit else payload, None))
                    held += len(payload)
                    if held > CHUNK * 16:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_warc(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of all *.warc.gz files below a folder, read in ranges of `split_bytes`.

    Columns: path, member_start, headers, http_headers, payload (null for revisits) and error. An empty folder or
    empty files give no rows. A stretch without a record (padding, other members, damaged records) gives one row with
    its start and an error and nulls otherwise; a payload that does not match its digest stops the job. Values of a
    repeated field are joined by newlines.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.warc.gz")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
        .where("length > 0")
    )
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start")).withColumn(
        "end", F.least(F.col("start") + split_bytes, F.col("length"))
    )
    tasks = files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1
    return ranges.repartition(int(tasks), "path", "start").mapInArrow(_range_reader, RECORDS)


def page_records(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """What the records of `write_warc` say of their pages: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A stretch of the files without a record stops the job.
    """
    def number(header: str):
        return F.regexp_extract(F.col("headers")[header], r"<urn:page:(-?[0-9]+)>", 1)

    def page(header: str):
        return F.when(F.col("headers")[header].isNotNull(), number(header).cast("long"))

    broken = F.raise_error(F.concat_ws(": ", "path", "error")).cast("long")
    return read_warc(spark, folder, split_bytes).select(
        F.when(F.col("error").isNotNull(), broken).otherwise(page("WARC-Record-ID")).alias("page_id"),
        F.col("http_headers")["Content-Length"].cast("long").alias("payload_bytes"),
        F.substring_index(F.col("headers")["WARC-Payload-Digest"], ":", -1).alias("payload_digest"),
        F.col("headers")["WARC-Type"].alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )
