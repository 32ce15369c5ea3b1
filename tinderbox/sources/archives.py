"""Zipped feed files as a Spark data source, unpacked on the executors.

`feed_archives` lists a folder, lets Spark push conditions on day and file name into the listing, and deals the
files that are left by size over partitions; files outside the window are never opened. Each archive is read and inflated
once: its checksums hold before its first line leaves. Files are reached through `pyarrow.fs`, so any
address it knows works; `unpack` does the same with contents that Spark has read.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from tinderbox.schemas import FeedSpec
from tinderbox.sources.delimited import parse_lines

BLOCK_BYTES = 1 << 20
PARTITION_BYTES = 2 << 20  # of packed files in one partition
HOLD_BYTES = 256 << 20  # larger members are inflated twice, once to check them, rather than held
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
ROWS = "path string, filename string, day string, line bigint, value binary, error string"


def _globs(spec: FeedSpec) -> str:
    return f"*.{spec.file_suffix}.{{CSV,csv}}{{.zip,.sampled_*.*.zip}}"


def name_pattern(spec: FeedSpec) -> str:
    """Names of a feed's full and sampled archives."""
    return rf".*\.{re.escape(spec.file_suffix)}\.(CSV|csv)(\.zip|\.sampled_.*\..*\.zip)"


def list_archives(spark: SparkSession, folder: str, spec: FeedSpec) -> DataFrame:
    """(path, length, filename) of the full and sampled archives of one feed; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", _globs(spec)).load(folder).select("path", "length")
    return files.withColumn("filename", F.element_at(F.split("path", "/"), -1))


def read_archives(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length, content) of exactly these files, by Spark's own reader; no others are opened."""
    reader = spark.read.format("binaryFile")
    return reader.load(paths) if paths else spark.createDataFrame([], "path string, length bigint, content binary")


_DAMAGE = (zipfile.BadZipFile, ValueError, EOFError, NotImplementedError, RuntimeError, zlib.error)


def _blocks(raw: io.BufferedIOBase, header: bool) -> Iterator[bytes]:
    """What follows the header, in blocks that end before a newline."""
    if header:
        raw.readline()
    rest = b""
    while chunk := raw.read(BLOCK_BYTES):
        head, newline, tail = (rest + chunk).rpartition(b"\n")
        if newline:
            yield head
        rest = tail
    if rest:
        yield rest


def member_blocks(content: bytes, header: bool, hold: int = HOLD_BYTES) -> Iterator[bytes]:
    """Blocks of whole lines of the first `.csv` member; raises before the first block if it can't be read to its end."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if n.lower().endswith(".csv")]
        if not names:
            raise ValueError("no csv member")
        if z.getinfo(names[0]).file_size <= hold:
            text = io.BytesIO(z.read(names[0]))
            yield from _blocks(text, header)
            return
        with z.open(names[0]) as raw:
            while raw.read(BLOCK_BYTES):
                pass
        with z.open(names[0]) as raw:
            yield from _blocks(raw, header)


def _split(block: bytes) -> pa.Array:
    if b"\r" in block:
        block = block.replace(b"\r\n", b"\n").removesuffix(b"\r")  # the newline after a block is gone already
    return pc.split_pattern(pa.array([block], pa.binary()), pattern="\n").flatten()


def archive_rows(path: str, content: bytes, header: bool, md5: str | None = None, hold: int = HOLD_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of ROWS: the lines of an archive that are not empty, with their numbers, then one row without a value
    that holds the number of the last line, and the fault if there is one; a faulty archive has no lines.

    An empty file is sound, whatever its listed checksum.
    """
    name = path.rsplit("/", 1)[-1]
    day, at, fault = name.split(".", 1)[0], 0, None

    def batch(lines: pa.Array, numbers: pa.Array, error: str | None) -> pa.RecordBatch:
        n = len(lines)
        columns = [pa.array([x] * n, pa.string()) for x in (path, name, day)]
        return pa.RecordBatch.from_arrays([*columns, numbers, lines, pa.array([error] * n, pa.string())], names=["path", "filename", "day", "line", "value", "error"])

    try:
        if content and md5 and hashlib.md5(content).hexdigest() != md5:
            raise ValueError("checksum differs from the listed one")
        for block in member_blocks(content, header, hold) if content else ():
            lines = _split(block)
            numbers = pa.array(range(at + 1, at + len(lines) + 1), pa.int64())
            at += len(lines)
            filled = pc.greater(pc.binary_length(lines), 0)
            yield batch(lines.filter(filled), numbers.filter(filled), None)
    except _DAMAGE as err:
        if at:  # the member was whole a moment ago: let Spark try the task again
            raise
        fault = str(err) if isinstance(err, ValueError) else repr(err)
    yield batch(pa.array([None], pa.binary()), pa.array([at], pa.int64()), fault)


def _store(address: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of an address; Spark writes local ones with a single slash."""
    if "://" in address or re.match(r"[a-z0-9]+:/", address):
        return pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", address))
    return pafs.LocalFileSystem(), address


@dataclass
class ArchiveGroup(InputPartition):
    """Paths that one task reads."""

    paths: list[str]


_TESTS = {
    EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v,
    LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
}


class ArchiveReader(DataSourceReader):
    """Options: path (a folder), pattern (of file names), header, md5 (expected checksums by file name, as JSON),
    partitionbytes."""

    def __init__(self, options: dict) -> None:
        self.folder = options["path"].rstrip("/")
        self.pattern = options.get("pattern", r".*\.zip")
        self.header = str(options.get("header", "false")).lower() == "true"
        self.md5 = json.loads(options.get("md5", "{}"))
        self.most = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            kind = type(f).__name__
            if type(f) in _TESTS and f.attribute in (("day",), ("filename",)):
                self.tests.append((f.attribute[0], kind, f.value))
            else:
                yield f

    def wanted(self, name: str) -> bool:
        known = {"filename": name, "day": name.split(".", 1)[0]}
        by_name = {kind.__name__: test for kind, test in _TESTS.items()}
        return re.fullmatch(self.pattern, name) is not None and all(by_name[kind](known[c], v) for c, kind, v in self.tests)

    def partitions(self) -> list[ArchiveGroup]:
        store, base = _store(self.folder)
        found = store.get_file_info(pafs.FileSelector(base, recursive=False))
        files = sorted((f for f in found if f.is_file and self.wanted(f.base_name)), key=lambda f: f.base_name)
        groups, filled = [], self.most
        for f in files:
            if filled + f.size > self.most:
                groups.append(ArchiveGroup([]))
                filled = 0
            groups[-1].paths.append(f"{self.folder}/{f.base_name}")
            filled += f.size
        return groups or [ArchiveGroup([])]

    def read(self, partition: ArchiveGroup) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            store, place = _store(path)
            with store.open_input_stream(place, compression=None) as file:
                content = file.read()
            yield from archive_rows(path, content, self.header, self.md5.get(path.rsplit("/", 1)[-1]))


class ArchiveSource(DataSource):
    """Lines of the zip files in a folder, as ROWS."""

    @classmethod
    def name(cls) -> str:
        return "feed_archives"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def archive_lines(spark: SparkSession, folder: str, spec: FeedSpec, md5: dict[str, str] | None = None) -> DataFrame:
    """ROWS of a feed's archives in `folder`; conditions on `day` and `filename` decide which files are opened.

    `md5` has expected checksums by file name. Each archive ends with a row without a value, which
    says what is wrong with it, if anything. A missing or empty folder gives no rows.
    """
    spark.dataSource.register(ArchiveSource)
    spark.conf.set(PUSHDOWN, "true")  # a reader that takes conditions needs it
    reader = spark.read.format("feed_archives").option("pattern", name_pattern(spec)).option("header", spec.header)
    if md5:
        reader = reader.option("md5", json.dumps(md5))
    return reader.load(folder)


def typed_rows(lines: DataFrame, spec: FeedSpec) -> DataFrame:
    """The feed's columns, and filename, line, value_read (false for the row that ends an archive) and error.

    An archive is inflated by one task; its lines are dealt over all tasks before they are parsed, which costs more.
    """
    named = lines.select(
        "filename", "line", F.col("value").isNotNull().alias("value_read"), "error", F.col("value").cast("string").alias("value")
    )
    return parse_lines(named.hint("rebalance", "filename", "line"), spec.schema)


def unpack(archives: DataFrame, header: bool) -> DataFrame:
    """Rows (path, value, error) of archives that Spark has read (path, content): their lines that are not empty.

    Empty files give nothing. An archive that cannot be read to its end, or holds no `.csv` member, gives one
    error row and no lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                for rows in archive_rows(path.as_py(), content.as_py(), header):
                    yield rows.select(["path", "value", "error"])

    filled = archives.where(F.length("content") > 0).select("path", "content")
    out = filled.mapInArrow(run, "path string, value binary, error string")
    return out.select("path", F.col("value").cast("string").alias("value"), "error").where("value IS NOT NULL OR error IS NOT NULL")


def scan_archives(spark: SparkSession, folder: str, spec: FeedSpec) -> tuple[DataFrame, DataFrame]:
    """(typed rows, error rows) of all archives of a feed in `folder`; no matching file is an error.

    Error rows are (path, error), one for each archive that gave no rows because it is damaged. Whoever needs both
    and wants one reading takes `typed_rows` and writes it first.
    """
    if list_archives(spark, folder, spec).isEmpty():
        raise FileNotFoundError(f"no {spec.name} archives below {folder}")
    lines = archive_lines(spark, folder, spec)
    rows = parse_lines(lines.where("value IS NOT NULL").select(F.col("value").cast("string").alias("value")), spec.schema)
    return rows, lines.where("error IS NOT NULL").select("path", "error")
