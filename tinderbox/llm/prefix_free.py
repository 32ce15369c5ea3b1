"""Removal of repeated byte strings by prefix-free parsing and suffix arrays.

Parsing: a rolling hash of TRIGGER bytes triggers at the places where it is least among all that lie
in one string of LENGTH bytes, so every such string has one trigger and equal strings have equal ones.
A phrase is the text of all consecutive strings with one trigger; phrases overlap by LENGTH - 1 bytes,
so each string lies in exactly one phrase, at the same place relative to its trigger.

Dictionary and parse: distinct phrases meet by trigger. Of a phrase, only the first document in corpus
order keeps it; in later ones all its strings are repeats. Distinct phrases with a common trigger are
put into suffix order to LENGTH bytes; equal runs of that order, combined with the parse (document
and place of each phrase), give the earliest start of every string.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize, slices

LENGTH = 100
TRIGGER = 24
BLOCK = 1 << 22
PLACE_BITS = 24
# Dictionary bytes that one suffix array holds, and phrases of one trigger beyond which their strings
# are compared by 128-bit hash in a shuffle of their own instead.
ARRAY_BYTES = 2 << 20
HOT_PHRASES = 4096
NO_ID = (1 << 63) - 1


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of every run of TRIGGER (16 + 8) bytes, mixed so that its order is random."""
    base = np.uint64(0x9E3779B97F4A7C15)
    h, power, width, eight = data.astype(np.uint64) + np.uint64(1), base, 1, None
    while width < 16:
        h = h[:-width] * power + h[width:]
        power, width = power * power, width * 2
        if width == 8:
            eight, by_eight = h, power
    h = h[: len(data) - TRIGGER + 1] * by_eight + eight[16 : 16 + len(data) - TRIGGER + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def phrases(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Triggers' hashes, first string starts, and last string starts plus one, in blocks of a text."""
    reach = LENGTH - TRIGGER + 1
    with np.errstate(over="ignore"):
        for at in range(0, max(len(text) - LENGTH + 1, 0), BLOCK):
            data = np.frombuffer(text, np.uint8, min(BLOCK + LENGTH - 1, len(text) - at), at)
            h = rolling_hash(data)
            least = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
            width = 1
            while 2 * width <= reach:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < reach:
                least = np.minimum(least[: width - reach], least[reach - width :])
            place = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
            starts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
            ends = np.concatenate([starts[1:], [len(place)]])
            yield h[place[starts]].view(np.int64), starts + at, ends + at


def parse(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Triggers, phrase hashes, starts and ends (of string starts) of all phrases of a text."""
    parts = list(phrases(text))
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, none, none
    triggers, starts, ends = (np.concatenate(c) for c in zip(*parts, strict=True))
    digest = xxhash.xxh3_64_intdigest
    spans = zip(starts.tolist(), (ends + (LENGTH - 1)).tolist(), strict=True)
    hashes = np.fromiter((digest(text[a:b]) for a, b in spans), np.uint64, len(starts)).view(np.int64)
    return triggers, hashes, starts, ends


def suffix_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rank of the LENGTH bytes from each start: suffixes are sorted by their first 8 bytes, then by
    pairs of ranks, which doubles the sorted depth, up to LENGTH."""
    word = np.zeros(len(data), np.uint64)
    padded = np.concatenate([data, np.zeros(LENGTH, np.uint8)])
    for i in range(8):
        word = (word << np.uint64(8)) | padded[i : i + len(data)]
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)

    def paired(apart: int) -> np.ndarray:
        far = np.zeros(len(rank), np.int64)
        far[:-apart] = rank[apart:] + 1
        return rank * (len(rank) + 1) + far

    depth = 8
    while 2 * depth <= LENGTH:
        rank = np.unique(paired(depth), return_inverse=True)[1].astype(np.int64)
        depth *= 2
    return np.unique(paired(LENGTH - depth)[starts], return_inverse=True)[1]


def runs(values: np.ndarray, marked: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of marked, consecutive values in one group."""
    joined = marked[1:] & marked[:-1] & (values[1:] == values[:-1] + 1) & (group[1:] == group[:-1])
    first = marked & ~np.concatenate([[False], joined])
    last = marked & ~np.concatenate([joined, [False]])
    return np.flatnonzero(first), np.flatnonzero(last)


def _repeats(rows: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the strings, as ranges of starts, of which an earlier one is equal, among
    phrases given as (doc, start of the phrase in it, bytes)."""
    data = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
    sizes = np.array([len(r[2]) for r in rows])
    strings = sizes - (LENGTH - 1)
    which = np.repeat(np.arange(len(rows)), strings)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(strings) - strings, strings)
    classes = suffix_classes(data, (np.cumsum(sizes) - sizes)[which] + inside)
    doc = np.array([r[0] for r in rows], np.int64)[which]
    start = np.array([r[1] for r in rows], np.int64)[which] + inside
    order = np.lexsort((start, doc, classes))
    head = np.concatenate([[True], classes[order][1:] != classes[order][:-1]])
    first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = np.empty(len(order), bool)
    later[order] = (doc[order] != doc[order][first]) | (start[order] != start[order][first])
    a, b = runs(start, later, which)
    return doc[a], start[a], start[b] + 1


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in slices(batches):
        texts = [squeeze(t or b"") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("doc"), pa.array(texts, pa.binary())], names=["doc_id", "doc", "packed"])


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _parser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (trigger, phrase, doc), once for each phrase of a document."""
    for batch in slices(batches):
        out: list[tuple] = []
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
            triggers, hashes, _, _ = parse(text or b"")
            once = np.unique(hashes, return_index=True)[1]
            out.append((triggers[once], hashes[once], np.full(len(once), doc, np.int64)))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["trigger", "phrase", "doc"])


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked phrases of each document, where they stand first in it: (trigger, doc, start, bytes)."""
    for batch in slices(batches):
        rows = []
        for doc, packed, asked in zip(*(batch.column(c).to_pylist() for c in ("doc", "packed", "asked")), strict=True):
            text = _unpack(packed)
            triggers, hashes, starts, ends = parse(text)
            values, first = np.unique(hashes, return_index=True)
            for i in first[np.isin(values, np.array(asked, np.int64))].tolist():
                rows.append((int(triggers[i]), doc, int(starts[i]), text[starts[i] : ends[i] + LENGTH - 1]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["trigger", "doc", "start", "bytes"])


def _sorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over the phrases of whole triggers, as many as fit ARRAY_BYTES; rows come ordered by trigger."""
    held: list[tuple[int, int, bytes]] = []
    size, last = 0, None

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in _repeats(held)], names=["doc", "start", "end"])

    for batch in batches:
        for trigger, doc, start, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size > ARRAY_BYTES and trigger != last:
                yield flush()
                held, size = [], 0
            held.append((doc, start, data))
            size, last = size + len(data), trigger
    if held:
        yield flush()


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(128-bit hash of the string, doc, start) of every string of the phrases of hot triggers."""
    for batch in slices(batches, 1 << 20):
        rows = []
        for _, doc, start, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for k in range(len(data) - LENGTH + 1):
                rows.append((xxhash.xxh3_128_digest(data[k : k + LENGTH]), doc, start + k))
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = [pa.binary(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["string", "doc", "start"])


def removed_ranges(text: bytes, repeats: list[int], ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges to remove: strings of the phrases named in `repeats`, of phrases that stood earlier
    in the text, and of the given ranges of starts."""
    _, hashes, starts, ends = parse(text)
    again = np.ones(len(hashes), bool)
    again[np.unique(hashes, return_index=True)[1]] = False
    again |= np.isin(hashes, np.array(repeats, np.int64))
    a = np.concatenate([starts[again], np.array([r[0] for r in ranges], np.int64)])
    b = np.concatenate([ends[again], np.array([r[1] for r in ranges], np.int64)]) + LENGTH - 1
    order = np.argsort(a, kind="stable")
    out: list[list[int]] = []
    for s, e in zip(a[order].tolist(), b[order].tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _remover(text_type: pa.DataType | None) -> Callable:
    """Digest columns per document or, with a text type, the remaining bytes."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for packed, repeats, starts, ends in zip(
                *(batch.column(c).to_pylist() for c in ("packed", "repeats", "starts", "ends")), strict=True
            ):
                text = _unpack(packed)
                cut = removed_ranges(text, repeats or [], list(zip(starts or [], ends or [], strict=True)))
                edges = [0, *(x for span in cut for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(text), len(text) - len(kept), len(cut), sha256(kept).hexdigest(), kept))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 3 + [pa.string()]
            named = [pa.array(c, k) for c, k in zip(cols[:4], kinds, strict=True)]
            if text_type is not None:
                named.append(pa.array(cols[4], text_type))
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if text_type is not None else [])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *named], names=["doc_id", *names])

    return remove


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the bytes that stay,
    as `kept`, if asked for).

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a document of smaller
    id, or in the same document before. Null texts count as empty; shorter texts lose nothing. Null ids
    come after all others. Rows that share an id (or have none) count as one document laid over one
    another: of equal strings, the ones at the smallest offset stay. No rows give no rows; extra
    columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text").cast("string").cast("binary").alias("text")
    )
    packed = texts.mapInArrow(_pack, f"doc_id {kind}, doc long, packed binary")

    # One shuffle of the parse, by trigger; both sides of the join read it.
    parsed = texts.select("doc", "text").mapInArrow(_parser, "trigger long, phrase long, doc long").repartition("trigger")
    met = parsed.groupBy("trigger").agg(
        F.min("doc").alias("d0"), F.max("doc").alias("d1"), F.min("phrase").alias("p0"), F.max("phrase").alias("p1")
    )
    met = met.where("d0 < d1 OR p0 < p1").select("trigger", (F.col("p0") < F.col("p1")).alias("differs"))
    shared = materialize(parsed.join(met, "trigger"), "phrases")
    first = shared.groupBy("trigger", "phrase").agg(F.min("doc").alias("first"))
    owned = materialize(
        shared.join(first, ["trigger", "phrase"]).where("first < doc OR differs").withColumn("repeat", F.col("first") < F.col("doc")), "parse"
    )
    busy = owned.where("NOT repeat").groupBy("trigger").agg(F.count(F.lit(1)).alias("n"))
    hot = busy.where(F.col("n") > HOT_PHRASES).select("trigger")

    asked = owned.where("NOT repeat").groupBy("doc").agg(F.collect_list("phrase").alias("asked"))
    dictionary = materialize(
        packed.join(asked, "doc").select("doc", "packed", "asked").mapInArrow(_cutter, "trigger long, doc long, start long, bytes binary"),
        "dictionary",
    )
    calm = dictionary.join(hot, "trigger", "left_anti").repartition("trigger").sortWithinPartitions("trigger")
    ranges = calm.mapInArrow(_sorter, "doc long, start long, end long")
    strings = dictionary.join(hot, "trigger", "left_semi").mapInArrow(_strings, "string binary, doc long, start long")
    least = strings.groupBy("string").agg(F.min(F.struct("doc", "start")).alias("least"))
    late = strings.join(least, "string").where(F.struct("doc", "start") > F.col("least"))
    ranges = ranges.unionByName(late.select("doc", "start", (F.col("start") + 1).alias("end")))

    marks = owned.where("repeat").select("doc", "phrase", F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"))
    marks = marks.unionByName(ranges.withColumn("phrase", F.lit(None).cast("long")))
    by_doc = marks.groupBy("doc").agg(
        F.collect_list("phrase").alias("repeats"), F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return packed.join(by_doc, "doc", "left").select("doc_id", "packed", "repeats", "starts", "ends").mapInArrow(
        _remover(pa.binary() if with_text else None), schema + (", kept binary" if with_text else "")
    )
