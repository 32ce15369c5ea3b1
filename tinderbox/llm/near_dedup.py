"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard on full shingle sets.

All signature coordinates come from two permutations: the first scatters shingles over a circle of
2**32 places, the second ranks the places, and coordinate k uses the second one shifted by k. Bands are
chosen so that a pair at the threshold is missed with a chance below MISS.

Equal sets are one class from the start. In each bucket the classes are compared with the one of the smallest
id, and true links are contracted to components. Only where members of one star are still apart are they
compared with each other: in blocks of GROUP_BLOCK sets, whose intersections are one matrix product, so
that pairs exist only inside a task. Blocks of a star's largest component do not meet each other, so this last step
grows with the members outside that component times all members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize, slices
from tinderbox.llm.components import components

COORDINATES = 200
MISS = 1e-6
SCATTER = np.uint64(0x9E3779B97F4A7C15)
RANK_STEP = np.uint32(0x9E3779B1)
BLOCK = 256
GROUP_BLOCK = 128
COLUMNS = 4096


def bands_for(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold less often than `miss`."""
    share = percent / 100
    for rows in range(12, 0, -1):
        if (1 - share**rows) ** (coordinates // rows) <= miss:
            return coordinates // rows, rows
    return coordinates, 1


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * SCATTER
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles. A-Z count as a-z; a text of fewer words
    than `size` is one shingle, a text without words has none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix64(h * SCATTER + w[i : len(w) - n + 1 + i])
    return np.unique(h)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least rank of (place - k) over the set's places."""
    places = (shingles >> np.uint64(32)).astype(np.uint32) * RANK_STEP
    shifts = np.arange(coordinates, dtype=np.uint32) * RANK_STEP
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(places), BLOCK):
        rank = places[at : at + BLOCK, None] - shifts[None, :]
        rank ^= rank >> np.uint32(16)
        rank *= np.uint32(0x85EBCA6B)
        rank ^= rank >> np.uint32(13)
        rank *= np.uint32(0xC2B2AE35)
        np.minimum(least, rank.min(axis=0), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sig[: bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = mix64(key * SCATTER + parts[:, r])
    return key.view(np.int64)


def _sketcher(size: int, bands: int, rows: int) -> Callable:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, high, low, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text or b"", size)
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                counts.append(len(shingles))
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                keys.append(band_keys(signature(shingles, bands * rows), bands, rows) if len(shingles) else np.empty(0, np.int64))
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "n_shingles", "high", "low", "bands"],
            )

    return sketch


def _shingler(size: int) -> Callable:
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t or b"", size).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return shingle


def spanning_links(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets that join what the labels keep apart; of links between the same two labels,
    or labels joined before, one is enough."""
    sizes = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    seen = np.bincount(at, minlength=len(values))
    column = np.cumsum(seen > 1) - 1  # shingles of one set alone are in no intersection
    row = np.repeat(np.arange(len(sets)), sizes)
    row, at = row[seen[at] > 1], column[at[seen[at] > 1]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        low, high = np.searchsorted(at, (start, start + COLUMNS))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[low:high], at[low:high] - start] = 1
        common += held @ held.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = (100 * common >= percent * union) & (labels[:, None] != labels[None, :])
    root = {int(x): int(x) for x in labels}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    out = []
    for a, b in zip(*np.nonzero(np.triu(linked)), strict=True):
        x, y = find(int(labels[a])), find(int(labels[b]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((int(a), int(b)))
    return out


def _comparer(percent: int) -> Callable:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, labels, sets = None, [], [], []

        def links() -> pa.RecordBatch:
            found = spanning_links(sets, np.array(labels), percent) if len(set(labels)) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[p[k]] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            shingles = batch.column("shingles")
            flat, ends = shingles.flatten().to_numpy(), np.cumsum(shingles.value_lengths().to_numpy())
            keys = zip(*(batch.column(c).to_pylist() for c in ("first", "i", "j")), strict=True)
            for at, (group, node, label) in enumerate(zip(keys, batch.column("node").to_pylist(), batch.column("component").to_pylist(), strict=True)):
                if group != key:
                    if key is not None:
                        yield links()
                    key, nodes, labels, sets = group, [], [], []
                nodes.append(node)
                labels.append(label)
                sets.append(flat[ends[at - 1] if at else 0 : ends[at]].copy())
        if key is not None:
            yield links()

    return compare


def _meetings(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """Members (first, node, component) of stars that span components, with their sets, once for each pair (i, j) of
    blocks they are compared in. Blocks of the largest component meet only blocks of the rest."""
    sizes = stars.groupBy("first", "component").agg(F.count(F.lit(1)).alias("n"))
    spans = sizes.groupBy("first").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n")).where("n > top.n")
    blocks = lambda n: F.ceil(n / GROUP_BLOCK).cast("int")
    spans = spans.select("first", F.col("top.component").alias("top"), blocks(F.col("top.n")).alias("inner"), blocks(F.col("n") - F.col("top.n")).alias("rest"))
    spans = materialize(spans, "spans")
    inside, h = F.col("component") == F.col("top"), F.xxhash64("node")
    block = F.when(inside, F.col("rest") + F.pmod(h, F.col("inner"))).otherwise(F.pmod(h, F.col("rest"))).cast("int")
    others = F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("inner"))
    met = stars.join(spans, "first").withColumn("block", block).withColumn("others", others).join(sets, "node")
    return met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        "first", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component", "shingles"
    )


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links) and
    kept (it is that id).

    Two documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets. Null and empty
    texts have an empty set, are linked with nothing and are kept. Rows of one id are one document,
    linked with whatever any of them is linked with. A row without an id takes no part: its
    component is null and it is kept. Repeated rows get equal rows; extra columns are not read.
    """
    bands, rows = bands_for(percent)
    kind = docs.schema["doc_id"].dataType
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    sketches = materialize(
        texts.mapInArrow(_sketcher(shingle_words, bands, rows), "doc_id long, n_shingles long, high long, low long, bands array<bigint>"),
        "sketches",
    )
    full = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Aggregates are written before rows are joined with them: Spark splits a hot key only if none is in the way.
    classes = materialize(full.groupBy("high", "low").agg(F.min("doc_id").alias("node")), "least-ids")
    members = materialize(
        full.select("doc_id", "n_shingles", "high", "low").join(classes, ["high", "low"]).select("doc_id", "node").distinct(), "classes"
    )
    buckets = (
        full.join(classes.select("high", "low", F.col("node").alias("doc_id")), ["high", "low", "doc_id"], "left_semi")
        .select(F.col("doc_id").alias("node"), "n_shingles", F.explode("bands").alias("bucket"))
    )
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").drop("last")
    crowded = materialize(buckets.join(materialize(shared, "shared-buckets"), "bucket"), "buckets")

    def compatible(a: str, b: str):
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    # Sets are needed of documents in shared buckets only.
    wanted = crowded.select(F.col("node").alias("doc_id")).distinct()
    sets = materialize(
        texts.join(wanted, "doc_id", "left_semi").mapInArrow(_shingler(shingle_words), "node long, shingles array<bigint>"), "sets"
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb"))
        true_link = 100 * common >= percent * (F.size("sa") + F.size("sb") - common)
        return pairs.join(a, "a").join(b, "b").where(true_link).select("a", "b")

    sizes = materialize(crowded.select(F.col("node").alias("first"), F.col("n_shingles").alias("first_size")).distinct(), "sizes")
    rays = materialize(crowded.where("node <> first").select("first", "node", "n_shingles").distinct(), "rays")
    pairs = (
        rays.join(sizes, "first")
        .where(compatible("n_shingles", "first_size"))
        .select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    )
    split_ids = members.groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y").select("doc_id")
    same_id = members.join(split_ids, "doc_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(confirmed(pairs).unionByName(same_id))
    stars = materialize(
        crowded.select("first", "node").distinct().join(found, "node", "left")
        .select("first", "node", F.coalesce("component", "node").alias("component")).distinct(),
        "stars",
    )
    meeting = _meetings(stars, sets)
    meeting = meeting.repartition("first", "i", "j").sortWithinPartitions("first", "i", "j")
    late = materialize(meeting.mapInArrow(_comparer(percent), "a long, b long"), "late-links")
    roots = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = components(late.unionByName(roots)).select("node", "component")
    by_doc = members.join(final, "node", "left").select(
        F.col("doc_id").alias("id"), F.coalesce("component", "node").alias("component")
    ).groupBy("id").agg(F.min("component").alias("component"))
    by_doc = materialize(by_doc, "by-document")
    out = sketches.select("doc_id", "n_shingles").join(by_doc, F.col("doc_id") == F.col("id"), "left")
    component = F.coalesce("component", "doc_id").cast(kind)
    return out.select(
        F.col("doc_id").cast(kind).alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that `near_duplicates` keeps, with all their columns; rows without an id stay."""
    gone = near_duplicates(docs.select("doc_id", "text"), shingle_words, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])
