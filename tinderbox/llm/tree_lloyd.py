"""Vector codes by Lloyd's rounds over partition-local cover trees.

Vectors are cut into equal parts, and each position of a part has its own codebook. Partitions cut their rows into
chunks; a chunk keeps one cover tree for each position, in whose order every node's points are a run, so that
cumulative sums give the sum and the count of any subtree at once. A round walks each tree from its root:
if the entry nearest to a node's centre is so much nearer than the others that, by the triangle inequality, no point
within the covering radius can prefer another, the whole subtree is assigned; other nodes descend, and only the
points of ambiguous leaves are compared one by one. Components are whole numbers, so sums and distances are
exact and don't depend on how the rows are dealt.

The trees are written once, about as many bytes as the vectors; a round reads them and shuffles counts and sums
of the entries only. The driver holds the codebooks, whose size does not depend on the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tinderbox.llm.common import materialize

CHUNK = 4096
LEAF = 16
COMPARE = 1 << 20  # distances held at once
MOST = 2**24  # of a component's size: squared distances stay exact in doubles


@dataclass
class Tree:
    """Points in tree order; node i covers points[start[i]:end[i]] within radius[i] of points[center[i]], its
    children are the nodes child[i] .. child[i] + children[i]."""

    order: np.ndarray
    points: np.ndarray
    radius: np.ndarray
    center: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray

    def pack(self) -> list[bytes]:
        places = np.stack([self.center, self.start, self.end, self.child, self.children]).astype(np.int32)
        return [self.order.astype(np.int32).tobytes(), self.points.astype(np.int32).tobytes(), self.radius.tobytes(), places.tobytes()]

    @classmethod
    def unpack(cls, order: bytes, points: bytes, radius: bytes, places: bytes, width: int) -> Tree:
        at = np.frombuffer(order, np.int32)
        rows = np.frombuffer(points, np.int32).reshape(len(at), width).astype(np.int64)
        nodes = np.frombuffer(places, np.int32).reshape(5, -1)
        return cls(at, rows, np.frombuffer(radius, np.float64), *nodes)


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Every node's points lie within its radius; children's balls have at most half of it, and their centres
    lie further apart than that half. Nodes of few points, or of equal ones, are leaves."""
    order = np.arange(len(points))
    real = points.astype(np.float64)
    nodes: list[list[float]] = []
    todo = [(0, len(points), 0)]  # start, end, centre's position in points
    while len(nodes) < len(todo):
        start, end, c = todo[len(nodes)]
        idx = order[start:end]
        apart = np.sqrt(((real[idx] - real[c]) ** 2).sum(axis=1))
        radius = float(apart.max(initial=0))
        node = [radius, c, start, end, 0, 0]
        nodes.append(node)
        if len(idx) <= leaf or radius == 0:
            continue
        sets, near = [], apart <= radius / 2
        while len(idx):
            sets.append((c, idx[near]))
            idx = idx[~near]
            if len(idx):
                c = int(idx[0])
                near = np.sqrt(((real[idx] - real[c]) ** 2).sum(axis=1)) <= radius / 2
        node[4:] = [len(todo), len(sets)]
        at = start
        for c, members in sets:
            order[at : at + len(members)] = members
            todo.append((at, at + len(members), c))
            at += len(members)
    place = np.empty(len(points), np.int64)
    place[order] = np.arange(len(points))
    table = np.array(nodes, np.float64)
    whole = table[:, 1:].astype(np.int64)
    return Tree(order, points[order], table[:, 0], place[whole[:, 0]], *whole[:, 1:].T)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    gap = points[:, None, :].astype(np.float64) - entries[None, :, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], ..., starts[i] + lengths[i] - 1 for all i, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def assign(tree: Tree, entries: np.ndarray, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts and sums of the points nearest to each entry (ties to the lower index), and how many points were
    compared one by one. `codes`, if given, gets each point's entry in tree order."""
    known = entries.astype(np.float64)
    upto = np.zeros((len(tree.points) + 1, tree.points.shape[1]), np.int64)
    np.cumsum(tree.points, axis=0, out=upto[1:])
    counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    step = max(1, COMPARE // max(1, entries.size))
    # A point p at distance r from the centre c has |p-j|^2 - |p-b|^2 >= |c-j|^2 - |c-b|^2 - 2 r |j-b|.
    twice = 2 * np.sqrt(squared(entries, known)) * (1 + 1e-9)
    frontier, single = np.zeros(min(1, len(tree.points)), np.int64), []
    while len(frontier):
        below = []
        for at in range(0, len(frontier), step):
            nodes = frontier[at : at + step]
            far = squared(tree.points[tree.center[nodes]], known)
            best = far.argmin(axis=1)
            gain = far - far[np.arange(len(nodes)), best][:, None]
            gain[np.arange(len(nodes)), best] = np.inf
            radius = tree.radius[nodes]
            sure = (gain > radius[:, None] * twice[best] + 1e-6).all(axis=1) | (radius == 0)
            start, end, entry = tree.start[nodes[sure]], tree.end[nodes[sure]], best[sure]
            np.add.at(counts, entry, end - start)
            np.add.at(sums, entry, upto[end] - upto[start])
            if codes is not None:
                codes[_ranges(start, end - start)] = np.repeat(entry, end - start)
            open_ = nodes[~sure]
            leaves = open_[tree.children[open_] == 0]
            single.append(_ranges(tree.start[leaves], tree.end[leaves] - tree.start[leaves]))
            inner = open_[tree.children[open_] > 0]
            below.append(_ranges(tree.child[inner], tree.children[inner]))
        frontier = np.concatenate(below)
    alone = np.concatenate(single) if single else np.zeros(0, np.int64)
    for at in range(0, len(alone), step):
        some = alone[at : at + step]
        entry = squared(tree.points[some], known).argmin(axis=1)
        np.add.at(counts, entry, 1)
        np.add.at(sums, entry, tree.points[some])
        if codes is not None:
            codes[some] = entry
    return counts, sums, len(alone)


TREE = ["order", "points", "radius", "nodes"]


def _planter(parts: int, dim: int, chunk: int) -> Callable:
    """Rows to chunks: ids and labels as lists, and for each position the four buffers of its tree."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def trees() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            n = len(table)
            vectors = table.column("v").combine_chunks()
            if (lengths := vectors.value_lengths().to_numpy()).size and (lengths != dim).any():
                raise ValueError(f"vectors must all have {dim} components; one has {int(lengths[lengths != dim][0])}")
            values = vectors.flatten().to_numpy().reshape(n, dim)
            width = dim // parts
            packed = [cover_tree(values[:, p * width : (p + 1) * width]).pack() for p in range(parts)]
            lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), table.column(c).combine_chunks()) for c in ("id", "label")]
            return pa.RecordBatch.from_arrays(
                [*lists, *[pa.array([[x[k] for x in packed]], pa.list_(pa.binary())) for k in range(len(TREE))]], names=["id", "label", *TREE]
            )

        rows = 0
        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, chunk - rows)
                held.append(piece)
                rows, batch = rows + piece.num_rows, batch.slice(piece.num_rows)
                if rows == chunk:
                    yield trees()
                    held, rows = [], 0
        if rows:
            yield trees()

    return plant


def _chunks(batches: Iterator[pa.RecordBatch], parts: int, width: int) -> Iterator[tuple[pa.RecordBatch, list[Tree]]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            buffers = [row.column(c)[0].as_py() for c in TREE]
            yield row, [Tree.unpack(*(b[p] for b in buffers), width) for p in range(parts)]


def _summer(books: np.ndarray) -> Callable:
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for _, trees in _chunks(batches, parts, width):
            for p, tree in enumerate(trees):
                n, total, _ = assign(tree, books[p])
                counts[p] += n
                sums[p] += total
        place = np.indices((parts, entries)).reshape(2, -1).astype(np.int32)
        columns = [place[0], place[1], counts.ravel(), *sums.reshape(-1, width).T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "n", *[f"s{k}" for k in range(width)]])

    return add


def _coder(books: np.ndarray) -> Callable:
    parts, _, width = books.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, trees in _chunks(batches, parts, width):
            ids, labels = (row.column(c).flatten() for c in ("id", "label"))
            codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
            for p, tree in enumerate(trees):
                own = np.zeros(len(ids), np.int64)
                assign(tree, books[p], own)
                codes[tree.order, p] = own
                error[tree.order] += ((tree.points - books[p][own]) ** 2).sum(axis=1)
            text = [c.tobytes().hex() for c in codes]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    return code


def whole_components(column: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double; null if the vector or a component is null or not finite. A component
    beyond MOST stops the job."""
    x = column.cast("array<double>")
    sound = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    big = F.exists(x, lambda c: F.abs(c * scale) >= MOST)
    stop = F.raise_error(F.lit(f"a component times {scale} is beyond {MOST}")).cast("array<bigint>")
    return F.when(sound, F.when(big, stop).otherwise(F.transform(x, lambda c: F.floor(c * scale))))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codebooks(trees: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, component) after some rounds; unused entries stay, means are rounded down."""
    width = books.shape[2]
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in ("part", "entry")])
    schema = T.StructType(schema.fields + [T.StructField(c, T.LongType()) for c in ["n", *[f"s{k}" for k in range(width)]]])
    for _ in range(rounds):
        found = trees.mapInArrow(_summer(books), schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(f"s{k}") for k in range(width)]).alias("sums")
        )
        books = books.copy()
        for part, entry, n, sums in found.where("n > 0").collect():  # parts x entries rows, whatever the input
            books[part, entry] = [s // n for s in sums]
    return books


def compress_vectors(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, column: str = "embedding", chunk: int = CHUNK
) -> DataFrame:
    """One row per vector (vec_id, label, and the vector itself in `column`): vec_id, code, error, label_error and codebooks_sha256.

    Components become floor(scale * x). Rows whose vector is null, or holds null or non-finite components, are left out.
    Codebooks start as the parts of the vectors of the smallest ids (ties between repeated ids: the smaller
    vector); with fewer vectors than `entries`, they have as many entries as there are vectors. Rows without an id are
    coded like others, but start no entry; if no row has an id, null ids do. Repeated rows are coded each, and count
    each. `code` is two hex digits a part, so `entries` is at most 256. label_error adds up the
    errors of all rows with the label, null being one label. Vectors of another length than that of the smallest id
    stop the job, as do lengths that `parts` doesn't divide and components of 2**24 and more. An empty
    table gives no rows. Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: entries must be 1 to 256")
    known = vectors.select(F.col("vec_id").alias("id"), F.col("label").alias("label"), whole_components(F.col(f"`{column}`"), scale).alias("v")).where("v IS NOT NULL")
    seeds = [r[0] for r in known.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("id", "v").select("v", "id").collect()]
    ids = known.schema["id"].dataType
    if not seeds:
        return known.select(F.col("id").alias("vec_id"), *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    dim = len(seeds[0])
    if dim % parts or any(len(s) != dim for s in seeds):
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts" if dim % parts else "vectors differ in length")
    books = np.array(seeds, np.int64).reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2)

    label = known.schema["label"].dataType
    planted = T.StructType(
        [T.StructField("id", T.ArrayType(ids)), T.StructField("label", T.ArrayType(label))] + [T.StructField(c, T.ArrayType(T.BinaryType())) for c in TREE]
    )
    trees = materialize(known.mapInArrow(_planter(parts, dim, chunk), planted), "trees")
    books = codebooks(trees, books, rounds)
    done = T.StructType([T.StructField("id", ids), T.StructField("label", label), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = materialize(trees.mapInArrow(_coder(books), done), "codes")
    # Written first, the sums are a plain table: a small one is broadcast, and Spark may split a label of many rows.
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
