"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors and queries are dealt into blocks, every block of queries meets every block of vectors in a
grid of cells, and a cell holds two cover trees. Pairs of nodes are visited best first; a pair is
pruned when the bound from its centres and covering radii stays below the worst k-th score that
the queries of its group have so far.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize

VECTOR_BLOCK = 4096
QUERY_BLOCK = 2048
LEAF = 64


@dataclass
class Node:
    """A centre, the radius that covers its points, and these points as order[start:end]."""

    center: int
    radius: float
    start: int
    end: int
    children: list[Node] = field(default_factory=list)


def distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    gap = points - center
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[Node, np.ndarray]:
    """Tree and the order of points in which every node is a contiguous run.

    A node's points are covered by children of half its radius, whose centres lie further apart than
    that; the first child keeps its parent's centre. Small sibling sets share a leaf, whose radius
    is that of all its points.
    """
    order = np.empty(len(points), np.int64)
    filled = 0

    def make(idx: np.ndarray, center: int) -> Node:
        nonlocal filled
        apart = distances(points[idx], points[center])
        radius = float(apart.max())
        node = Node(center, radius, filled, filled + len(idx))
        if len(idx) <= leaf or radius == 0:
            order[filled : filled + len(idx)] = idx
            filled += len(idx)
            return node
        near = apart <= radius / 2
        sets = [(center, idx[near])]
        rest = idx[~near]
        while len(rest):
            c = int(rest[0])
            near = distances(points[rest], points[c]) <= radius / 2
            sets.append((c, rest[near]))
            rest = rest[~near]
        bundle: list[tuple[int, np.ndarray]] = []
        for c, members in [*sets, (-1, np.empty(0, np.int64))]:
            small = c >= 0 and len(members) < leaf
            if small:
                bundle.append((c, members))
            if bundle and (not small or sum(len(m) for _, m in bundle) >= leaf):
                together = np.concatenate([m for _, m in bundle])
                node.children.append(make_leaf(together, bundle[0][0]))
                bundle = []
            if c >= 0 and not small:
                node.children.append(make(members, c))
        return node

    def make_leaf(idx: np.ndarray, center: int) -> Node:
        nonlocal filled
        node = Node(center, float(distances(points[idx], points[center]).max()), filled, filled + len(idx))
        order[filled : filled + len(idx)] = idx
        filled += len(idx)
        return node

    return make(np.arange(len(points)), 0), order


def dual_search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, vector_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query position, vector id, score) of each query's k best vectors but those of its own id; ties to smaller ids."""
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1]) < 2**52
    q, v = queries.astype(np.float64), vectors.astype(np.float64)
    q_root, q_order = cover_tree(q)
    v_root, v_order = cover_tree(v)
    kind = np.float64 if exact else np.int64
    qs, vs = queries[q_order].astype(kind), vectors[v_order].astype(kind)
    q_ids, v_ids = query_ids[q_order], vector_ids[v_order]
    q_size, v_size = np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)
    best: list[list[tuple]] = [[] for _ in q_order]  # (-score, id), ascending
    worst = np.full(len(q_order), -np.inf)

    def bound(a: Node, b: Node) -> float:
        top = q[a.center] @ v[b.center] + a.radius * v_size[b.center] + b.radius * q_size[a.center] + a.radius * b.radius
        return top + 1e-9 * abs(top) + 1e-6 + 1e-12 * q_size[a.center] * v_size[b.center]

    def meet(a: Node, b: Node) -> None:
        scores = qs[a.start : a.end] @ vs[b.start : b.end].T
        ids = v_ids[b.start : b.end]
        hits = (scores >= worst[a.start : a.end, None]) & (q_ids[a.start : a.end, None] != ids[None, :])
        for i in np.flatnonzero(hits.any(axis=1)):
            at = np.flatnonzero(hits[i])
            row = a.start + i
            new = [(-int(scores[i, j]), int(ids[j])) for j in at]
            best[row] = sorted([*best[row], *new])[:k]
            if len(best[row]) == k:
                worst[row] = -best[row][-1][0]

    stack = [(bound(q_root, v_root), q_root, v_root)]
    while stack:
        top, a, b = stack.pop()
        if top < worst[a.start : a.end].min():
            continue
        if not a.children and not b.children:
            meet(a, b)
        elif not a.children or (b.children and b.radius >= a.radius):
            stack += sorted(((bound(a, c), a, c) for c in b.children), key=lambda x: x[0])
        else:
            stack += sorted(((bound(c, b), c, b) for c in a.children), key=lambda x: x[0])
    return [(int(q_order[row]), i, -s) for row, found in enumerate(best) for s, i in found]


def _searcher(k: int) -> Callable:
    def search(cell: pd.DataFrame) -> pd.DataFrame:
        asks = cell[cell["asks"]]
        held = cell[~cell["asks"]]
        rows: list[tuple[int, int, int]] = []
        if len(asks) and len(held):
            ids = asks["vec_id"].to_numpy(np.int64)
            found = dual_search(np.stack(asks["v"].to_numpy()), ids, np.stack(held["v"].to_numpy()), held["vec_id"].to_numpy(np.int64), k)
            rows = [(int(ids[at]), vec, score) for at, vec, score in found]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"], dtype="int64")

    return search


def top_k(vectors: DataFrame, is_query, k: int = 5, vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best among (vec_id, v array<bigint>).

    `is_query` is a condition on vec_id. Null ids and null vectors take no part. Rows that repeat id and vector
    count once; an id with several vectors asks and answers with each of them, and is never its own
    candidate. Only vectors of equal length meet; those of length zero score 0. Scores must fit a
    long. Fewer candidates than k give fewer rows. Equal scores go to the smaller id.
    """
    known = materialize(
        vectors.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), "v")
        .distinct()
        .withColumn("dim", F.size("v"))
        .withColumn("asks", is_query),
        "vectors",
    )
    sizes = known.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    rows, columns = (max(1, -(-n // block)) for n, block in zip(sizes, (vector_block, query_block), strict=True))

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    place = F.xxhash64("vec_id", "v")
    held = known.withColumn("row", F.pmod(place, F.lit(rows)).cast("int")).withColumn("column", numbers(columns)).withColumn("asks", F.lit(False))
    asks = known.where("asks").withColumn("row", numbers(rows)).withColumn("column", F.pmod(place, F.lit(columns)).cast("int"))
    cells = held.unionByName(asks).groupBy("dim", "row", "column")
    found = cells.applyInPandas(_searcher(k), "query_id long, vec_id long, score long")
    ranking = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integer_vectors(table: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and v: floor(256 * x) of every component x as double. Vectors that are null, or hold
    null or non-finite components, are left out."""
    x = F.col(column).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.where(x.isNotNull() & sound).select("vec_id", F.transform(x, lambda c: F.floor(c * 256)).alias("v"))
