"""Trie of shared conversation prefixes, by ternary search trees over range shards.

Turns are encoded by a dictionary whose ids follow the order of (role, text). Conversations, as arrays of ids, are
range-partitioned and sorted, and each partition is cut into shards of bounded size. A shard becomes one ternary search
tree, into which its distinct sequences go middle first, so that its branches are balanced; going through the nodes
from the last made to the first adds up members, leaves and savings without recursion.

Because shards are ranges of the sorted order, a node can lie in several shards only if it is a prefix both of a shard's last
sequence and of the next one's first. Those nodes alone, as many as the common prefixes at the boundaries are long,
are merged across shards: by their depth and the first shard that has them. In the order of (first shard, depth) they are
in preorder, so differences of running sums give the totals of their subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tinderbox.llm.common import materialize

SHARD_TURNS = 200_000
EMIT = 8192
SHARD = "part int, sub int, convs array<bigint>, lengths array<int>, ids array<bigint>, sizes array<bigint>"
NODE = (
    "shard long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "bytes long, ends binary, shared boolean, side int, with_previous boolean, on_last boolean, parent_side int"
)
NOTHING = hashlib.sha256(b"").hexdigest()


def encode_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, id and bytes (of the text in UTF-8) of every turn that has a conv_id."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    distinct = rows.select("role", "text").distinct().orderBy("role", "text")
    words = materialize(distinct.withColumn("id", F.monotonically_increasing_id()), "turn-dictionary")
    coded = rows.join(words.withColumnsRenamed({"role": "r", "text": "t"}), (F.col("role") == F.col("r")) & (F.col("text") == F.col("t")))
    return coded.select("conv_id", "turn", "id", F.octet_length("text").cast("long").alias("bytes"))


def numbered_turns(coded: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id, bytes: in the order of turn, null first; ties by role, then text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    return coded.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "id", "bytes")


def shared_openings(turns: DataFrame, group: int = 5, longest: int = 9) -> DataFrame:
    """Turns (conv_id, pos, id, bytes) of rebuilt conversations: the first h turns of conversation c - c % group, then c's own
    from the (h + 1)-th on, h being crc32(decimal c) % longest. Every conversation has a row with a null pos too,
    also if nothing else is left of it. Positions may have gaps."""
    height = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    convs = turns.select("conv_id").distinct()
    own = turns.where(F.col("pos") > height)
    heads = turns.where((F.col("pos") < longest) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    wanted = convs.select("conv_id", height.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    opened = heads.join(wanted, "base").where("pos <= h").select("conv_id", "pos", "id", "bytes")
    empty = convs.select("conv_id", *[F.lit(None).cast("long").alias(c) for c in ("pos", "id", "bytes")])
    return own.unionByName(opened).unionByName(empty)


def _shards(limit: int):
    """Sorted conversations to rows of whole shards: a shard ends with the conversation that fills it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sub, weight = TaskContext.get().partitionId(), 0, 0
        held: list[pa.RecordBatch] = []

        def shard() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids, sizes = (rows.column(c).combine_chunks() for c in ("ids", "sizes"))
            columns = [rows.column("conv_id").combine_chunks(), ids.value_lengths(), ids.flatten(), sizes.flatten()]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sub], pa.int32()), *lists], names=["part", "sub", "convs", "lengths", "ids", "sizes"])

        for batch in batches:
            upto = np.cumsum(batch.column("ids").value_lengths().to_numpy().astype(np.int64) + 1)
            at = gone = 0
            while at < batch.num_rows:
                end = min(batch.num_rows, int(np.searchsorted(upto, gone + limit - weight)) + 1)
                held.append(batch.slice(at, end - at))
                weight += int(upto[end - 1]) - gone
                at, gone = end, int(upto[end - 1])
                if weight >= limit:
                    yield shard()
                    held, sub, weight = [], sub + 1, 0
        if held:
            yield shard()

    return cut


class Ternary:
    """Ternary search tree over sequences of ids. Node 0 is the trie's root; `low` and `high` link a node with its
    smaller and larger siblings, `down` with its children (0: none). A parent is made before its children."""

    def __init__(self) -> None:
        self.key, self.low, self.high, self.down = [0], [0], [0], [0]
        self.parent, self.depth, self.size = [-1], [0], [0]

    def add(self, sequence: list[int], sizes: list[int]) -> list[int]:
        """Nodes of the sequence's prefixes, root first."""
        key, low, high, down = self.key, self.low, self.high, self.down
        path, at = [0], 0
        for x, size in zip(sequence, sizes, strict=True):
            link, last, node = down, at, down[at]
            while node and key[node] != x:
                link, last = (low, node) if x < key[node] else (high, node)
                node = link[node]
            if not node:
                node = link[last] = len(key)
                made = ((key, x), (low, 0), (high, 0), (down, 0), (self.parent, at), (self.depth, len(path)), (self.size, size))
                for column, value in made:
                    column.append(value)
            path.append(node)
            at = node
        return path


def middle_first(n: int) -> Iterator[int]:
    """0 .. n - 1, the middle of each interval before its halves."""
    todo = [(0, n)]
    while todo:
        low, high = todo.pop()
        if low < high:
            mid = (low + high) // 2
            yield mid
            todo += [(mid + 1, high), (low, mid)]


def shard_nodes(convs: list[int], lengths: list[int], ids: list[int], sizes: list[int], left: int, right: int) -> Iterator[tuple]:
    """Nodes of one shard, as rows of NODE without the shard's number.

    `left` and `right` are the lengths of the prefixes that its first and its last sequence have in common with the
    shards beside it, -1 for none. Nodes on these prefixes are `shared`: their counts are those of this shard, without
    children that an earlier shard has too and without leaves and savings of shared nodes, and their
    `ends` are the ids themselves.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)]).tolist()
    sequences = [ids[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    firsts = [i for i, s in enumerate(sequences) if i == 0 or s != sequences[i - 1]]
    after = [*firsts[1:], len(sequences)]
    tree, ending, paths = Ternary(), {}, {}
    for k in middle_first(len(firsts)):
        i = firsts[k]
        path = tree.add(sequences[i], sizes[starts[i] : starts[i + 1]])
        ending[path[-1]] = (i, after[k])
        if k in (0, len(firsts) - 1):
            paths[k] = path
    first, last = paths[0], paths[len(firsts) - 1]
    known = set(first[: left + 1])
    shared = known | set(last[: right + 1])

    n = len(tree.key)
    members, least, children, leaves, saved = [0] * n, [convs[0]] * n, [0] * n, [0] * n, [0] * n
    seen = [False] * n
    for node in range(n - 1, -1, -1):
        if node in ending:
            i, j = ending[node]
            members[node] += j - i
            least[node] = min(least[node], convs[i]) if seen[node] else convs[i]
        if node not in shared:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * tree.size[node]
        up = tree.parent[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = min(least[up], least[node]) if seen[up] else least[node]
            seen[up] = True
            children[up] += node not in known
            leaves[up] += leaves[node]
            saved[up] += saved[node]

    def on(path: list[int], node: int) -> bool:
        depth = tree.depth[node]
        return depth < len(path) and path[depth] == node

    for node in range(n):
        up, own = tree.parent[node], node not in shared
        i, j = ending.get(node, (0, 0))
        text = ",".join(map(str, convs[i:j])).encode()
        yield (
            tree.depth[node], least[node], least[up] if up >= 0 and up not in shared else None, members[node], children[node], leaves[node],
            saved[node], tree.size[node], hashlib.sha256(text).hexdigest().encode() if own else text, not own,
            None if own else int(not on(first, node)), node in known, not own and on(last, node),
            int(not on(first, up)) if own and up in shared else None,
        )


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in NODE.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]] for c in NODE.split(", ")]
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            shard, left, right = (row.column(c)[0].as_py() for c in ("shard", "left", "right"))
            lists = [row.column(c).flatten().to_pylist() for c in ("convs", "lengths", "ids", "sizes")]
            nodes = shard_nodes(*lists, left, right)
            while some := [(shard, *x) for x in islice(nodes, EMIT)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), kinds, strict=True)], names=names)


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the pieces of each (home, depth), which come together and in order."""
    key, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])], names=["home", "depth", "ends_sha256"])

    for batch in batches:
        for *at, piece in zip(*(batch.column(c).to_pylist() for c in ("home", "depth", "ends")), strict=True):
            if at != key:
                if key is not None:
                    yield done()
                key, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece)
    if key is not None:
        yield done()


def _bounds(shards: DataFrame) -> DataFrame:
    """part, sub, shard (its number in order) and left, right: common prefixes with the shards beside it, -1 for none."""
    length = F.element_at("lengths", -1)
    edges = shards.select("part", "sub", F.slice("ids", 1, F.col("lengths")[0]).alias("first"), F.slice("ids", F.size("ids") - length + 1, length).alias("last"))
    numbers = edges.select("part", "sub").withColumn("shard", F.row_number().over(Window.orderBy("part", "sub")).cast("long"))
    edges = edges.join(numbers, ["part", "sub"])
    met = edges.select("shard", "last").join(edges.select((F.col("shard") - 1).alias("shard"), "first"), "shard")
    apart = F.array_position(F.zip_with("last", "first", lambda a, b: a.eqNullSafe(b)), False)
    common = met.select("shard", F.when(apart == 0, F.size("last")).otherwise(apart - 1).cast("int").alias("right"))
    out = numbers.join(common, "shard", "left").join(common.select((F.col("shard") + 1).alias("shard"), F.col("right").alias("left")), "shard", "left")
    return out.select("part", "sub", "shard", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("left", "right")])


def _merged(instances: DataFrame, bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shared nodes, merged, and (shard, depth, side, on_last, conv_id) of what each was merged from."""
    line = Window.partitionBy("depth").orderBy("shard", "side").rowsBetween(Window.unboundedPreceding, 0)
    held = materialize(instances.withColumn("home", F.last(F.when(~F.col("with_previous"), F.col("shard")), True).over(line)), "shared-nodes")
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = held.groupBy("home", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums], F.max("bytes").alias("bytes"), F.max("shard").alias("until")
    )
    nodes = materialize(
        nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")), "merged-nodes"
    )
    # Below a node are the deeper ones of its first shard, and all that begin in later shards before its last.
    deeper = Window.partitionBy("home").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    per_shard = bounds.select("shard").join(nodes.groupBy(F.col("home").alias("shard")).agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own")), "shard", "left")
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    running = per_shard.select("shard", *[F.sum(F.coalesce(c, F.lit(0))).over(upto).alias(f"{c}_upto") for c in ("leaf", "own")])
    begun = running.select(F.col("shard").alias("home"), F.col("leaf_upto").alias("leaf_from"), F.col("own_upto").alias("own_from"))
    ended = running.select((F.col("shard") + 1).alias("until"), "leaf_upto", "own_upto")
    totals = nodes.withColumn("leaf_here", F.sum("leaf").over(deeper)).withColumn("own_here", F.sum("own").over(deeper)).join(begun, "home").join(ended, "until")

    merged_conv = nodes.select("home", "depth", F.col("conv_id").alias("conv"))
    places = held.select("shard", "depth", "side", "on_last", "home").join(merged_conv, ["home", "depth"]).select("shard", "depth", "side", "on_last", F.col("conv").alias("conv_id"))
    above = places.where("on_last").select(F.col("shard").alias("home"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    pieces = held.where(F.octet_length("ends") > 0).select("home", "depth", "shard", "ends").repartition("home", "depth").sortWithinPartitions("home", "depth", "shard")
    ends = pieces.select("home", "depth", "ends").mapInArrow(_hash_pieces, "home long, depth long, ends_sha256 string")
    out = totals.join(above, ["home", "depth"], "left").join(ends, ["home", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("leaf_here") + F.col("leaf_upto") - F.col("leaf_from")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("own_here") + F.col("own_upto") - F.col("own_from")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
    return out, places


def trie_of(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie over conversations given as (conv_id, pos, id, bytes); a row with a null pos only states
    that its conversation exists."""
    step = F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "bytes"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("t"))
    arrays = whole.select("conv_id", F.transform("t", lambda x: x["id"]).alias("ids"), F.transform("t", lambda x: x["bytes"]).alias("sizes"))
    ranges = arrays.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    shards = materialize(ranges.mapInArrow(_shards(shard_turns), SHARD), "shards")
    bounds = materialize(_bounds(shards), "bounds")
    nodes = materialize(shards.join(bounds, ["part", "sub"]).mapInArrow(_grow, NODE), "nodes")
    shared, places = _merged(nodes.where("shared"), bounds)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    whole_nodes = nodes.where("NOT shared").withColumn("ends_sha256", F.col("ends").cast("string"))
    closed = whole_nodes.where("parent_side IS NULL").select(*columns, "ends_sha256")
    parents = places.select("shard", (F.col("depth") + 1).alias("depth"), F.col("side").alias("parent_side"), F.col("conv_id").alias("parent"))
    open_ = whole_nodes.where("parent_side IS NOT NULL").drop("parent_conv_id").join(parents, ["shard", "depth", "parent_side"])
    return closed.unionByName(open_.withColumnRenamed("parent", "parent_conv_id").select(*columns, "ends_sha256")).unionByName(shared)


def conversation_trie(conversations: DataFrame, group: int = 5, longest: int = 9, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of rebuilt conversations (`shared_openings`): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Reads conv_id (whole numbers), turn, role and text, whatever other columns there are. Turns are ordered by
    `turn`, null first, ties by role, then text; repeated rows are turns each. Null roles and texts
    become empty; rows without a conv_id belong to no conversation and are left out. saved_tokens counts bytes of whole texts,
    of any length. For a negative id, c - c % group lies nearer to zero. An empty table gives no nodes, not
    even a root. The ids (not the texts) of one conversation's turns travel as one array.
    """
    turns = materialize(numbered_turns(encode_turns(conversations)), "turns")
    return trie_of(shared_openings(turns, group, longest), shard_turns)
