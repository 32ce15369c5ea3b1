"""Content sort, vector codes over cover trees and the prefix trie against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tinderbox.llm import content_sort, prefix_trie, tree_lloyd

DOCS = "doc_id long, text string, bucket int, run string, key binary, size long, `a.b` int, id int, edge string, row long, best int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r", b"k", 2, 3, 4, "e", 5, k) for k, (i, t) in enumerate(rows)], DOCS)


def brute_copies(rows, largest):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        stays = (max if largest else min)(known) if known else None
        given = False
        for i in ids:
            kept = i == stays and not given
            given = given or kept
            out.append((i, stays, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def copies(rng, n):
    texts = ["", None, "a", "a ", "x" * 5000, "x" * 5000 + "y", "é" * 40, "hot", "hot"] + ["hot"] * 12
    return [(rng.choice([None, *range(40)]), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize(("keep", "buckets"), [("largest", 1), ("largest", 40), ("smallest", 40), ("smallest", 7)])
def test_exact_duplicates(spark, keep, buckets):
    rows = copies(random.Random(buckets), 400) + [(i, f"only {i}") for i in range(60)] + [(None, "no id")] * 3 + [(7, "again")] * 3
    docs = documents(spark, rows)
    out = content_sort.exact_duplicates(docs.repartition(5), keep, buckets=buckets)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute_copies(rows, keep == "largest")


def test_a_hot_text_is_dealt_over_buckets(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    held = content_sort._sorted_runs(docs, "largest", None, 30, [])
    sizes = [r["count"] for r in held.groupBy("bucket").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 500
    out = {r.doc_id: r for r in content_sort.exact_duplicates(docs, "largest", buckets=30).collect()}
    assert out[0].group_size == 1000 and out[0].keep_id == 2997 and out[2997].kept and not out[0].kept and out[1].kept


def test_drop_exact_duplicates(spark):
    docs = documents(spark, [(3, "a"), (1, "A"), (2, None), (None, ""), (5, "b"), (5, "b")])
    out = content_sort.drop_exact_duplicates(docs, normalise=F.lower)
    assert out.columns == docs.columns and out.schema["a.b"] == docs.schema["a.b"]
    assert sorted((r["doc_id"], r["text"], r["a.b"]) for r in out.collect()) == [(1, "A", 3), (2, None, 3), (5, "b", 3)]
    assert content_sort.drop_exact_duplicates(docs.limit(0)).collect() == []
    assert content_sort.exact_duplicates(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="keep"):
        content_sort.exact_duplicates(docs, "newest")


def test_content_sort_runs_no_python_and_shuffles_texts_once(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    plan = content_sort._sorted_runs(docs, "largest", None, 4, [])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange") == 1


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, k, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v, k in rows if v is not None and None not in v and np.isfinite(v).all()]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    points = np.stack([v for *_, v in kept]).reshape(len(kept), parts, -1)
    books = points[:entries].transpose(1, 0, 2).copy()

    def near():
        gaps = [((points[:, p, None] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)]
        return np.stack([g.argmin(axis=1) for g in gaps], axis=1), sum(g.min(axis=1) for g in gaps)

    for _ in range(rounds):
        codes, _ = near()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = points[codes[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(axis=0) // len(own)
    codes, error = near()
    by_label = collections.Counter()
    for (_, k, _), e in zip(kept, error.tolist(), strict=True):
        by_label[k] += e
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = [(i, "".join(f"{c:02x}" for c in row), e, by_label[k], sha) for (i, k, _), row, e in zip(kept, codes.tolist(), error.tolist(), strict=True)]
    return sorted(out, key=repr)


VECTORS = "vec_id long, embedding array<double>, label string, code int, error string, id int, v int, points binary"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, 1, "e", 2, 3, b"p") for i, v, k in rows], VECTORS)


@pytest.mark.parametrize(("parts", "entries", "chunk"), [(2, 5, 64), (4, 64, 4096), (8, 3, 7), (1, 300, 50)])
def test_vector_codes(spark, parts, entries, chunk):
    rng = np.random.default_rng(parts)
    rows = [(int(i), rng.normal(0, 0.3, 8).tolist(), rng.choice(["a", "b"])) for i in range(300)]
    rows += [(1000 + i, [0.25] * 8, None) for i in range(150)]  # one hot vector
    rows += [(i, rng.integers(-2, 3, 8).astype(float).tolist(), "ties") for i in range(50, 150)]  # repeated ids, equal distances
    rows += [(None, rng.normal(0, 0.3, 8).tolist(), "a"), (2000, None, "a"), (2001, [0.1] * 7 + [None], "a"), (2002, [0.1] * 7 + [float("nan")], "b"), (2003, [0.1] * 7 + [float("-inf")], "b")]
    rows += [rows[0]] * 3
    if entries > 256:
        with pytest.raises(ValueError, match="256"):
            tree_lloyd.compress_vectors(vectors(spark, rows), parts, entries)
        entries = 256
    out = tree_lloyd.compress_vectors(vectors(spark, rows).repartition(3), parts, entries, chunk=chunk)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute_codes(rows, parts, entries, 2)


def test_vector_codes_of_few_or_unfit_vectors(spark):
    rows = [(4, [0.5, -0.5], None), (2, [0.25, 0.0], "x")]
    out = tree_lloyd.compress_vectors(vectors(spark, rows), 2).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in out) == [(2, "0000", 0), (4, "0101", 0)]
    assert tree_lloyd.compress_vectors(vectors(spark, []), 2).collect() == []
    assert tree_lloyd.compress_vectors(vectors(spark, [(1, None, None)]), 2).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError, match="3 equal parts"):
        tree_lloyd.compress_vectors(vectors(spark, rows), 3)
    for bad, words in (([1e30, 0.0], "beyond"), ([0.0], "components")):
        with pytest.raises(Exception, match=words):
            tree_lloyd.compress_vectors(vectors(spark, [*rows, (9, bad, None)]), 2, entries=2).collect()


def test_cover_tree_holds_its_rules_and_assigns_subtrees():
    rng = np.random.default_rng(5)
    points = np.concatenate([c + rng.integers(-6, 7, (300, 4)) for c in rng.integers(-900, 900, (12, 4))])
    tree = tree_lloyd.cover_tree(points, leaf=8)
    assert (points[tree.order] == tree.points).all() and sorted(tree.order) == list(range(len(points)))
    for i in range(len(tree.radius)):
        own, c = tree.points[tree.start[i] : tree.end[i]], tree.points[tree.center[i]]
        assert np.sqrt(((own - c) ** 2).sum(axis=1)).max() <= tree.radius[i] + 1e-9
        kids = range(tree.child[i], tree.child[i] + tree.children[i])
        assert not kids or (tree.start[kids[0]], tree.end[kids[-1]]) == (tree.start[i], tree.end[i])
        assert all(tree.radius[k] <= tree.radius[i] / 2 + 1e-9 for k in kids)
    again = tree_lloyd.Tree.unpack(*tree.pack(), 4)
    entries = np.array([points[k * 300] for k in range(12)])
    codes = np.zeros(len(points), np.int64)
    counts, sums, alone = tree_lloyd.assign(again, entries, codes)
    want = ((tree.points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (codes == want).all() and (counts == np.bincount(want, minlength=12)).all()
    assert all((sums[e] == tree.points[want == e].sum(axis=0)).all() for e in range(12))
    assert alone < len(points) / 10  # clusters go as whole subtrees


def brute_trie(rows, group=5, longest=9):
    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % longest
        built = tuple(own.get(c - c % group, [])[:h] + own[c][h:])
        ends[built].append(c)
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not kids[k]
    return sorted(
        (m[0], len(k), members[k[:-1]][0] if k else -1, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, ends.get(k, []))).encode()).hexdigest())
        for k, m in members.items()
    )


TURNS = "conv_id long, turn int, role string, text string, pos int, id string, bytes int, shard int, depth int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", 2, 3, 4) for r in rows], TURNS)


def nodes_of(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


@pytest.mark.parametrize("shard_turns", [1, 4, 25, 100_000])
def test_prefix_trie(spark, shard_turns):
    rng = random.Random(shard_turns)
    rows = []
    for c in rng.sample(range(120), 70):
        hot = rng.random() < 0.35
        for t in range(4 if hot else rng.randrange(1, 7)):
            text = f"hot {t}" if hot else rng.choice(["", "a", "b", "é", "a", None])
            rows.append((c, rng.choice([None, t, t, 2]) if not hot else t, rng.choice(["user", None]) if not hot else "user", text))
    rows += [rows[3]] * 2 + [(None, 1, "user", "nobody's")] * 3
    rows += [(500, t, "user", "long " * 20 + str(t % 3)) for t in range(90)]
    rows += [(510 + c, t, "user", "x" * 3000) for c in range(3) for t in range(9)]
    got = nodes_of(prefix_trie.conversation_trie(conversations(spark, rows).repartition(4), shard_turns=shard_turns))
    assert got == brute_trie(rows)


def test_prefix_trie_of_copies_alone_and_of_nothing(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 200, 5) for t in range(3)]
    assert nodes_of(prefix_trie.conversation_trie(conversations(spark, rows), shard_turns=10)) == brute_trie(rows)
    assert nodes_of(prefix_trie.conversation_trie(conversations(spark, []))) == []
    assert nodes_of(prefix_trie.conversation_trie(conversations(spark, [(None, 1, "user", "x")]))) == []


def test_ternary_tree_is_balanced_by_middle_first():
    order = list(prefix_trie.middle_first(1023))
    assert sorted(order) == list(range(1023))
    tree = prefix_trie.Ternary()
    for k in order:
        tree.add([k], [1])

    def height(node):
        return 0 if not node else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.down[0]) == 10
