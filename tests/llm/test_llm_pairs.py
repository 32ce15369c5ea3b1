"""Near-duplicates, repeated strings and top-k search against brute force."""

import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tinderbox.llm import components, cover_tree, near_dedup, prefix_free
from tinderbox.llm.common import table

SCHEMA = "doc_id long, text string, component_id long, kept boolean, node long, start long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, False, 8, 9) for i, t in rows], SCHEMA)


def variants(rng, n):
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(500)}"
        out.append(" ".join(words))
    return out


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            common = len(sets[i] & sets[j])
            linked = common and 100 * common >= percent * len(sets[i] | sets[j]) and None not in (rows[i][0], rows[j][0])
            if same_id or linked:
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i)) if d is not None else None) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, monkeypatch, size, percent):
    monkeypatch.setattr(near_dedup, "GROUP_BLOCK", 128 if size == 5 else 7)
    rng = random.Random(size)
    texts = [t for _ in range(4) for t in variants(rng, 25)] + ["", None, "one", "One", "two words", "TWO words", "a b c", "x " * 40, "é " * 40]
    rows = list(enumerate(texts)) + [(3, texts[3]), (4, texts[90]), (None, texts[5]), (None, None)]
    rng.shuffle(rows)
    got = near_dedup.near_duplicates(frame(spark, rows), size, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute_components(rows, size, percent)
    assert got.where("NOT (kept <=> (doc_id <=> component_id))").count() == 0
    stay = near_dedup.drop_near_duplicates(frame(spark, rows), size, percent)
    assert stay.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" boolean", "").split(", ")
    assert stay.count() == got.where("kept").count()


def test_members_of_one_component_are_not_compared(spark, monkeypatch):
    """1,000 linked documents and one more in their star: a copy of each set, not one for each block."""
    monkeypatch.setattr(near_dedup, "GROUP_BLOCK", 10)
    members = [(1, i, 1) for i in range(1000)] + [(1, 1000, 1000)] + [(2, i, i % 3 // 2) for i in range(60)] + [(3, 5, 5), (3, 6, 5)]
    stars = spark.createDataFrame(members, "first long, node long, component long")
    sets = spark.range(1001).select(F.col("id").alias("node"), F.array("id").alias("shingles"))
    got = near_dedup._meetings(stars, sets).collect()
    assert sum(r.first == 1 for r in got) == 1000 + 1 + 100 and not any(r.first == 3 for r in got)
    met = {}
    for r in got:
        met.setdefault((r.first, r.i, r.j), []).append((r.node, r.component))
    pairs = {(k[0], *sorted((a, b))) for k, v in met.items() for a, x in v for b, y in v if x != y}
    assert pairs == {(1, i, 1000) for i in range(1000)} | {(2, *sorted((a, b))) for a in range(2, 60, 3) for b in range(60) if b % 3 < 2}


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_bands_miss_hardly_any():
    for percent in (50, 80, 85, 95):
        bands, rows = near_dedup.bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= near_dedup.MISS and bands * rows <= near_dedup.COORDINATES


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    share = (near_dedup.signature(a, 2000) == near_dedup.signature(b, 2000)).mean()
    assert abs(share - 800 / 1200) < 0.08


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    got = components.components(spark.createDataFrame(path + star + [(5, 5)], "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(i, 0) for i in range(61)} | {(1000 + i, 1000) for i in range(50)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first = {}
    for i in order:
        data = (rows[i][1] or "").encode()
        key = (rows[i][0] is None, rows[i][0] or 0)
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            first[window] = min(first.get(window, (key, s)), (key, s))
    out = []
    for d, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if first[data[s : s + 100]] < ((d is None, d or 0), s):
                gone[s : s + 100] = b"\x01" * 100
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(data), len(data) - len(kept), spans, sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeat_rows():
    rng = random.Random(5)

    def words(n):
        return " ".join(rng.choice(["the", "of", "and", "tion", "er", "é", "ß"]) + str(rng.randrange(90)) for _ in range(n))

    passage, other = words(60), words(25)
    rows = [(i, f"{words(rng.randrange(60))} {passage[rng.randrange(40):]} {words(30)} {other}") for i in range(40)]
    rows += [(40, None), (41, ""), (42, "a" * 99), (43, "a" * 1000), (44, "ab" * 400), (45, rows[3][1]), (46, passage * 3), (47, rows[7][1][:150])]
    rows += [(48, "x" * 99 + "y"), (49, "x" * 99 + "y"), (2, rows[2][1]), (None, passage), (None, words(80))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [prefix_free.HOT_PHRASES, 1])
def test_repeated_strings(spark, monkeypatch, hot):
    monkeypatch.setattr(prefix_free, "HOT_PHRASES", hot)
    monkeypatch.setattr(prefix_free, "ARRAY_BYTES", 2000)
    rows = repeat_rows()
    got = [tuple(r) for r in prefix_free.remove_repeats(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == brute_repeats(rows)


def test_repeated_strings_in_blocks(monkeypatch):
    """Cutting a long text into blocks doesn't change which strings have earlier equals."""
    text = ("".join(chr(97 + i * i % 26) for i in range(700)) * 2).encode() + b"z" * 300
    whole = prefix_free.removed_ranges(text, [], [])
    monkeypatch.setattr(prefix_free, "BLOCK", 256)
    triggers, hashes, starts, ends = prefix_free.parse(text)
    assert starts[0] == 0 and ends[-1] == len(text) - 99 and (starts[1:] == ends[:-1]).all()
    assert whole


def test_repeats_of_nothing_and_kept_bytes(spark):
    assert prefix_free.remove_repeats(frame(spark, [])).count() == 0
    out = prefix_free.remove_repeats(frame(spark, [(1, "p" * 150), (2, "p" * 150 + "q")]), with_text=True).orderBy("doc_id").collect()
    assert bytes(out[0].kept) == b"p" * 0 + b"p" * (150 - out[0].n_removed) and bytes(out[1].kept) == b"q"


def brute_top(rows, k):
    out = []
    sets = {(i, tuple(v)) for i, v in rows if i is not None and v is not None}
    for q in {i for i, _ in sets if i % 50 == 0}:
        scored = [(-sum(x * y for x, y in zip(a, b, strict=True)), j) for i, a in sets if i == q for j, b in sets if j != q and len(a) == len(b)]
        out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [40, 4096])
def test_top_k(spark, block):
    rng = random.Random(block)
    rows = [(i, [rng.randrange(-60, 60) for _ in range(6)]) for i in range(400)]
    rows += [(i, [10, 20, 30, 40, 50, 60]) for i in range(400, 600)] + [(600, [1, 2]), (650, [3, 4]), (700, [])]
    rows += [rows[3], (50, [1, 1, 1, 1, 1, 1]), (None, [1] * 6), (701, None), (750, [2**40, 0, 0, 0, 0, 0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<bigint>")
    got = cover_tree.top_k(df, F.col("vec_id") % 50 == 0, 5, block, block)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 5)
    assert cover_tree.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_pruning_skips_far_nodes():
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.integers(0, 5, (500, 8)) + 1000 * c for c in range(4)]).astype(np.int64)
    root, order = cover_tree.cover_tree(vectors.astype(float))
    assert sorted(order.tolist()) == list(range(2000))

    def walk(node):
        points = vectors[order[node.start : node.end]].astype(float)
        assert np.sqrt(((points - vectors[node.center]) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        assert not node.children or sum(c.end - c.start for c in node.children) == node.end - node.start
        for child in node.children:
            walk(child)

    walk(root)


def test_vectors_without_sound_components(spark):
    rows = [(1, [0.5, -0.001]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [])]
    got = cover_tree.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert [(r.vec_id, r.v) for r in got] == [(1, [128, -1]), (6, [])]


def test_real_rows_keep_one_of_each_group(spark, sf):
    docs = table(spark, sf, "documents")
    out = near_dedup.near_duplicates(docs, 5, 80)
    groups = out.where("n_shingles > 0").groupBy("component_id").agg(F.sum(F.col("kept").cast("int")).alias("n"))
    assert groups.where("n <> 1").count() == 0
