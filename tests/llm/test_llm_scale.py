"""What must hold beyond small inputs: blocks, bytes read, the search of packing, hot join keys."""

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tinderbox.llm import ngrams, packing, prefix_free, warc
from tinderbox.llm.common import materialize
from tinderbox.session import scoped


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_ngrams_do_not_depend_on_blocks(monkeypatch, block):
    texts = ["", " ", "a", "word", "a b", "x" * 300, "no no  no\n\nyes \t yes", "äöü €uro \U0001f600 " * 9, " led  and trailed "]
    texts.append("".join(random.Random(5).choices("ab \n", k=500)))

    def counts(text):
        parts = list(ngrams.grams(text, 18))
        return np.sort(np.concatenate(parts)).tolist() if parts else []

    whole = [counts(t) for t in texts]
    monkeypatch.setattr(ngrams, "BLOCK", block)
    assert [counts(t) for t in texts] == whole


class Counting:
    def __init__(self, raw):
        self.raw, self.at, self.read_bytes = raw, 0, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        data = self.raw[self.at : self.at + n]
        self.at += len(data)
        self.read_bytes += len(data)
        return data


def some_records(n, between=lambda i: b""):
    rng = random.Random(3)
    members = [(warc.record(i, f"http://x/{i}", rng.randbytes(rng.randint(0, 900)).hex().encode(), None), between(i)) for i in range(n)]
    return b"".join(a + b for a, b in members)


@pytest.mark.parametrize(
    ("between", "most"),
    [
        (lambda i: b"", 1.2),
        (lambda i: gzip.compress(b"other" * 50) if i % 2 else b"", 3),
        (lambda i: gzip.compress(b"other" * 50), 3),
        (lambda i: b"\0" * 40 if i % 3 == 0 else b"", 3),
    ],
)
def test_ranges_read_the_file_about_once(between, most):
    raw, step = some_records(8000, between), 1 << 21
    total, starts = 0, []
    for s in range(0, len(raw), step):
        file = Counting(raw)
        starts += [at for at, head, _ in warc.records_between(file, s, min(s + step, len(raw)), len(raw)) if head is not None]
        total += file.read_bytes
    assert len(raw) > 2 * step and len(starts) == len(set(starts)) == 8000
    assert total <= most * len(raw)


def test_records_stored_in_others_are_none(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 512)
    inner = warc.record(7, "http://in/", b"inner" * 9, None)

    def stored(block):  # a record whose member holds its bytes as they are
        head = f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: {len(block)}\r\n\r\n".encode()
        return gzip.compress(head + block + b"\r\n\r\n", 0, mtime=0)

    raw = b"".join(stored(b"<" * 700 + inner + b">" * 900) + warc.record(i, None, b"p" * 50, None) for i in range(20))
    expected = [at for at, _, _ in warc.records_between(Counting(raw), 0, len(raw), len(raw))]
    assert len(expected) == 40
    for step in (97, 600, 5000):
        got = [at for s in range(0, len(raw), step) for at, _, _ in warc.records_between(Counting(raw), s, min(s + step, len(raw)), len(raw))]
        assert got == expected


@pytest.mark.parametrize(("low", "high"), [(700, 2000), (1200, 1500)])
def test_search_beats_best_fit_on_thousands(low, high):
    rng = random.Random(1)
    lengths = [rng.randint(low, high) for _ in range(4000)]
    bins = packing.complete(lengths, 4096)
    assert sorted(i for b in bins for i in b) == list(range(4000))
    assert max(sum(lengths[i] for i in b) for b in bins) <= 4096
    assert packing.least_bins(lengths, 4096) <= len(bins) <= len(packing.best_fit(lengths, 4096)) - 30


def test_fillings_are_all_of_them_by_waste():
    rng = random.Random(2)
    for _ in range(60):
        pieces = [rng.randint(1, 12) for _ in range(rng.randint(0, 8))]
        counts = {s: pieces.count(s) for s in pieces}
        found = list(packing.fillings(sorted(counts), counts, 20, 20))
        subsets = {tuple(sorted((p for k, p in enumerate(pieces) if m >> k & 1), reverse=True)) for m in range(1 << len(pieces))}
        assert sorted(tuple(sorted(f, reverse=True)) for f, _ in found) == sorted(s for s in subsets if sum(s) <= 20)
        assert [w for _, w in found] == sorted(20 - sum(f) for f, _ in found)


def test_lower_bound_is_none_too_high():
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        assert packing.least_bins(sizes, 30) <= len(packing.complete(sizes, 30, 10**5))


def test_crowded_strings_are_told_apart_by_128_bits():
    import pyarrow as pa

    data = random.Random(1).randbytes(prefix_free.LENGTH + 3)
    batch = pa.RecordBatch.from_pydict({"trigger": [1], "doc": [5], "start": [9], "bytes": [data]})
    (out,) = prefix_free._strings(iter([batch]))
    assert out.column("start").to_pylist() == [9, 10, 11, 12] and {len(s) for s in out.column("string").to_pylist()} == {16}


def test_a_hot_key_is_split_once_the_aggregate_is_written(spark):
    rows = spark.range(60000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    least = rows.groupBy("k").agg(F.count("v").alias("n"))
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    with scoped(spark, low):
        met = rows.join(materialize(least, "least"), "k")
        assert len(met.collect()) == 60000
        assert "skew=true" in met._jdf.queryExecution().executedPlan().toString()
