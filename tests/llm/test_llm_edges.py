"""Columns of any name and ids of any size."""

import pytest
from pyspark.sql import functions as F

from tinderbox.llm import near_dedup, packing, pii, quality_rules
from tinderbox.llm.queries import tokenizer_file

LABELS = "doc_id long, quality int"


@pytest.fixture
def docs(spark):
    long = " ".join(f"word{i}" for i in range(90))
    rows = [(1, long, 1), (2, long, 2), (None, long, 3), (4, "mail me@example.org " + " ".join(f"other{i}" for i in range(90)), 4)]
    return spark.createDataFrame([(*r, 5, 6, 7, 8) for r in rows], "doc_id long, text string, `a.b` int, _gone int, c0 int, component int, n_chars int")


def test_filters_keep_columns_of_any_name(spark, docs):
    labels = spark.createDataFrame([], LABELS)
    for out, ids in (
        (near_dedup.drop_near_duplicates(docs), [1, 4, None]), (quality_rules.drop_low_quality(docs, labels), [1, 2, 4, None]), (pii.mask_pii(docs), [1, 2, 4, None]),
    ):
        assert out.columns == docs.columns
        got = out.collect()
        assert sorted((r["doc_id"] for r in got), key=lambda i: (i is None, i or 0)) == ids
        assert all(r["_gone"] == 5 and r["c0"] == 6 and r["a.b"] in (1, 2, 3, 4) for r in got)
    masked = {r["doc_id"]: r for r in pii.mask_pii(docs).collect()}
    assert masked[4]["text"].startswith("mail [email] ") and masked[4]["n_chars"] == len(masked[4]["text"])
    assert pii.mask_pii(docs.limit(0)).collect() == []


def test_packing_keeps_large_ids_beside_null_ones(spark):
    big = 9007199254740993
    rows = [(big + k, f"text {k}") for k in range(6)] + [(None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack_documents(docs, tokenizer_file())
    assert sorted((r.doc_id for r in out.collect()), key=lambda i: (i is None, i or 0)) == [*range(big, big + 6), None, None]
    named = packing.pack_documents(docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), tokenizer_file())
    assert {r.doc_id for r in named.collect()} == {*(f"d{big + k}" for k in range(6)), None}
