"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor wrote and keeps every document but those it is there to drop. All but the
last return the columns of their input. Nulls, empty texts, repeated rows and extra columns are handled as
the operators' docstrings say: texts that are null or empty fall to the quality rules, rows without an id
pass the near-duplicate stage, and an empty table gives an empty result of the last stage's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tinderbox.llm import mixing, near_dedup, packing, pii, quality_rules
from tinderbox.llm.common import materialize, table
from tinderbox.llm.queries import tokenizer_file
from tinderbox.session import tune

# The stages fit models and search in ways that SQL cannot state.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counting rules or the model reject go."""
    return quality_rules.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return pii.mask_pii(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once for every time the mix draws it; those it doesn't draw go."""
    return mixing.draw_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("personal data", privacy),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
