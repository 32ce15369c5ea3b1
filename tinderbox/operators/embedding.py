"""Text vectors, their reduction and their caches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, CountVectorizerModel, Normalizer, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.schemas import ddl
from tinderbox.session import new_dir

Encoder = Callable[[pd.Series], np.ndarray]


def hashed_words(dim: int = 64) -> Encoder:
    """Stand-in encoder: unit-length counts of hashed words; equal texts give equal vectors."""

    def encode(texts: pd.Series) -> np.ndarray:
        slots: dict[str, int] = {}
        out = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            for word in re.findall("[a-z0-9]+", text.lower()):
                if word not in slots:
                    slots[word] = int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % dim
                out[row, slots[word]] += 1.0
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length == 0, 1.0, length)

    return encode


def embed_words(df: DataFrame, text: str, vector: str, dim: int = 64) -> DataFrame:
    """What `embed` adds with the encoder `hashed_words(dim)`, inside the JVM: words are hashed by built-in functions,
    counted by a vectorizer over the slots and scaled to unit length. A null text counts as empty."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    slot = lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("long"), F.lit(dim)).cast("string")
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol="__slots", outputCol="__counts")
    counted = counter.transform(df.withColumn("__slots", F.transform(words, slot)))
    scaled = Normalizer(p=2.0, inputCol="__counts", outputCol="__unit").transform(counted)
    return scaled.withColumn(vector, vector_to_array("__unit", "float32")).drop("__slots", "__counts", "__unit")


def embed(df: DataFrame, text: str, vector: str, encoder: Encoder) -> DataFrame:
    """Add the vector of each text; the encoder sees one Arrow batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vectors = encoder(pdf[text].fillna(""))
            yield pdf.assign(**{vector: list(np.asarray(vectors, dtype=np.float32))})

    return df.mapInPandas(run, f"{ddl(df.schema)}, `{vector}` array<float>")


def embed_distinct(df: DataFrame, text: str, vector: str, encoder: Encoder) -> DataFrame:
    """Encode each distinct text once."""
    return embed(df.select(text).where(F.col(text).isNotNull()).distinct(), text, vector, encoder)


def fit_pca(df: DataFrame, vector: str, k: int) -> PCAModel:
    """Principal components; each task adds up its rows' covariance part."""
    ready = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return PCA(k=k, inputCol="features", outputCol="reduced").fit(ready)


def centre(df: DataFrame, vector: str) -> list[float]:
    """Mean vector, one number per dimension."""
    dim = len(df.select(vector).first()[0])
    row = df.agg(*[F.avg(F.get(vector, F.lit(i))).alias(f"m{i}") for i in range(dim)]).first()
    return [float(x) for x in row]


def reduce_dims(
    df: DataFrame, vector: str, model: PCAModel, mean: list[float], out: str
) -> DataFrame:
    """Project centred vectors on the components."""
    centred = F.zip_with(
        F.col(vector).cast("array<double>"),
        F.array(*[F.lit(m) for m in mean]),
        lambda x, m: x - m,
    )
    ready = df.withColumn("features", array_to_vector(centred))
    reduced = model.transform(ready)
    return reduced.withColumn(out, vector_to_array("reduced", "float32")).drop(
        "features", "reduced"
    )


def explained_variance(model: PCAModel) -> list[float]:
    """Running sum of the variance share kept by the first components."""
    return [float(x) for x in np.cumsum(model.explainedVariance.toArray())]


def build_cache(
    df: DataFrame, text: str, vector: str, encoder: Encoder, k: int, prefix: str = ""
) -> tuple[DataFrame, PCAModel, list[float]]:
    """Reduced vector per distinct text, with the model and mean that reduce further texts.

    `prefix` is put before each text for encoding only; the cache is keyed by the text. The vectors are written
    to a table below the shared folder first, so the encoder sees each distinct text once. Fewer
    components than `k` remain if the encoder gives fewer dimensions.
    """
    worded = df.select(text).where(F.col(text).isNotNull()).distinct()
    worded = worded.withColumn("__worded", F.concat(F.lit(prefix), F.col(text)))
    encoded = embed(worded, "__worded", vector, encoder).select(text, vector)
    path = new_dir(df.sparkSession, "vectors")
    encoded.write.parquet(path)
    vectors = df.sparkSession.read.schema(encoded.schema).parquet(path)
    model, mean = fit_pca(vectors, vector, k), centre(vectors, vector)
    reduced = reduce_dims(vectors, vector, model, mean, "__reduced")
    return reduced.select(text, F.col("__reduced").alias(vector)), model, mean


def cached_or_encoded(
    df: DataFrame, cache: DataFrame, text: str, vector: str, encoder: Encoder, finish=None
) -> DataFrame:
    """Cached vectors where known; only missing distinct texts are encoded.

    `finish` turns a fresh vector into a cached-size one, such as `reduce_dims`.
    """
    known = cache.select(text, vector)
    missing = df.select(text).distinct().join(known, text, "left_anti")
    fresh = embed_distinct(missing, text, vector, encoder)
    if finish is not None:
        fresh = finish(fresh)
    return df.join(known.unionByName(fresh.select(text, vector)), text, "left")
