"""Quality classifier with supervised subword embeddings.

Each hashed word or character n-gram has a learned vector; a document is the mean of its vectors and
a softmax over a linear layer gives the class. Vectors and layer are trained together by numpy
stochastic gradient descent on a bounded sample. For scoring, layer and vectors are multiplied out
once, which leaves one number per bucket and the same results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import held_out, slices
from tinderbox.llm.ngrams import Sparse, mean_value
from tinderbox.llm.training import Sample, labelled_sample, platt, sigmoid

BITS = 17
DIMENSIONS = 12
EPOCHS = 6
PER_CLASS = 800
TRAIN_CHARS = 50_000


@dataclass(frozen=True)
class EmbeddingModel:
    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    a: float = 1.0
    b: float = 0.0

    def margins(self) -> np.ndarray:
        """What a bucket adds to the difference of the two classes' scores."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def fit(sample: Sample, epochs: int = EPOCHS, rate: float = 0.5, seed: int = 7) -> EmbeddingModel | None:
    """Stochastic gradient descent over single documents, classes weighing the same; the score is
    calibrated on every fourth row, which the descent does not see. None without two rows a class."""
    if not sample.usable:
        return None
    rng = np.random.default_rng(seed)
    x, y = Sparse(sample.texts, BITS), sample.labels
    vectors = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    fitted = np.arange(len(y)) % 4 != 3
    if min(np.bincount(y[fitted], minlength=2)) == 0:
        fitted[:] = True
    share = np.bincount(y[fitted], minlength=2) / fitted.sum()
    rows = np.flatnonzero(fitted)
    steps, done = epochs * len(rows), 0
    # Shares of single n-grams are about 1 / length; the vectors' rate makes up for that.
    boost = 1.0 / max(float(np.square(x.shares).sum() / max(x.rows, 1)), 1e-6)
    boost = min(boost, 2000.0)
    for _ in range(epochs):
        for r in rng.permutation(rows):
            lr = rate * (1 - done / steps)
            done += 1
            ids, shares = x.take(r)
            if not len(ids):
                continue
            hidden = shares @ vectors[ids]
            out = hidden @ layer + bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[y[r]] -= 1
            p *= 0.5 / share[y[r]]
            back = layer @ p
            layer -= lr * 0.2 * np.outer(hidden, p)
            bias -= lr * 0.1 * p
            vectors[ids] -= (lr * 0.05 * boost) * shares[:, None] * back[None, :]
    model = EmbeddingModel(vectors, layer, bias)
    scores = x.dot(model.margins()) + model.offset()
    rest = ~fitted if min(np.bincount(y[~fitted], minlength=2)) > 0 else np.ones(len(y), bool)
    a, b = platt(scores[rest], y[rest], sample.weights[rest])
    return EmbeddingModel(vectors, layer, bias, max(a, 1e-6), b)


def scorer(model: EmbeddingModel | None) -> Callable:
    margins, offset, a, b = (None, 0, 0, 0) if model is None else (model.margins(), model.offset(), model.a, model.b)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                mean = 0.0 if margins is None else mean_value(text or "", margins, BITS)
                out.append(0.5 if margins is None else float(sigmoid(a * (mean + offset) + b)))
            p = np.array(out, np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return score


def quality_classifier(
    docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, train_chars: int = TRAIN_CHARS
) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted.

    Learns only from labels of rows that are not held out, at most `per_class` of each class with
    texts up to `train_chars` long; scores whole texts. A null or empty text has no n-grams and gets
    the score of the bias alone; null ids are not held out. Repeated rows get equal rows. Without
    labels of both classes every score is 0.5. Other columns are not read, whatever their names.
    """
    model = fit(labelled_sample(docs, labels, label, per_class, train_chars))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    ).mapInArrow(scorer(model), f"doc_id {kind}, held_out boolean, score double, predicted int")
