"""Quality rules: counting rules first, then a hashed n-gram logistic regression.

The regression is fitted on a bounded sample of labelled rows, its scores are calibrated to
probabilities on the part of the sample it did not see, and every document is scored in Arrow
batches against fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import by_position, slices
from tinderbox.llm.ngrams import Sparse, mean_value
from tinderbox.llm.training import Sample, labelled_sample, platt, sigmoid

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_PROBABILITY = 0.5
BITS = 18
PER_CLASS = 800
TRAIN_CHARS = 50_000

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, quality_probability double"
)


@dataclass(frozen=True)
class QualityModel:
    """`weights` by bucket; probability = sigmoid(a * (mean weight + bias) + b)."""

    weights: np.ndarray
    bias: float
    a: float
    b: float

    def probability(self, text: str) -> float:
        return float(sigmoid(self.a * (mean_value(text, self.weights, BITS) + self.bias) + self.b))


def fit(sample: Sample, rounds: int = 40, rate: float = 2.0) -> QualityModel | None:
    """Logistic regression by full-batch AdaGrad on three quarters of the sample (classes weigh the
    same), calibrated on the last quarter at the true class sizes. None without two rows a class."""
    if not sample.usable:
        return None
    x, y = Sparse(sample.texts, BITS), sample.labels
    fitted = np.arange(len(y)) % 4 != 3
    if min(np.bincount(y[fitted], minlength=2)) == 0:
        fitted[:] = True
    balance = np.where(fitted, 0.5 / np.maximum(np.bincount(y[fitted], minlength=2)[y], 1), 0.0)
    size = 1 << BITS
    w, seen, bias, bias_seen = np.zeros(size), np.full(size, 1e-12), 0.0, 1e-12
    for _ in range(rounds):
        gap = balance * (sigmoid(x.dot(w) + bias) - y)
        grad = x.gradient(gap, size)
        seen += grad * grad
        w -= rate * grad / np.sqrt(seen) * (grad != 0)
        bias_seen += gap.sum() ** 2
        bias -= 0.1 * gap.sum() / np.sqrt(bias_seen)
    scores = x.dot(w) + bias
    rest = ~fitted if min(np.bincount(y[~fitted], minlength=2)) > 0 else np.ones(len(y), bool)
    a, b = platt(scores[rest], y[rest], sample.weights[rest])
    return QualityModel(w.astype(np.float32), float(bias), max(a, 0.0), b)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    n_space = sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup_lines = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                dup_lines += 1
            elif line.strip(" \t\x0b\x0c\r"):
                seen.add(line)
    return n, len(text) - n_space, symbols, dup_lines, _repeat_words(words)


def _repeat_words(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(number) + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def judge(text: str | None, model: QualityModel | None, threshold: float) -> tuple:
    """The values of COLUMNS for one text."""
    text = text or ""
    counts = base_counts(text)
    failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
    p = 1.0 if model is None else model.probability(text)
    return (*counts, failed, not failed and p >= threshold, p)


def scorer(model: QualityModel | None, threshold: float) -> Callable:
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [judge(t, model, threshold) for t in batch.column("text").to_pylist()]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", *names])

    return score


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    train_chars: int = TRAIN_CHARS,
    threshold: float = KEEP_PROBABILITY,
) -> DataFrame:
    """One row per document: its counts, `base_failed`, `quality_probability` and `kept`.

    Null texts count as empty; empty texts have too few words and are not kept. Rows are judged one by one, so
    repeated rows and null ids get their own, equal results. Without labels of both classes (or
    without any rows) no model is fitted and the counting rules decide alone. Only `doc_id` and `text`
    are read, so extra columns of any name do no harm. The model sees at most `per_class` labelled
    rows of each class with texts up to `train_chars` long; scoring covers whole texts.
    """
    model = fit(labelled_sample(docs, labels, "quality", per_class, train_chars))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        scorer(model, threshold), f"doc_id {kind}, {COLUMNS}"
    )


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, train_chars: int = TRAIN_CHARS, threshold: float = KEEP_PROBABILITY
) -> DataFrame:
    """The documents that `quality_rules` keeps, with all their columns, whatever these are named."""
    model = fit(labelled_sample(docs, labels, "quality", per_class, train_chars))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            good = [judge(t, model, threshold)[6] for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return by_position(docs, keep)
