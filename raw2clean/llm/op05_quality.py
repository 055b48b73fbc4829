"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

One pass over the texts gives each document a short vector of transformed
statistics (shares of byte classes, word lengths, repetition); it is stored, and
everything after works on these vectors. The moments of both classes are sums over ALL
labelled training rows, taken by Spark; what reaches the driver are two
mean vectors and two small matrices. Statistics of a short text say little: they
are standardised and drawn towards the mean by size / (size + ``DAMPING``).
Class covariances of the damped statistics are shrunk towards a multiple of the identity, their Cholesky factors are
computed once and shipped with the scoring tasks. The score is the logistic
function of the difference of the two Gaussian log densities (Mahalanobis distances and log
determinants) plus the log odds of the classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import (LOWER, SPACE, chunks, crc_fold, importable, mix, read, span_hashes, stored,
                                  text_buffer, texts, word_spans)

FOLDS, HELD = 5, 0
THRESHOLD = 0.3
DAMPING = 200        # bytes: a text of this size has its statistics halved
SHRINKAGE = 0.02     # weight of the identity in a class covariance

_CLASS = np.full(256, 6, np.uint8)                      # 6: other ASCII signs
_CLASS[list(range(97, 123))] = 0                        # lower case
_CLASS[list(range(65, 91))] = 1                         # upper case
_CLASS[list(range(48, 58))] = 2                         # digits
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 3              # blanks
_CLASS[10] = 4                                          # line ends
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 5             # punctuation
_CLASS[128:] = 7                                        # bytes of other scripts
NAMES = ["length", "lower", "upper", "digits", "blanks", "line_ends", "punctuation", "signs", "other_bytes",
         "word_length", "word_length_spread", "distinct_words", "distinct_pairs", "words_without_letters", "longest_word"]


def _distinct_share(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each row over all of them (1 for a row without any)."""
    keyed = np.sort(mix(h ^ mix(row.astype(np.uint64) + np.uint64(1))) >> np.uint64(24) | row.astype(np.uint64) << np.uint64(40))
    first = np.ones(len(keyed), bool)
    first[1:] = keyed[1:] != keyed[:-1]
    total = np.bincount(row, minlength=n)
    distinct = np.bincount((keyed[first] >> np.uint64(40)).astype(np.intp), minlength=n)
    return np.where(total > 0, distinct / np.maximum(total, 1), 1.0)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x len(NAMES): the transformed statistics of each text of a buffer (at most 2**24 rows)."""
    n, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * 8 + _CLASS[data], minlength=8 * n).reshape(n, 8)
    share = counts / np.maximum(size, 1)[:, None]
    starts, ends, of = word_spans(~SPACE[data], offsets)
    length = (ends - starts).astype(float)
    words = np.bincount(of, minlength=n)
    mean = np.bincount(of, length, minlength=n) / np.maximum(words, 1)
    spread = np.sqrt(np.bincount(of, (length - mean[of]) ** 2, minlength=n) / np.maximum(words, 1))
    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    h = span_hashes(LOWER[data] + np.uint8(1), starts, ends)
    together = of[1:] == of[:-1]
    pairs = mix(h[:-1][together] * np.uint64(3) + h[1:][together])
    letters = np.concatenate(([0], np.cumsum(np.isin(_CLASS[data], (0, 1, 7)))))
    plain = np.bincount(of, letters[ends] == letters[starts], minlength=n) / np.maximum(words, 1)
    angle = np.arcsin(np.sqrt(np.clip(share, 0, 1)))
    return np.column_stack([
        np.log1p(size), angle, np.log1p(mean), np.log1p(spread), _distinct_share(of, h, n),
        _distinct_share(of[1:][together], pairs, n), np.arcsin(np.sqrt(np.clip(plain, 0, 1))), np.log1p(longest)])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x (array of doubles), a row for each row."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            x = statistics(*text_buffer(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
                ["doc_id", "x"])

    return texts(docs).mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Of the statistics the mean and scale; of each class the mean of the damped ones, the inverse Cholesky factor and a constant."""

    centre: np.ndarray
    scale: np.ndarray
    damping: float
    means: tuple[np.ndarray, np.ndarray] = ()
    whiten: tuple[np.ndarray, np.ndarray] = ()
    constant: tuple[float, float] = ()

    @classmethod
    def over(cls, n: np.ndarray, sums: np.ndarray, squares: np.ndarray, damping: float) -> Discriminant:
        """Mean and scale, from both classes' counts, sums of x and sums of x x'."""
        total = max(n.sum(), 1)
        centre = sums.sum(axis=0) / total
        return cls(centre, np.sqrt(np.maximum(np.diag(squares.sum(axis=0)) / total - centre ** 2, 1e-6)), damping)

    def damped(self, x: np.ndarray) -> np.ndarray:
        """Standardised statistics, all but the length itself drawn to 0 in short texts."""
        z = (x - self.centre) / self.scale
        size = np.expm1(x[:, :1])
        z[:, 1:] *= (size + 1) / (size + 1 + self.damping)
        return z

    def fit(self, n: np.ndarray, sums: np.ndarray, squares: np.ndarray, shrinkage: float) -> Discriminant:
        """With the classes, from the same moments of the damped statistics; a class without rows takes the shape of the whole."""
        d, total = sums.shape[1], n.sum()
        means, whiten, constant = [], [], []
        for c in (0, 1):
            m = sums[c] / n[c] if n[c] else np.zeros(d)
            cov = squares[c] / n[c] - np.outer(m, m) if n[c] else np.eye(d)
            cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / d, 1e-3) * np.eye(d)
            lower = np.linalg.cholesky(cov)
            means.append(m)
            whiten.append(np.linalg.inv(lower))
            constant.append(float(np.log((n[c] + 1) / (total + 2)) - np.log(np.diag(lower)).sum()))
        return replace(self, means=tuple(means), whiten=tuple(whiten), constant=tuple(constant))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.damped(x)
        log = [self.constant[c] - 0.5 * np.square((z - self.means[c]) @ self.whiten[c].T).sum(axis=1) for c in (0, 1)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def _moments(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums of z and sums of z z' of both classes, z = of(x), over all rows (x, y): sums a task, then a sum by entry."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            z, y = of(np.asarray(batch.column("x").flatten(), np.float64).reshape(-1, d)), np.asarray(batch.column("y"))
            for c in (0, 1):
                total[c] += np.concatenate(([(y == c).sum()], z[y == c].sum(axis=0), (z[y == c].T @ z[y == c]).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], total.shape[1]), pa.int32()),
                                          pa.array(np.tile(np.arange(total.shape[1]), 2), pa.int32()), pa.array(total.ravel())],
                                         ["y", "k", "v"])

    total = np.zeros((2, 1 + d + d * d))
    for r in rows.mapInArrow(run, "y int, k int, v double").groupBy("y", "k").agg(F.sum("v").alias("v")).collect():
        total[r["y"], r["k"]] = r["v"]
    return total[:, 0], total[:, 1:1 + d], total[:, 1 + d:].reshape(2, d, d)


def fit(vectors: DataFrame, labels: DataFrame, label: str, shrinkage: float = SHRINKAGE, damping: float = DAMPING) -> Discriminant:
    """The model of (doc_id, x) and labels (doc_id, 0 or 1; other values and null ids are left out)."""
    y = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
         .where(F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.min("y").alias("y")))
    rows = stored(vectors.join(y, "doc_id").select("x", "y"), "training-statistics")
    model = Discriminant.over(*_moments(rows, lambda x: x), damping)
    return model.fit(*_moments(rows, model.damped), shrinkage)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
             folds: int = FOLDS, held: int = HELD, shrinkage: float = SHRINKAGE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Labels are learnt from rows outside the held-out fold only; of a document
    labelled twice the smaller label counts. A null or empty text has the
    statistics of no words and is scored like any other. Without labels of a class the
    score follows the other class's shape. Repeated rows give a row each;
    other columns are not read.
    """
    vectors, model = train(docs, labels, label, folds, held, shrinkage)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shipped.value.score(np.asarray(batch.column("x").flatten(), np.float64).reshape(-1, len(NAMES)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return vectors.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (crc_fold(F.col("doc_id"), folds) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held: int = HELD,
          shrinkage: float = SHRINKAGE) -> tuple[DataFrame, Discriminant]:
    """The stored statistics of all documents, and the model of the labels outside the held-out fold."""
    vectors = stored(document_statistics(docs), "statistics")
    return vectors, fit(vectors, labels.where(crc_fold(F.col("doc_id"), folds) != held), label, shrinkage)


def accepted(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they are: texts are judged where they lie, nothing is shuffled."""
    shipped = importable(docs.sparkSession).sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        parts = chunks(iter([pa.RecordBatch.from_arrays([text], ["text"])]))
        return pa.array(np.concatenate([np.zeros(0), *(shipped.value.score(statistics(*text_buffer(p.column("text")))) for p in parts)]))

    return docs.where(score(F.coalesce(docs["text"].cast("string"), F.lit(""))) >= threshold)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
