"""Toxicity by non-negative positive-unlabelled learning.

The classifier learns from confirmed toxic examples and from unlabelled text, which
holds toxic documents too. With the class prior p, the risk of a linear model f on the words of a
text is estimated as

    p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)])

with the logistic loss l; where the second term falls below zero (the model
has begun to tell the positives in the unlabelled sample from the others by heart), a step
climbs back on that term alone (Kiryo et al., 2017).

Both samples are bounded parameters: the first rows in a hash order of their
ids. Spark counts their words; only those that tell the samples apart, and
their places in the sampled documents, reach the driver, which trains. The prior is the upper end of the 95 % interval of the share of toxic documents among
the labelled ones of the training folds: one too low would call a word's presence in
the unlabelled sample harmless. Texts are scored where they lie; the model (at most ``WORDS``
word hashes and weights) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import LOWER, chunks, crc_fold, importable, read, span_hashes, stored, text_buffer, texts, word_spans

FOLDS, HELD = 3, 1
THRESHOLD = 0.7
POSITIVES, UNLABELLED = 6_000, 20_000   # documents of the two samples, at most
WORDS = 20_000                          # words of the model, at most
LEAST_DOCS, LEAST_Z = 5, 5.0            # sampled documents that hold a word of the model, and how far its shares differ
STEPS, RATE, DECAY = 1500, 0.1, 1e-5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every word (letters, digits, bytes of other scripts; A-Z in lower case)."""
    starts, ends, row = word_spans(_LETTER[data], offsets)
    return row, span_hashes(LOWER[data], starts, ends)


@dataclass
class Model:
    words: np.ndarray     # sorted hashes
    weights: np.ndarray
    bias: float

    def score(self, row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        """The sigmoid of bias and the weights of the distinct known words of each of n rows."""
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            known = self.words[at] == h
            pair = np.unique(row[known].astype(np.int64) * len(self.words) + at[known])
            f = np.bincount(pair // len(self.words), self.weights[pair % len(self.words)], minlength=n)
        else:
            f = np.zeros(n)
        return 1 / (1 + np.exp(-np.clip(f + self.bias, -700, 700)))


def train(words: np.ndarray, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = STEPS,
          rate: float = RATE, decay: float = DECAY) -> Model:
    """The non-negative risk by Adam over both whole samples (lists of distinct word hashes), on the sorted ``words``."""
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    if not positive or not unlabelled or not len(words):
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))

    def sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        row, h = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        known = words[at] == h
        return row[known], at[known], len(rows)

    sets = [sparse(positive), sparse(unlabelled)]
    w, b = np.zeros(len(words)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    sigmoid = lambda f: 1 / (1 + np.exp(-np.clip(f, -50, 50)))
    for t in range(1, steps + 1):
        (pr, pc, pn), (ur, uc, un) = sets
        fp, fu = np.bincount(pr, w[pc], pn) + b, np.bincount(ur, w[uc], un) + b
        # slopes by f of l(f) and l(-f), l(f) = log(1 + exp(-f))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if negative >= 0:
            gp, gu = prior * (-sigmoid(-fp) - sigmoid(fp)) / pn, sigmoid(fu) / un
        else:
            gp, gu = prior * sigmoid(fp) / pn, -sigmoid(fu) / un
        g = np.append(np.bincount(pc, gp[pr], len(words)) + np.bincount(uc, gu[ur], len(words)) + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(words, w, float(b))


def _sampled_words(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, p, u (whether it is in either sample) and the distinct word hashes of each sampled document.

    ``sample`` is bounded by the sample sizes, and so is its broadcast.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            row, h = words_of(*text_buffer(batch.column("text")))
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            out = [np.unique(h[a:b]).view(np.int64) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "words"])

    found = (texts(docs).join(F.broadcast(sample), "doc_id", "left_semi").mapInArrow(run, "doc_id long, words array<long>")
             .groupBy("doc_id").agg(F.min("words").alias("words")))
    return stored(found.join(F.broadcast(sample), "doc_id"), "sample")


def telling_words(sampled: DataFrame) -> np.ndarray:
    """Words whose shares of documents in the two samples differ by ``LEAST_Z`` standard errors, the most telling
    ``WORDS`` of them, sorted. Words that tell nothing would let the model learn its samples by heart."""
    pn, un = (max(x or 0, 1) for x in sampled.agg(F.sum("p"), F.sum("u")).first())
    both = (F.col("p") + F.col("u")) / (pn + un)
    z = F.abs(F.col("p") / pn - F.col("u") / un) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / pn + 1 / un))
    rows = (sampled.select(F.explode("words").alias("word"), "p", "u").groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
            .where(F.col("p") + F.col("u") >= LEAST_DOCS).withColumn("z", z).where(F.col("z") >= LEAST_Z)
            .orderBy(F.desc("z"), "word").limit(WORDS).select("word").collect())
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _telling_only(sampled: DataFrame, words: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The telling words of each document of both samples: what the driver trains on."""
    shipped = sampled.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.intersect1d(np.array(w, np.int64).view(np.uint64), shipped.value).view(np.int64) for w in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "p", "u")] + [pa.array(kept, pa.list_(pa.int64()))],
                                             ["doc_id", "p", "u", "words"])

    rows = sampled.select("doc_id", "p", "u", "words").mapInArrow(run, "doc_id long, p int, u int, words array<long>").orderBy("doc_id").collect()
    return tuple([np.array(r["words"], np.int64).view(np.uint64) for r in rows if r[c]] for c in ("p", "u"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held: int = HELD,
        positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """The model from the rows outside the held-out fold."""
    train_rows = lambda df: df.where(F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), folds) != held))
    y = (train_rows(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")))
         .where(F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y")))
    share, n = y.agg(F.coalesce(F.avg("y"), F.lit(0.0)), F.count("*")).first()
    prior = share + 1.96 * (share * (1 - share) / max(n, 1)) ** 0.5
    ids = train_rows(texts(docs).select("doc_id")).distinct()
    first = lambda df, n, seed: [r[0] for r in df.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n).collect()]
    p, u = first(y.where("y = 1").select("doc_id"), positives, 1), first(ids, unlabelled, 2)
    spark = docs.sparkSession
    in_p, in_u = set(p), set(u)
    sampled = _sampled_words(docs, spark.createDataFrame([(i, int(i in in_p), int(i in in_u)) for i in sorted(in_p | in_u)],
                                                         "doc_id long, p int, u int"))
    words = telling_words(sampled)
    return train(words, *_telling_only(sampled, words), prior)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; a text without words gets the bias alone."""
    shipped = importable(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            s = shipped.value.score(*words_of(*text_buffer(batch.column("text"))), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (crc_fold(F.col("doc_id"), folds) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score, predicted.

    A null or empty text gets the score of no words. Of a document labelled
    twice the larger label counts. Without positives or documents the score
    is the prior. Repeated rows and null ids give a row each; null ids are never
    learnt from. Other columns are not read.
    """
    return score_documents(docs, fit(docs, labels))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
