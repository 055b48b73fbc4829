"""Token counts: a map-side lookup in two tiers, no pre-token is shuffled.

A text's tokens are the sum over its pre-tokens: a run of blanks with the
word behind it, or a line end. No piece of the vocabulary holds a blank
after another character, and none but the single bytes holds a line end, so no merge
crosses these borders (``PieceLengths`` checks both on loading).

Tier one is a table of the pre-tokens most frequent in the corpus with their
lengths, broadcast; its size is bounded by ``table_size`` entries, each of at
most ``MAX_KEY`` characters. It comes from one pass over all texts in which
each task keeps a Misra-Gries summary of bounded size. Tier two is a worker's
own cache of the misses, emptied when it reaches ``CACHE`` entries. Either
tier only saves work: every miss is encoded by the library.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import chunks, importable, read, text_buffer, texts

TOKENIZER = "piece_bpe_32k.model"
LIMIT = 4096
TABLE_SIZE = 32_768      # entries of the broadcast table
SUMMARY = 65_536         # entries of a task's Misra-Gries summary
SUMMARY_OUT = 8_192      # entries of it that leave the task
MAX_KEY = 64             # characters of a pre-token in the broadcast table
CACHE = 300_000          # entries of a worker's cache
SPLIT = re.compile(r" *[^ \n]+| +|\n+")
BLANK = "▁"


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, after the blank that the library puts before it."""
    return SPLIT.findall(" " + text.replace(BLANK, " ")) if text else []


class PieceLengths:
    """Lengths of pre-tokens by the library; raises if the vocabulary doesn't split as assumed."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        odd = [p for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
               for p in [sp.id_to_piece(i)] if BLANK in p.lstrip(BLANK) or (len(p) > 1 and "\n" in p)]
        if odd or sp.normalize(" a  \n") != "▁▁a▁▁\n":
            raise ValueError(f"the vocabulary has pieces across blanks or line ends: {odd[:3]}")

    def of(self, tokens: list[str]) -> list[int]:
        asked = [t[1:] if t[0] == " " else "\n" + t for t in tokens]
        ids = self.sp.encode(asked, num_threads=1)
        return [len(t) if t[0] == "\n" else 1 if t == " " else len(i) - (0 if t[0] == " " else 2)
                for t, i in zip(tokens, ids, strict=True)]


_LENGTHS: dict[str, PieceLengths] = {}


def lengths_of(path: str) -> PieceLengths:
    if path not in _LENGTHS:
        _LENGTHS[path] = PieceLengths(path)
    return _LENGTHS[path]


def pruned(counts: Counter, size: int) -> Counter:
    """The Misra-Gries step: what the entry after the first ``size`` counts is taken from all."""
    if len(counts) <= size:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    cut = int(np.partition(values, len(values) - size - 1)[len(values) - size - 1])
    return Counter({k: v - cut for k, v in counts.items() if v > cut})


def frequent_pre_tokens(docs: DataFrame, table_size: int = TABLE_SIZE) -> DataFrame:
    """The most frequent pre-tokens of all texts, (token, n); n errs by at most a share
    1/SUMMARY of each task's pre-tokens (ties to the smaller token)."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                counts.update(pre_tokens(text))
            if len(counts) > 4 * SUMMARY:
                counts = pruned(counts, SUMMARY)
        top = sorted(((k, v) for k, v in pruned(counts, SUMMARY).items() if len(k) <= MAX_KEY),
                     key=lambda x: (-x[1], x[0]))[:SUMMARY_OUT]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()),
                                          pa.array([v for _, v in top], pa.int64())], ["token", "n"])

    return (texts(docs).select("text").mapInArrow(summarise, "token string, n long")
            .groupBy("token").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "token").limit(table_size))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, table_size: int = TABLE_SIZE) -> DataFrame:
    """Token counts of every whole text: doc_id, n_bytes, n_tokens, over_limit.

    One row out per row in, repeated rows and null ids too. A null or empty
    text has 0 bytes and 0 tokens. Other columns are not read.
    """
    spark = importable(docs.sparkSession)
    keys = [r["token"] for r in frequent_pre_tokens(docs, table_size).collect()]
    table = spark.sparkContext.broadcast(dict(zip(keys, lengths_of(path).of(keys), strict=True)) if keys else {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, frequent = lengths_of(path), table.value
        cache: dict[str, int] = {}
        for batch in chunks(batches):
            found = [pre_tokens(t) for t in batch.column("text").to_pylist()]
            missed = set().union(*found).difference(frequent)
            if len(cache) + len(missed) > CACHE:
                cache.clear()
            new = [t for t in missed if t not in cache]
            cache.update(zip(new, lengths.of(new), strict=True) if new else ())
            known = frequent | {t: cache[t] for t in missed}
            n = [sum(map(known.__getitem__, f)) for f in found]
            size = np.diff(text_buffer(batch.column("text"))[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
