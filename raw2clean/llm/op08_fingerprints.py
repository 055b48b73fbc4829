"""Context-triggered piecewise hashing of whole texts.

A rolling hash over the last seven bytes marks a chunk border wherever its
value is -1 modulo the block size, so borders depend on the text around them and an
edit moves only those nearby. Each chunk gives one letter of the signature.
The block size is the largest that leaves ``LENGTH`` borders; a fingerprint holds
the signatures at that size and at twice that size. Two fingerprints are compared
by the edit distance of signatures at equal block sizes.

The next document's text is needed beside each text. Rows are ranged by
doc_id and sorted, which moves each text once; a task sees its documents in
order, and only the first and last of each partition are joined across tasks (two
rows a partition).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raw2clean.llm.common import chunks, importable, mix, read, span_hashes, stored, texts

#: Fixed value: the letters of a signature.
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
WINDOW = 7           # bytes of the rolling hash
LEAST_BLOCK = 4      # the smallest block size
LENGTH = 32          # borders that a block size leaves at least, unless it is the smallest
PREFIX = 256         # characters of the text that range rows of one id


def rolling(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte of a buffer, of that byte and the six before."""
    h = np.zeros(len(data), np.uint32)
    wide = data.astype(np.uint32)
    for k in range(min(WINDOW, len(data))):
        h[k:] ^= (wide[:len(wide) - k] + np.uint32(1)) * np.uint32(0x9E3779B1) >> np.uint32(3 * k)
        h[k:] *= np.uint32(1 + 2 * (k == WINDOW - 1))
    return h


def _signature(values: np.ndarray, cuts: np.ndarray) -> str:
    ends = np.append(cuts, len(values)) if not len(cuts) or cuts[-1] < len(values) else cuts
    starts = np.concatenate(([0], ends[:-1]))
    return LETTERS[(span_hashes(values, starts, ends) >> np.uint64(58)).astype(np.intp)].tobytes().decode()


def fingerprint(text: str) -> str:
    """``size:signature:signature at twice the size``; ``LEAST_BLOCK::`` for the empty text."""
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) == 0:
        return f"{LEAST_BLOCK}::"
    # the window begins anew with the text: the first bytes are hashed as if after zeros
    h = mix(rolling(data).astype(np.uint64))
    size = LEAST_BLOCK
    cuts = np.flatnonzero((h & np.uint64(size - 1)) == size - 1) + 1
    while len(twice := cuts[(h[cuts - 1] & np.uint64(2 * size - 1)) == 2 * size - 1]) >= LENGTH:
        size, cuts = 2 * size, twice
    values = data.astype(np.uint64) + np.uint64(1)
    return f"{size}:{_signature(values, cuts)}:{_signature(values, twice)}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a column of the table at a time in the bits of an integer."""
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    plus, minus = full, 0
    for y in b:
        eq = at.get(y, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        score += 1 if up & top else -1 if down & top else 0
        up = (up << 1 | 1) & full
        down = down << 1 & full
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
    return score


def _alike(a: str, b: str) -> float:
    return 1.0 if a == b else 1.0 - edit_distance(a, b) / max(len(a), len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1: the best over the block sizes that two fingerprints share; 1 for equal ones, 0 without a common size."""
    if a == b:
        return 1.0
    (m, a1, a2), (n, b1, b2) = a.split(":"), b.split(":")
    pairs = ([(a1, b1), (a2, b2)] if m == n else [(a2, b1)] if 2 * int(m) == int(n) else
             [(a1, b2)] if int(m) == 2 * int(n) else [])
    return max((_alike(x, y) for x, y in pairs), default=0.0)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _row(doc_id: int | None, text: str, print_: str, following: str, next_print: str) -> tuple:
    import hashlib
    changed = edited(text, following)
    other = fingerprint(changed) if changed != text else print_
    return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), print_, other,
            likeness(print_, other), likeness(print_, next_print))


def _record(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = zip(*rows, strict=True) if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _NAMES)


def _docs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for batch in chunks(batches):
        yield from zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)


def fingerprints(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are taken by ascending doc_id, nulls first, ties by text; the
    last one's next is the first (a single document's next is itself). A null
    or empty text is the empty one, whose fingerprint has no letters. Each row gives a row; other columns are not read.
    """
    spark = importable(docs.sparkSession)
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # the seam columns are null in all rows but a partition's first (its head) and last (its tail)
    schema = f"{_OUT}, at int, head string, tail string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        at = TaskContext.get().partitionId()
        done: list[tuple] = []
        first = last = None

        def out(rows: list[tuple], head: str | None = None, tail: str | None = None) -> pa.RecordBatch:
            b = _record(rows)
            same = lambda v, kind: pa.array([v] * len(rows), kind)
            return pa.RecordBatch.from_arrays([*b.columns, same(at, pa.int32()), same(head, pa.string()), same(tail, pa.string())],
                                              [*_NAMES, "at", "head", "tail"])

        for doc_id, text in _docs(batches):
            print_ = fingerprint(text)
            if last is None:
                first = text
            else:
                done.append(_row(*last, text, print_))
            last = (doc_id, text, print_)
            if len(done) == 512:
                yield out(done)
                done = []
        if done:
            yield out(done)
        if last is not None:
            yield out([(last[0], None, None, last[2], None, None, None)], first, last[1])

    # the text's beginning spreads the rows of one id, those without an id too
    ranged = texts(docs).repartitionByRange(n, "doc_id", F.substring("text", 1, PREFIX)).sortWithinPartitions("doc_id", "text")
    walked = stored(ranged.mapInArrow(walk, schema), "fingerprints")
    seams = walked.where("head is not null")   # one row for each partition that has documents
    order = Window.orderBy("at")
    closed = (seams.withColumn("following", F.coalesce(F.lead("head").over(order), F.first("head").over(order)))
              .select("doc_id", F.col("tail").alias("text"), "following").repartition(n))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield _record([_row(i, t, fingerprint(t), f, fingerprint(f)) for i, t, f in
                           zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True)])

    return walked.where("head is null").select(*_NAMES).unionByName(closed.mapInArrow(close, _OUT))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))
