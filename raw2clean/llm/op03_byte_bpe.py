"""Byte-level BPE by a tree reduction over a monoid of token sequences.

The elements are encoded byte strings, the product of two is the encoding of
their concatenation. A pre-token is cut into halves down to short leaves;
neighbours are joined by re-encoding a window at their border, which grows
until its first and last tokens are those that stood there before. Then every
pair of adjacent tokens in the result is stable: it lies in one half, or in
the window, whose own encoding has it. A sequence all of whose adjacent pairs
are stable is the encoding of its bytes (the first merge across a border would
also show in the encoding of that pair alone), so the join is exact.
Decoding concatenates bytes up the same tree.

Pre-tokens (matches of the pattern) are encoded separately; a worker keeps
the encodings of those it met in two generations of ``CACHE_BYTES`` each. When
the younger is full, it becomes the older, whose pre-tokens stay known only if they are met again.
"""

from __future__ import annotations

import hashlib
import heapq
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from raw2clean.llm.common import chunks, importable, read, texts, trim

RANKS = "byte_bpe_50k.tiktoken"
LEAF = 32            # bytes that are encoded without a further cut
CACHE_BYTES = 12_000_000   # of pre-tokens and ids that a worker keeps, in each of two generations
ENTRY = 180          # bytes that Python's objects of an entry take besides
CACHED = 64          # characters of the longest pre-token kept


class BytePairs:
    """Encoder and decoder over a table of ranks {bytes: id}."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.singles = [ranks[bytes([i])] for i in range(256)]

    def merge(self, data: bytes) -> list[int]:
        """Merges of the lowest rank first, leftmost first, from single bytes."""
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) > 2 * LEAF:
            return self._merge_long(data)
        get, cuts = self.ranks.get, list(range(len(data) + 1))
        pair = [get(data[i:i + 2], 1 << 60) for i in range(len(data) - 1)]
        while pair:
            best = min(pair)
            if best == 1 << 60:
                break
            i = pair.index(best)
            del cuts[i + 1], pair[i]
            if i < len(pair):
                pair[i] = get(data[cuts[i]:cuts[i + 2]], 1 << 60)
            if i:
                pair[i - 1] = get(data[cuts[i - 1]:cuts[i + 1]], 1 << 60)
        return [self.ranks[data[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same merges with a heap, for windows that have grown long."""
        get, n = self.ranks.get, len(data)
        ends, prev = list(range(1, n + 1)), list(range(-1, n - 1))  # of the token that starts at i; 0: no such token
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            mid = ends[i]
            if mid == 0 or mid >= n or ends[mid] != end:
                continue
            ends[i], ends[mid] = end, 0
            if end < n:
                prev[end] = i
                if (r := get(data[i:ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end]))
            if (p := prev[i]) >= 0 and (r := get(data[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        return [self.ranks[data[i:e]] for i, e in enumerate(ends) if e]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both, from the encodings of each."""
        if not left or not right:
            return left or right
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = self.merge(self.decode(left[-a:]) + self.decode(right[:b]))
            left_held = a == len(left) or window[0] == left[-a]
            right_held = b == len(right) or window[-1] == right[b - 1]
            if left_held and right_held:
                return left[:-a] + window + right[b:]
            a, b = a if left_held else 2 * a, b if right_held else 2 * b

    def encode(self, data: bytes) -> list[int]:
        """The ids of one pre-token's bytes."""
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode(data[:half]), self.encode(data[half:]))

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids, concatenated up the tree."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def load_ranks(path: str) -> dict[bytes, int]:
    import base64
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def little_endian(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit integers, the lowest byte first."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Worker:
    """A pattern, an encoder and the ids of pre-tokens met, as little-endian bytes."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.pairs, self.find = BytePairs(load_ranks(path)), regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0    # of the younger generation, in bytes

    def forget(self) -> None:
        """Give the generations up at a task's end: idle workers share their executor's memory with later stages."""
        self.young, self.old, self.size = {}, {}, 0
        trim()

    def packed(self, token: str) -> bytes:
        """The ids of a pre-token that the younger generation doesn't have."""
        ids = self.old.get(token)
        if ids is None:
            ids = little_endian(self.pairs.encode(token.encode()))
        if len(token) <= CACHED:
            if self.size >= CACHE_BYTES:
                self.young, self.old, self.size = {}, self.young, 0
            self.young[token] = ids
            self.size += len(token) + len(ids) + ENTRY
        return ids

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        packed, out = self.packed, []
        tokens = self.find(text)
        for k in range(0, len(tokens), 4096):     # a generation may change between
            get = self.young.get
            out += [get(t) or packed(t) for t in tokens[k:k + 4096]]
        return b"".join(out)


_WORKERS: dict[tuple[str, str], Worker] = {}


def worker_for(path: str, pattern: str) -> Worker:
    if (path, pattern) not in _WORKERS:
        _WORKERS[path, pattern] = Worker(path, pattern)
    return _WORKERS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Every whole text as ids: doc_id, ids (binary, little-endian unsigned 32-bit).

    One row out per row in, repeated rows and null ids too; a null or empty
    text has no ids. Other columns are not read.
    """
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = worker_for(path, pattern)
        for batch in chunks(batches):
            ids = [w.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])
        w.forget()

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the text's bytes again (binary); null ids decode to none."""
    importable(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = worker_for(path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                out = [w.pairs.decode(np.frombuffer(i or b"", "<u4").tolist()) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(out, pa.binary())],
                                                 ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The digest of encoding and decoding: doc_id, n_tokens, ids_sha256, decoded_sha256.

    What ``decode_documents(encode_documents(docs))`` holds, in one pass that lets neither ids nor bytes leave the task.
    """
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = worker_for(path, pattern)
        for batch in chunks(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                ids = w.encode(text)
                decoded = w.pairs.decode(np.frombuffer(ids, "<u4").tolist())
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            n, encoded, decoded = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(encoded), pa.array(decoded)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        w.forget()

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
