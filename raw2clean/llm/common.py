"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Text handed to Python at once, in bytes: what one task holds beside its Arrow batch.
CHUNK_BYTES = 500_000

_LIBC = ctypes.CDLL(None)


#: Rows handed to Python at once: Spark's default of 10,000 whole texts is some 40 MB on both sides of every task.
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000")


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session import this package from its checkout, and give
    them smaller batches, unless the session has a batch size of its own."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH")]))
    key, default, ours = BATCH_ROWS
    if spark.conf.get(key) == default:
        spark.conf.set(key, ours)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, a null text as the empty one: other columns can't clash."""
    importable(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def text_key(text: str | Column) -> Column:
    """128 bits that stand for a text; a null one is the empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")))


def as_struct(docs: DataFrame) -> Column:
    """All columns of ``docs`` in one struct, out of the way of the names that an operator adds."""
    return F.struct(*[docs["`" + c.replace("`", "``") + "`"].alias(c) for c in docs.columns])


def crc_fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod ``n`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; one of our own only in a local session without it."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="raw2clean-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends, its size is known to the planner."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and the offsets of its rows (one more than rows)."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def trim() -> None:
    """Give freed memory back to the system at a task's end: workers stay, and share their executor's limit with later stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):   # glibc
        _LIBC.malloc_trim(0)


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in their text column (a longer text alone); trims at the end."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(text_buffer(batch.column("text"))[1])
        groups = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
    trim()


# -- vectorised word hashes ------------------------------------------------

_R = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i modulo 2**64 for i < n."""
    have = _POWERS.get("r", np.zeros(0, np.uint64))
    if len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        inv = np.uint64(pow(int(_R), -1, 1 << 64))
        for key, base in (("r", _R), ("i", inv)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["r"], _POWERS["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span values[start:end] (values > 0, as uint8): a polynomial, mixed."""
    r, i = _powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * r[:len(values)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * i[starts] + (ends - starts).astype(np.uint64) * _R)


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of the runs of word bytes; a run never crosses a row's border."""
    if len(is_word) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    border = np.zeros(len(is_word) + 1, bool)
    border[offsets] = True
    before = np.concatenate(([False], is_word[:-1])) & ~border[:-1]
    after = np.concatenate((is_word[1:], [False])) & ~border[1:]
    starts = np.flatnonzero(is_word & ~before)
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
