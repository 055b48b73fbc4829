"""Exact top-k search by inner product: a Voronoi join.

Equal vectors are one candidate that carries its k + 1 smallest distinct ids (an
id of several rows up to k times), so a group of copies costs one row. Pivots cut the distinct vectors into Voronoi
cells. A summary of a cell (its radius, and the smallest distances to the pivot with
the rows that stand behind them) bounds every score in it: for a query q and
a vector x of the cell of pivot p,

    <q,p> - |q| d(x,p)  <=  <q,x>  <=  <q,p> + |q| d(x,p).

The lower bounds of all summaries give each query a threshold that its k-th
best score is sure to reach; the query is sent to those cells alone whose
upper bound reaches it. Queries are the smaller side, so they are what is
replicated. Cells are cut into blocks of about ``BLOCK`` vectors; a task reads a
block, then streams the queries sent to it past the block as matrix
products, and keeps k rows for each query and block.

Scores are exact integers: products run in doubles where every sum stays
below 2**53, else in Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raw2clean.llm.common import importable, read, stored

K, EVERY, SCALE = 5, 50, 256
PIVOTS = 64          # cells for each length of vector; pivots are a bounded sample
BLOCK = 2048         # vectors of a block
LONG = (1 << 63) - 1
SLACK = 1e-9         # relative room for rounding in the bounds


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v = floor(scale * x) as doubles; rows null, or with a null or non-finite component, are left out."""
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return x.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        "vec_id", F.transform("v", lambda c: _floor(c * F.lit(float(scale)))).alias("v"))


def _floor(c: Column) -> Column:
    """Floor as a double: values of 2**52 and more are whole already and don't fit a long."""
    return F.when(F.abs(c) < float(1 << 52), F.floor(c).cast("double")).otherwise(c)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if len(column) else pa.array([], pa.float64())
    return np.asarray(flat, np.float64).reshape(len(column), dim)


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as int64; beyond a long, its ends."""
    with np.errstate(over="ignore"):
        top = (np.abs(queries).max(initial=0) * np.abs(data).max(initial=0)) * max(1, queries.shape[1])
    if top < 2.0 ** 53:
        return np.rint(queries @ data.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    exact = whole(queries) @ whole(data).T
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64) if exact.size else exact.astype(np.int64)


class Cells:
    """Pivots of one vector length with the summaries of their cells."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        n = len(pivots)
        self.radius, self.rows = np.full(n, -1.0), np.zeros(n, np.int64)
        self.near: list[list[tuple[float, list[int]]]] = [[] for _ in range(n)]

    def of(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector and the distance to it."""
        with np.errstate(over="ignore"):
            d = np.stack([np.sqrt(np.square(v - p).sum(axis=1)) for p in self.pivots], axis=1)
        cell = d.argmin(axis=1)
        return cell, d[np.arange(len(v)), cell]

    def wanted(self, q: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
        """queries x cells: whether a cell can hold one of the k best of a query, rows of its own id not counted."""
        with np.errstate(all="ignore"):   # components near the largest double: bounds without a value bound nothing
            base, norm = q @ self.pivots.T, np.sqrt(np.square(q).sum(axis=1))[:, None]
            room = SLACK * (np.abs(base).max(initial=0) + norm.max(initial=0) * (1 + self.radius.max(initial=0)))
            which = [c for c, near in enumerate(self.near) for _ in near]
            far = np.array([d for near in self.near for d, _ in near])
            count = np.array([len(ids) for near in self.near for _, ids in near])
            ids = np.array([i for near in self.near for _, of in near for i in of], np.int64)
            # scores end at the ends of a long, and so do the bounds
            low = np.nan_to_num(np.minimum(base[:, which] - norm * far, float(LONG)), nan=-np.inf, neginf=-np.inf)
            high = np.nan_to_num(np.maximum(base + norm * self.radius, float(-LONG - 1)) + room, nan=np.inf, posinf=np.inf)
        order = np.argsort(-low, axis=1, kind="stable")
        # rows of other ids alone: any number of rows may have the query's id
        foreign = count - np.add.reduceat(ids == own[:, None], np.cumsum(count) - count, axis=1, dtype=np.int64)
        reached = np.cumsum(np.take_along_axis(foreign, order, axis=1), axis=1) >= k
        at = np.where(reached.any(axis=1), reached.argmax(axis=1), 0)
        least = np.where(reached.any(axis=1), low[np.arange(len(q)), order[np.arange(len(q)), at]], -np.inf)
        return (high >= least[:, None]) & (self.radius >= 0)


def _cells(distinct: DataFrame, k: int, n_pivots: int) -> dict[int, Cells]:
    """Pivots by a hash order over the distinct vectors of each length, and the summaries of all their cells."""
    dims = Window.partitionBy("dim").orderBy("h", "v")
    picked = (distinct.select(F.size("v").alias("dim"), F.xxhash64("v").alias("h"), "v")
              .withColumn("r", F.row_number().over(dims)).where(F.col("r") <= n_pivots).select("dim", "v").collect())
    by_dim: dict[int, list] = {}
    for r in sorted(picked, key=lambda r: (r["dim"], r["v"])):
        by_dim.setdefault(r["dim"], []).append(r["v"])
    return {dim: Cells(np.array(v, np.float64).reshape(len(v), dim)) for dim, v in by_dim.items()}


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.asarray(batch.column("v").value_lengths())
    for dim in np.unique(sizes):
        yield int(dim), batch.filter(pa.array(sizes == dim))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, n_pivots: int = PIVOTS,
          block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query, ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``; candidates
    are all rows of the same length but the query's own id. Rows with a
    repeated id are candidates each; a repeated query id with another vector
    is answered for each of its vectors (equal ones once). Scores beyond a
    long are its ends, and rank as such. Null ids take no part; other columns are not read.
    """
    spark = importable(vectors.sparkSession)
    rows = quantised(vectors, scale)
    # k + 1 distinct ids of each distinct vector suffice, as one of them may be the query's own, and k rows of each id
    kept = Window.partitionBy("h", "v").orderBy("vec_id")
    distinct = stored(rows.groupBy(F.xxhash64("v").alias("h"), "v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
                      .withColumn("r", F.row_number().over(kept)).where(F.col("r") <= k + 1)
                      .groupBy("h", "v").agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat("vec_id", F.col("n"))))).alias("ids"))
                      .select("v", "ids"), "vectors")
    cells = spark.sparkContext.broadcast(_cells(distinct, k, n_pivots))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                cell, d = cells.value[dim].of(_matrix(part.column("v"), dim))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cell), dim), pa.int32()), pa.array(cell, pa.int32()), pa.array(d), part.column("v"), part.column("ids")],
                    ["dim", "cell", "d", "v", "ids"])

    placed = stored(distinct.mapInArrow(assign, "dim int, cell int, d double, v array<double>, ids array<long>"), "cells")
    near = Window.partitionBy("dim", "cell").orderBy("d")
    known = {dim: c for dim, c in cells.value.items()}
    for r in placed.groupBy("dim", "cell").agg(F.max("d").alias("radius"), F.count("*").alias("n")).collect():
        known[r["dim"]].radius[r["cell"]], known[r["dim"]].rows[r["cell"]] = r["radius"], r["n"]
    for r in (placed.select("dim", "cell", "d", "ids").withColumn("r", F.row_number().over(near))
              .where(F.col("r") <= k + 1).collect()):
        known[r["dim"]].near[r["cell"]].append((r["d"], r["ids"]))
    summaries = spark.sparkContext.broadcast(known)

    def blocks_of(dim: int, cell: int) -> int:
        return -(-int(summaries.value[dim].rows[cell]) // block)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Data to its block, by a hash of its first id."""
        for batch in batches:
            ids = np.asarray(batch.column("ids").flatten())[np.asarray(batch.column("ids").offsets)[:-1] - batch.column("ids").offsets[0].as_py()]
            n = np.array([blocks_of(a, b) for a, b in zip(batch.column("dim").to_pylist(), batch.column("cell").to_pylist(), strict=True)])
            b = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("dim"), batch.column("cell"), pa.array(b, pa.int32()), pa.nulls(len(b), pa.int64()), batch.column("v"), batch.column("ids")],
                ["dim", "cell", "block", "query_id", "v", "ids"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries to the blocks of the cells that they need."""
        for batch in batches:
            for dim, part in _by_dim(batch):
                if dim not in summaries.value:
                    continue
                for s in range(0, part.num_rows, 256):
                    some = part.slice(s, 256)
                    row, cell = np.nonzero(summaries.value[dim].wanted(_matrix(some.column("v"), dim), np.asarray(some.column("vec_id")), k))
                    n = np.array([blocks_of(dim, c) for c in cell], np.int64)
                    row, cell = np.repeat(row, n), np.repeat(cell, n)
                    b = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), dim), pa.int32()), pa.array(cell, pa.int32()), pa.array(b, pa.int32()),
                         some.column("vec_id").take(take), some.column("v").take(take), pa.nulls(len(row), pa.list_(pa.int64()))],
                        ["dim", "cell", "block", "query_id", "v", "ids"])

    schema = "dim int, cell int, block int, query_id long, v array<double>, ids array<long>"
    queries = rows.where(F.col("vec_id") % every == 0).distinct()
    both = placed.mapInArrow(deal, schema).unionByName(queries.mapInArrow(send, schema))
    met = both.repartition("dim", "cell", "block").sortWithinPartitions("dim", "cell", "block", F.col("query_id").asc_nulls_first())

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, data = None, [], None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)) for c in ("dim", "cell", "block")], axis=1)
            is_query = np.asarray(batch.column("query_id").is_valid())
            change = np.any(keys[1:] != keys[:-1], axis=1) | (is_query[1:] != is_query[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                now, part = tuple(keys[a].tolist()), batch.slice(a, b - a)
                if now != key:
                    key, parts, data = now, [], None
                if not is_query[a]:
                    parts.append((_matrix(part.column("v"), now[0]), part.column("ids").to_pylist()))
                    continue
                if data is None:
                    ids = [x for p in parts for i in p[1] for x in i]
                    of = np.repeat(np.arange(sum(len(p[1]) for p in parts)), [len(i) for p in parts for i in p[1]])
                    data = (np.concatenate([p[0] for p in parts]), np.array(ids, np.int64), of) if parts else ()
                if data:
                    for s in range(0, part.num_rows, 256):
                        some = part.slice(s, 256)
                        yield best(np.asarray(some.column("query_id")), _matrix(some.column("v"), now[0]), some.column("v"), *data)

    def best(query_ids: np.ndarray, q: np.ndarray, q_v: pa.Array, x: np.ndarray, ids: np.ndarray, of: np.ndarray) -> pa.RecordBatch:
        scores = products(q, x)
        out: list[tuple[int, int, int]] = []
        for i, own in enumerate(query_ids.tolist()):
            foreign = np.flatnonzero(ids != own)
            s = scores[i][of[foreign]]
            if len(s) > k:   # all that reach the k-th best, ties too
                some = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
            else:
                some = np.arange(len(s))
            theirs = ids[foreign[some]]
            some = some[np.lexsort((theirs, -s[some].astype(object) if s.min(initial=0) == -LONG - 1 else -s[some]))][:k]
            out += [(i, int(ids[foreign[j]]), int(s[j])) for j in some]
        take = pa.array([r[0] for r in out], pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids).take(take), q_v.take(take), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64())],
            ["query_id", "v", "vec_id", "score"])

    found = met.mapInArrow(solve, "query_id long, v array<double>, vec_id long, score long")
    ranked = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
    return (found.select("query_id", F.xxhash64("v").alias("h"), "vec_id", "score")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM x AS q JOIN x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
