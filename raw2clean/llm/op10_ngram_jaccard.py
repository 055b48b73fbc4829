"""N-gram Jaccard join: a blocked sparse matrix product of document by n-gram incidence.

Rows of the incidence matrix are the distinct n-gram sets (64-bit hashes;
documents with equal sets are one row, known by a 128-bit hash of the set), columns
the n-grams. The overlaps of all pairs are the product of the matrix with its
transpose; what is computed of it are the blocks that can hold a link:

* Sizes fall into classes so wide that two sets that link lie in the same class or
  in neighbours; a window is a class and the next. A window's sets link
  only if they differ in at most d n-grams, its bound. Each set is cut into more than
  d parts by a hash of its n-grams: a differing n-gram spoils one part, so
  sets that link have equal parts. Sets with an equal part are candidates.
  A part without any n-gram of its own (empty, or only n-grams frequent in
  the corpus, of which a bounded table is kept) counts only for sets with many such
  parts, as any others that link agree in another part as well.
* A task ties sets that share a signature on the spot, and sends each
  signature once, with the first of the sets tied to the one that has it. So a
  signature arrives once a task, however many sets share it.
* Candidates that hang together form a component; each set goes on once, to the
  block of its component. Sets without candidates go no further.
* Components of many sets are cut into parts; a block is one part or two, so no task
  holds more. First come each part by itself and with the next, blocks that grow as the sets do. Where a
  component doesn't hang together by what they link, it is cut anew, so that a part holds sets of
  one group that does or of small groups, and pairs of parts follow, but for those of one group.
* In a block, columns with equal entries are one weighted column. Overlaps
  accumulate over slices of columns; after each slice, pairs whose count and
  remaining columns can't reach the bound of their sizes are discarded.

A block returns a spanning forest of its links, fewer edges than sets, so a
group of near copies never becomes all its pairs. Components of these edges,
with the copies put back, are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import LOWER, SPACE, chunks, importable, mix, read, span_hashes, stored, text_buffer, text_key, texts, trim, word_spans
from raw2clean.llm.components import connected_components

WIDTH, PERCENT = 4, 85
FREQUENT = 65_536          # entries of the table of frequent n-grams
FREQUENT_OUT = 8_192       # of them, from one task at most
HELD = 1_500_000           # n-grams or signatures a task holds before it counts or sends them
PART_SETS, PART_GRAMS = 256, 2_000_000   # of a part of a large component
SLICE = 4096               # columns of a slice


def ngram_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; of fewer words, the hash of the whole sequence."""
    n = len(offsets) - 1
    starts, ends, of = word_spans(~SPACE[data], offsets)
    h = span_hashes(LOWER[data] + np.uint8(1), starts, ends)   # no UTF-8 text holds the byte 255
    cuts = np.searchsorted(of, np.arange(n + 1))
    count = np.diff(cuts)
    grams = np.full(max(len(h) - width + 1, 0), width, np.uint64)
    for k in range(width):
        grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(grams)])
    out = []
    for a, c in zip(cuts.tolist(), count.tolist(), strict=False):
        if c >= width:
            out.append(np.unique(grams[a:a + c - width + 1]))
        elif c:
            whole = np.array([c], np.uint64)
            for k in range(c):
                whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + h[a + k])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def size_classes(percent: int, top: int) -> list[int]:
    """Borders of the classes up to ``top``: sets that link lie in one class or in neighbours."""
    borders = [1]
    while borders[-1] <= top:
        borders.append(max(borders[-1] + 1, 100 * (borders[-1] - 1) // percent + 1))
    return [*borders, borders[-1] + 1, 100 * borders[-1] // percent + 2]


def window_parts(percent: int, borders: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each window (class k and k + 1): the most n-grams in which sets that link differ, and its number of parts."""
    k = np.arange(len(borders) - 2)
    most = np.array(borders)[k + 1] + np.array(borders)[k + 2] - 2          # of the sizes of both sets together
    differ = (100 - percent) * most // (100 + percent)
    return differ, differ + 3 + differ // 20


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in chunks(batches):
        yield batch, ngram_sets(*text_buffer(batch.column("text")), width)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """Arrays of hashes as a column of lists of longs."""
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def frequent_ngrams(docs: DataFrame, width: int) -> np.ndarray:
    """The most frequent n-grams of all documents, sorted.

    A task counts all its n-grams, ``HELD`` at a time, and keeps the most
    frequent of what it has seen; any table gives the same links, a good one fewer candidates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts, waiting, held = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def counted(keep: int) -> tuple[np.ndarray, np.ndarray]:
            g, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *waiting]), return_counts=True)
            both, at = np.unique(np.concatenate([grams, g]), return_inverse=True)
            total = np.bincount(at, np.concatenate([counts, c]), minlength=len(both)).astype(np.int64)
            top = np.flatnonzero(total >= 3)
            top = np.sort(top[np.argsort(-total[top], kind="stable")[:keep]])
            return both[top], total[top]

        for _, sets in _sets(batches, width):
            waiting += sets
            held += sum(map(len, sets))
            if held >= HELD:
                grams, counts = counted(4 * FREQUENT)
                waiting, held = [], 0
        grams, counts = counted(FREQUENT_OUT)
        yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts)], ["g", "n"])

    rows = (texts(docs).select("text").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "g").limit(FREQUENT).collect())
    return np.sort(np.array([r["g"] for r in rows], np.int64).view(np.uint64))


class Parts:
    """The signatures of the parts of many sets at once."""

    def __init__(self, frequent: np.ndarray, percent: int):
        self.frequent, self.percent = frequent, percent
        self.borders = size_classes(percent, 1 << 32)
        self.differ, self.parts = window_parts(percent, self.borders)

    def signatures(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The signatures, and the number of the set that each belongs to."""
        n = np.array([len(s) for s in sets], np.int64)
        grams = np.concatenate([np.zeros(0, np.uint64), *sets])
        own = np.ones(len(grams), bool)
        if len(self.frequent) and len(grams):
            at = np.minimum(np.searchsorted(self.frequent, grams), len(self.frequent) - 1)
            own = self.frequent[at] != grams
        row = np.repeat(np.arange(len(sets)), n)
        of_class = np.searchsorted(self.borders, n, side="right") - 1
        out, of = [], []
        for window in (of_class, of_class - 1):
            # sets of a window without room to differ link only if they are equal: they are one row already
            used = (window >= 0) & (n > 0)
            used[used] = self.differ[window[used]] > 0
            m = np.where(used, self.parts[np.maximum(window, 0)], 0)
            base = np.cumsum(m) - m
            total = int(m.sum())
            if not total:
                continue
            inside = used[row]
            g, r = grams[inside], row[inside]
            part = base[r] + (g % m[r].astype(np.uint64)).astype(np.int64)
            low = np.bincount(part, (g & np.uint64(0xFFFFFFFF)).astype(float), minlength=total)
            high = np.bincount(part, (g >> np.uint64(32)).astype(float), minlength=total)
            vacuous = np.bincount(part, own[inside], minlength=total) == 0
            owner = np.repeat(np.arange(len(sets)), m)
            many = np.bincount(owner, vacuous, minlength=len(sets)) >= m - self.differ[np.maximum(window, 0)]
            kept = ~vacuous | many[owner]
            place = mix(np.repeat(window, m).astype(np.uint64) << np.uint64(32) | (np.arange(total) - np.repeat(base, m)).astype(np.uint64))
            out.append(mix(mix(low.astype(np.uint64) + place) + high.astype(np.uint64))[kept])
            of.append(owner[kept])
        return np.concatenate([np.zeros(0, np.uint64), *out]), np.concatenate([np.zeros(0, np.int64), *of])


def tie(signatures: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each signature once with its smallest set, and the distinct ties (smallest set, other set) within equal ones."""
    order = np.lexsort((sets, signatures))
    signatures, sets = signatures[order], sets[order]
    first = np.ones(len(signatures), bool)
    first[1:] = signatures[1:] != signatures[:-1]
    head = sets[np.maximum.accumulate(np.where(first, np.arange(len(sets)), 0))] if len(sets) else sets
    ties = np.unique(np.stack([head, sets], axis=1)[head != sets], axis=0)
    return signatures[first], sets[first], ties


def packed(values: np.ndarray) -> bytes:
    """64-bit numbers by byte planes: planes of equal bytes shrink to nothing in shuffles and files."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(planes: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(kind).ravel()


def forest_of(ties: np.ndarray) -> np.ndarray:
    """A star for each component of the ties: (its smallest set, another of its sets), sorted by the other."""
    ids, at = np.unique(ties, return_inverse=True)
    a, b = at.reshape(-1, 2).T
    label = np.arange(len(ids))
    while True:
        new, least = label.copy(), np.minimum(label[a], label[b])
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            other = label != np.arange(len(ids))
            return np.stack([ids[label[other]], ids[other]], axis=1)
        label = new


_TABLE = "uid long, doc_id long, text_key binary, n long, key binary, bucket int, signatures binary, sets binary, ties array<long>"


def _part_table(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """Rows of documents (uid, doc_id, text_key, n, key), of signatures by bucket with their sets' uids, and of ties found in a task."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_ngrams(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        parts, uid = Parts(frequent.value, percent), TaskContext.get().partitionId() << 36
        found, of, held = [], [], 0

        def record(many_rows: int, /, **columns: pa.Array) -> pa.RecordBatch:
            kinds = {"uid": pa.int64(), "doc_id": pa.int64(), "text_key": pa.binary(), "n": pa.int64(), "key": pa.binary(), "bucket": pa.int32(),
                     "signatures": pa.binary(), "sets": pa.binary(), "ties": pa.list_(pa.int64())}
            return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(many_rows, k) for c, k in kinds.items()], list(kinds))

        def sent() -> Iterator[pa.RecordBatch]:
            signatures, sets, ties = tie(np.concatenate([np.zeros(0, np.uint64), *found]), np.concatenate([np.zeros(0, np.int64), *of]))
            if len(ties := forest_of(ties)):   # sets tied here are one from now on: the first of them stands for all
                at = np.minimum(np.searchsorted(ties[:, 1], sets), len(ties) - 1)
                sets = np.where(ties[at, 1] == sets, ties[at, 0], sets)
            bucket = (signatures >> np.uint64(40)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            spans = [(b, order[i:j]) for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)) if i < j]
            yield record(len(spans), bucket=pa.array([b for b, _ in spans], pa.int32()),
                         signatures=pa.array([packed(np.diff(signatures[x], prepend=np.uint64(0))) for _, x in spans], pa.binary()),   # they ascend
                         sets=pa.array([packed(sets[x]) for _, x in spans], pa.binary()))
            for k in range(0, len(ties), 10_000):
                yield record(1, ties=pa.array([ties[k:k + 10_000].ravel().tolist()], pa.list_(pa.int64())))

        for batch, sets in _sets(batches, width):
            rows = np.arange(uid, uid + len(sets))
            uid += len(sets)
            yield record(len(sets), uid=pa.array(rows), doc_id=batch.column("doc_id"), text_key=batch.column("text_key"),
                         n=pa.array([len(s) for s in sets], pa.int64()), key=pa.array([set_key(s) for s in sets], pa.binary()))
            signatures, owner = parts.signatures(sets)
            found.append(signatures)
            of.append(rows[owner])
            held += len(signatures)
            if held >= HELD:
                yield from sent()
                found, of, held = [], [], 0
        yield from sent()

    return texts(docs).withColumn("text_key", text_key("text")).mapInArrow(run, _TABLE)


def _tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ties of a partition's buckets, sorted by bucket: sets of different tasks that share a signature.

    One bucket is held at a time, and a forest of the ties so far.
    """
    each = lambda rows, c, kind: [unpacked(x, kind) for r in rows for x in r.column(c).to_pylist()]
    ties, bucket, rows = np.zeros((0, 2), np.int64), None, []

    def with_bucket() -> np.ndarray:
        if not rows:
            return ties
        signatures = np.concatenate([np.cumsum(d, dtype=np.uint64) for d in each(rows, "signatures", np.uint64)])
        return forest_of(np.concatenate([ties, tie(signatures, np.concatenate(each(rows, "sets", np.int64)))[2]]))

    for batch in batches:
        of = np.asarray(batch.column("bucket"))
        cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b and of[a] != bucket:
                ties, bucket, rows = with_bucket(), of[a], []
            rows.append(batch.slice(a, b - a))
    ties = with_bucket()
    trim()
    yield pa.RecordBatch.from_arrays([pa.array(ties[:, 0]), pa.array(ties[:, 1])], ["u", "v"])


def linked_pairs(sets: list[np.ndarray], part: np.ndarray, percent: int) -> np.ndarray:
    """Whether each pair of sets of a block links: of two parts, pairs across them; of one, all."""
    rows, n = len(sets), np.array([len(s) for s in sets], np.int64)
    low, high = np.minimum.outer(n, n), np.maximum.outer(n, n)
    alive = (100 * low >= percent * high) & ~np.eye(rows, dtype=bool)
    if len(np.unique(part)) == 2:
        alive &= part[:, None] != part[None, :]
    need = percent * np.add.outer(n, n)          # (100 + percent) * overlap must reach it
    grams, row = np.concatenate(sets), np.repeat(np.arange(rows), n)
    order = np.argsort(grams, kind="stable")
    grams, row = grams[order], row[order]
    starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    width = np.diff(np.append(starts, len(grams)))
    # columns with equal entries: a sum of random numbers of their rows, one column with a weight for each sum
    label = np.add.reduceat(mix(row.astype(np.uint64) + np.uint64(1)), starts)
    label[width == 1] = 0                        # an n-gram of one set adds to no overlap
    _, first, weight = np.unique(label, return_index=True, return_counts=True)
    keep = width[first] > 1
    first, weight = first[keep], weight[keep].astype(np.float64)
    overlap = np.zeros((rows, rows))
    if not len(first):
        return np.zeros((rows, rows), bool)
    lengths = width[first]
    entries = np.repeat(starts[first] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    column, row = np.repeat(np.arange(len(first)), lengths), row[entries]
    left = np.bincount(row, weight[column], minlength=rows)
    for a in range(0, len(first), SLICE):
        lo, hi = np.searchsorted(column, (a, a + SLICE))
        part_of = np.zeros((rows, min(SLICE, len(first) - a)))
        part_of[row[lo:hi], column[lo:hi] - a] = 1
        weighted = part_of * weight[a:a + SLICE]
        overlap += weighted @ part_of.T
        left -= weighted.sum(axis=1)
        alive &= (100 + percent) * (overlap + np.minimum.outer(left, left)) >= need
        if not alive.any():
            break
    return alive & ((100 + percent) * overlap >= need)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links."""
    seen, out = np.zeros(len(linked), bool), []
    for root in range(len(linked)):
        if seen[root]:
            continue
        seen[root], stack = True, [root]
        while stack:
            at = stack.pop()
            new = np.flatnonzero(linked[at] & ~seen)
            seen[new] = True
            out += [(at, int(j)) for j in new]
            stack += new.tolist()
    return out


def _part_counts(sets: DataFrame, *by: str) -> DataFrame:
    """The number of parts for the sets of each group."""
    return sets.groupBy(*by).agg(F.greatest(F.ceil(F.count("*") / PART_SETS), F.ceil(F.sum("n") / PART_GRAMS)).cast("int").alias("parts"))


def _by_group(sets: DataFrame) -> DataFrame:
    """The sets of components that don't hang together (key, c, n, doc_id, label), cut into parts anew: a group
    (equal label) that would fill a part has parts of its own, named in ``pure``; the smaller ones share parts."""
    own = sets.groupBy("c", "label").agg(F.count("*").alias("m"), F.sum("n").alias("grams"))
    pure = own.where((F.col("m") >= PART_SETS) | (F.col("grams") >= PART_GRAMS)).select("c", "label", F.col("label").alias("pure"))
    named = sets.join(pure, ["c", "label"], "left").withColumn("pool", F.coalesce(F.hex("pure"), F.lit("")))
    return (named.join(_part_counts(named, "c", "pool"), ["c", "pool"])
            .withColumn("part", F.concat_ws(":", "pool", F.pmod(F.xxhash64("key"), F.col("parts")).cast("string")))
            .select("key", "doc_id", "c", "part", "pure"))


def _open_blocks(rest: DataFrame) -> DataFrame:
    """(c, a, b, part) for both parts of each pair that may still link: not two of one group; shared parts also with themselves."""
    each = rest.groupBy("c", "part").agg(F.first("pure").alias("pure"))
    x, y = each.alias("x"), each.alias("y")
    pairs = (x.join(y, (F.col("x.c") == F.col("y.c")) & (F.col("x.part") <= F.col("y.part"))
                    & (F.col("x.pure").isNull() | F.col("y.pure").isNull() | (F.col("x.pure") != F.col("y.pure"))))
             .select("x.c", F.col("x.part").alias("a"), F.col("y.part").alias("b")))
    return pairs.withColumn("part", F.explode(F.array_distinct(F.array("a", "b"))))


def link_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    Two documents link when ``100 * intersection >= percent * union`` of
    their n-gram sets; a component's id is its smallest doc_id. A document
    without words (null or empty text) has no set and links with nothing: its
    component is itself. Rows that repeat an id with another text are
    documents of their own, known by their sets. A null id never names a
    component unless all its ids are null. Other columns are not read; an
    empty table gives no rows.
    """
    return link_rows(docs, width, percent).select("doc_id", "n_shingles", "component_id")


def link_rows(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``link_documents`` with text_key, and component: the key of a set of the row's
    component, the same for all its rows whatever their ids; null for a row without words."""
    spark = importable(docs.sparkSession)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored_parts = stored(_part_table(docs, width, percent, buckets), "parts-of-sets")
    table = stored_parts.where("uid is not null").select("uid", "doc_id", "text_key", "n", "key")
    sets = table.where("key is not null")

    # candidates: sets that share a part. Only the first set of each star found in a task takes part in the
    # search for components; the others follow it, so a group of copies weighs no more than the tasks that met it.
    stars = stored_parts.where("ties is not null").select(F.explode(F.transform(
        F.sequence(F.lit(0), F.size("ties") - 2, F.lit(2)), lambda i: F.struct(F.get("ties", i).alias("lead"), F.get("ties", i + 1).alias("uid")))).alias("t")).select("t.*")
    tied = (stored_parts.where("bucket is not null").select("bucket", "signatures", "sets")
            .repartition(buckets // 4, "bucket").sortWithinPartitions("bucket").mapInArrow(_tied, "u long, v long"))
    labels = stored(connected_components(tied).select(F.col("node").alias("lead"), "label"), "candidates")
    near = (stars.join(labels, "lead", "left").select("uid", F.coalesce("label", "lead").alias("c"))
            .unionByName(stars.select("lead").distinct().join(labels, "lead", "left_anti").select(F.col("lead").alias("uid"), F.col("lead").alias("c")))
            .unionByName(labels.select(F.col("lead").alias("uid"), F.col("label").alias("c"))))
    found = sets.join(near, "uid").groupBy("key").agg(F.min("c").alias("c"), F.min("n").alias("n"), F.min("doc_id").alias("doc_id"))
    several = found.groupBy("c").agg(F.count("*").alias("m")).where("m > 1").select("c")   # else copies of one set
    chosen = stored(found.join(several, "c"), "chosen")
    parts = stored(chosen.join(_part_counts(chosen, "c"), "c").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")), "parts")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, grams in _sets(batches, width):
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in grams], pa.binary()), _lists(grams)], ["key", "grams"])

    texts_of = texts(docs)

    def with_grams(placed: DataFrame) -> DataFrame:
        """The sets of ``placed`` (key, doc_id and more), read again from a text that has them."""
        wanted = stored(placed.select(F.col("doc_id").alias("_id")).distinct(), "wanted")
        return (texts_of.join(wanted, texts_of["doc_id"].eqNullSafe(wanted["_id"]), "left_semi")
                .mapInArrow(again, "key binary, grams array<long>").join(placed.drop("doc_id"), "key").dropDuplicates(["key"]))

    def solve(block: pa.Table) -> pa.Table:
        keys = block.column("key").to_pylist()
        lists = block.column("grams").combine_chunks()
        flat, cuts = np.asarray(lists.flatten()).view(np.uint64), np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths()))))
        grams = [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        found = forest(linked_pairs(grams, np.asarray(block.column("part")), percent)) if len(keys) > 1 else []
        if len(keys) > PART_SETS:   # a block of a size worth giving back
            trim()
        return pa.table({"u": pa.array([keys[i] for i, _ in found], pa.binary()), "v": pa.array([keys[j] for _, j in found], pa.binary())})

    def solved(rows: DataFrame) -> DataFrame:
        return rows.groupBy("c", "a", "b").applyInArrow(solve, "u binary, v binary")

    # each part by itself, with the next and with the one before
    side = F.array_distinct(F.array("part", F.pmod(F.col("part") + 1, "parts"), F.pmod(F.col("part") - 1, "parts")))
    rows = (with_grams(parts.select("key", "doc_id", "c", "part", "parts")).withColumn("other", F.explode(side))
            .select("c", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "key", "grams"))
    of = stored(connected_components(solved(rows)).select(F.col("node").alias("key"), "label"), "linked-parts")
    many = parts.where("parts > 3")   # of up to three parts these were all pairs
    if not many.isEmpty():
        groups = many.drop("part", "parts").join(of, "key", "left").withColumn("label", F.coalesce("label", "key"))
        apart = groups.groupBy("c").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("c")
        if not apart.isEmpty():
            rest = stored(_by_group(groups.join(apart, "c", "left_semi")), "apart")
            links = solved(with_grams(rest.select("key", "doc_id", "c", "part")).join(_open_blocks(rest), ["c", "part"])
                           .select("c", "a", "b", "part", "key", "grams"))
            of = connected_components(links.unionByName(of.select(F.col("key").alias("u"), F.col("label").alias("v")))).select(
                F.col("node").alias("key"), "label")

    first = sets.groupBy("key").agg(F.min("doc_id").alias("first"))
    named = first.join(of, "key", "left")
    smallest = named.where("label is not null").groupBy("label").agg(F.min("first").alias("smallest"))
    ids = stored(named.join(smallest, "label", "left").select("key", F.coalesce("label", "key").alias("component"),
                                                                     F.coalesce("smallest", "first").alias("component_id")), "components")
    return (table.select("doc_id", "text_key", "n", "key").join(ids, "key", "left")
            .select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component", F.coalesce("component_id", "doc_id").alias("component_id")))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY 1, 2
"""
