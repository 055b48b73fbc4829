"""SimHash near-dedup: vantage-point trees over 64-bit fingerprints.

Equal fingerprints are one row. Over all 64 bits, distances of unlike texts lie
so close together that a ball of 4 bits meets most branches of any tree. So
the bits are cut into four blocks: of two fingerprints that differ in at most d bits,
at least two blocks differ in at most ``d // 3`` bits each (three blocks with more would
differ in more than d). Each of the six pairs of blocks has a tree; its
nodes measure the distance of one of both blocks in turn from a vantage point.

* Shards. The upper levels of the trees are fitted on a bounded sample of
  fingerprints (``SAMPLE``; a poor fit makes uneven shards, never other links). Each fingerprint
  has one home shard a tree. It also visits the shards beyond a boundary that its ball
  overlaps, by the triangle bound |d(x, v) - d(y, v)| <= d(x, y); of two shards
  the one that comes later is visited, so each pair meets once a tree.
* Within a shard, trees go on: homes are split by their distance from one of them, those
  who look follow a branch only if the triangle bound lets them. Small rests are
  compared as they are.
* Many alike. Rests that no vantage point splits are fingerprints of one large
  group. There, those equal but for d neighbouring bits are tied first (they
  link for sure), and those that hang together with most others aren't compared among themselves.
* A shard of more than ``PART`` fingerprints is cut into parts, and each pair of parts is a block.

A block returns a forest of its links, fewer edges than fingerprints. Components of
these edges, with the copies put back, are the result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import LOWER, chunks, read, stored, text_buffer, texts, trim
from raw2clean.llm.components import connected_components
from raw2clean.llm.op10_ngram_jaccard import forest_of

WIDTH, DISTANCE, SEED = 4, 4, 42
BLOCKS = [np.uint64(0xFFFF << (16 * k)) for k in range(4)]
TREES = list(combinations(BLOCKS, 2))
SAMPLE, OF_SHARD = 1 << 20, 64      # fingerprints that the shards are fitted on, in all and for a shard
SHARD, LEAST = 32_768, 16  # homes of a shard; of the sample's, below which it isn't split
PART = 1 << 21             # fingerprints of a part of a shard
HELD = 500_000             # places a task holds before it sends them
REST, DENSE = 1 << 16, 1 << 22      # pairs that are compared as they are; pairs from which ties come first
AT_ONCE = 1 << 20          # pairs compared at once
SHINGLES = 65_536          # shingles hashed at once


def simhash(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """A bit is set if more than half of the shingles' XXH64 have it; without words, 0."""
    import xxhash
    words = text.translate(LOWER.tobytes()).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts, ends = np.concatenate(([0], ends[:-1] + 1))[:max(len(words) - width + 1, 1)], ends[min(width, len(words)) - 1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), SHINGLES):
        spans = zip(starts[k:k + SHINGLES].tolist(), ends[k:k + SHINGLES].tolist(), strict=True)
        h = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, print: a row for each row; a null text is the empty one, whose fingerprint is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = text_buffer(batch.column("text"))
            prints = [simhash(data[a:b].tobytes(), width) for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "print"])

    return texts(docs).mapInArrow(run, "doc_id long, print long")


# -- shards ------------------------------------------------------------------

@dataclass
class Shards:
    """A tree of vantage points: node k has the children 2k + 1 (near) and 2k + 2; its leaves, from left to right, are the shards."""

    vantage: np.ndarray
    mask: np.ndarray
    radius: np.ndarray       # 64 where a node isn't split
    levels: int

    @staticmethod
    def fit(sample: np.ndarray, masks: tuple[np.uint64, np.uint64], levels: int) -> Shards:
        n = (1 << levels) - 1
        out = Shards(np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.full(n, 64), levels)
        points = {0: sample}
        for node in range(n):
            level = (node + 1).bit_length() - 1
            own = points.pop(node, sample[:0])
            out.mask[node] = masks[level % 2]
            if len(own) < LEAST:
                continue
            out.vantage[node] = own[len(own) // 2]
            far = np.bitwise_count((own ^ out.vantage[node]) & out.mask[node])
            out.radius[node] = radius = int(np.median(far))
            points[2 * node + 1], points[2 * node + 2] = own[far <= radius], own[far > radius]
        return out

    def places(self, prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, whether it is the row's home): homes, and visits to later shards that lie within reach."""
        row, node, home = np.arange(len(prints)), np.zeros(len(prints), np.int64), np.ones(len(prints), bool)
        for _ in range(self.levels):
            far = np.bitwise_count((prints[row] ^ self.vantage[node]) & self.mask[node]).astype(np.int64)
            near = far <= self.radius[node]
            # a home goes to its own side and looks in on the far one; who visits goes wherever the bound lets it
            left, right = np.where(home, near, far - reach <= self.radius[node]), far + reach > self.radius[node]
            row, node, home = (np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2]),
                               np.concatenate([home[left], (home & ~near)[right]]))
        return row, node - ((1 << self.levels) - 1), home


# -- search within a shard ---------------------------------------------------

class Links:
    """Edges between fingerprints, kept as a forest."""

    def __init__(self) -> None:
        self.edges, self.held = [np.zeros((0, 2), np.int64)], 0

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        if len(u):
            self.edges.append(np.stack([u, v], axis=1).view(np.int64))
            self.held += len(u)
            if self.held > AT_ONCE:
                self.forest()

    def forest(self) -> np.ndarray:
        self.edges = [forest_of(np.concatenate(self.edges))]
        self.held = 0
        return self.edges[0]


def _near(homes: np.ndarray, others: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices of others, of homes) of the pairs within ``distance``, a slice of the others at a time."""
    step = max(1, AT_ONCE // max(len(homes), 1))
    for at in range(0, len(others), step):
        i, j = np.nonzero(np.bitwise_count(others[at:at + step, None] ^ homes) <= distance)
        yield i + at, j


def _compare(homes: np.ndarray, others: np.ndarray, distance: int, links: Links) -> None:
    for i, j in _near(homes, others, distance):
        unlike = others[i] != homes[j]
        links.add(others[i[unlike]], homes[j[unlike]])


def _compare_dense(homes: np.ndarray, others: np.ndarray, distance: int, links: Links) -> None:
    """As ``_compare``, for many that are alike: no pairs within the largest group that hangs together so far.

    Sure ties come first. Then those outside the group are compared with all homes, a slice at a time, and what they
    tie to the group is inside from then on; at last those inside are compared with the homes still outside.
    """
    both, at = np.unique(np.concatenate([homes, others]), return_inverse=True)
    home_at, other_at = at[:len(homes)], at[len(homes):]
    ties = [np.zeros((0, 2), np.int64)]
    for low in range(0, 64, distance) if distance else ():
        rest = both & ~np.uint64(((1 << distance) - 1 << low) & (1 << 64) - 1)
        order = np.argsort(rest, kind="stable")
        same = np.flatnonzero(rest[order[1:]] == rest[order[:-1]])
        ties.append(np.stack([order[same], order[same + 1]], axis=1))
    found = [forest_of(np.concatenate(ties))]
    inside = np.zeros(len(both), bool)

    def largest() -> None:
        stars = found[0] = forest_of(np.concatenate(found))
        del found[1:]
        if len(stars):
            lead, size = np.unique(stars[:, 0], return_counts=True)
            own = stars[:, 0] == lead[np.argmax(size)]
            inside[stars[own]] = True

    def add(i: np.ndarray, j: np.ndarray) -> None:
        unlike = i != j
        i, j = i[unlike], j[unlike]
        while (new := inside[i] != inside[j]).any():
            inside[i[new]] = inside[j[new]] = True
        found.append(np.stack([i, j], axis=1))
        if sum(map(len, found)) > AT_ONCE + len(both):
            largest()

    largest()
    step, later = max(1, AT_ONCE // max(len(homes), 1)), []
    for k in range(0, len(other_at), step):
        some = other_at[k:k + step]
        later.append(some[inside[some]])
        some = some[~inside[some]]
        for i, j in _near(homes, both[some], distance):
            add(some[i], home_at[j])
        if not inside.any():
            largest()
    largest()
    later, outside = np.concatenate([other_at[:0], *later]), home_at[~inside[home_at]]
    for i, j in _near(both[outside], both[later], distance):
        add(later[i], outside[j])
    stars = both[forest_of(np.concatenate(found))]
    links.add(stars[:, 0], stars[:, 1])


def search(homes: np.ndarray, others: np.ndarray, masks: tuple[np.uint64, np.uint64], distance: int, links: Links) -> None:
    """Add the links between ``others`` and ``homes`` whose distance is within reach in both masks."""
    reach, stack = distance // 3, [(homes, others, 0, 0)]
    while stack:
        homes, others, level, stuck = stack.pop()
        pairs = len(homes) * len(others)
        if pairs <= REST or stuck == len(masks):
            (_compare if pairs <= DENSE else _compare_dense)(homes, others, distance, links)
            continue
        vantage, mask = homes[len(homes) // 2], masks[level % len(masks)]
        far = np.bitwise_count((homes ^ vantage) & mask).astype(np.int64)
        radius = int(np.median(far))
        if radius == far.max():
            radius -= 1
        near, seen = far <= radius, np.bitwise_count((others ^ vantage) & mask).astype(np.int64)
        parts = [(homes[near], others[seen - reach <= radius]), (homes[~near], others[seen + reach > radius])]
        if sum(len(h) * len(o) for h, o in parts) > 0.9 * pairs:      # the other mask, or none, splits them
            stack.append((homes, others, level + 1, stuck + 1))
        else:
            stack += [(h, o, level + 1, 0) for h, o in parts]


# -- the join ------------------------------------------------------------------

def _fit(prints: DataFrame, n: int) -> list[Shards]:
    """The trees of the shards, fitted on the fingerprints below a bound of their hash: ``OF_SHARD`` a shard, about ``SAMPLE`` at most."""
    levels = max(0, min(-(-n // SHARD), SAMPLE // OF_SHARD) - 1).bit_length()
    sample = np.zeros(0, np.uint64)
    if levels:
        share = min(1.0, (OF_SHARD << levels) / n)
        rows = prints.where(F.pmod(F.xxhash64("print"), F.lit(1 << 40)) < int(share * (1 << 40))).select("print").toArrow()
        sample = np.sort(rows.column("print").to_numpy().view(np.uint64))
    return [Shards.fit(sample, masks, levels) for masks in TREES]


def _places(batches: Iterator[pa.RecordBatch], trees: list[Shards], reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        prints = np.asarray(batch.column("print")).view(np.uint64)
        for t, tree in enumerate(trees):
            row, shard, home = tree.places(prints, reach)
            yield t, prints[row], shard, home


def _parts(prints: DataFrame, sent, reach: int) -> dict[tuple[int, int], int]:
    """The number of parts of each shard of more than one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, total = sent.value, Counter()
        for t, _, shard, _ in _places(batches, trees, reach):
            for s, c in zip(*np.unique(shard, return_counts=True), strict=True):
                total[t, int(s)] += int(c)
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in keys], pa.int32()), pa.array([s for _, s in keys], pa.int64()),
                                          pa.array([total[k] for k in keys], pa.int64())], ["tree", "shard", "n"])

    rows = (prints.select("print").mapInArrow(run, "tree int, shard long, n long").groupBy("tree", "shard").agg(F.sum("n").alias("n"))
            .where(F.col("n") > PART).collect())     # at most as many as there are shards
    return {(r["tree"], r["shard"]): -(-r["n"] // PART) for r in rows}


def _links(prints: DataFrame, n: int, distance: int) -> DataFrame:
    """(u, v): forests of the links of distinct fingerprints, one of each block."""
    reach, context = distance // 3, prints.sparkSession.sparkContext
    sent = context.broadcast(_fit(prints, n))
    parts = context.broadcast(_parts(prints, sent, reach) if n > PART else {})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = defaultdict(list)
        waiting = 0

        def out() -> Iterator[pa.RecordBatch]:
            keys = list(held)
            columns = [pa.array([k[c] for k in keys], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([np.concatenate(held[k]).tobytes() for k in keys], pa.binary())],
                                             ["tree", "shard", "a", "b", "of_a", "home", "prints"])
            held.clear()

        for t, x, shard, home in _places(batches, sent.value, reach):
            order = np.lexsort((home, shard))
            x, shard, home = x[order], shard[order], home[order]
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(home.astype(np.int8)) != 0)) + 1
            for xs, s, h in zip(np.split(x, cuts), shard[np.append(0, cuts)].tolist() if len(x) else (), home[np.append(0, cuts)].tolist() if len(x) else (), strict=False):
                several = parts.value.get((t, s), 1)
                if several == 1:
                    held[t, s, 0, 0, True, h].append(xs)
                    waiting += len(xs)
                    continue
                of = (xs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(several)
                for p in np.unique(of).tolist():
                    own = xs[of == p]
                    for other in range(several):
                        held[t, s, min(p, other), max(p, other), p <= other, h].append(own)
                    waiting += several * len(own)
                if waiting >= HELD:
                    yield from out()
                    waiting = 0
            if waiting >= HELD:
                yield from out()
                waiting = 0
        yield from out()

    def solve(block: pa.Table) -> pa.Table:
        groups: dict[tuple, list[np.ndarray]] = defaultdict(list)
        for of_a, home, raw in zip(*(block.column(c).to_pylist() for c in ("of_a", "home", "prints")), strict=True):
            groups[of_a, home].append(np.frombuffer(raw, np.uint64))
        get = lambda of_a, home: np.concatenate([np.zeros(0, np.uint64), *groups[of_a, home]])
        masks, links = TREES[block.column("tree")[0].as_py()], Links()
        homes, guests = get(True, True), get(True, False)
        if block.column("a")[0].as_py() == block.column("b")[0].as_py():
            search(homes, np.concatenate([homes, guests]), masks, distance, links)
        else:
            search(homes, np.concatenate([get(False, True), get(False, False)]), masks, distance, links)
            search(get(False, True), guests, masks, distance, links)
        found = links.forest()
        trim()
        return pa.table({"u": pa.array(found[:, 0]), "v": pa.array(found[:, 1])})

    places = prints.select("print").mapInArrow(send, "tree int, shard long, a int, b int, of_a boolean, home boolean, prints binary")
    return places.groupBy("tree", "shard", "a", "b").applyInArrow(solve, "u long, v long")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, width: int = WIDTH) -> DataFrame:
    """doc_id, print, component_id for every row: texts whose fingerprints differ in at most ``distance`` bits link.

    A component's id is its smallest doc_id; a null id never names a component unless all its
    ids are null. Null, empty and wordless texts have the fingerprint 0 and link like any other; fewer words
    than ``width`` are one shingle. Equal fingerprints are one row until the end, so
    copies, however many, add no work to the search. Rows that repeat an id are documents of their own.
    Other columns are not read, an empty table gives no rows.
    """
    if not 0 <= distance < 12:
        raise ValueError("distance: 0 to 11 bits")
    rows = stored(fingerprints(docs, width), "fingerprints")
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    labels = connected_components(_links(prints, prints.count(), distance)).select(F.col("node").alias("print"), "label")
    named = prints.join(labels, "print", "left")
    smallest = named.where("label is not null").groupBy("label").agg(F.min("first").alias("smallest"))
    ids = stored(named.join(smallest, "label", "left").select("print", F.coalesce("smallest", "first").alias("component_id")), "components")
    return rows.join(ids, "print").select("doc_id", "print", "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
