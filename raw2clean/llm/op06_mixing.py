"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A document's place is a 63-bit hash; a source's documents fall into
``BLOCKS`` blocks by its leading bits. A source's quota is a number of blocks: all
of them as often as its target holds its size, and of one copy more, in an order
permuted for the source, as many as the rest of the target holds.

A tree over the output shards divides the quotas: each node draws how many blocks of
every source go left from the multivariate hypergeometric distribution, so leaves
of equal capacity get exact quotas and no block is lost or doubled. Each
leaf draws its quota from its sources' permuted blocks, disjoint by construction.
The blocks that the leaves drew are what the mix takes, and each shard shuffles their documents
locally. All draws come from fixed seeds: reruns agree.

What whole blocks leave of a target is less than the next block in order. That one is refined
level by level (each level is one small aggregate: ``BLOCKS`` sums a source), down
to about ``FEW`` documents, of which a subset is chosen that comes nearest; this part goes to a shard of its own draw.

The list of sources is the mix's configuration and is held by the driver
(a name, a sum and at most 3 x ``BLOCKS`` block places each).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import as_struct, importable, read, stored

WEIGHTS = (5, 2, 1)     # of the sources by code point, repeating, null last
MOST = 3                # times a source's size that its target may be
BITS = 8                # of the hash order, at each level
BLOCKS = 1 << BITS
PLACE_BITS = 63
FEW = 256               # documents that are filled in one by one, about
SUMS = 1 << 16          # units in which their sizes are summed up at most
SEED = 20


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place(doc_id: Column, source: Column, text: Column) -> Column:
    """The document's place in the permuted order, 0 to 2**63 - 1; rows alike in all three share it."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), doc_id, source, F.lit("|"), text), 1)


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST) -> list[float]:
    """Shares of the whole size by weight; what is above ``most`` times a size is shared anew among the rest."""
    total, held = float(sum(sizes)), [False] * len(sizes)
    while True:
        left = total - sum(most * s for s, h in zip(sizes, held, strict=True) if h)
        weight = sum(w for w, h in zip(weights, held, strict=True) if not h)
        out = [float(most * s) if h else left * w / weight for s, w, h in zip(sizes, weights, held, strict=True)]
        above = [i for i, (t, s, h) in enumerate(zip(out, sizes, held, strict=True)) if not h and t > most * s]
        if not above:
            return out
        for i in above:
            held[i] = True
        if all(held):
            return [float(most * s) for s in sizes]


def split_quotas(quotas: Sequence[int], shards: int, seed: int = SEED) -> np.ndarray:
    """shards x sources: exact block counts, by the splitting tree."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(lo: int, hi: int, blocks: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = blocks
            return
        mid = (lo + hi) // 2
        room = int(blocks.sum()) * (mid - lo) // (hi - lo)
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        left = rng.multivariate_hypergeometric(blocks, room, method="marginals") if len(blocks) else blocks
        split(lo, mid, left)
        split(mid, hi, blocks - left)

    split(0, shards, np.asarray(quotas, np.int64))
    return out


def _fill(sizes: list[tuple[int, int]], rest: int) -> list[int]:
    """Places of documents (place, size) whose sizes sum up as near to ``rest`` as any subset's (in units of ``rest`` / ``SUMS``).

    A bit for each sum that the documents so far can reach; then back through the documents, from the nearest sum.
    """
    docs = [(p, s) for p, s in sorted(sizes) if s > 0]
    unit = max(1, rest // SUMS)
    steps, most = [1], 2 * (rest // unit) + 1       # a sum beyond twice the rest is farther than none
    for _, size in docs:
        steps.append((steps[-1] | steps[-1] << size // unit) & ((1 << most + 1) - 1))
    goal = rest // unit
    below = (steps[-1] & ((1 << goal + 1) - 1)).bit_length() - 1
    above = steps[-1] >> goal
    over = goal + (above & -above).bit_length() - 1 if above else None
    at = over if over is not None and over - goal < goal - below else below
    taken = []
    for k in range(len(docs) - 1, -1, -1):
        if not steps[k] >> at & 1:
            taken.append(docs[k][0])
            at -= docs[k][1] // unit
    return taken[::-1]


def block_order(source: int) -> list[int]:
    """The order in which a source's blocks are drawn."""
    return np.random.Generator(np.random.PCG64([SEED, 1, source])).permutation(BLOCKS).tolist()


def _drawn(slim: DataFrame, rest: dict[int, int]) -> dict[int, tuple[list[int], dict[int, tuple[int, list[int]]]]]:
    """For each source with a rest: the blocks that it holds, in the order drawn, and what is taken of blocks in part: {block: (below which place, single places)}."""
    spark = slim.sparkSession
    whole: dict[int, list[int]] = {i: [] for i in rest}
    base, depth, left, out = dict.fromkeys(rest, 0), 0, dict(rest), {}
    while left:
        shift = PLACE_BITS - BITS * (depth + 1)
        at = stored(spark.createDataFrame([(i, base[i]) for i in left], "no int, base long"), "mix-level")
        inside = slim.join(at, "no").where(F.shiftright("place", shift + BITS) == F.shiftright("base", shift + BITS)) if depth else slim.join(at, "no")
        sums: dict[int, dict[int, tuple[int, int]]] = {i: {} for i in left}
        for r in (inside.groupBy("no", F.shiftright("place", shift).bitwiseAND(BLOCKS - 1).alias("block"))
                  .agg(F.sum("size").alias("size"), F.count("*").alias("docs")).collect()):
            sums[r["no"]][r["block"]] = (r["size"], r["docs"])
        few: dict[int, tuple[list[int], int]] = {}   # the parts of this level whose documents are looked at, and what to fill
        for i in list(left):
            order, full = block_order(i) if depth == 0 else list(range(BLOCKS)), 0
            while full < BLOCKS and sums[i].get(order[full], (0, 0))[0] <= left[i]:
                left[i] -= sums[i].get(order[full], (0, 0))[0]
                full += 1
            docs = sums[i].get(order[full], (0, 0))[1] if full < BLOCKS else 0
            lo, hi = full, full + (full < BLOCKS)
            refine = docs > FEW and shift >= BITS
            while not refine and docs < FEW and left[i] and (lo > 0 or hi < BLOCKS):   # neighbours in order, up to about FEW documents
                if hi < BLOCKS:
                    docs += sums[i].get(order[hi], (0, 0))[1]
                    hi += 1
                if lo > 0:
                    lo -= 1
                    left[i] += sums[i].get(order[lo], (0, 0))[0]
                    docs += sums[i].get(order[lo], (0, 0))[1]
            if depth == 0:
                whole[i] = order[:lo]
            if refine:
                base[i] += order[full] << shift
                continue
            if depth:       # of the one block refined: all below, and some of these documents
                out[i] = {base[i] >> PLACE_BITS - BITS: (base[i] + (lo << shift), [])}
            few[i] = (order[lo:hi], left.pop(i))
        wanted = {i: f for i, f in few.items() if f[0] and f[1]}
        if wanted:
            ends = stored(spark.createDataFrame([(i, (base[i] >> shift) + b) for i, (parts, _) in wanted.items() for b in parts], "no int, part long"), "mix-few")
            docs_of: dict[int, list[tuple[int, int]]] = {i: [] for i in wanted}
            for r in (slim.withColumn("part", F.shiftright("place", shift)).join(ends, ["no", "part"])
                      .groupBy("no", "place").agg(F.sum("size").alias("size")).collect()):
                docs_of[r["no"]].append((r["place"], r["size"]))
            for i, (_, fill) in wanted.items():
                part = out.setdefault(i, {})
                for p in _fill(docs_of[i], fill):
                    part.setdefault(p >> PLACE_BITS - BITS, (0, []))[1].append(p)
        depth += 1
    return {i: (whole[i], out.get(i, {})) for i in rest}


class Mix:
    """What the mix takes: for each source and block that the leaves drew, the shards of its copies.

    ``sources``: source, no, source_size, target. ``blocks``: no, block, shards (one for each whole copy), rest_shard (of one copy
    more, if drawn), and of that copy, where it is taken in part: the place below which, and single places.
    """

    def __init__(self, sources: DataFrame, blocks: DataFrame, slim: DataFrame, shards: int):
        self.sources, self.blocks, self.slim, self.shards = sources, blocks, slim, shards


def plan_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, shards: int | None = None) -> Mix:
    """The plan over all rows; ``shards`` output shards, by default the session's shuffle partitions. What is taken doesn't depend on their number."""
    spark = importable(docs.sparkSession)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                          F.col("text").cast("string").alias("text"))
    slim = stored(columns.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                                 place(F.col("doc_id"), F.col("source"), F.col("text")).alias("place")), "mix-sizes")
    rows = slim.groupBy("source").agg(F.sum("size").alias("size")).orderBy(F.col("source").asc_nulls_last()).collect()
    sizes = [r["size"] for r in rows]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], most) if rows else []
    sources = stored(spark.createDataFrame([(r["source"], i, r["size"], goal[i]) for i, r in enumerate(rows)],
                                           "source string, no int, source_size long, target double"), "mix-sources")
    numbered = slim.join(sources.select(F.col("source").alias("of"), "no"), F.col("source").eqNullSafe(F.col("of"))).select("no", "place", "size")
    copies = [min(most, int(t // s)) if s else 0 for t, s in zip(goal, sizes, strict=True)]
    rest = {i: r for i, (t, s, c) in enumerate(zip(goal, sizes, copies, strict=True)) if s and c < most and (r := round(t - c * s)) > 0}
    drawn = _drawn(numbered, rest)

    # a source's quota: every block for each whole copy, those of the rest, and a place for what is taken of blocks in part
    units: list[list[tuple[int, int]]] = []
    for i in range(len(rows)):
        whole, part = drawn.get(i, ([], {}))
        units.append([(c, b) for c in range(copies[i]) for b in block_order(i)] + [(copies[i], b) for b in (*whole, *sorted(part))])
    quotas = split_quotas([len(u) for u in units], shards)
    table = []
    for i, u in enumerate(units):
        # the leaves draw their quotas from the source's permuted blocks, without putting back
        order = np.random.Generator(np.random.PCG64([SEED, 2, i])).permutation(len(u))
        shard_of = {u[k]: int(s) for k, s in zip(order, np.repeat(np.arange(shards), quotas[:, i]), strict=True)}
        part = drawn.get(i, ([], {}))[1]
        of_block: dict[int, list[int]] = {}
        for (c, b), s in sorted(shard_of.items()):
            if c < copies[i]:
                of_block.setdefault(b, []).append(s)
        for b in sorted({b for _, b in u}):
            rest_shard = shard_of.get((copies[i], b))
            cut, singles = part.get(b, (None, []))    # no cut: the whole block
            table.append((i, b, of_block.get(b, []), rest_shard, cut, singles))
    blocks = stored(spark.createDataFrame(table, "no int, block int, shards array<int>, rest_shard int, cut long, singles array<long>"), "mix-blocks")
    return Mix(sources, blocks, slim, shards)


def _placed(rows: DataFrame, mix: Mix, source: str, at: str, out: str) -> DataFrame:
    """``rows`` with the shards of each row's copies in ``out`` (none: not taken), source_size and target."""
    by = mix.sources.select(F.col("source").alias("_mix_of"), F.col("no").alias("_mix_no"), F.col("source_size").alias("_mix_size"), F.col("target").alias("_mix_target"))
    blocks = mix.blocks.select(F.col("no").alias("_mix_no"), F.col("block").alias("_mix_block"), F.col("shards").alias("_mix_shards"), F.col("rest_shard").alias("_mix_rest"),
                               F.col("cut").alias("_mix_cut"), F.col("singles").alias("_mix_singles"))
    joined = (rows.join(by, F.col(source).eqNullSafe(F.col("_mix_of")), "left")
              .withColumn("_mix_block", F.shiftright(at, PLACE_BITS - BITS).cast("int")).join(blocks, ["_mix_no", "_mix_block"], "left"))
    more = F.col("_mix_rest").isNotNull() & (F.col("_mix_cut").isNull() | (F.col(at) < F.col("_mix_cut")) | F.array_contains("_mix_singles", F.col(at)))
    none = F.array().cast("array<int>")
    return joined.withColumn(out, F.concat(F.coalesce("_mix_shards", none), F.when(more, F.array("_mix_rest")).otherwise(none)))


def taken(mix: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards: what the mix takes of every document.

    A null source is a source, the last. A null or empty text has size 0, and
    taking it takes no words. Rows alike in id, source and text are taken
    alike. Without any words all targets are 0 and nothing is taken. An empty
    table gives no rows.
    """
    return _placed(mix.slim, mix, "source", "place", "shards").select(
        "doc_id", "size", F.col("_mix_size").alias("source_size"), F.col("_mix_target").alias("target"),
        (F.col("size") * F.size("shards")).alias("taken"), "shards")


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, dealt to shards and shuffled within each.

    The columns are those of ``docs``, extra ones too. ``mix`` is the plan over the same rows.
    """
    rows = docs.select(as_struct(docs).alias("_mix_row"), docs["source"].cast("string").alias("_mix_source"),
                       place(docs["doc_id"].cast("long"), docs["source"].cast("string"), docs["text"].cast("string")).alias("_mix_place"))
    return (_placed(rows, mix, "_mix_source", "_mix_place", "_mix_to")
            .select("_mix_row", "_mix_place", F.posexplode("_mix_to").alias("_mix_copy", "_mix_shard"))
            .repartition(mix.shards, "_mix_shard")
            .sortWithinPartitions("_mix_shard", F.xxhash64(F.lit(SEED), "_mix_place", "_mix_copy"))
            .select(*[F.col("_mix_row").getField(c).alias(c) for c in docs.columns]))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(plan_mix(read(spark, sf_dir, "documents")))
