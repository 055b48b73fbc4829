"""Ranked lexical search: bag deduplication.

Items are queries; their terms are the vocabulary, and nothing else of a document
matters to its score but its length. So each document becomes a bag: the vocabulary's terms
in it with their counts (tf), and m, which stands for the length.

1. One pass over the texts writes a bag a document. The corpus counts (documents with
   terms, terms, documents holding a term) are summed from these bags.
2. Documents of one bag and one m score alike for every item: they are a class. A 128-bit
   hash names it, and the bags themselves are compared by the grouping, which
   combines within each task before it shuffles; a class of a third of all documents arrives
   as one row a task.
3. Each class is scored once, for all items at once over the items that hold its
   terms. A task keeps each item's k best classes, by score, then by the
   smallest doc_id; a class holds a document at least, so k classes are enough.
4. Of the classes that are left (k an item at most), the k smallest doc_ids are looked up
   and each item's classes are expanded in that order.

Items come in blocks of bounded size (``ITEM_BYTES`` and ``ITEM_ROWS``); a block's
vocabulary is what is broadcast, and each block is a pass over the texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raw2clean.llm.common import LOWER, chunks, importable, read, span_hashes, stored, text_buffer, texts, trim, word_spans

K = 50
ITEM_BYTES, ITEM_ROWS = 4_000_000, 20_000    # of a block of items
POSTINGS = 2_000_000                         # additions at once
PENDING = 500_000                            # scores a task holds before it keeps the best

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IS_TERM = np.array([bool(re.match(TERM, chr(b))) or b > 127 for b in range(256)])
RESULT = "item_id long, rank int, doc_id long, score long"


@dataclass
class Vocabulary:
    """The terms of a block of items, in order of their hashes, and the items that hold each."""

    item_ids: list[int | None]
    hashes: np.ndarray
    letters: np.ndarray      # the terms' bytes, one after another
    begins: np.ndarray       # of each term in letters
    lengths: np.ndarray
    holders: np.ndarray      # items, term after term
    first_holder: np.ndarray  # of each term in holders, one more than terms
    most_terms: int          # of an item

    @staticmethod
    def of(items: list[tuple[int | None, str | None]]) -> Vocabulary:
        held: dict[bytes, list[int]] = {}
        most = 0
        for k, (_, text) in enumerate(items):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            starts, ends, _ = word_spans(IS_TERM[raw], np.array([0, len(raw)]))
            lower = LOWER[raw].tobytes()
            terms = {lower[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)}
            most = max(most, len(terms))
            for t in terms:
                held.setdefault(t, []).append(k)
        letters = np.frombuffer(b"".join(held), np.uint8)
        lengths = np.array([len(t) for t in held], np.int64)
        ends = np.cumsum(lengths)
        hashes = span_hashes(letters + np.uint8(1), ends - lengths, ends)
        order = np.argsort(hashes, kind="stable")
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms of the items have one 64-bit hash")
        holders = list(held.values())
        counts = np.array([len(holders[t]) for t in order], np.int64)
        return Vocabulary([i for i, _ in items], hashes[order], letters, (ends - lengths)[order], lengths[order],
                          np.array([i for t in order for i in holders[t]], np.int64), np.concatenate(([0], np.cumsum(counts))), most)

    def find(self, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The spans that are terms, and which: by hash, then letter by letter."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = span_hashes(lower + np.uint8(1), starts, ends)
        term = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[term] == h)
        at = at[self.lengths[term[at]] == ends[at] - starts[at]]
        right, left, k = np.ones(len(at), bool), np.arange(len(at)), 0
        while len(left := left[self.lengths[term[at[left]]] > k]):
            right[left] &= lower[starts[at[left]] + k] == self.letters[self.begins[term[at[left]]] + k]
            k += 1
        return at[right], term[at[right]]


def bags(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of UTF-8 texts: their numbers of terms; the pairs (term, tf) of all bags by text and term; the border of each bag."""
    rows = len(offsets) - 1
    starts, ends, of = word_spans(IS_TERM[data], offsets)
    at, term = vocabulary.find(LOWER[data], starts, ends)
    several = max(len(vocabulary.hashes), 1)
    key, tf = np.unique(of[at] * several + term, return_counts=True)
    cuts = np.searchsorted(key, np.arange(rows + 1) * several)
    return np.bincount(of, minlength=rows), np.stack([key % several, tf], axis=1).astype(np.int32), cuts


def _bag_table(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            n, pairs, cuts = bags(*text_buffer(batch.column("text")), sent.value)
            bag = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((8 * cuts).astype(np.int32)), pa.py_buffer(pairs.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), bag], ["doc_id", "n", "bag"])

    return stored(texts(docs).mapInArrow(run, "doc_id long, n long, bag binary"), "bags")


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a column of bags, and the row of each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    pairs = (np.frombuffer(data, np.uint8)[cuts[0]:cuts[-1]] if data is not None else np.zeros(0, np.uint8)).view(np.int32).reshape(-1, 2)
    return pairs, np.repeat(np.arange(len(column)), np.diff(cuts) // 8)


def documents_holding(bag_table: DataFrame, terms: int) -> np.ndarray:
    """The number of bags that hold each term: one count a term and task, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for batch in batches:
            if batch.num_rows:
                df += np.bincount(_pairs(batch.column("bag"))[0][:, 0], minlength=terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(df[held], pa.int64())], ["term", "df"])

    out = np.zeros(terms, np.int64)
    for r in bag_table.where("octet_length(bag) > 0").select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def scores(pairs: np.ndarray, row: np.ndarray, m: np.ndarray, weight: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Scores of bags (rows) for all items (columns)."""
    n_items = len(vocabulary.item_ids)
    term, tf = pairs[:, 0].astype(np.int64), pairs[:, 1].astype(np.int64)
    part = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
    term, row, part = term[part > 0], row[part > 0], part[part > 0]
    begins, several = vocabulary.first_holder[term], np.diff(vocabulary.first_holder)[term]
    cell = np.repeat(row * n_items, several) + vocabulary.holders[np.repeat(begins - (np.cumsum(several) - several), several) + np.arange(several.sum())]
    if len(part) and vocabulary.most_terms * int(part.max()) >= 1 << 53:     # sums that doubles can't hold
        out = np.zeros(len(m) * n_items, np.int64)
        np.add.at(out, cell, np.repeat(part, several))
    else:
        out = np.bincount(cell, np.repeat(part, several), minlength=len(m) * n_items).astype(np.int64)
    return out.reshape(len(m), n_items)


class Best:
    """Each item's k best classes so far: by score, then by the smallest doc_id."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)     # a score must be above 0
        self.rows, self.held = [np.zeros((0, 4), np.int64)], 0

    def add(self, table: np.ndarray, first: np.ndarray, uid: np.ndarray) -> None:
        at, item = np.nonzero(table >= self.least)
        self.rows.append(np.stack([item, table[at, item], first[at], uid[at]], axis=1))
        self.held += len(at)
        if self.held > PENDING:
            self.kept()

    def kept(self) -> np.ndarray:
        """Rows (item, score, smallest doc_id, class)."""
        rows = np.concatenate(self.rows)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        rank = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
        rows, rank = rows[rank < self.k], rank[rank < self.k]
        full = rows[rank == self.k - 1]
        self.least[full[:, 0]] = full[:, 1]
        self.rows, self.held = [rows], len(rows)
        return rows


_LAST = (1 << 63) - 1


def _best_classes(classes: DataFrame, vocabulary: Vocabulary, weight: np.ndarray, k: int) -> DataFrame:
    """(item, item_id, score, first, uid): the k best classes of each item."""
    sent = classes.sparkSession.sparkContext.broadcast((vocabulary, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, w = sent.value
        best, n_items, holders = Best(len(words.item_ids), k), len(words.item_ids), np.diff(words.first_holder)
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs, row = _pairs(batch.column("bag"))
            m, first, uid = (np.asarray(batch.column(c)) for c in ("m", "first", "uid"))
            work = np.bincount(row, holders[pairs[:, 0]], minlength=len(m)) + n_items
            group = np.cumsum(work) // POSTINGS
            for a, b in zip(*(lambda c: (c, np.append(c[1:], len(m))))(np.unique(group, return_index=True)[1]), strict=True):
                lo, hi = np.searchsorted(row, (a, b))
                best.add(scores(pairs[lo:hi], row[lo:hi] - a, m[a:b], w, words), first[a:b], uid[a:b])
        rows = best.kept()
        trim()
        ids = pa.array([words.item_ids[i] for i in rows[:, 0]], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), ids, *(pa.array(rows[:, c]) for c in (1, 2, 3))], ["item", "item_id", "score", "first", "uid"])

    found = classes.select("uid", "first", "m", "bag").mapInArrow(run, "item long, item_id long, score long, first long, uid long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "uid")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def _rank_block(docs: DataFrame, items: list[tuple[int | None, str | None]], k: int) -> DataFrame:
    spark, vocabulary = docs.sparkSession, Vocabulary.of(items)
    table = _bag_table(docs, vocabulary)
    n_docs, n_terms = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_terms or not len(vocabulary.hashes):
        return spark.createDataFrame([], RESULT)
    df = documents_holding(table, len(vocabulary.hashes))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    named = (table.where("octet_length(bag) > 0").withColumn("m", F.expr(f"100 - 50 + ((50 * n * {n_docs}L) div {n_terms}L)"))
             .withColumn("key", F.unhex(F.md5(F.concat(F.col("m").cast("string").cast("binary"), F.lit(b":"), "bag")))).select("key", "m", "bag", "doc_id"))
    same = ["key", "m", "bag"]     # the hash, and what it stands for
    classes = stored(named.groupBy(*same).agg(F.min("doc_id").alias("first")).withColumn("first", F.coalesce("first", F.lit(_LAST)))
                     .withColumn("uid", F.monotonically_increasing_id()), "classes")
    chosen = stored(_best_classes(classes, vocabulary, weight, k), "chosen")

    # at most k classes an item: their keys are few enough to send to the bags, their bags are compared
    few = stored(classes.join(F.broadcast(chosen.select("uid").distinct()), "uid", "left_semi"), "chosen-classes")
    members = named.join(F.broadcast(few.select("key").distinct()), "key", "left_semi")
    order = Window.partitionBy(*same).orderBy(F.asc_nulls_last("doc_id"))
    members = members.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")
    members = members.join(few.select("uid", *same), same).select("uid", "doc_id")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (chosen.join(members, "uid").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, equal scores by ascending doc_id.

    ``items`` has ``item_id`` and ``text``. Equal rows of items are one item; rows that share
    an id and not the text are items of their own. An item or a document that is null, empty or
    without terms meets nothing; fewer than k documents above 0 are all there are. Rows of documents
    that repeat an id are documents of their own, a null id comes after all others. Other
    columns are not read; empty tables give no rows.
    """
    spark = importable(docs.sparkSession)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    rows, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-rows // ITEM_ROWS), -(-size // ITEM_BYTES))
    out = spark.createDataFrame([], RESULT)
    for b in range(blocks):
        of_block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        if of_block:
            found = _rank_block(docs, [tuple(r) for r in of_block], k)
            out = found if blocks == 1 else out.unionByName(stored(found, "ranked"))
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
m AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // terms) AS m FROM d, c),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY term),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""
