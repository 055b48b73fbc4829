"""Periodic run detection: online dyadic square catching.

A run is a longest stretch of words with a smallest period q that holds q at
least twice. Words are appended to a growing sequence. Each completed block of
L words (L a power of two, starting at a multiple of L) is held by a catcher.
When a word is appended, the suffix of L words that it completes is compared
with the catchers that begin 2L to 4L words before the suffix: two comparisons
a level. A square of period 2L <= p < 4L has a block of L words within its first
half, and that block comes again p words later, so no square is missed; the
catchers of two words also watch the shorter periods.

What a catcher reports is a suffix comparison (block, period). It goes back to the
first word that differs from the word p further on, and on until a word ends
it or the sequence does; then it stays open and goes on with the next words
appended. Once it is p words long it is a square; all squares of one period that hang
together are one comparison, and so one run. Comparisons within a
run whose period divides theirs are not started: they could only give that run again.

Words are known by 64-bit hashes. Spans of words are compared by polynomial
prefix sums and binary search, for all new comparisons at once; the words of each
run found are then compared one by one. Texts follow one another in one
sequence, each closed by an end mark that occurs once, so no square crosses texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import SPACE, _powers, chunks, mix, read, span_hashes, text_buffer, texts, word_spans

MIN_LENGTH = 12
SLICE = 65_536             # words appended at once
WORD = r"[^\x20\x09-\x0D]+"


class SquareCatcher:
    """A growing sequence of words, its catchers, open comparisons and the runs found so far.

    ``append`` any number of words at a time, ``finish`` at the end; ``runs()``
    then has rows (start, end, period). How the words are cut into calls changes nothing.
    """

    def __init__(self, min_length: int = MIN_LENGTH):
        self.min_length = max(min_length, 2)
        self.words = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)          # of each word: where its text begins
        self.sums = np.zeros(1, np.uint64)           # of words times powers, before each word
        self.catchers: dict[int, np.ndarray] = {}    # by L: the hashes of the completed blocks
        self.open = np.zeros((0, 2), np.int64)       # start, period of comparisons that hold up to the last word
        self.found = np.zeros((0, 3), np.int64)      # start, end, period

    # -- spans of words ----------------------------------------------------

    def _span(self, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self._inverse[at]

    def _forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The number of words from i and from j > i on that are the same."""
        low, high = np.zeros(len(i), np.int64), len(self.words) - j
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self._span(i, middle) == self._span(j, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def _backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The number of words before i and before j > i that are the same, within the text of i."""
        low, high = np.zeros(len(i), np.int64), i - self.begins[i]
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self._span(i - middle, middle) == self._span(j - middle, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    # -- the online step -----------------------------------------------------

    def append(self, words: np.ndarray, begins: np.ndarray) -> None:
        """Add words, and of each the place in the whole sequence where its text begins."""
        if not len(words):
            return
        before = len(self.words)
        self.words = np.concatenate([self.words, words])
        self.begins = np.concatenate([self.begins, begins])
        n = len(self.words)
        powers, self._inverse = _powers(n + 1)
        self.sums = np.concatenate([self.sums, self.sums[-1] + np.cumsum(words * powers[before:n])])
        open_now, self.open = self.open, np.zeros((0, 2), np.int64)
        at = np.full(len(open_now), before)
        self._settle(open_now[:, 0], at + self._forward(at - open_now[:, 1], at), open_now[:, 1])
        # the words of the longest text; shorter texts have no more levels than they need
        longest = int((np.arange(before, n) - begins).max()) + 1
        # short squares: blocks of two words lie in them only if they are three words or more from end to end
        for length in [1] * (self.min_length < 5) + [1 << k for k in range(1, max(longest.bit_length() - 1, 2))]:
            self._catch(length, before, n)

    def _catch(self, length: int, before: int, n: int) -> None:
        held = self.catchers.get(length, np.zeros(0, np.uint64))
        new = np.arange(len(held), n // length) * length
        self.catchers[length] = held = np.concatenate([held, self._span(new, length)])
        suffix = np.arange(max(before - length + 1, 0), n - length + 1)
        if not len(suffix):
            return
        here, block = self._span(suffix, length), suffix // length
        # periods from 2 * length on; the catchers of the shortest squares also those below
        for back in {1: (1, 2, 3), 2: (0, 1, 2, 3) if self.min_length >= 5 else (2, 3)}.get(length, (2, 3)):
            at = block - back
            hit = np.flatnonzero((at >= 0) & (held[np.maximum(at, 0)] == here) & (at * length < suffix) & (at * length >= self.begins[suffix]))
            if len(hit):
                self._start(at[hit] * length, suffix[hit] - at[hit] * length, length)

    def _start(self, block: np.ndarray, period: np.ndarray, length: int) -> None:
        """Comparisons of blocks that came again, but those inside a run whose period divides theirs."""
        new = np.ones(len(block), bool)
        n = len(self.words)
        known = np.concatenate([self.found, np.insert(self.open, 1, n, axis=1)])
        known = known[known[:, 1] - known[:, 0] >= 2 * known[:, 2]]
        for q in np.unique(known[:, 2]):
            if not new.any():
                return
            of_q = known[known[:, 2] == q]
            of_q = of_q[np.argsort(of_q[:, 0])]
            run = np.searchsorted(of_q[:, 0], block, side="right") - 1
            new &= ~((run >= 0) & (period % q == 0) & (of_q[np.maximum(run, 0), 1] >= block + period + length))
        block, period = block[new], period[new]
        back = self._backward(block, block + period)
        ahead = self._forward(block + length, block + period + length)
        self._settle(block - back, block + period + length + ahead, period)

    def _settle(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Comparisons that hold up to the last word stay open; of the others, those that are long enough are runs."""
        n = len(self.words)
        is_open = end == n
        if is_open.any():
            self.open = np.unique(np.concatenate([self.open, np.stack([start, period], axis=1)[is_open]]), axis=0)
        run = ~is_open & (end - start >= np.maximum(self.min_length, 2 * period))
        self._report(np.stack([start, end, period], axis=1)[run])

    def _report(self, runs: np.ndarray) -> None:
        if not len(runs):
            return
        kept = [run for s, e, p in np.unique(runs, axis=0).tolist() for run in self._checked(s, e, p)]
        found = np.concatenate([self.found, np.array(kept, np.int64).reshape(-1, 3)])
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        again = (found[1:, :2] == found[:-1, :2]).all(axis=1)     # one stretch: its smallest period
        self.found = found[np.concatenate(([True], ~again))[:len(found)]]

    def _checked(self, s: int, e: int, p: int) -> list[tuple[int, int, int]]:
        """The run word by word; where sums of different words were alike, the stretches that are there."""
        same = self.words[s:e - p] == self.words[s + p:e]
        if same.all():
            return [(s, e, p)]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0])))).reshape(-1, 2)
        return [(s + a, s + b + p, p) for a, b in edges.tolist() if b + p - a >= max(self.min_length, 2 * p)]

    def finish(self) -> None:
        """No word follows: what is open ends here."""
        start, period = self.open[:, 0], self.open[:, 1]
        end = np.full(len(start), len(self.words))
        self.open = np.zeros((0, 2), np.int64)
        self._report(np.stack([start, end, period], axis=1)[end - start >= np.maximum(self.min_length, 2 * period)])

    def runs(self) -> np.ndarray:
        return self.found[np.lexsort((self.found[:, 2], self.found[:, 0]))]


def runs_of_texts(data: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of UTF-8 texts: the words of each; all runs (text, start, length, period) in order; whether each word stays, text after text."""
    texts_, (starts, ends, of) = len(offsets) - 1, word_spans(~SPACE[data], offsets)
    count = np.bincount(of, minlength=texts_)
    begins = np.cumsum(count) - count + np.arange(texts_)     # in the sequence with an end mark after each text
    words = np.empty(len(starts) + texts_, np.uint64)
    place = np.arange(len(starts)) + of
    words[place] = span_hashes(data + np.uint8(1), starts, ends)
    words[begins + count] = mix(np.arange(1, texts_ + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    of_place = np.repeat(begins, count + 1)
    catcher = SquareCatcher(min_length)
    for a in range(0, len(words), SLICE):
        catcher.append(words[a:a + SLICE], of_place[a:a + SLICE])
    catcher.finish()
    found = catcher.runs()
    text = np.searchsorted(begins, found[:, 0], side="right") - 1
    change = np.zeros(len(words) + 1, np.int64)               # a word goes if a run holds it after its first period
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    runs = np.stack([text, found[:, 0] - begins[text], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return count, runs, (np.cumsum(change)[:-1] == 0)[place]


_RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs, collapsed: the runs of the words of each text, and the text without their repeats.

    ``runs`` holds (start, length, period) of every run of ``min_length``
    words or more and twice its period, by start, then period. ``collapsed``
    has the words that no run holds after its first period, joined by one space.
    Each row gives a row, by itself and in one task; a null text is the empty one, without words or runs; a text
    of any length is read whole. Null and repeated ids pass through, other columns are not
    read, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = text_buffer(batch.column("text"))
            count, found, stays = runs_of_texts(data, offsets, min_length)
            cuts = np.searchsorted(found[:, 0], np.arange(batch.num_rows + 1))
            runs = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(found[:, k]) for k in (1, 2, 3)], ["start", "length", "period"]))
            raw, kept, at = data.tobytes(), [], 0
            for a, b, n in zip(offsets, offsets[1:], count.tolist(), strict=False):
                parts = raw[a:b].split()
                kept.append(b" ".join(compress(parts, stays[at:at + n].tolist())))
                at += n
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())],
                                             ["doc_id", "n_words", "runs", "collapsed"])

    return texts(docs).mapInArrow(run, f"doc_id long, n_words long, runs array<{_RUN}>, collapsed string")


def repeated_tail(text: Column, doc_id: Column) -> Column:
    """The texts that op 13 reads: of each tenth id by its crc32, the words from the a-th on are repeated with a period."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def repeated(s: Column) -> Column:
        n = F.size(s["words"])
        a = s["g"] % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + s["g"] % 8))
        return F.array_join(F.transform(s["words"], lambda _, i: F.get(s["words"], F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    return F.when((h % 10 == 0) & text.rlike(WORD),
                  F.get(F.transform(F.array(F.struct(words.alias("words"), g.alias("g"))), repeated), F.lit(0))).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = periodic_runs(docs.select("doc_id", repeated_tail(F.col("text"), F.col("doc_id")).alias("text")))
    rank = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("length")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    best = F.array_min(rank)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
