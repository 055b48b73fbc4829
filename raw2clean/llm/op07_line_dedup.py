"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

A run is a table of (h1, h2, n, holder): the 128-bit hash of a line's key, how
many documents of the run's batches hold it, and the largest of their ids. It
is bucketed and sorted by the hash, so runs are merged and anti-joined bucket
by bucket without a shuffle.

Documents come in batches of descending id. A batch is counted by hash
(combined before its one shuffle) and merge-anti-joined with the runs: a
line already found in ``at_least`` documents is settled, since its holder is a
larger id, and goes no further. The rest becomes a run of its own. Two runs of
a level are compacted into one of the next by a full outer merge join. At the
end the levels are compacted into one run; its settled lines and their
holders decide which lines go.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import as_struct, read, stored

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, AT_LEAST, BATCHES = 20, 3, 4
SMALLEST = -(1 << 63)   # stands for a null doc_id: smaller than any other


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


class LineRuns:
    """The runs, by level; tables of the session's catalog in the shared warehouse."""

    def __init__(self, spark: SparkSession, at_least: int, buckets: int):
        self.spark, self.at_least, self.buckets = spark, at_least, buckets
        self.name, self.made, self.levels = f"line_runs_{uuid.uuid4().hex[:12]}", 0, [[]]

    def _write(self, run: DataFrame) -> str:
        table, self.made = f"{self.name}_{self.made}", self.made + 1
        (run.select("h1", "h2", "n", "holder").repartition(self.buckets, "h1", "h2")
         .write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").format("parquet").saveAsTable(table))
        return table

    def _merged(self, a: str, b: str) -> str:
        left, right = self.spark.table(a).alias("a"), self.spark.table(b).alias("b")
        both = left.join(right, ["h1", "h2"], "full_outer").select(
            "h1", "h2", (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"),
            F.greatest("a.holder", "b.holder").alias("holder"))
        table = self._write(both)
        self._drop(a, b)
        return table

    def _drop(self, *tables: str) -> None:
        for t in tables:
            self.spark.sql(f"DROP TABLE {t}")

    def add(self, batch: DataFrame) -> None:
        """A batch of (h1, h2, n, holder), all of its ids smaller than those before."""
        for table in [t for level in self.levels for t in level]:
            settled = self.spark.table(table).where(F.col("n") >= self.at_least)
            batch = batch.join(settled, ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(batch))
        k = 0
        while len(self.levels[k]) == 2:
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(self._merged(*self.levels[k]))
            self.levels[k] = []
            k += 1

    def settled(self) -> DataFrame:
        """(h1, h2, holder) of the lines in at least ``at_least`` documents; ends the runs."""
        tables = [t for level in self.levels for t in level]
        while len(tables) > 1:
            tables = [self._merged(tables[0], tables[1]), *tables[2:]]
        out = stored(self.spark.table(tables[0]).where(F.col("n") >= self.at_least).select("h1", "h2", "holder"),
                     "settled-lines")
        self._drop(*tables)
        return out


def _with_lines(docs: DataFrame) -> DataFrame:
    """id, th and lines beside the given columns, whose names are left alone: a struct holds them."""
    return docs.select(
        as_struct(docs).alias("row"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(SMALLEST)).alias("id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")).select(
        "row", "id", F.xxhash64("text").alias("th"), F.split("text", "\n", -1).alias("lines"))


def settled_lines(docs: DataFrame, min_chars: int, at_least: int, batches: int) -> DataFrame:
    spark = docs.sparkSession
    keyed = _with_lines(docs).select("id", "lines")
    bounds = keyed.agg(F.percentile_approx("id", [k / batches for k in range(1, batches)], 1000)).first()[0] or []
    edges = [None, *sorted(set(bounds), reverse=True), None]
    runs = LineRuns(spark, at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for high, low in zip(edges, edges[1:], strict=False):
        part = keyed
        if high is not None:
            part = part.where(F.col("id") <= high)
        if low is not None:
            part = part.where(F.col("id") > low)
        keys = F.filter(F.transform("lines", line_key), lambda k: F.char_length(k) >= min_chars)
        runs.add(part.select("id", F.explode(F.array_distinct(keys)).alias("key"))
                 .select("id", *_hashes(F.col("key")))
                 .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("holder")))
    return runs.settled()


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, at_least: int = AT_LEAST,
                batches: int = BATCHES) -> DataFrame:
    """The rows of ``docs`` as a struct ``row`` beside n_lines, n_dropped and the ``kept`` text.

    Each row counts as a document. Rows that share the largest id holding a
    line all keep it; a null id is smaller than any other. A null or empty
    text is one empty line, kept as the empty text. Extra columns stay in the
    struct, whatever their names. An empty table gives no rows.
    """
    docs_lines = _with_lines(docs)
    settled = settled_lines(docs, min_chars, at_least, batches)
    at = (docs_lines.select("id", "th", F.posexplode(F.transform("lines", line_key)).alias("pos", "key"))
          .where(F.char_length("key") >= min_chars).select("id", "th", "pos", *_hashes(F.col("key"))))
    dropped = stored(at.join(settled, ["h1", "h2"]).where("holder <> id")
                     .groupBy("id", "th").agg(F.collect_set("pos").alias("dropped")), "dropped-lines")
    # th and id alone might meet twice for different texts only by a 64-bit collision within one doc_id
    joined = docs_lines.join(dropped, ["id", "th"], "left")
    gone = F.coalesce("dropped", F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    return joined.select("row", F.size("lines").cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"),
                         F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n").alias("kept"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
m AS (SELECT k.*, coalesce(doc_id IS DISTINCT FROM holder AND g.key IS NOT NULL, false) AS gone FROM k LEFT JOIN g ON g.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
