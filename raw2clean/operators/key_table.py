"""Key dedup against what is already cleaned (G6 from year to year).

The keys of all rows kept so far lie in a bucketed table. A new year's rows
are deduplicated among themselves, dealt to the buckets once, and anti-joined bucket by
bucket; the table itself is scanned where it lies and never shuffled again, so a year
costs its own rows and a scan of keys, not another dedup of all years.

A row is known by one text that spells out its key columns, so NULLs are equal and no two
keys are alike. Keys are kept by run: the same run again sees the keys of the
other runs only, and replaces its own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.functions.sqltext import literal, quoted
from raw2clean.operators.dedup import dedup_by_key

_KEY = "__key"


def key_text(keys: Iterable[str]) -> str:
    """SQL that spells out key columns: each value as its length and text, a NULL as a dash."""
    parts = [f"coalesce(concat(length(CAST({quoted(k)} AS STRING)), ':', CAST({quoted(k)} AS STRING)), '-')" for k in keys]
    return f"concat({', '.join(parts)})"


class KeyTable:
    """The keys of the rows kept so far, in the catalog table ``name``: bucketed by key, partitioned by run.

    The table lies in the session's warehouse, which all executors must share. ``buckets``
    should leave a bucket's keys in a task's memory at the size expected; it is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Iterable[str], buckets: int = 64):
        self.spark, self.name, self.keys, self.buckets = spark, name, list(keys), buckets
        sc = spark.sparkContext
        if spark.catalog.tableExists(name):
            return
        if not sc.master.startswith("local") and not sc.getConf().contains("spark.sql.warehouse.dir"):
            raise ValueError("set spark.sql.warehouse.dir to a folder that all executors share")
        spark.createDataFrame([], f"{_KEY} string, __run string").write.partitionBy("__run").bucketBy(buckets, _KEY).sortBy(_KEY).format(
            "parquet").saveAsTable(name)

    def new_rows(self, df: DataFrame, run: str, **dedup) -> DataFrame:
        """One row for each key of ``df`` that no other run has (further arguments go to ``dedup_by_key``). Lazy."""
        known = self.spark.table(self.name).where(F.col("__run") != str(run)).select(_KEY)
        rows = dedup_by_key(df, self.keys, **dedup).selectExpr(f"{key_text(self.keys)} AS {_KEY}", "*")
        return rows.hint("shuffle_merge").join(known.hint("merge"), _KEY, "left_anti").drop(_KEY)

    def add(self, rows: DataFrame, run: str) -> None:
        """Keep the keys of ``rows`` as those of ``run``, instead of what it had."""
        keys = rows.selectExpr(f"{key_text(self.keys)} AS {_KEY}").distinct()
        # a task holds whole buckets, so a run adds one file to each; a named partition is overwritten alone
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (__run = {literal(str(run))}) SELECT {_KEY} FROM {{keys}}",
                       keys=keys.repartition(self.buckets, _KEY))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def dedup_run(table: KeyTable, df: DataFrame, run: str, out_path: str, fmt: str = "parquet", **dedup) -> None:
    """Add a year to a table of runs: rows of new keys go to ``out_path`` as the run ``run``, then their keys to the table.

    If it is killed between the two, the same run again mends it: its own keys never stand against it.
    """
    from raw2clean.sources.runs import append_run, read_runs
    append_run(table.new_rows(df, run, **dedup), out_path, str(run), fmt=fmt)
    table.add(read_runs(table.spark, out_path, runs=[run]), run)
