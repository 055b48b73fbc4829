"""The column rules over a stream of CSV files.

Rules and the empty-row filter are stateless, so ``RuleSet.apply`` works on a
streaming DataFrame unchanged; each micro-batch is cleaned as it arrives.
Duplicate removal across batches would need state (a watermark and
``dropDuplicatesWithinWatermark``) and is left to batch jobs, as in the
legacy code, which has no stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from raw2clean.operators.shape import drop_empty_rows
from raw2clean.plans.ruleset import RuleSet
from raw2clean.sources.io import string_schema


def clean_stream(spark: SparkSession, in_dir: str, rules: RuleSet,
                 columns: Sequence[str] | None = None, max_files: int | None = None,
                 pattern: str = "*.csv") -> DataFrame:
    """A streaming DataFrame: new CSV files in ``in_dir`` -> rules -> no empty rows.

    A stream needs its schema up front: all-string, from ``columns`` (the
    file header) or else from the rules' input columns.
    """
    schema = string_schema(list(columns) if columns is not None else rules.inputs)
    r = (spark.readStream.schema(schema).option("header", True)
         .option("pathGlobFilter", pattern))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return drop_empty_rows(rules.apply(r.csv(in_dir)))


def write_stream(df: DataFrame, out_dir: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = False) -> StreamingQuery:
    """Append each micro-batch to ``out_dir``; progress kept in ``checkpoint``
    (a shared folder) so a restarted query resumes where it stopped."""
    w = df.writeStream.format(fmt).option("path", out_dir).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def run_available(df: DataFrame, out_dir: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process every file present now, then stop."""
    q = write_stream(df, out_dir, checkpoint, fmt, available_now=True)
    q.awaitTermination()
