"""The three jobs of the legacy code, as functions of ``(spark, paths)``.

* ``run_clean``: loan records of one year -> rule table -> no empty rows ->
  duplicates removed -> written (section 3.1 of the survey).
* ``run_merge``: a folder of yearly survey CSV files -> one table matched by
  column name, with the year of each file (section 3.2).
* ``run_quality``: rules and statistics of a table -> outcome tables
  (section 3.3).

Each builds one lazy plan and runs it with one write (plus the small
jobs named in each function).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.functions.rules import as_column
from raw2clean.operators.dedup import dedup_by_key, distinct_rows
from raw2clean.operators.quality import QualityRule, run_checks
from raw2clean.operators.shape import (
    FILE,
    SURVEY_SENTINELS,
    merge_by_name,
    null_sentinels,
    present_columns,
    value_counts,
)
from raw2clean.plans.presets import DEDUP_KEYS_2007, YEAR_TO_ERA, preset
from raw2clean.plans.ruleset import RuleSet
from raw2clean.session import for_wide_rules, shuffles_freed
from raw2clean.sources.io import files_by_year, group_by_header, read_group, read_table, write_table, year_of_file
from raw2clean.sources.runs import append_run

#: Rules beyond which Spark's whole-stage code grows too long for the JVM to compile.
MANY_RULES = 20

#: Scans of one header and year each that a folder is read by.
YEAR_SCANS = 100


def clean(df: DataFrame, rules: RuleSet, dedup_keys: Sequence[str] | None = None,
          dedup_method: str = "min_struct", on_missing: str = "raise") -> DataFrame:
    """Rule table, then empty rows dropped, then duplicates removed.

    With ``dedup_keys`` one row per key survives (fixed survivor); without,
    one row per distinct row. The legacy 2007 job ran ``distinct`` and then a
    key dedup; the key dedup alone gives the same rows, with one shuffle.
    Beyond ``MANY_RULES`` rules the session gets the settings for wide rule tables, and rows are packed for the shuffle.
    """
    if len(rules) > MANY_RULES:
        for_wide_rules(df.sparkSession)
    out = rules.apply(df, on_missing=on_missing)
    if dedup_keys:
        return dedup_by_key(out, dedup_keys, method=dedup_method, drop_all_null=True)
    return distinct_rows(out, drop_all_null=True, method="packed" if len(rules) > MANY_RULES else "rows")


def run_clean(spark: SparkSession, year: str | int, in_path: str, out_path: str | None = None,
              types: str = "string", tract_style: str = "fixed2",
              dedup_method: str = "min_struct", append: bool = False, compression: str | None = None) -> DataFrame:
    """Clean one year of loan records with its era's preset.

    The 2000 file has one line above its real header (promoted, S10). The
    2007-2017 layout dedups on its 43 key columns; the others on whole rows.
    Written as CSV with header when ``out_path`` is given (``compression``: ``"gzip"`` and so on); with ``append``, added to the
    runs at ``out_path`` as the run of its year, so that a second call replaces the first (``read_runs`` reads it).
    """
    era = YEAR_TO_ERA[str(year)]
    df = read_table(spark, in_path, types=types, promote_first_row=(str(year) == "2000"))
    keys = DEDUP_KEYS_2007 if era == "2007" else None
    out = clean(df, preset(era, tract_style), dedup_keys=keys, dedup_method=dedup_method)
    if out_path and append:
        append_run(out, out_path, str(year), compression=compression)
    elif out_path:
        write_table(out, out_path, fmt="csv", compression=compression)
    return out


def run_clean_years(spark: SparkSession, paths: dict[str, str], out_path: str | None = None,
                    at_once: int = 4, append: bool = False, **kw) -> dict[str, DataFrame]:
    """``run_clean`` for several years, ``at_once`` of them at a time, so that one year's last tasks
    don't leave the cluster idle. With ``out_path`` each year is written to ``out_path/year=YYYY`` (a
    layout Spark prunes on read), with ``append`` as a run of ``out_path``; what a year shuffled is freed when it is written.
    A year that fails raises its error when the others are done."""
    def one(year: str, path: str) -> DataFrame:
        dest = out_path if append or not out_path else f"{out_path.rstrip('/')}/year={year}"
        return run_clean(spark, year, path, dest, append=append, **kw)

    with shuffles_freed(spark) if out_path else nullcontext(), ThreadPoolExecutor(at_once) as pool:
        started = {str(year): pool.submit(inheritable_thread_target(spark)(one), year, path) for year, path in paths.items()}
    return {year: f.result() for year, f in started.items()}


def merge_folder(spark: SparkSession, in_path: str, pattern: str = "*.csv",
                 year_column: str = "Year", sentinels: Sequence[str] = SURVEY_SENTINELS,
                 by: str = "name", drop_empty: bool | str = True) -> DataFrame | None:
    """U1/U2 with S3, S11, R15 and C2: all matching files below ``in_path``
    as one table.

    One listing tells the files and the year of each; one job reads their first lines and groups
    them by header. Files of one header and year are one parallel CSV scan, in which Spark checks
    every header and the year is a constant (beyond ``YEAR_SCANS`` of them: one scan a
    header, the year worked out from each row's file). The scans are united by column name. Columns with no
    value in any file are dropped with one joint aggregate, so the data is read twice. A column
    dropped from some files only would be NULL for those files' rows after a
    by-name union anyway, so one aggregate over the united table gives the
    legacy per-file result without a job per file and column. With
    ``by="position"`` the columns of the first file name those of all; there it matters which columns
    each file loses, and ``drop_empty="file"`` drops from each file its own empty columns before the
    union, as the legacy job did: one aggregate by file for each header, then one scan for the files of
    one header that keep the same columns (files without rows are left out). Returns ``None`` when no file matches.
    """
    years = files_by_year(spark, in_path, pattern)
    groups = group_by_header(spark, list(years))
    if not groups:   # no files, or none with any line
        return None
    keep, kept_of = None, {tuple(columns): [(columns, of)] for columns, of in groups}
    if drop_empty == "file":
        kept_of = {tuple(columns): present_columns(null_sentinels(read_group(spark, columns, of), sentinels, extra={FILE: F.col("_metadata.file_path")}), of)
                   for columns, of in groups}
        kept_of = {c: parts for c, parts in kept_of.items() if parts}
        if not kept_of:
            kept_of = {tuple(columns): [(columns, of)] for columns, of in groups}
    elif drop_empty:
        plain = [null_sentinels(read_group(spark, columns, of), sentinels) for columns, of in groups]
        rows, values = value_counts(merge_by_name(plain, by=by))
        keep = [c for c, n in values.items() if n or not rows]
    parts = sorted(((list(header), kept, of) for header, some in kept_of.items() for kept, of in some), key=lambda p: p[2][0])
    scans = [(header, kept, F.lit(y), [f for f in of if years[f] == y]) for header, kept, of in parts for y in dict.fromkeys(years[f] for f in of)]
    if len(scans) > YEAR_SCANS:
        scans = [(header, kept, year_of_file(in_path), of) for header, kept, of in parts]
    merged = merge_by_name([null_sentinels(read_group(spark, header, of), sentinels, subset=kept, extra={year_column: y}, only=kept)
                            for header, kept, y, of in scans], by=by)
    return merged if keep is None else merged.select(*[as_column(c) for c in (*keep, year_column)])


def run_merge(spark: SparkSession, in_path: str, out_path: str | None = None,
              single_file: bool = False, **kw) -> DataFrame | None:
    """The survey merge job: ``merge_folder`` then a CSV write with header.

    Nothing is written if no file matches (as the legacy job).
    """
    out = merge_folder(spark, in_path, **kw)
    if out is not None and out_path:
        write_table(out, out_path, fmt="csv", single_file=single_file)
    return out


def run_quality(spark: SparkSession, in_path: str | DataFrame, rules: Sequence[QualityRule] = (),
                statistics: bool = False, out_path: str | None = None, fmt: str = "json",
                result: str = "rule_outcomes", distinct: str | Sequence[str] = "approx", **read) -> DataFrame:
    """A quality job: all-string CSV scan, rules and/or statistics, one result
    table picked by name (D5) and written as JSON (no compression) or
    Parquet (snappy) when ``out_path`` is given. Further arguments go to
    ``read_table``: ``schema`` (S4), ``sep``, ``quote``, ``pattern``, ..."""
    df = in_path if isinstance(in_path, DataFrame) else read_table(spark, in_path, **{"recursive": True} | read)
    results = run_checks(df, rules, statistics=statistics, distinct=distinct)
    out = results[result]
    if out_path:
        write_table(out, out_path, fmt=fmt)
    return out
