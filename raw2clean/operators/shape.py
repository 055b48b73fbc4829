"""Whole-table operators: empty rows and columns, sentinels, high-cardinality
columns, merge by column name.

The data-dependent operators (which columns to drop or blank) decide from ONE
joint aggregate over all columns: partial aggregates per task, a final
aggregate of one row. Only that one row (one number per column) reaches the
driver; the rows themselves never do.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from raw2clean.functions.rules import as_column
from raw2clean.functions.sqltext import literal, quoted

# Sentinels the survey tables use for "no value".
SURVEY_SENTINELS = ("-888888888", "(X)", "")

#: The column that holds the path of a row's file.
FILE = "__file"


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL (empty text is a value)."""
    return df.dropna(how="all")


def null_sentinels(df: DataFrame, values: Iterable[str] = SURVEY_SENTINELS,
                   subset: Iterable[str] | None = None, extra: Mapping[str, Column] | None = None,
                   only: Iterable[str] | None = None) -> DataFrame:
    """Listed values become NULL in string columns (as ``df.replace``); ``extra`` columns are added as
    they are; ``only`` names the columns that stay."""
    values = [str(v) for v in values]
    subset = set(subset) if subset is not None else None
    no_value = ", ".join(literal(v) for v in values)
    only = set(df.columns if only is None else only)
    cols = []
    for f in df.schema.fields:
        if f.name not in only:
            continue
        c = quoted(f.name)
        if isinstance(f.dataType, StringType) and (subset is None or f.name in subset) and values:
            c = f"CASE WHEN {c} IN ({no_value}) THEN NULL ELSE {c} END AS {c}"
        cols.append(c)
    if not extra:
        return df.selectExpr(*cols)
    return df.select(*[F.expr(c) for c in cols], *[c.alias(name) for name, c in extra.items()])


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """G1 + G2/G3 in one pass: row count and non-NULL count per column."""
    columns = list(columns) if columns is not None else df.columns
    row = df.selectExpr("count(1) AS __rows", *[f"count({quoted(c)}) AS c{i}" for i, c in enumerate(columns)]).first()
    return row["__rows"], {c: row[f"c{i}"] for i, c in enumerate(columns)}


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """NULL count of every column, one pass."""
    rows, nn = value_counts(df, columns)
    return {c: rows - v for c, v in nn.items()}


def present_columns(df: DataFrame, files: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """C2 per file: (columns with a value, files) for all of ``files`` that have rows, in order of the first file.

    ``df`` holds the files' rows with their paths in the column ``FILE``, as Spark's ``_metadata.file_path`` has
    them. ONE aggregate counts the values of every column by file, whatever the number of files; files that keep the same
    columns come back as one row.
    """
    columns = [c for c in df.columns if c != FILE]
    counts = df.groupBy(FILE).agg(*[F.expr(f"count({quoted(c)}) AS c{i}") for i, c in enumerate(columns)])
    has = ", ".join(f"CASE WHEN c{i} > 0 THEN {i} END" for i in range(len(columns)))
    found = (counts.selectExpr(FILE, f"array_compact(array({has})) AS kept").groupBy("kept")
             .agg(F.collect_list(F.try_url_decode(F.replace(FILE, F.lit("+"), F.lit("%2B")))).alias("files")).collect())
    plain = lambda f: re.sub("^([A-Za-z][A-Za-z0-9+.-]*):/*", r"\1:/", f)
    names = {plain(f): f for f in files}
    out = [([columns[i] for i in r["kept"]], sorted(names[plain(f)] for f in r["files"])) for r in found]
    return sorted(out, key=lambda p: p[1][0])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are NULL in every row.

    A table without rows keeps its columns (there is no evidence to drop on).
    """
    rows, nn = value_counts(df)
    if rows == 0:
        return df
    keep = [c for c in df.columns if nn[c] > 0]
    return df.select(*[as_column(c) for c in keep])


drop_empty_columns = drop_null_columns


def value_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, v): every non-NULL value ``v`` of column number ``i``, as text.

    Rows unpivot with ``inline``; each pair carries one value, unlike Spark's
    Expand plan for several ``count(DISTINCT)``, which copies the whole row
    once per column.
    """
    pairs = ", ".join(f"named_struct('i', {i}, 'v', CAST({quoted(c)} AS STRING))" for i, c in enumerate(columns))
    return df.selectExpr(f"inline(array({pairs}))").where("v IS NOT NULL")


def _distinct_exact(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Exact distinct counts of several columns in one shuffle; a partial
    aggregate removes repeats inside each task before the shuffle."""
    if not columns:
        return {}
    counts = value_pairs(df, columns).distinct().groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    got = {r["i"]: r["n"] for r in counts.collect()}   # one row per column
    return {c: got.get(i, 0) for i, c in enumerate(columns)}


def distinct_counts(df: DataFrame, columns: Sequence[str], method: str = "exact", rsd: float = 0.05) -> dict[str, int]:
    """Distinct (non-NULL) values per column.

    ``method="exact"``: one shuffle of the (column, value) pairs.
    ``method="approx"``: HyperLogLog++ estimates, one pass, fixed-size buffers.
    """
    columns = list(columns)
    if not columns:
        return {}
    if method == "approx":
        row = df.agg(*[F.approx_count_distinct(as_column(c), rsd).alias(f"c{i}")
                       for i, c in enumerate(columns)]).first()
        return {c: row[f"c{i}"] for i, c in enumerate(columns)}
    if method == "exact":
        return _distinct_exact(df, columns)
    raise ValueError(f"unknown method {method!r}")


def more_distinct_than(df: DataFrame, columns: Sequence[str], threshold: int) -> dict[str, bool]:
    """Whether each column holds more than ``threshold`` distinct values; exact, from counted values.

    Estimates choose, per column, a share of the hash space in which about
    four times ``threshold`` of its values lie; the distinct values of that
    share are counted. More than ``threshold`` of them prove the column to be
    above, so an ID-like column is never shuffled value by value. Columns not
    proved so are counted in full: their estimate said that they are small.
    """
    columns = list(columns)
    if not columns:
        return {}
    estimate = distinct_counts(df, columns, method="approx")
    one_in = [max(1, estimate[c] // (4 * max(threshold, 1))) for c in columns]
    share = F.element_at(F.array(*[F.lit(m) for m in one_in]), F.col("i") + 1)
    part = (value_pairs(df, columns).where(F.pmod(F.xxhash64("v"), share) == 0).distinct()
            .groupBy("i").agg(F.count(F.lit(1)).alias("n")))
    seen = {r["i"]: r["n"] for r in part.collect()}   # one row per column
    above = {c: seen.get(i, 0) > threshold for i, c in enumerate(columns)}
    open_ = [c for c, m in zip(columns, one_in, strict=True) if m > 1 and not above[c]]
    return above | {c: n > threshold for c, n in _distinct_exact(df, open_).items()}


def blank_high_cardinality(df: DataFrame, prefix: str, threshold: int = 20,
                           method: str = "exact") -> DataFrame:
    """Columns whose name starts with ``prefix`` and that hold more than
    ``threshold`` distinct values are blanked (all NULL, same type). Checked
    columns move to the end, in their order; no match returns ``df``.
    ``method="approx"`` decides by estimates.
    """
    checked = [c for c in df.columns if c.startswith(prefix)]
    if not checked:
        return df
    above = (more_distinct_than(df, checked, threshold) if method == "exact" else
             {c: n > threshold for c, n in distinct_counts(df, checked, method=method).items()})
    types = dict(df.dtypes)
    others = [as_column(c) for c in df.columns if c not in checked]
    blanked = [(F.lit(None).cast(types[c]) if above[c] else as_column(c)).alias(c) for c in checked]
    return df.select(*others, *blanked)


def merge_by_name(frames: Sequence[DataFrame], by: str = "name") -> DataFrame | None:
    """Union of several tables; duplicates are kept.

    ``by="name"`` matches columns by name, a column absent from a table is
    NULL there, and new columns are appended in order of appearance. Each
    table is projected once to the columns of all, so the plan grows with the
    number of tables, not with its square.
    ``by="position"`` is the legacy positional union (column counts must agree).
    Returns ``None`` for no tables.
    """
    frames = list(frames)
    if not frames:
        return None
    if by == "position":
        return reduce(lambda a, b: a.union(b), frames)
    if by != "name":
        raise ValueError(f"unknown by={by!r}")
    key = str if frames[0].sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    names: dict[str, str] = {}
    types: dict[str, list[DataType]] = {}
    for f in frames:
        for field in f.schema.fields:
            names.setdefault(key(field.name), field.name)
            types.setdefault(key(field.name), []).append(field.dataType)
    one = {k: t[0] if all(x == t[0] for x in t) else None for k, t in types.items()}

    def projected(f: DataFrame) -> DataFrame:
        own = {key(c): c for c in f.columns}
        # types that differ are left to the union, which widens them
        return f.select(*[as_column(own[k]).alias(n) if k in own else
                          (F.lit(None) if one[k] is None else F.lit(None).cast(one[k])).alias(n) for k, n in names.items()])
    return reduce(lambda a, b: a.union(b), [projected(f) for f in frames])
