"""Column statistics as states that can be kept and merged (D3).

A state holds, for a column of a part of a table (a year, a file), counts, the extremes, the
moments of its numbers, a HyperLogLog sketch of its values and, if asked for, a KLL
sketch of its numbers. States of several parts merge into the state of all
parts together, so a table's profile after another year needs that year's
rows and the stored states, not the rows of older years.

Distinct counts are estimates (``DISTINCT_ERROR``: one standard error), quantiles have a rank
error of at most ``RANK_ERROR`` in 99 of 100 cases; everything else is exact,
sums of doubles up to their rounding.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raw2clean.functions.rules import number
from raw2clean.functions.sqltext import Sql, literal, quoted
from raw2clean.sources.runs import append_run, read_runs

#: Size of the sketches: 2**12 registers, and k of the quantile sketch.
LG_K, KLL_K = 12, 200
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.0133

#: Columns summarised in one aggregate: Spark's object hash aggregate sorts from 128 groups on.
COLUMNS_AT_ONCE = 100

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def is_numeric(kind: str) -> bool:
    return kind.split("(")[0] in NUMERIC_TYPES


def column_states(df: DataFrame, columns: Sequence[str] | None = None, by: Iterable[str] = (), quantiles: bool = False) -> DataFrame:
    """One row for each column (and each value of ``by``): its state.

    (by..., position, column, type, rows, nulls, distinct_sketch, quantile_sketch, min, max, min_number,
    max_number, numbers, mean, m2, sum, min_length, max_length). ``min`` and ``max`` are texts, of numeric columns the texts of
    the smallest and largest number. A column of a table without rows has no state. Rows unpivot into (column,
    value) pairs, a number is parsed once a pair; pairs are summarised within each task, and
    one state for each column and task is shuffled.
    """
    kinds, by = dict(df.dtypes), list(by)
    columns = [c for c in df.columns if c not in by] if columns is None else list(columns)
    at = {c: i for i, c in enumerate(columns)}

    def some(part: Sequence[str], numeric: bool) -> DataFrame:
        pairs = ", ".join(f"named_struct('position', {at[c]}, 'v', CAST({quoted(c)} AS STRING))" for c in part)
        keys = [f"_by{i}" for i in range(len(by))]
        values = df.selectExpr(*[f"{quoted(b)} AS {k}" for b, k in zip(by, keys, strict=True)], f"inline(array({pairs}))").selectExpr(
            *keys, "position", "v", f"{number(Sql('v')).text} AS d")
        extremes = ["min_by(v, struct(d, v)) FILTER (WHERE d IS NOT NULL)", "max_by(v, struct(d, v)) FILTER (WHERE d IS NOT NULL)"] if numeric else ["min(v)", "max(v)"]
        sketch = f"kll_sketch_agg_double(d, {KLL_K})" if quantiles else "CAST(NULL AS BINARY)"
        return values.groupBy(*keys, "position").agg(*[F.expr(e) for e in (
            "count(1) AS rows", "count_if(v IS NULL) AS nulls", f"hll_sketch_agg(v, {LG_K}) AS distinct_sketch", f"{sketch} AS quantile_sketch",
            f"{extremes[0]} AS min", f"{extremes[1]} AS max", "min(d) AS min_number", "max(d) AS max_number", "count(d) AS numbers", "avg(d) AS mean",
            "var_pop(d) * count(d) AS m2", "sum(d) AS sum", "min(length(v)) AS min_length", "max(length(v)) AS max_length")])

    parts = [(own[k:k + COLUMNS_AT_ONCE], numeric) for numeric in (False, True)
             for own in [[c for c in columns if is_numeric(kinds[c]) == numeric]] for k in range(0, len(own), COLUMNS_AT_ONCE)]
    if not parts:
        raise ValueError("no columns to summarise")
    out = reduce(lambda a, b: a.union(b), [some(*p) for p in parts])
    names, types = (", ".join(literal(x) for x in xs) for xs in (columns, [kinds[c] for c in columns]))
    rest = [c for c in out.columns if not c.startswith("_by") and c != "position"]
    return out.selectExpr(*[f"_by{i} AS {quoted(b)}" for i, b in enumerate(by)], "position",
                          f"element_at(array({names}), position + 1) AS `column`", f"element_at(array({types}), position + 1) AS type", *rest)


def merge_states(states: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The states of all parts together, one row for each column (and each value of ``by``).

    Means and squared deviations are pooled around the common mean (Chan, Golub and LeVeque, 1979), so large
    values that differ little lose nothing. A column whose type differs between parts is text from
    then on. A column goes where its first part had it.
    """
    keys = [*[quoted(b) for b in by], "`column`"]
    over = Window.partitionBy(*keys)
    numeric = " OR ".join(f"startswith(type, '{t}')" for t in NUMERIC_TYPES)
    common = states.withColumn("_mean", F.sum(F.col("numbers") * F.col("mean")).over(over) / F.nullif(F.sum("numbers").over(over), F.lit(0)))
    e = [
        "min(position) AS position", "CASE WHEN min(type) = max(type) THEN min(type) ELSE 'string' END AS type", "sum(rows) AS rows", "sum(nulls) AS nulls",
        "hll_union_agg(distinct_sketch) AS distinct_sketch", "kll_merge_agg_double(quantile_sketch) AS quantile_sketch",
        f"CASE WHEN bool_and({numeric}) THEN min_by(min, struct(min_number, min)) FILTER (WHERE min IS NOT NULL) ELSE min(min) END AS min",
        f"CASE WHEN bool_and({numeric}) THEN max_by(max, struct(max_number, max)) FILTER (WHERE max IS NOT NULL) ELSE max(max) END AS max",
        "min(min_number) AS min_number", "max(max_number) AS max_number", "sum(numbers) AS numbers", "any_value(_mean) AS mean",
        "sum(m2 + numbers * (mean - _mean) * (mean - _mean)) AS m2", "sum(sum) AS sum", "min(min_length) AS min_length", "max(max_length) AS max_length"]
    merged = common.groupBy(*keys).agg(*[F.expr(x) for x in e])
    return merged.select(*[c for c in states.columns if c in merged.columns])


def quantile_columns(probabilities: Iterable[float]) -> list[str]:
    """Expressions on a state's row: ``q50`` for 0.5 and so on; NULL without numbers."""
    return [f"CASE WHEN numbers > 0 THEN kll_sketch_get_quantile_double(quantile_sketch, CAST({p} AS DOUBLE)) END AS q{round(100 * p):02d}" for p in probabilities]


def save_states(df: DataFrame, path: str, part: str, quantiles: bool = True) -> None:
    """Summarise the rows of one part, and keep its states at ``path``; the same part again replaces them."""
    append_run(column_states(df, quantiles=quantiles), path, part, fmt="parquet")


def stored_states(spark: SparkSession, path: str, parts: Iterable[str] | None = None) -> DataFrame | None:
    """The merged states of all parts kept at ``path``, or of those named; no row of any part is read again."""
    found = read_runs(spark, path, runs=parts)
    return None if found is None else merge_states(found)
