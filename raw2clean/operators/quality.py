"""Data quality: rules with one outcome row each (D1, D2, D6, D7) and a
statistics profile with one row per column (D3).

All rules of a list are evaluated in ONE aggregate over the table; the
single metrics row is then unpivoted to outcome rows by ``inline`` on the
executors, so evaluation is one Spark job and nothing is collected.

Definitions (the legacy rule language leaves them open):

* EMPTY is NULL or the empty text. A CSV read turns an empty cell into NULL,
  so the two cannot be told apart in read data anyway.
* ``with threshold > t`` compares the share of rows that pass with ``t``.
* ``between a and b`` is exclusive unless ``inclusive=True``.
* A rule on a table without rows has no metric (NULL) and fails.

Profile statistics follow Schelter et al., "Automating Large-Scale Data
Quality Verification", PVLDB 11(12), 2018: row count, completeness, distinct
count, uniqueness, minimum, maximum, mean, standard deviation (sample) and
sum, with shortest and longest text added. Numeric statistics are over the
values that read as numbers; uniqueness is the share of non-NULL rows whose
value occurs exactly once. Statistics that are kept and merged from year to year
are in ``raw2clean.operators.states``.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from raw2clean.functions.rules import as_column, number, text
from raw2clean.operators.shape import value_pairs
from raw2clean.operators.states import column_states, is_numeric, quantile_columns

OUTCOME_SCHEMA = StructType([
    StructField("position", IntegerType(), False),
    StructField("rule", StringType(), False),
    StructField("outcome", StringType(), False),
    StructField("metric", DoubleType(), True),
    StructField("reason", StringType(), True),
])

PROFILE_SCHEMA = StructType([
    StructField("column", StringType(), False),
    StructField("type", StringType(), False),
    StructField("rows", LongType(), False),
    StructField("nulls", LongType(), False),
    StructField("completeness", DoubleType(), True),
    StructField("distinct", LongType(), True),
    StructField("uniqueness", DoubleType(), True),
    StructField("min", StringType(), True),
    StructField("max", StringType(), True),
    StructField("mean", DoubleType(), True),
    StructField("stddev", DoubleType(), True),
    StructField("sum", DoubleType(), True),
    StructField("min_length", IntegerType(), True),
    StructField("max_length", IntegerType(), True),
    StructField("distinct_is_exact", BooleanType(), False),
])

_OPS: dict[str, Callable[[Column, Column], Column]] = {
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
    "=": operator.eq, "!=": operator.ne,
}


@dataclass(frozen=True)
class QualityRule:
    """A rule: an aggregate metric over the table and a test of that metric."""

    text: str
    metric: Callable[[DataFrame], Column]
    passes: Callable[[Column], Column]
    expectation: str


def _compare(op: str, bound: float) -> Callable[[Column], Column]:
    if op not in _OPS:
        raise ValueError(f"unknown comparison {op!r}")
    return lambda m: _OPS[op](m, F.lit(float(bound)))


def _between(low: float, high: float, inclusive: bool) -> Callable[[Column], Column]:
    if inclusive:
        return lambda m: (m >= F.lit(float(low))) & (m <= F.lit(float(high)))
    return lambda m: (m > F.lit(float(low))) & (m < F.lit(float(high)))


def _num(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def is_empty(c: str | Column) -> Column:
    s = text(c)
    return s.isNull() | (s == F.lit(""))


def non_empty(column: str, threshold: float = 0.0, op: str = ">") -> QualityRule:
    """``ColumnValues "c" != EMPTY with threshold > t``."""
    return QualityRule(
        text=f'ColumnValues "{column}" != EMPTY with threshold {op} {_num(threshold)}',
        metric=lambda df: F.avg(F.when(is_empty(column), 0.0).otherwise(1.0)),
        passes=_compare(op, threshold),
        expectation=f"{op} {_num(threshold)}",
    )


def completeness(column: str, low: float | None = None, high: float | None = None,
                 op: str | None = None, bound: float | None = None,
                 inclusive: bool = False) -> QualityRule:
    """Share of non-NULL rows, ``between low and high`` or ``op bound``."""
    if op is not None:
        passes, expect = _compare(op, bound), f"{op} {_num(bound)}"
    else:
        passes, expect = _between(low, high, inclusive), f"between {_num(low)} and {_num(high)}"
    return QualityRule(
        text=f'Completeness "{column}" {expect}',
        metric=lambda df: F.avg(F.when(as_column(column).isNull(), 0.0).otherwise(1.0)),
        passes=passes,
        expectation=expect,
    )


def column_count(op: str, bound: int) -> QualityRule:
    """``ColumnCount > n``: the number of columns of the table."""
    return QualityRule(
        text=f"ColumnCount {op} {bound}",
        metric=lambda df: F.lit(float(len(df.columns))),
        passes=_compare(op, bound),
        expectation=f"{op} {bound}",
    )


def evaluate(df: DataFrame, rules: Sequence[QualityRule]) -> DataFrame:
    """One outcome row per rule, positions from 0, order and repeats kept.

    An empty rule list gives an empty outcome table (D4).
    """
    rules = list(rules)
    if not rules:
        return df.sparkSession.createDataFrame([], OUTCOME_SCHEMA)
    metrics = df.agg(*[r.metric(df).cast("double").alias(f"m{i}") for i, r in enumerate(rules)])
    rows = []
    for i, r in enumerate(rules):
        m = F.col(f"m{i}")
        ok = F.coalesce(r.passes(m), F.lit(False))
        reason = (F.when(ok, F.lit(None).cast("string"))
                  .when(m.isNull(), F.lit("no rows to measure"))
                  .otherwise(F.lit(f"metric does not satisfy {r.expectation}")))
        rows.append(F.struct(
            F.lit(i).alias("position"), F.lit(r.text).alias("rule"),
            F.when(ok, "Passed").otherwise("Failed").alias("outcome"),
            m.alias("metric"), reason.alias("reason")))
    return metrics.select(F.inline(F.array(*rows)))


def profile(df: DataFrame, columns: Iterable[str] | None = None, distinct: str | Iterable[str] = "approx") -> DataFrame:
    """D3: statistics of every column, one row each (``AllStatistics of AllColumns``).

    How distinct values are counted is the caller's word, whatever the table holds, and
    ``distinct_is_exact`` says it in each row:

    ``distinct="approx"`` (default): one pass without a value shuffle, from the columns' states (see
    ``states``); distinct counts are estimates (standard error 1.6 %), uniqueness is NULL.

    A list of names: the same, and these columns get exact counts and uniqueness from the frequencies of their
    values, a second scan that shuffles their distinct values.

    ``distinct="exact"``: exact for all columns, in ONE scan: every statistic comes
    from the frequencies of (column, value) pairs, which are shuffled.
    """
    columns = list(columns) if columns is not None else df.columns
    if distinct == "exact":
        return _profile_exact(df, columns)
    if isinstance(distinct, str) and distinct != "approx":
        raise ValueError(f"unknown distinct={distinct!r}")
    asked = [] if distinct == "approx" else list(distinct)
    if unknown := [c for c in asked if c not in columns]:
        raise ValueError(f"no such columns: {unknown}")
    summary = _from_states(column_states(df, columns)).withColumnRenamed("position", "i")
    if not asked:
        return _profile_rows(df, columns, summary.withColumn("singles", F.lit(None).cast("bigint")), F.lit(False))
    at = F.element_at(F.array(*[F.lit(columns.index(c)) for c in asked]), F.col("i") + 1)
    exact = (value_pairs(df, asked).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
             .groupBy(at.alias("i")).agg(F.count(F.lit(1)).alias("counted"), F.count_if(F.col("n") == 1).alias("singles")))
    is_asked = F.col("i").isin([columns.index(c) for c in asked])
    found = summary.join(F.broadcast(exact), "i", "left").withColumn(      # a row for each column asked for
        "distinct", F.when(is_asked, F.coalesce("counted", F.lit(0))).otherwise(F.col("distinct")))
    return _profile_rows(df, columns, found, is_asked)


def _from_states(states: DataFrame) -> DataFrame:
    """The statistics that states hold, one row for each."""
    return states.withColumns({
        "distinct": F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)), "smin": F.col("min"), "smax": F.col("max"), "nmin": F.col("min"), "nmax": F.col("max"),
        "stddev": F.when(F.col("numbers") > 1, F.sqrt(F.col("m2") / (F.col("numbers") - 1)))})


def profile_of_states(states: DataFrame, quantiles: Sequence[float] = ()) -> DataFrame:
    """D3 from (merged) states: the rows of ``profile(distinct="approx")``, in the columns' order, and quantiles if asked for."""
    rows, nulls = F.col("rows"), F.col("nulls")
    return _from_states(states).orderBy("position").select(
        "column", "type", "rows", "nulls", F.try_divide(rows - nulls, rows).alias("completeness"), "distinct", F.lit(None).cast("double").alias("uniqueness"),
        "min", "max", "mean", "stddev", "sum", "min_length", "max_length", F.lit(False).alias("distinct_is_exact"),
        *[F.expr(q) for q in quantile_columns(quantiles)])


def _column_info(columns: Sequence[str], types: dict[str, str]) -> tuple[Column, Column, Column]:
    """Name, type and is-numeric of column number ``i``, as expressions on ``i``."""
    idx = F.col("i") + 1
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), idx)
    tps = F.element_at(F.array(*[F.lit(types[c]) for c in columns]), idx)
    numeric = F.element_at(F.array(*[F.lit(is_numeric(types[c])) for c in columns]), idx)
    return names, tps, numeric


def _profile_exact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), as_column(c).cast("string").alias("v"))
        for i, c in enumerate(columns)
    ])))
    freq = (pairs.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("d", number("v")).withColumn("len", F.length("v")))
    n, v, d = F.col("n"), F.col("v"), F.col("d")
    per = freq.groupBy("i").agg(
        F.sum(n).alias("rows"),
        F.sum(F.when(v.isNull(), n).otherwise(0)).alias("nulls"),
        F.count(v).alias("distinct"),
        F.sum(F.when(v.isNotNull() & (n == 1), 1).otherwise(0)).alias("singles"),
        F.min(v).alias("smin"), F.max(v).alias("smax"),
        F.min_by(v, d).alias("nmin"), F.max_by(v, d).alias("nmax"),
        F.sum(n * d).alias("sum"),
        F.sum(F.when(d.isNotNull(), n)).alias("num_n"),
        F.min("len").alias("min_length"), F.max("len").alias("max_length"),
    ).withColumn("mean", F.col("sum") / F.col("num_n"))
    # second pass over the frequency table: sum of squared deviations (sums
    # skip the NULLs of non-numbers). No filter here: one pushed below the
    # aggregate would change the exchange and defeat its reuse.
    means = per.select("i", "mean")
    m2 = (freq.join(F.broadcast(means), "i")
          .groupBy("i").agg(F.sum(n * (d - F.col("mean")) * (d - F.col("mean"))).alias("m2")))
    spread = F.when(F.col("num_n") > 1, F.sqrt(F.col("m2") / (F.col("num_n") - 1)))
    return _profile_rows(df, columns, per.join(F.broadcast(m2), "i", "left").withColumn("stddev", spread), F.lit(True))


def _profile_rows(df: DataFrame, columns: Sequence[str], per: DataFrame, exact: Column) -> DataFrame:
    """One row per column, also for a table without rows (bounded by the column count)."""
    ids = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("i"))
    out = ids.join(F.broadcast(per), "i", "left")
    name, tp, is_num = _column_info(columns, dict(df.dtypes))
    rows = F.coalesce(F.col("rows"), F.lit(0)).cast("long")
    nulls = F.coalesce(F.col("nulls"), F.lit(0)).cast("long")
    return out.select(
        name.alias("column"), tp.alias("type"), rows.alias("rows"), nulls.alias("nulls"),
        F.try_divide(rows - nulls, rows).alias("completeness"),
        F.coalesce(F.col("distinct"), F.lit(0)).cast("long").alias("distinct"),
        F.when(rows > nulls, F.col("singles") / (rows - nulls)).alias("uniqueness"),
        F.when(is_num, F.col("nmin")).otherwise(F.col("smin")).alias("min"),
        F.when(is_num, F.col("nmax")).otherwise(F.col("smax")).alias("max"),
        F.col("mean").alias("mean"), F.col("stddev").alias("stddev"),
        F.col("sum").cast("double").alias("sum"),
        F.col("min_length").cast("int").alias("min_length"),
        F.col("max_length").cast("int").alias("max_length"),
        exact.alias("distinct_is_exact"),
    )


def run_checks(df: DataFrame, rules: Sequence[QualityRule] = (),
               statistics: bool = False, distinct: str | Sequence[str] = "approx") -> dict[str, DataFrame]:
    """D2 + D3 + D5: the named result tables of a check run (lazy DataFrames).

    ``results["rule_outcomes"]`` is the outcome table (the one the legacy jobs
    pick at index 0); ``results["statistics"]`` the profile when asked for.
    """
    out = {"rule_outcomes": evaluate(df, rules)}
    if statistics:
        out["statistics"] = profile(df, distinct=distinct)
    return out
