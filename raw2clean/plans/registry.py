"""Registered queries: one per operator, each with a DuckDB oracle.

Every query reads the given tables (mostly ``lineitem``, through the ``raw``
view of messy text columns that Spark derives from it) and runs over all of
their rows. ``ORACLE_SQL`` holds the equivalent SQL, written by hand, for
the same tables in DuckDB. Output column names match between the two.

Queries that write files (round trips, header promotion, folder merge,
stream) write below the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.functions import rules as R
from raw2clean.operators import dedup, quality, shape
from raw2clean.plans import ruleset as RS
from raw2clean.plans.ruleset import RuleSet
from raw2clean.plans.survey_rules import era_sql
from raw2clean.plans.survey_rules import quoted as _q
from raw2clean.session import for_wide_rules, shuffles_freed
from raw2clean.sources import io

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
RAW_TEXT = ["code", "state_code", "county_code", "tract", "amount", "label", "age"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``raw`` view: messy text columns made from every ``lineitem`` row."""
    l = table(spark, sf_dir, "lineitem")
    s = lambda c: c.cast("string")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    return l.select(
        *KEYS,
        s(F.col("l_linenumber")).alias("code"),
        F.when(pk % 10 == 0, F.lit(None).cast("string")).otherwise(s(sk % 57)).alias("state_code"),
        s(pk % 200).alias("county_code"),
        F.when(ok % 5 == 0, F.concat(s(pk), F.lit("."), F.lpad(s(sk % 100), 2, "0")))
         .when(ok % 5 == 1, F.lit("NA")).otherwise(s(pk)).alias("tract"),
        F.when(ok % 11 == 0, "NA").when(ok % 11 == 1, "EXEMPT").when(ok % 11 == 2, "-5")
         .when(ok % 11 == 3, "abc").when(ok % 11 == 4, "").otherwise(s(sk)).alias("amount"),
        F.when(pk % 4 == 0, "Male").when(pk % 4 == 1, "Female")
         .when(pk % 4 == 2, "Not applicable").otherwise("x1").alias("label"),
        F.when(ok % 6 == 0, "25-34").when(ok % 6 == 1, "8888").when(ok % 6 == 2, "<25")
         .when(ok % 6 == 3, "NA").otherwise(s(sk)).alias("age"),
    )


RAW_SQL = """WITH raw AS (
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CAST(l_linenumber AS STRING) AS code,
 CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(l_suppkey % 57 AS STRING) END AS state_code,
 CAST(l_partkey % 200 AS STRING) AS county_code,
 CASE l_orderkey % 5 WHEN 0 THEN CONCAT(CAST(l_partkey AS STRING), '.', LPAD(CAST(l_suppkey % 100 AS STRING), 2, '0')) WHEN 1 THEN 'NA' ELSE CAST(l_partkey AS STRING) END AS tract,
 CASE l_orderkey % 11 WHEN 0 THEN 'NA' WHEN 1 THEN 'EXEMPT' WHEN 2 THEN '-5' WHEN 3 THEN 'abc' WHEN 4 THEN '' ELSE CAST(l_suppkey AS STRING) END AS amount,
 CASE l_partkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Not applicable' ELSE 'x1' END AS label,
 CASE l_orderkey % 6 WHEN 0 THEN '25-34' WHEN 1 THEN '8888' WHEN 2 THEN '<25' WHEN 3 THEN 'NA' ELSE CAST(l_suppkey AS STRING) END AS age
 FROM lineitem
)
"""

K = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _with_keys(spark, sf_dir, rules: dict) -> DataFrame:
    return RuleSet(rules).apply(raw(spark, sf_dir), keep=KEYS)


def _sql(body: str) -> str:
    return RAW_SQL + body


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None):
    def deco(fn):
        Q[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle
        return fn
    return deco


# --- R2 / R3 / R4 / R5 --------------------------------------------------------

@query("keep_codes", _sql(f"""SELECT {K},
 CASE WHEN code IN ('1', '2', '3', '4') THEN code ELSE NULL END AS code,
 CASE WHEN label IN ('Male', 'Female') THEN label ELSE NULL END AS label
 FROM raw"""))
def q_keep_codes(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"code": R.keep_codes(["1", "2", "3", "4"]),
                                      "label": R.keep_codes(["Male", "Female"])})


@query("keep_and_relabel", _sql(f"""SELECT {K},
 CASE WHEN label IN ('Male', 'Female') THEN label WHEN label = 'Not applicable' THEN 'NA' ELSE NULL END AS label
 FROM raw"""))
def q_keep_and_relabel(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"label": R.keep_and_relabel(["Male", "Female"], {"Not applicable": "NA"})})


@query("text_without_digits", _sql(f"""SELECT {K},
 CASE WHEN regexp_matches(label, '^[^0-9]+$') THEN label ELSE NULL END AS label,
 CASE WHEN regexp_matches(amount, '^[^0-9]+$') THEN amount ELSE NULL END AS amount
 FROM raw"""))
def q_text_without_digits(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"label": R.text_without_digits(), "amount": R.text_without_digits()})


@query("digits_or_sentinel", _sql(f"""SELECT {K},
 CASE WHEN regexp_matches(amount, '^[0-9]+$') OR amount IN ('NA') THEN amount ELSE NULL END AS amount,
 CASE WHEN regexp_matches(tract, '^[0-9]+$') THEN tract ELSE NULL END AS tract
 FROM raw"""))
def q_digits_or_sentinel(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"amount": R.digits(["NA"]), "tract": R.digits()})


# --- R6 / R7 / R10 / R8 / R9 ----------------------------------------------------

@query("numeric_any", _sql(f"""SELECT {K},
 CASE WHEN try_cast(amount AS DOUBLE) IS NOT NULL THEN amount ELSE NULL END AS amount,
 CASE WHEN try_cast(tract AS DOUBLE) IS NOT NULL THEN tract ELSE NULL END AS tract
 FROM raw"""))
def q_numeric_any(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"amount": R.numeric(), "tract": R.numeric()})


@query("numeric_non_negative", _sql(f"""SELECT {K},
 CASE WHEN try_cast(amount AS DOUBLE) >= 0 THEN amount ELSE NULL END AS amount
 FROM raw"""))
def q_numeric_non_negative(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"amount": R.numeric(low=0)})


@query("numeric_upper_bound", _sql(f"""SELECT {K},
 CASE WHEN try_cast(amount AS DOUBLE) <= 50 THEN amount ELSE NULL END AS amount,
 CASE WHEN try_cast(age AS DOUBLE) <= 100 THEN age ELSE NULL END AS age
 FROM raw"""))
def q_numeric_upper_bound(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"amount": R.numeric(high=50), "age": R.numeric(high=100)})


@query("numeric_or_sentinel", _sql(f"""SELECT {K},
 CASE WHEN try_cast(amount AS DOUBLE) IS NOT NULL OR amount IN ('NA', 'EXEMPT') THEN amount ELSE NULL END AS amount
 FROM raw"""))
def q_numeric_or_sentinel(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"amount": R.numeric(sentinels=["NA", "EXEMPT"])})


@query("non_negative_or_sentinel", _sql(f"""SELECT {K},
 CASE WHEN try_cast(amount AS DOUBLE) >= 0 OR amount IN ('NA', 'EXEMPT') THEN amount ELSE NULL END AS amount,
 CASE WHEN try_cast(age AS DOUBLE) >= 0 OR age IN ('NA', 'EXEMPT') THEN age ELSE NULL END AS age
 FROM raw"""))
def q_non_negative_or_sentinel(spark, sf_dir):
    rule = R.numeric(low=0, sentinels=["NA", "EXEMPT"])
    return _with_keys(spark, sf_dir, {"amount": rule, "age": rule})


# --- R11 / R12 / R12b / R13 -----------------------------------------------------

@query("integer_text_length", _sql(f"""SELECT {K},
 CASE WHEN try_cast(regexp_replace(trim(tract), '[.][0-9]*$', '') AS BIGINT) IS NOT NULL
       AND length(tract) IN (4, 6, 7) THEN tract ELSE NULL END AS tract
 FROM raw"""))
def q_integer_text_length(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"tract": R.integer_text([4, 6, 7])})


@query("text_length", _sql(f"""SELECT {K},
 CASE WHEN length(county_code) >= 2 AND county_code NOT LIKE '%[^A-Za-z]%' THEN county_code ELSE NULL END AS county_code,
 CASE WHEN (length(state_code) = 2 AND state_code NOT LIKE '%[^A-Za-z]%') OR state_code IN ('NA', 'EXEMPT') THEN state_code ELSE NULL END AS state_code
 FROM raw"""))
def q_text_length(spark, sf_dir):
    lit = "%[^A-Za-z]%"
    return _with_keys(spark, sf_dir, {
        "county_code": R.text_length(min_length=2, not_like=lit),
        "state_code": R.text_length(exact=2, not_like=lit, sentinels=["NA", "EXEMPT"]),
    })


@query("text_length_charset", _sql(f"""SELECT {K},
 CASE WHEN length(label) >= 4 AND regexp_matches(label, '^[A-Za-z]+$') THEN label ELSE NULL END AS label,
 CASE WHEN length(state_code) = 2 AND state_code LIKE '%[^A-Za-z]%' THEN state_code ELSE NULL END AS state_abbr
 FROM raw"""))
def q_text_length_charset(spark, sf_dir):
    return _with_keys(spark, sf_dir, {
        "label": R.text_length(min_length=4, charset="A-Za-z"),
        # the legacy LIKE test: always NULL, since no text holds the literal class
        "state_abbr": R.Rule("text_length", R.text_length(exact=2, like="%[^A-Za-z]%").build,
                             inputs=("state_code",)),
    })


@query("range_or_number", _sql(f"""SELECT {K},
 CASE WHEN (regexp_matches(age, '^[0-9]+-[0-9]+$') OR try_cast(age AS DOUBLE) IS NOT NULL OR age IN ('NA', 'EXEMPT'))
       AND age NOT IN ('8888', '9999') THEN age ELSE NULL END AS age
 FROM raw"""))
def q_range_or_number(spark, sf_dir):
    return _with_keys(spark, sf_dir, {"age": R.range_or_number(["NA", "EXEMPT"], ["8888", "9999"])})


# --- R14 --------------------------------------------------------------------------

_TRACT_NULL = "state_code IS NULL OR county_code IS NULL OR tract IS NULL"

# The fixed-width code, written for DuckDB with right() and strpos() instead of lpad.
_POINT = "strpos(tract, '.') > 0"
_WHOLE = "ltrim(CASE WHEN " + _POINT + " THEN left(tract, strpos(tract, '.') - 1) ELSE tract END, '0')"
_DECIMALS = "rtrim(CASE WHEN " + _POINT + " THEN substr(tract, strpos(tract, '.') + 1) ELSE '' END, '0')"
TRACT_FIXED_SQL = f"""CASE WHEN {_TRACT_NULL} OR length(state_code) > 2 OR length(county_code) > 3
   OR NOT regexp_full_match(tract, '[0-9]+([.][0-9]*)?') THEN NULL
  WHEN {_POINT} OR length(tract) < 5 THEN CASE WHEN length({_WHOLE}) < 5 AND length({_DECIMALS}) < 3 THEN
     right('00' || state_code, 2) || right('000' || county_code, 3) || right('0000' || {_WHOLE}, 4) || left({_DECIMALS} || '00', 2) END
  WHEN length(tract) < 7 THEN right('00' || state_code, 2) || right('000' || county_code, 3) || right('0' || tract, 6) END"""


@query("tract_code_fixed", _sql(f"""SELECT {K}, {TRACT_FIXED_SQL} AS census_tract FROM (SELECT {K},
 CASE WHEN l_orderkey % 13 = 0 THEN concat('1', state_code, '9') ELSE state_code END AS state_code,
 CASE WHEN l_orderkey % 13 = 1 THEN concat('12', county_code, '9') ELSE county_code END AS county_code,
 CASE l_orderkey % 9 WHEN 0 THEN concat('9', tract) WHEN 1 THEN concat('00', tract) WHEN 2 THEN concat(tract, '00') WHEN 3 THEN concat(tract, '.129')
   WHEN 4 THEN '1234567' WHEN 5 THEN concat(l_linenumber, '.5') ELSE tract END AS tract FROM raw) t"""))
def q_tract_code_fixed(spark, sf_dir):
    s = lambda c: F.col(c).cast("string")
    k, t = F.col("l_orderkey") % 9, F.col("tract")
    odd = raw(spark, sf_dir).select(
        *KEYS,
        F.when(F.col("l_orderkey") % 13 == 0, F.concat(F.lit("1"), F.coalesce("state_code", F.lit("")), F.lit("9"))).otherwise(F.col("state_code")).alias("state_code"),
        F.when(F.col("l_orderkey") % 13 == 1, F.concat(F.lit("12"), "county_code", F.lit("9"))).otherwise(F.col("county_code")).alias("county_code"),
        F.when(k == 0, F.concat(F.lit("9"), t)).when(k == 1, F.concat(F.lit("00"), t)).when(k == 2, F.concat(t, F.lit("00")))
         .when(k == 3, F.concat(t, F.lit(".129"))).when(k == 4, "1234567").when(k == 5, F.concat(s("l_linenumber"), F.lit(".5"))).otherwise(t).alias("tract"))
    return RuleSet({"census_tract": R.tract_code("state_code", "county_code", "tract")}).apply(odd, keep=KEYS)


@query("tract_code_truncate", _sql(f"""SELECT {K},
 CASE WHEN {_TRACT_NULL} THEN NULL ELSE
   lpad(state_code, 2, '0') || lpad(county_code, 3, '0') || lpad(
     CASE WHEN tract LIKE '%.%' THEN CAST(CAST(trunc(try_cast(tract AS DOUBLE)) AS BIGINT) AS VARCHAR)
          ELSE tract END, 6, '0') END AS census_tract
 FROM raw"""))
def q_tract_code_truncate(spark, sf_dir):
    return _with_keys(spark, sf_dir, {
        "census_tract": R.tract_code("state_code", "county_code", "tract", style="truncate")})


# --- R15-R20 ---------------------------------------------------------------------

def _sentinel_sql(c: str, values: str) -> str:
    return f"CASE WHEN {c} IN ({values}) THEN NULL ELSE {c} END AS {c}"


_SENT = "'-888888888', '(X)', '', 'NA'"


@query("null_sentinels", _sql("SELECT " + K + ", " + ", ".join(_sentinel_sql(c, _SENT) for c in RAW_TEXT)
                              + " FROM raw"))
def q_null_sentinels(spark, sf_dir):
    return shape.null_sentinels(raw(spark, sf_dir), list(shape.SURVEY_SENTINELS) + ["NA"])


@query("string_table", _sql("""SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
 CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey,
 CAST(l_suppkey AS VARCHAR) AS l_suppkey, code, label FROM raw"""))
def q_string_table(spark, sf_dir):
    return RS.cast_to_string(raw(spark, sf_dir).select(*KEYS, "code", "label"))


@query("trim_strings", _sql(f"""SELECT {K}, trim(concat(' ', label, '  ')) AS label,
 trim(concat(amount, ' ')) AS amount FROM raw"""))
def q_trim_strings(spark, sf_dir):
    padded = raw(spark, sf_dir).select(
        *KEYS, F.concat(F.lit(" "), "label", F.lit("  ")).alias("label"),
        F.concat("amount", F.lit(" ")).alias("amount"))
    return RS.trim_strings(padded)


@query("numeric_except", _sql(f"SELECT {K}, " + ", ".join(
    f"CASE WHEN try_cast({c} AS DOUBLE) IS NOT NULL THEN {c} ELSE NULL END AS {c}"
    for c in RAW_TEXT if c != "label") + ", label FROM raw"))
def q_numeric_except(spark, sf_dir):
    return RS.numeric_except(raw(spark, sf_dir), exclude=KEYS + ["label"])


@query("non_negative_columns", _sql(f"SELECT {K}, code, state_code, county_code, "
                                    "CASE WHEN try_cast(tract AS DOUBLE) >= 0 THEN tract ELSE NULL END AS tract, "
                                    "CASE WHEN try_cast(amount AS DOUBLE) >= 0 THEN amount ELSE NULL END AS amount, "
                                    "label, CASE WHEN try_cast(age AS DOUBLE) >= 0 THEN age ELSE NULL END AS age "
                                    "FROM raw"))
def q_non_negative_columns(spark, sf_dir):
    return RS.non_negative(raw(spark, sf_dir), ["tract", "amount", "age"])


@query("keep_one_column", _sql("SELECT CASE WHEN code IN ('1', '2', '3') THEN code ELSE NULL END AS code FROM raw"))
def q_keep_one_column(spark, sf_dir):
    return RS.keep_one_column(raw(spark, sf_dir), "code", ["1", "2", "3"])


# --- R21 + P1 + G5: the flagship --------------------------------------------------

def clean_rules() -> RuleSet:
    return RuleSet({
        "code": R.keep_codes(["1", "2", "3", "4"]),
        "state_code": R.text_length(min_length=1, not_like="%[^A-Za-z]%"),
        "county_code": R.numeric(low=0),
        "tract": R.numeric(),
        "census_tract": R.tract_code("state_code", "county_code", "tract"),
        "amount": R.numeric(low=0, sentinels=["NA", "EXEMPT"]),
        "label": R.keep_and_relabel(["Male", "Female"], {"Not applicable": "NA"}),
        "age": R.range_or_number(["NA", "EXEMPT"], ["8888", "9999"]),
    }, name="clean_table")


CLEAN_SQL = _sql("""SELECT DISTINCT * FROM (SELECT
 CASE WHEN code IN ('1', '2', '3', '4') THEN code ELSE NULL END AS code,
 CASE WHEN length(state_code) >= 1 AND state_code NOT LIKE '%[^A-Za-z]%' THEN state_code ELSE NULL END AS state_code,
 CASE WHEN try_cast(county_code AS DOUBLE) >= 0 THEN county_code ELSE NULL END AS county_code,
 CASE WHEN try_cast(tract AS DOUBLE) IS NOT NULL THEN tract ELSE NULL END AS tract,
 """ + TRACT_FIXED_SQL + """ AS census_tract,
 CASE WHEN try_cast(amount AS DOUBLE) >= 0 OR amount IN ('NA', 'EXEMPT') THEN amount ELSE NULL END AS amount,
 CASE WHEN label IN ('Male', 'Female') THEN label WHEN label = 'Not applicable' THEN 'NA' ELSE NULL END AS label,
 CASE WHEN (regexp_matches(age, '^[0-9]+-[0-9]+$') OR try_cast(age AS DOUBLE) IS NOT NULL OR age IN ('NA', 'EXEMPT'))
       AND age NOT IN ('8888', '9999') THEN age ELSE NULL END AS age
 FROM raw) t
 WHERE COALESCE(code, state_code, county_code, tract, census_tract, amount, label, age) IS NOT NULL""")


@query("clean_table", CLEAN_SQL)
def q_clean_table(spark, sf_dir):
    from raw2clean.plans.jobs import clean
    return clean(raw(spark, sf_dir), clean_rules())


# --- G5 / G6 / W1 ------------------------------------------------------------------

@query("distinct_rows", _sql("SELECT DISTINCT code, state_code, label, age FROM raw"))
def q_distinct_rows(spark, sf_dir):
    return dedup.distinct_rows(raw(spark, sf_dir).select("code", "state_code", "label", "age"))


@query("distinct_rows_by_hashes", _sql("SELECT DISTINCT code, label, state_code, amount, age, tract FROM raw"))
def q_distinct_rows_by_hashes(spark, sf_dir):
    return dedup.distinct_rows(raw(spark, sf_dir).select("code", "label", "state_code", "amount", "age", "tract"), method="hashes")


_DEDUP_COLS = ["code", "label", "state_code", "amount", "age", "tract", "l_orderkey", "l_linenumber"]


@query("dedup_by_key", _sql("""SELECT code, label, state_code, amount, age, tract, l_orderkey, l_linenumber FROM (
 SELECT *, row_number() OVER (PARTITION BY code, label ORDER BY state_code NULLS FIRST, amount NULLS FIRST,
   age NULLS FIRST, tract NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST) AS rn FROM raw) t
 WHERE rn = 1"""))
def q_dedup_by_key(spark, sf_dir):
    return dedup.dedup_by_key(raw(spark, sf_dir).select(*_DEDUP_COLS), ["code", "label"])


@query("dedup_by_key_row_number", ORACLE_SQL["dedup_by_key"])
def q_dedup_by_key_row_number(spark, sf_dir):
    return dedup.dedup_by_key(raw(spark, sf_dir).select(*_DEDUP_COLS), ["code", "label"], method="row_number")


# --- G6 from year to year: halves of the table one after the other ----------------------

_YEAR_KEYS = ["state_code", "county_code", "age", "label"]


@query("dedup_against_table", _sql(f"""SELECT {', '.join(_DEDUP_COLS)}, county_code FROM (
 SELECT *, row_number() OVER (PARTITION BY {', '.join(_YEAR_KEYS)} ORDER BY l_orderkey % 2, code NULLS FIRST, amount NULLS FIRST,
   tract NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST) AS rn FROM raw) t WHERE rn = 1"""))
def q_dedup_against_table(spark, sf_dir):
    """Two halves as two runs, each of them twice: the rows that a dedup of all keeps, the first half before the second."""
    from uuid import uuid4

    from raw2clean.operators.key_table import KeyTable, dedup_run
    from raw2clean.sources.runs import read_runs
    path, rows = io.work_dir(spark, "dedup-years"), raw(spark, sf_dir).select(*_DEDUP_COLS, "county_code")
    table = KeyTable(spark, f"keys_{uuid4().hex[:12]}", _YEAR_KEYS, buckets=16)
    try:
        for half in (0, 1, 1, 0):
            dedup_run(table, rows.where(F.col("l_orderkey") % 2 == half), str(half), path)
    finally:
        table.drop()
    return read_runs(spark, path)


_ALL_RAW = KEYS + RAW_TEXT


@query("top_n_per_group", _sql(f"SELECT {', '.join(_ALL_RAW)} FROM (SELECT *, row_number() OVER ("
                               "PARTITION BY county_code ORDER BY "
                               + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '999999')" for c in _ALL_RAW)
                               + ") AS rn FROM raw) t WHERE rn = 1"))
def q_top_n_per_group(spark, sf_dir):
    return dedup.top_n_per_group(raw(spark, sf_dir), "county_code", null_as="999999")


# --- C1 / C2 / C3 --------------------------------------------------------------------

@query("drop_null_columns", _sql(f"SELECT {K}, code, label FROM raw"))
def q_drop_null_columns(spark, sf_dir):
    cleaned = _with_keys(spark, sf_dir, {
        "code": R.passthrough(),
        # legacy two-letter test with a literal LIKE: NULL in every row, so dropped
        "state_abbr": R.Rule("text_length", R.text_length(exact=2, like="%[^A-Za-z]%").build,
                             inputs=("state_code",)),
        "label": R.passthrough(),
    })
    return shape.drop_null_columns(cleaned)


@query("drop_empty_columns", _sql(f"""SELECT {K},
 CASE WHEN amount IN ('-888888888', '(X)', '') THEN NULL ELSE amount END AS amount FROM raw"""))
def q_drop_empty_columns(spark, sf_dir):
    df = raw(spark, sf_dir).select(
        *KEYS, "amount",
        # a column holding only "no value" sentinels
        F.when(F.col("l_orderkey") % 2 == 0, "(X)").otherwise("-888888888").alias("flag"))
    return shape.drop_empty_columns(shape.null_sentinels(df))


_HC = ["x_code", "x_label", "x_county", "x_age", "x_state"]
_HC_SRC = {"x_code": "code", "x_label": "label", "x_county": "county_code", "x_age": "age",
           "x_state": "state_code"}


def _hc_frame(spark, sf_dir):
    return raw(spark, sf_dir).select(
        *KEYS, F.col("code").alias("x_code"), F.col("label").alias("x_label"),
        F.col("county_code").alias("x_county"), F.col("age").alias("x_age"),
        F.col("state_code").alias("x_state"), "amount")


@query("blank_high_cardinality", _sql(
    "SELECT " + K + ", amount, " + ", ".join(
        f"CASE WHEN (SELECT count(DISTINCT {_HC_SRC[c]}) FROM raw) > 20 "
        f"THEN CAST(NULL AS VARCHAR) ELSE {c} END AS {c}"
        for c in _HC)
    + " FROM (SELECT *, code AS x_code, label AS x_label, county_code AS x_county, age AS x_age,"
      " state_code AS x_state FROM raw) t"))
def q_blank_high_cardinality(spark, sf_dir):
    return shape.blank_high_cardinality(_hc_frame(spark, sf_dir), prefix="x_", threshold=20)


# --- U1 / U2 / C6 (in memory) ---------------------------------------------------------

@query("merge_by_name", _sql(f"""SELECT {K}, code, label, '1992' AS Year FROM raw
 UNION ALL BY NAME
 SELECT o_orderkey AS l_orderkey, o_orderstatus AS label, o_orderpriority AS priority, '1993' AS Year FROM orders"""))
def q_merge_by_name(spark, sf_dir):
    a = raw(spark, sf_dir).select(*KEYS, "code", "label", F.lit("1992").alias("Year"))
    b = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("label"),
        F.col("o_orderpriority").alias("priority"), F.lit("1993").alias("Year"))
    return shape.merge_by_name([a, b])


# --- D1 / D2 / D6 / D7 / D3 ----------------------------------------------------------------

def _outcome_sql(pos: int, rule: str, metric_sql: str, test: str, expect: str,
                 source: str = " FROM q") -> str:
    rule_sql = rule.replace("'", "''")
    return (f"SELECT {pos} AS position, '{rule_sql}' AS rule, "
            f"CASE WHEN coalesce(m {test}, false) THEN 'Passed' ELSE 'Failed' END AS outcome, m AS metric, "
            f"CASE WHEN coalesce(m {test}, false) THEN NULL WHEN m IS NULL THEN 'no rows to measure' "
            f"ELSE 'metric does not satisfy {expect}' END AS reason "
            f"FROM (SELECT CAST({metric_sql} AS DOUBLE) AS m{source}) s")


_NE_COLS = ["amount", "state_code", "label", "empty_col", "amount"]


def _quality_frame(spark, sf_dir):
    return raw(spark, sf_dir).withColumn(
        "empty_col", F.when(F.col("amount") == "abc", F.lit("")).otherwise(F.lit(None).cast("string")))


_QF = ", CASE WHEN amount = 'abc' THEN '' ELSE NULL END AS empty_col"


@query("quality_non_empty", _sql(f", q AS (SELECT *{_QF} FROM raw)\n" + " UNION ALL ".join(
    _outcome_sql(i, f'ColumnValues "{c}" != EMPTY with threshold > 0',
                 f"avg(CASE WHEN {c} IS NULL OR {c} = '' THEN 0.0 ELSE 1.0 END)", "> 0", "> 0")
    for i, c in enumerate(_NE_COLS))))
def q_quality_non_empty(spark, sf_dir):
    return quality.evaluate(_quality_frame(spark, sf_dir), [quality.non_empty(c) for c in _NE_COLS])


@query("quality_completeness", _sql(", q AS (SELECT * FROM raw)\n" + " UNION ALL ".join([
    _outcome_sql(0, 'Completeness "state_code" between 0.4 and 0.8',
                 "avg(CASE WHEN state_code IS NULL THEN 0.0 ELSE 1.0 END)", "> 0.4 AND m < 0.8",
                 "between 0.4 and 0.8"),
    _outcome_sql(1, 'Completeness "state_code" between 0.8 and 1',
                 "avg(CASE WHEN state_code IS NULL THEN 0.0 ELSE 1.0 END)", "> 0.8 AND m < 1.0",
                 "between 0.8 and 1"),
    _outcome_sql(2, 'Completeness "code" between 0.8 and 1',
                 "avg(CASE WHEN code IS NULL THEN 0.0 ELSE 1.0 END)", "> 0.8 AND m < 1.0",
                 "between 0.8 and 1"),
])))
def q_quality_completeness(spark, sf_dir):
    return quality.evaluate(raw(spark, sf_dir), [
        quality.completeness("state_code", 0.4, 0.8),
        quality.completeness("state_code", 0.8, 1.0),
        quality.completeness("code", 0.8, 1.0),
    ])


_N_COLUMNS = "(SELECT count(*) FROM (DESCRIBE " + _sql("SELECT * FROM raw") + ") c)"


@query("quality_column_count", _sql(", q AS (SELECT * FROM raw)\n" + " UNION ALL ".join([
    _outcome_sql(0, "ColumnCount > 10", _N_COLUMNS, "> 10", "> 10", source=""),
    _outcome_sql(1, "ColumnCount > 20", _N_COLUMNS, "> 20", "> 20", source=""),
    _outcome_sql(2, 'ColumnValues "state_code" != EMPTY with threshold > 0',
                 "avg(CASE WHEN state_code IS NULL OR state_code = '' THEN 0.0 ELSE 1.0 END)", "> 0", "> 0"),
])))
def q_quality_column_count(spark, sf_dir):
    return quality.evaluate(raw(spark, sf_dir), [quality.column_count(">", 10), quality.column_count(">", 20), quality.non_empty("state_code")])


# No rules give no outcomes, beside those of another list

@query("quality_no_rules", _sql(", q AS (SELECT * FROM raw)\n" + _outcome_sql(
    0, 'ColumnValues "code" != EMPTY with threshold > 0', "avg(CASE WHEN code IS NULL OR code = '' THEN 0.0 ELSE 1.0 END)", "> 0", "> 0")))
def q_quality_no_rules(spark, sf_dir):
    none = quality.run_checks(raw(spark, sf_dir), [])["rule_outcomes"]
    return none.union(quality.evaluate(raw(spark, sf_dir), [quality.non_empty("code")]))


def _profile_sql(i: int, c: str, typ: str) -> str:
    d = f"try_cast(CAST({c} AS VARCHAR) AS DOUBLE)"
    n = f"length(CAST({c} AS VARCHAR))"
    return (f"SELECT '{c}' AS \"column\", '{typ}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls, "
            f"count({c}) / count(*) AS completeness, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM raw WHERE {c} IS NOT NULL)) AS \"distinct\", "
            f"(SELECT CASE WHEN sum(n) > 0 THEN sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n) END FROM "
            f"(SELECT count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY {c})) AS uniqueness, "
            f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, "
            f"round(avg({d}), 6) AS mean, round(stddev_samp({d}), 6) AS stddev, round(sum({d}), 6) AS sum, "
            f"CAST(min({n}) AS INTEGER) AS min_length, CAST(max({n}) AS INTEGER) AS max_length, true AS distinct_is_exact FROM raw")


_RAW_TYPES = {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint"}


@query("profile_columns", _sql(" UNION ALL ".join(
    _profile_sql(i, c, _RAW_TYPES.get(c, "string")) for i, c in enumerate(_ALL_RAW))))
def q_profile_columns(spark, sf_dir):
    p = quality.profile(raw(spark, sf_dir), distinct="exact")
    return p.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "sum")})


_SMALL_RAW = ["l_linenumber", "code", "state_code", "label"]
_PROFILES = " UNION ALL ".join(_profile_sql(i, c, _RAW_TYPES.get(c, "string")) for i, c in enumerate(_ALL_RAW))
_SMALL_SQL = "\"column\" IN (" + ", ".join(f"'{c}'" for c in _SMALL_RAW) + ")"


def _near(p: DataFrame, exact: DataFrame) -> DataFrame:
    """The profile with ``distinct_near``: whether its count lies within three standard errors of the exact one."""
    from raw2clean.operators.states import DISTINCT_ERROR
    true = exact.select("column", F.col("distinct").alias("_true"))
    off = F.abs(F.col("distinct") - F.col("_true"))
    return p.join(F.broadcast(true), "column").withColumn("distinct_near", off <= 3 * DISTINCT_ERROR * F.col("_true") + 1).drop("_true")


@query("profile_columns_auto", _sql(f"SELECT * EXCLUDE (\"distinct\", uniqueness, distinct_is_exact), CASE WHEN {_SMALL_SQL} THEN \"distinct\" END AS \"distinct\", "
                                    f"CASE WHEN {_SMALL_SQL} THEN uniqueness END AS uniqueness, {_SMALL_SQL} AS distinct_is_exact, true AS distinct_near "
                                    f"FROM ({_PROFILES}) t"))
def q_profile_columns_auto(spark, sf_dir):
    """Exact counts of the columns named, estimates of the others: those are compared by their error."""
    rows = raw(spark, sf_dir)
    p = _near(quality.profile(rows, distinct=_SMALL_RAW), quality.profile(rows, distinct="exact"))
    return p.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "sum")} | {
        c: F.when(F.col("distinct_is_exact"), F.col(c)) for c in ("distinct", "uniqueness")})


@query("profile_merged_states", _sql("SELECT * EXCLUDE (\"distinct\", uniqueness, distinct_is_exact), true AS distinct_near, CASE WHEN mean IS NOT NULL THEN true END AS median_near "
                                     f"FROM ({_PROFILES}) t"))
def q_profile_merged_states(spark, sf_dir):
    """Four parts summarised one by one, one of them twice, their states kept and merged: the profile of all rows."""
    from raw2clean.operators.states import RANK_ERROR, save_states, stored_states
    path, rows = io.work_dir(spark, "states"), raw(spark, sf_dir)
    for part in (0, 1, 2, 3, 1):
        save_states(rows.where(F.col("l_orderkey") % 4 == part), path, str(part))
    p = quality.profile_of_states(stored_states(spark, path), quantiles=[0.5])
    p = _near(p, quality.profile(rows, distinct="exact")).withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "sum")})
    # the share of numbers below the median and up to it, counted in all rows
    medians = p.select("column", "q50")
    numbers = rows.selectExpr("inline(array(" + ", ".join(f"named_struct('column', '{c}', 'v', CAST({c} AS STRING))" for c in _ALL_RAW) + "))").select(
        "column", R.number("v").alias("d")).where("d IS NOT NULL")
    ranks = numbers.join(F.broadcast(medians), "column").groupBy("column").agg(
        ((F.avg((F.col("d") < F.col("q50")).cast("double")) <= 0.5 + 2 * RANK_ERROR)
         & (F.avg((F.col("d") <= F.col("q50")).cast("double")) >= 0.5 - 2 * RANK_ERROR)).alias("median_near"))
    return p.join(F.broadcast(ranks), "column", "left").drop("distinct", "uniqueness", "distinct_is_exact", "q50")


# --- S6-S9: write and read back --------------------------------------------------------

RAW_STRINGS_SQL = _sql("SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, "
                       "CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey, "
                       "code, state_code, county_code, tract, amount, label, age FROM raw")


# A CSV read gives NULL for an empty cell, quoted or not (Spark's default
# ``nullValue`` is the empty text), so empty text comes back as NULL.
@query("round_trip_csv", _sql(
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, "
    "CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey, "
    + ", ".join(f"NULLIF({c}, '') AS {c}" for c in RAW_TEXT) + " FROM raw"))
def q_round_trip_csv(spark, sf_dir):
    path = io.work_dir(spark, "csv")
    io.write_table(raw(spark, sf_dir), path, fmt="csv")
    return io.read_table(spark, path)


@query("round_trip_json", _sql("SELECT * FROM raw"))
def q_round_trip_json(spark, sf_dir):
    df = raw(spark, sf_dir)
    path = io.work_dir(spark, "json")
    io.write_table(df, path, fmt="json")
    return spark.read.schema(df.schema).json(path)


@query("round_trip_parquet", _sql("SELECT * FROM raw"))
def q_round_trip_parquet(spark, sf_dir):
    path = io.work_dir(spark, "parquet")
    io.write_table(raw(spark, sf_dir), path, fmt="parquet")
    return spark.read.parquet(path)


# --- S6 again: runs that can be repeated ------------------------------------------------

_RUN_COLS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in KEYS) + ", " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in RAW_TEXT)


@query("append_runs", _sql(f"SELECT {_RUN_COLS}, CAST(NULL AS VARCHAR) AS note, CAST(l_orderkey % 3 AS VARCHAR) AS run FROM raw WHERE l_orderkey % 3 <> 1\n"
                           f"UNION ALL SELECT {_RUN_COLS}, 'again' AS note, '1' AS run FROM raw WHERE l_orderkey % 3 = 1 AND l_linenumber <> 2"))
def q_append_runs(spark, sf_dir):
    """Three runs, one of them twice with other rows and a column more, and an attempt that is never committed."""
    from raw2clean.sources import runs
    path, rows = io.work_dir(spark, "runs"), raw(spark, sf_dir)
    for run in range(3):
        runs.append_run(rows.where(F.col("l_orderkey") % 3 == run), path, str(run))
    runs.append_run(rows.where("l_orderkey % 3 = 1 AND l_linenumber <> 2").withColumn("note", F.lit("again")), path, "1")
    runs.write_attempt(rows.where("l_orderkey % 3 = 0"), path, "0")
    return runs.read_runs(spark, path, run_column="run")


# --- S10: header in the first data row -------------------------------------------------

@query("promote_header", ORACLE_SQL["round_trip_csv"])
def q_promote_header(spark, sf_dir):
    """The file's first line is junk; the real header is the first data row."""
    df = RS.cast_to_string(raw(spark, sf_dir))
    junk = [f"c{i}" for i in range(len(df.columns))]
    head = spark.createDataFrame([tuple(df.columns)], junk)
    path = io.work_dir(spark, "header")
    # the one-row frame is partition 0, so the header row opens the first file
    io.write_table(head.union(df.toDF(*junk)), path, fmt="csv")
    return io.read_table(spark, path, promote_first_row=True)


# --- S3 + S11 + R15 + U1/U2 + C2: a folder of yearly files -----------------------------------

_MERGE_SQL = _sql("""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CASE WHEN amount IN ('-888888888', '(X)', '') THEN NULL ELSE amount END AS amount,
  label, '2015' AS Year FROM raw
UNION ALL BY NAME
SELECT CAST(o_orderkey AS VARCHAR) AS l_orderkey, o_orderpriority AS priority,
  o_orderstatus AS label, '2016' AS Year FROM orders
UNION ALL BY NAME
SELECT CAST(c_custkey AS VARCHAR) AS l_orderkey, c_mktsegment AS label, 'Unknown' AS Year FROM customer
UNION ALL BY NAME
SELECT CAST(s_suppkey AS VARCHAR) AS l_orderkey, CAST(s_nationkey AS VARCHAR) AS l_linenumber, '2019' AS Year FROM supplier
UNION ALL BY NAME
SELECT CAST(s_nationkey AS VARCHAR) AS l_orderkey, CAST(s_suppkey AS VARCHAR) AS l_linenumber, '2019' AS Year FROM supplier
""")


@query("merge_folder", _MERGE_SQL)
def q_merge_folder(spark, sf_dir):
    """Folders of different headers whose names hold a blank, a ``%`` and a
    ``#``, below a folder whose own name holds a year; one without a year;
    files of one folder with their columns in different orders, one of them blank lines and
    a header; a file without any byte; and a JSON folder that
    the ``*.csv`` pattern must skip."""
    from raw2clean.plans.jobs import merge_folder
    base = io.work_dir(spark, "survey_1999")
    write_survey_folders(spark, sf_dir, base)
    return merge_folder(spark, base)


@query("merge_folder_per_file", _sql("""SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, label, '2015' AS Year FROM raw
UNION ALL SELECT CAST(o_orderkey AS VARCHAR) AS l_orderkey, o_orderstatus AS label, '2016' AS Year FROM orders
UNION ALL SELECT CAST(c_custkey AS VARCHAR) AS l_orderkey, c_mktsegment AS label, '2017' AS Year FROM customer"""))
def q_merge_folder_per_file(spark, sf_dir):
    """Files united by position after each has lost its own empty columns, which lie at other places in each year."""
    from raw2clean.plans.jobs import merge_folder
    base, none = io.work_dir(spark, "per-file"), F.lit("(X)")
    io.write_table(raw(spark, sf_dir).select("l_orderkey", none.alias("flag"), "label"), f"{base}/acs a+b_2015")
    io.write_table(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("label"), none.alias("flag")),
                   f"{base}/acs%20b#_2016")
    io.write_table(table(spark, sf_dir, "customer").select(none.alias("flag"), F.col("c_custkey").alias("key"), none.alias("more"), F.col("c_mktsegment").alias("segment")),
                   f"{base}/c_2017")
    return merge_folder(spark, base, by="position", drop_empty="file")


def write_survey_folders(spark, sf_dir, base):
    """Folders of CSV files with different headers below ``base``."""
    r = raw(spark, sf_dir)
    io.write_table(r.select(
        "l_orderkey", "l_linenumber", "amount", "label",
        F.when(F.col("l_orderkey") % 2 == 0, "(X)").otherwise("-888888888").alias("flag")),
        f"{base}/acs a_2015", fmt="csv")
    o = table(spark, sf_dir, "orders")
    io.write_table(o.select(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("label"),
                            F.col("o_orderkey").alias("l_orderkey")),
                   f"{base}/acs%20b#_2016", fmt="csv")
    c = table(spark, sf_dir, "customer")
    io.write_table(c.select(F.col("c_mktsegment").alias("label"), F.col("c_custkey").alias("l_orderkey")),
                   f"{base}/other", fmt="csv")
    io.write_table(o.select("o_orderkey"), f"{base}/acs_c_2017", fmt="json")
    # files of one folder with their columns in two orders; one of blank lines and a header alone
    n = table(spark, sf_dir, "supplier")
    io.write_table(n.select(F.col("s_suppkey").alias("l_orderkey"), F.col("s_nationkey").alias("l_linenumber")), f"{base}/acs d_2019", mode="append")
    io.write_table(n.select(F.col("s_suppkey").alias("l_linenumber"), F.col("s_nationkey").alias("l_orderkey")), f"{base}/acs d_2019", mode="append")
    blank = spark.createDataFrame([("",), ("",), ("l_linenumber,l_orderkey",)], "line string").coalesce(1)
    blank.write.mode("append").option("sep", "\x01").option("emptyValue", "").csv(f"{base}/acs d_2019")
    n.select(F.lit("").alias("line")).where("false").write.csv(f"{base}/acs e_2020")


# --- a stream of CSV files through the same rules ------------------------------------------

_STREAM_SQL = _sql("""SELECT * FROM (SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
 CAST(l_linenumber AS VARCHAR) AS l_linenumber,
 CASE WHEN code IN ('1', '2', '3', '4') THEN code ELSE NULL END AS code,
 CASE WHEN try_cast(amount AS DOUBLE) >= 0 OR amount IN ('NA', 'EXEMPT') THEN amount ELSE NULL END AS amount,
 CASE WHEN label IN ('Male', 'Female') THEN label WHEN label = 'Not applicable' THEN 'NA' ELSE NULL END AS label
 FROM raw) t WHERE COALESCE(l_orderkey, l_linenumber, code, amount, label) IS NOT NULL""")


@query("stream_clean", _STREAM_SQL)
def q_stream_clean(spark, sf_dir):
    from raw2clean.streaming.stream import clean_stream, run_available
    base = io.work_dir(spark, "stream")
    io.write_table(raw(spark, sf_dir), f"{base}/in", fmt="csv")
    rules = RuleSet({
        "l_orderkey": R.passthrough(), "l_linenumber": R.passthrough(),
        "code": R.keep_codes(["1", "2", "3", "4"]),
        "amount": R.numeric(low=0, sentinels=["NA", "EXEMPT"]),
        "label": R.keep_and_relabel(["Male", "Female"], {"Not applicable": "NA"}),
    })
    stream = clean_stream(spark, f"{base}/in", rules, columns=raw(spark, sf_dir).columns)
    run_available(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


# --- the era presets (R21 over 23 to 99 columns) on loan-layout tables ----------------------
#
# Each input column of an era is filled from every lineitem row with one of
# seventeen kinds of text (codes, sentinels, numbers, negatives, decimals,
# ranges, labels, blanks, NULL), chosen per row and column. The same SQL
# expressions build the table in Spark and in DuckDB.

_LOAN_VALUES = [
    "CAST(l_linenumber AS STRING)",
    "CAST(l_suppkey % 10 AS STRING)",
    "'NA'",
    "'EXEMPT'",
    "NULL",
    "CAST(l_partkey AS STRING)",
    "CAST(0 - l_suppkey AS STRING)",
    "CONCAT(CAST(l_partkey AS STRING), '.', LPAD(CAST(l_suppkey % 100 AS STRING), 2, '0'))",
    "'Not applicable'",
    "CONCAT(CAST(l_linenumber * 10 + 5 AS STRING), '-', CAST(l_linenumber * 10 + 14 AS STRING))",
    "CASE l_suppkey % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'White' WHEN 2 THEN 'Exempt' "
    "WHEN 3 THEN 'Conventional:First Lien' ELSE 'Not Hispanic or Latino' END",
    "''",
    "CAST(l_orderkey * 1000 + l_suppkey AS STRING)",
    "CAST(l_partkey % 100 AS STRING)",
    "'8888'",
    "CONCAT('0', CAST(l_suppkey % 100 AS STRING))",
    "CONCAT('06037', LPAD(CAST(l_partkey AS STRING), 6, '0'))",
]


def _loan_value_sql(i: int) -> str:
    whens = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(_LOAN_VALUES))
    return f"CASE (l_orderkey + 3 * l_linenumber + {7 * i}) % {len(_LOAN_VALUES)} {whens} END"


def _loan_column_sql(era: str, i: int, c: str, csv: bool = False) -> str:
    """The value of column number ``i`` in a row and in its doubles: ``dup`` 1 is the same
    row again, 2 a row that differs in some columns (2007: none of the dedup keys), 3 an empty row."""
    from raw2clean.plans.presets import DEDUP_KEYS_2007
    base = _loan_value_sql(i)
    differs = c not in DEDUP_KEYS_2007 if era == "2007" else i % 7 == 0
    value = f"CASE WHEN dup = 3 THEN NULL{f' WHEN dup = 2 THEN {_loan_value_sql(i + 5)}' if differs else ''} ELSE {base} END"
    return f"NULLIF({value}, '')" if csv else value


#: Lines of a task that makes loan rows: of 99 text columns, some 150 MB.
_LINES_A_TASK = 100_000


def _spread(lines: DataFrame) -> DataFrame:
    """Narrow lines dealt out to as many tasks as the wide rows made of them need, whatever the files' row groups."""
    count, cores = lines.count(), lines.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(max(1, min(cores, count // 10_000), -(-count // _LINES_A_TASK)), *KEYS)


def loan_table(spark: SparkSession, sf_dir: str, era: str) -> DataFrame:
    from raw2clean.plans.presets import preset
    cols = preset(era).inputs
    from raw2clean.plans.presets import DEDUP_KEYS_2007
    for_wide_rules(spark)   # a loan table is as wide as its rules
    rows = _spread(table(spark, sf_dir, "lineitem").select(*KEYS)).selectExpr(
        "l_orderkey + 3 * l_linenumber AS k", f"array({', '.join(_LOAN_VALUES)}) AS kinds",
        "explode(CASE WHEN l_orderkey % 10 IN (1, 2, 3) THEN array(0, CAST(l_orderkey % 10 AS INT)) ELSE array(0) END) AS dup")

    def column(i: int, c: str) -> str:
        """As ``_loan_column_sql`` says, from the row's kinds of text."""
        of = lambda n: f"element_at(kinds, CAST((k + {7 * n}) % {len(_LOAN_VALUES)} AS INT) + 1)"
        differs = c not in DEDUP_KEYS_2007 if era == "2007" else i % 7 == 0
        return f"CASE WHEN dup = 3 THEN NULL{f' WHEN dup = 2 THEN {of(i + 5)}' if differs else ''} ELSE {of(i)} END AS `{c}`"
    return rows.selectExpr(*[column(i, c) for i, c in enumerate(cols)])


def _loan_oracle(era: str, csv: bool = False) -> str:
    from raw2clean.plans.presets import DEDUP_KEYS_2007, preset
    cols, rules = preset(era).inputs, era_sql(era, TRACT_FIXED_SQL)   # the rules from the survey's text alone
    src = ("WITH loans AS (SELECT " + ", ".join(f"{_loan_column_sql(era, i, c, csv)} AS {_q(c)}" for i, c in enumerate(cols))
           + " FROM lineitem, (VALUES (0), (1), (2), (3)) AS d(dup) WHERE dup = 0 OR l_orderkey % 10 = dup),\n")
    outs = [_q(o) for o, _ in rules]
    cleaned = ("cleaned AS (SELECT " + ", ".join(f"{sql} AS {_q(o)}" for o, sql in rules)
               + " FROM loans WHERE " + " OR ".join(f"{_q(c)} IS NOT NULL" for c in cols) + ")\n")
    # rows whose every OUTPUT is NULL are dropped
    not_empty = f"COALESCE({', '.join(outs)}) IS NOT NULL"
    if era != "2007":
        return src + cleaned + f"SELECT DISTINCT * FROM cleaned WHERE {not_empty}"
    keys = [_q(k) for k in DEDUP_KEYS_2007]
    rest = [o for o in outs if o not in keys]
    return (src + cleaned + f"SELECT {', '.join(outs)} FROM (SELECT *, row_number() OVER (PARTITION BY "
            + ", ".join(keys) + " ORDER BY " + ", ".join(f"{r} NULLS FIRST" for r in rest)
            + f") AS __rn FROM cleaned WHERE {not_empty}) t WHERE __rn = 1")


def _register_loans(era: str) -> None:
    def q(spark, sf_dir):
        from raw2clean.plans.jobs import clean
        from raw2clean.plans.presets import DEDUP_KEYS_2007, preset
        keys = DEDUP_KEYS_2007 if era == "2007" else None
        return clean(loan_table(spark, sf_dir, era), preset(era), dedup_keys=keys)
    q.__name__ = f"q_clean_loans_{era}"
    query(f"clean_loans_{era}", _loan_oracle(era))(q)


for _era in ("2000", "2004", "2007", "2018", "2019"):
    _register_loans(_era)


# --- S5: two years of one layout from CSV, each written below its year ---------------------------

@query("clean_years", "SELECT * FROM (" + _loan_oracle("2004", csv=True)
       + ") t CROSS JOIN (VALUES (2005), (2006)) AS y(year)")
def q_clean_years(spark, sf_dir):
    from raw2clean.plans.jobs import run_clean_years
    base = io.work_dir(spark, "years")
    with shuffles_freed(spark):
        for year in ("2005", "2006"):
            io.write_table(loan_table(spark, sf_dir, "2004"), f"{base}/in/{year}", compression="gzip")
    run_clean_years(spark, {y: f"{base}/in/{y}" for y in ("2005", "2006")}, f"{base}/out", compression="gzip")
    return io.read_table(spark, f"{base}/out")   # Spark finds the year in the folder names


# --- S1, S7, S12, W2: typed read, one file, preview, order columns that are absent -----------------

@query("read_typed", _sql(f"SELECT {K}, CAST(code AS INTEGER) AS code, CAST(state_code AS INTEGER) AS state_code, "
                          "CAST(county_code AS INTEGER) AS county_code, tract, NULLIF(amount, '') AS amount, label, age FROM raw"))
def q_read_typed(spark, sf_dir):
    path = io.work_dir(spark, "typed")
    io.write_table(raw(spark, sf_dir), path)
    return io.read_table(spark, path, types="infer")


@query("single_file_csv", ORACLE_SQL["round_trip_csv"])
def q_single_file_csv(spark, sf_dir):
    path = io.work_dir(spark, "one-file")
    io.write_table(raw(spark, sf_dir), path, single_file=True)
    (file,) = io.list_files(spark, path)
    return io.read_table(spark, io.escape_glob(file))


@query("preview_rows", _sql(f"SELECT {K}, code FROM raw ORDER BY {K} LIMIT 5"))
def q_preview_rows(spark, sf_dir):
    return io.preview(raw(spark, sf_dir).select(*KEYS, "code").orderBy(*KEYS))


@query("top_n_present_columns", _sql("SELECT l_orderkey, l_linenumber, county_code, amount FROM (SELECT *, row_number() OVER ("
                                     "PARTITION BY county_code ORDER BY amount NULLS FIRST, l_orderkey, l_linenumber) AS rn FROM raw) t WHERE rn <= 3"))
def q_top_n_present_columns(spark, sf_dir):
    rows = raw(spark, sf_dir).select("l_orderkey", "l_linenumber", "county_code", "amount")
    return dedup.top_n_per_group(rows, "county_code", order=["no_such_column", "amount", "l_orderkey", "absent", "l_linenumber"], n=3)


# --- S11 alone: the year from each file's path ------------------------------------------------

@query("year_from_file_name", _sql("""SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, code, '2015' AS Year FROM raw
UNION ALL SELECT CAST(o_orderkey AS VARCHAR) AS l_orderkey, o_orderstatus AS code, '2016' AS Year FROM orders
UNION ALL SELECT CAST(c_custkey AS VARCHAR) AS l_orderkey, c_mktsegment AS code, 'Unknown' AS Year FROM customer"""))
def q_year_from_file_name(spark, sf_dir):
    base = io.work_dir(spark, "years")
    io.write_table(raw(spark, sf_dir).select("l_orderkey", "code"), f"{base}/acs_x_2015", fmt="csv")
    io.write_table(table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("code")),
        f"{base}/acs_x_2016", fmt="csv")
    io.write_table(table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("l_orderkey"), F.col("c_mktsegment").alias("code")),
        f"{base}/no_year", fmt="csv")
    return io.read_table(spark, base, recursive=True, pattern="*.csv", year_column="Year")


# --- the legacy quality jobs' own rule lists, on a fuel-station-shaped table --------------------

_FUEL_SQL = (", q AS (SELECT amount AS \"intersection directions\", CAST(NULL AS VARCHAR) AS plus4, "
             "label AS \"bd blends\", state_code AS \"cng station sells renewable natural gas\", "
             "age AS \"cng total compression capacity\", "
             "CASE WHEN amount = 'abc' THEN '' ELSE NULL END AS \"funding sources\", "
             "tract AS \"cng fill type code\", county_code AS \"ev level2 evse num\", "
             "CASE WHEN amount = '' THEN '' ELSE code END AS \"cng psi\" FROM raw)\n")


def _fuel_frame(spark, sf_dir):
    r = raw(spark, sf_dir)
    return r.select(
        F.col("amount").alias("intersection directions"), F.lit(None).cast("string").alias("plus4"),
        F.col("label").alias("bd blends"), F.col("state_code").alias("cng station sells renewable natural gas"),
        F.col("age").alias("cng total compression capacity"),
        F.when(F.col("amount") == "abc", "").alias("funding sources"),
        F.col("tract").alias("cng fill type code"), F.col("county_code").alias("ev level2 evse num"),
        F.when(F.col("amount") == "", "").otherwise(F.col("code")).alias("cng psi"))


def _ne_sql(i: int, c: str) -> str:
    qc = '"' + c + '"'
    return _outcome_sql(i, f'ColumnValues "{c}" != EMPTY with threshold > 0',
                        f"avg(CASE WHEN {qc} IS NULL OR {qc} = '' THEN 0.0 ELSE 1.0 END)", "> 0", "> 0")


def _register_quality(name: str, columns: list[str], rules_fn) -> None:
    def q(spark, sf_dir):
        return quality.evaluate(_fuel_frame(spark, sf_dir), rules_fn())
    q.__name__ = f"q_{name}"
    query(name, _sql(_FUEL_SQL + " UNION ALL ".join(_ne_sql(i, c) for i, c in enumerate(columns))))(q)


def _quality_jobs():
    from raw2clean.plans import checks
    _register_quality("quality_raw_table", checks.RAW_TABLE_COLUMNS, checks.raw_table_rules)
    _register_quality("quality_processed_table", checks.PROCESSED_TABLE_COLUMNS, checks.processed_table_rules)


_quality_jobs()


# --- S4 + D5 + D8: the quality job on declared columns, its outcomes written and read again ----------

@query("quality_job", _sql(_FUEL_SQL + " UNION ALL ".join(
    f"SELECT '{fmt}' AS format, * FROM ({_ne_sql(i, c)}) o" for fmt in ("json", "parquet")
    for i, c in enumerate(["bd blends", "plus4", "cng psi"]))))
def q_quality_job(spark, sf_dir):
    from raw2clean.plans.jobs import run_quality
    base = io.work_dir(spark, "quality")
    fuel = _fuel_frame(spark, sf_dir)
    # nested folders, a semicolon between cells, quoted cells, columns declared instead of a header
    fuel.write.option("sep", ";").option("quote", "'").option("quoteAll", True).option("emptyValue", "").csv(f"{base}/in/part 1")
    rules = [quality.non_empty(c) for c in ("bd blends", "plus4", "cng psi")]
    out = []
    for fmt in ("json", "parquet"):
        run_quality(spark, f"{base}/in", rules, out_path=f"{base}/{fmt}", fmt=fmt, schema=io.string_schema(fuel.columns),
                    header=False, sep=";", quote="'")
        out.append(spark.read.schema(quality.OUTCOME_SCHEMA).format(fmt).load(f"{base}/{fmt}").select(F.lit(fmt).alias("format"), "*"))
    return out[0].union(out[1])
