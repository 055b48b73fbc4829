"""Dedup against the keys of earlier runs: equal to one dedup of all, the old side is not shuffled."""

import random
import re
from uuid import uuid4

import pytest

from raw2clean.operators.dedup import dedup_by_key
from raw2clean.operators.key_table import KeyTable, dedup_run, key_text
from raw2clean.sources.runs import read_runs


@pytest.fixture
def table(spark):
    t = KeyTable(spark, f"keys_{uuid4().hex[:12]}", ["a", "b c"], buckets=4)
    yield t
    t.drop()


def _years(spark, n=400):
    rnd = random.Random(7)
    value = lambda: rnd.choice([None, "", "x", "1:x", "-", "é", str(rnd.randrange(12))])
    return spark.createDataFrame([(y, value(), value(), rnd.randrange(1000)) for y in (1, 2, 3) for _ in range(n)], "year int, a string, `b c` string, v int")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_year_by_year_is_one_dedup(spark, table, tmp_dir):
    df = _years(spark)
    for year in (1, 2, 3, 2, 1):           # runs may come again
        dedup_run(table, df.where(f"year = {year}"), str(year), tmp_dir)
    assert _rows(read_runs(spark, tmp_dir)) == _rows(dedup_by_key(df, ["a", "b c"], order=["year", "v"]))
    assert spark.table(table.name).count() == read_runs(spark, tmp_dir).count()


def test_a_killed_run_is_mended(spark, table, tmp_dir):
    df = _years(spark)
    dedup_run(table, df.where("year = 1"), "1", tmp_dir)
    table.add(df.where("year = 2"), "2")                                  # keys of rows that were never written
    dedup_run(table, df.where("year = 2"), "2", tmp_dir)
    assert _rows(read_runs(spark, tmp_dir)) == _rows(dedup_by_key(df.where("year < 3"), ["a", "b c"], order=["year", "v"]))


def test_the_old_side_is_not_shuffled(spark, table):
    df = _years(spark)
    table.add(df.where("year = 1"), "1")
    table.add(df.where("year = 2"), "2")
    out = table.new_rows(df.where("year = 3"), "3")
    plan = out._jdf.queryExecution().executedPlan().toString()
    old = plan[plan.index(f"FileScan parquet spark_catalog.default.{table.name}") - 2000:]
    scan = next(line for line in plan.splitlines() if table.name in line)
    assert "Bucketed: true" in scan and "SelectedBucketsCount: 4 out of 4" in scan and old
    # between the join and the scan of the keys stands no exchange
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if table.name in line)
    depth = lambda line: len(re.match(r"[\s:|+*-]*", line)[0])
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
        if "Join" in line and line in above:
            break
    assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above)


def test_keys_are_spelt_out(spark):
    df = spark.createDataFrame([("1", "2"), ("1:1", ""), (None, "12"), ("-", "12"), ("", None), ("", "-"), (None, None), ("é", "2")], "a string, `b c` string")
    assert df.selectExpr(f"{key_text(['a', 'b c'])} AS k").distinct().count() == 8


def test_empty_years(spark, table, tmp_dir):
    df = _years(spark)
    dedup_run(table, df.where("false"), "0", tmp_dir)
    dedup_run(table, df.where("year = 1"), "1", tmp_dir)
    dedup_run(table, df.where("false"), "2", tmp_dir)
    assert _rows(read_runs(spark, tmp_dir)) == _rows(dedup_by_key(df.where("year = 1"), ["a", "b c"]))
