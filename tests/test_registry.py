"""What the registered queries read and write on the way to their results."""

import duckdb

from raw2clean.plans import registry


def _lineitem(at, rows):
    duckdb.sql(f"COPY (SELECT i // 4 AS l_orderkey, i % 200 AS l_partkey, i % 10 AS l_suppkey, CAST(i % 4 + 1 AS INTEGER) AS l_linenumber "
               f"FROM range({rows}) t(i)) TO '{at}/lineitem.parquet' (FORMAT parquet)")
    return at


def test_loan_table_is_dealt_out_and_not_stored(spark, tmp_dir, monkeypatch):
    at = _lineitem(tmp_dir, 40_000)   # one row group: one task reads it
    monkeypatch.setattr(registry.io, "work_dir", lambda *a: 1 / 0)
    for era in ("2004", "2007"):
        made = registry.loan_table(spark, at, era)
        assert made.rdd.getNumPartitions() == min(4, spark.sparkContext.defaultParallelism)
        assert made.count() == 40_000 + 3 * 4_000
    empty = registry.loan_table(spark, _lineitem(tmp_dir, 0), "2004")
    assert empty.count() == 0


def test_single_file_csv_writes_the_whole_table(spark, tmp_dir):
    at = _lineitem(tmp_dir, 5_000)
    got = registry.Q["single_file_csv"](spark, at)
    assert got.columns == registry.raw(spark, at).columns and got.count() == 5_000
    assert len({f for f in got.inputFiles()}) == 1
    assert registry.ORACLE_SQL["single_file_csv"] == registry.ORACLE_SQL["round_trip_csv"]


def test_clean_years_stores_compressed_csv_only(spark, tmp_dir, monkeypatch):
    import os
    at, n = _lineitem(tmp_dir, 2_000), iter(range(100))
    monkeypatch.setattr(registry.io, "work_dir", lambda spark, name="": f"{tmp_dir}/kept/{name}-{next(n)}")
    assert registry.Q["clean_years"](spark, at).groupBy("year").count().count() == 2
    kept = [os.path.join(d, f) for d, _, files in os.walk(f"{tmp_dir}/kept") for f in files if not f.startswith((".", "_"))]
    assert {os.path.relpath(k, f"{tmp_dir}/kept").split("/")[1] for k in kept} == {"in", "out"}
    assert all(k.endswith(".csv.gz") for k in kept)
