"""Distinct rows, key dedup with a fixed survivor, top rows per group."""

import pytest

from raw2clean.operators.dedup import dedup_by_key, distinct_rows, top_n_per_group

ROWS = [("a", "x", "3"), ("a", None, "2"), ("a", "x", "1"), ("b", "y", "9"), ("b", "y", "9"), (None, "z", "5")]
SCHEMA = "k string, v string, w string"


@pytest.mark.parametrize("method", ["min_struct", "row_number"])
def test_fixed_survivor(spark, method):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted((tuple(r) for r in dedup_by_key(df, ["k"], method=method).collect()), key=str)
    # NULLs sort first, then smallest values in column order
    assert got == sorted([("a", None, "2"), ("b", "y", "9"), (None, "z", "5")], key=str)


def test_survivor_order_and_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = dedup_by_key(df, ["k"], order=["w", "v"])
    assert out.columns == ["k", "v", "w"]
    got = {r["k"]: (r["v"], r["w"]) for r in out.collect()}
    assert got["a"] == ("x", "1")


def test_any_survivor_keeps_one_per_key(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = dedup_by_key(df, ["k"], method="any")
    assert out.count() == 3 and out.select("k").distinct().count() == 3


def test_dedup_only_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert dedup_by_key(df, ["k"]).count() == 2


def test_missing_key(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError):
        dedup_by_key(df, ["nope"])


@pytest.mark.parametrize("drop_all_null", [False, True])
@pytest.mark.parametrize("most", [500_000, 0])
@pytest.mark.parametrize("extra", [[], [(None, None, None)], [(None, None, None)] * 2, [(None, "a", None), ("a", None, None)]])
def test_distinct_rows_by_hashes(spark, extra, most, drop_all_null):
    """A row of NULLs alone, once or twice; rows that differ in the place of a NULL have equal hashes."""
    df = spark.createDataFrame(ROWS + extra, SCHEMA)
    got = sorted((tuple(r) for r in distinct_rows(df, drop_all_null, "hashes", most).collect()), key=str)
    assert got == sorted({r for r in ROWS + extra if not drop_all_null or any(r)}, key=str)


def test_distinct_rows_by_hashes_shuffles_repeated_rows_only(spark, tmp_dir):
    odd = "`a.b` string, `__hash x` int, double double"
    df = spark.createDataFrame([(str(k % 95), k % 95, 0.0 if k % 2 else -0.0) for k in range(100)], odd)
    out = distinct_rows(df, method="hashes")
    assert out.columns == df.columns and out.count() == 95
    assert distinct_rows(df.limit(0), method="hashes").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    with pytest.raises(ValueError):
        distinct_rows(df, method="other")


def test_distinct_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert distinct_rows(df).count() == 5


def test_top_n_null_as(spark):
    df = spark.createDataFrame([("a", "5", "3"), ("a", None, "2"), ("a", "5", "1")], SCHEMA)
    # NULL sorts as the text '999999', after '5', so ('5', '1') comes first
    got = {r["k"]: (r["v"], r["w"]) for r in top_n_per_group(df, "k", null_as="999999").collect()}
    assert got["a"] == ("5", "1")
    got = {r["k"]: (r["v"], r["w"]) for r in top_n_per_group(df, "k").collect()}
    assert got["a"] == (None, "2")


def test_top_n_more_rows_and_absent_order_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = top_n_per_group(df, ["k"], order=["w", "not_there"], n=2)
    assert out.columns == ["k", "v", "w"]
    assert sorted(r["w"] for r in out.where("k = 'a'").collect()) == ["1", "2"]
    assert out.count() == 5


def test_row_number_over_many_keys(spark):
    """The 43 keys of the 2007 layout over its 79 rules: planned at once, and the same rows as by structs."""
    import time

    from raw2clean.plans.jobs import clean
    from raw2clean.plans.presets import DEDUP_KEYS_2007, preset
    rules = preset("2007")
    rows = [tuple(str((i * k) % 3) if k % 5 else None for k in range(len(rules.inputs))) for i in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in rules.inputs))
    begin = time.perf_counter()
    got = [sorted(map(str, clean(df, rules, dedup_keys=DEDUP_KEYS_2007, dedup_method=m).collect())) for m in ("row_number", "min_struct")]
    assert got[0] == got[1] and len(got[0]) > 1 and time.perf_counter() - begin < 60


@pytest.mark.parametrize("method", ["min_struct", "row_number", "any"])
def test_rows_of_nothing_are_no_survivors(spark, method):
    df = spark.createDataFrame([(None, None, None), (None, None, "x"), ("a", None, None), (None, "b", None), (None, None, None)], "k string, l string, v string")
    out = dedup_by_key(df, ["k", "l"], method=method, drop_all_null=True)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, None, "x"), ("a", None, None), (None, "b", None)], key=str)
    assert dedup_by_key(df.where("k IS NULL AND l IS NULL AND v IS NULL"), ["k", "l"], method=method, drop_all_null=True).count() == 0
    assert dedup_by_key(df, ["v", "l", "k"], method=method, drop_all_null=True).count() == 3


def test_top_n_sorts_only_rows_that_may_be_first(spark):
    df = spark.range(50_000).selectExpr("CAST(id % 7 AS STRING) AS g", "CAST((id * 7919) % 50000 AS STRING) AS v", "id AS w")
    for n in (1, 3):
        few = top_n_per_group(df, "g", n=n)
        all_ = top_n_per_group(df, "g", n=n, most_groups=0)
        assert sorted(map(tuple, few.collect())) == sorted(map(tuple, all_.collect())) and few.count() == 7 * n
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (few, all_)]
        assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]


def test_top_n_by_many_kinds_of_order(spark):
    """Against plain sorting: nulls, equal rows, long common prefixes, bytes above 127, groups of fewer rows than n, null groups."""
    import random
    r = random.Random(5)
    words = [None, "", "a", "a\x00", "aaaaaaaaaaz", "aaaaaaaaaab", "é", "\U0001f600", "z", "9", "10", "-1"]
    rows = [(r.choice([None, 1, 2, 3]), r.choice(words), r.choice([None, -5, 0, 7, -(1 << 63), (1 << 63) - 1]), r.choice([None, 0.5, float("nan")])) for _ in range(400)]
    rows += [(9, "only", 1, 1.0)] + rows[:60]
    df = spark.createDataFrame(rows, "g int, s string, l long, d double").selectExpr("*", "CAST(l % 1000 AS int) AS i", "date_add(DATE'2000-01-01', CAST(l % 1000 AS int)) AS t",
                                                                                     "timestamp_micros(l % 1000) AS u")
    show = lambda x: sorted(map(str, x.collect()))
    for first in ("s", "l", "d", "i", "t", "u"):
        order = [first, *[c for c in ("s", "l", "d") if c != first]]
        for n in (1, 2, 5):
            for null_as in (None, "999999") if first in ("s", "l") else (None,):
                got, want = (top_n_per_group(df, "g", order=order, n=n, null_as=null_as, most_groups=m) for m in (100, 0))
                assert show(got) == show(want)
    assert show(top_n_per_group(df.limit(0), "g", n=2)) == []
    assert show(top_n_per_group(df, ["g", "s"], order=["l", "d"], n=2)) == show(top_n_per_group(df, ["g", "s"], order=["l", "d"], n=2, most_groups=0))


@pytest.mark.parametrize("drop_all_null", [False, True])
def test_distinct_rows_packed(spark, drop_all_null):
    """Cells that hold a sign of the packed form, empty ones, and bytes that are no text keep rows apart as they are."""
    odd = [(None,) * 3, (None,) * 3, ("",) * 3, ("", None, None), ("a\x01b", None, "c"), ("a", "b", "c"), ("a\x01b", None, "c"), ("\x02", None, None),
           ("\x02", None, None), (None, "\x02", ""), ("\x01", None, None), (None, None, "\x01"), ("é", "日本", "'"), ("é", "日本", "'"), ("\\x01", "NULL", "")]
    df = spark.createDataFrame(odd, "`a.b` string, `c``d` string, `{i} {c}` string")
    bad = spark.range(4).selectExpr("CAST(X'C3' AS STRING)", "CAST(X'A9' AS STRING)", "CAST(if(id < 2, X'FE', X'FF') AS STRING)").toDF(*df.columns)
    df = df.union(bad)
    hexed = lambda d: sorted(map(str, d.selectExpr(*[f"hex(`{c.replace('`', '``')}`) AS c{i}" for i, c in enumerate(d.columns)]).collect()))
    got = distinct_rows(df, drop_all_null, "packed")
    assert got.schema == df.schema and hexed(got) == hexed(distinct_rows(df, drop_all_null))
    assert len(hexed(got)) == len(set(odd)) + 2 - drop_all_null
    one = df.select("`{i} {c}`")
    assert hexed(distinct_rows(one, drop_all_null, "packed")) == hexed(distinct_rows(one, drop_all_null))
    assert distinct_rows(df.limit(0), drop_all_null, "packed").count() == 0


def test_distinct_rows_packed_takes_other_types_as_rows(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", -0.0), ("a", float("nan")), ("a", float("nan")), (None, None)], "a string, b double")
    assert distinct_rows(df, True, "packed").count() == 2
    assert distinct_rows(spark.sql("SELECT a COLLATE UTF8_LCASE AS a FROM VALUES ('x'), ('X') AS t(a)"), method="packed").count() == 1
