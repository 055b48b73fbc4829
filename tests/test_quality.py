"""Quality rules (one outcome row each) and the column profile."""

import math

import pytest

from raw2clean.operators import quality as Q
from raw2clean.operators import states


def _frame(spark):
    rows = [("a", "1", None), ("", "2", None), (None, "x", None), ("b", "4", None)]
    return spark.createDataFrame(rows, "`s c` string, n string, e string")


def test_non_empty_and_order_and_repeats(spark):
    df = _frame(spark)
    rules = [Q.non_empty("s c"), Q.non_empty("e"), Q.non_empty("s c", 0.6), Q.non_empty("e")]
    out = Q.evaluate(df, rules).orderBy("position").collect()
    assert [r["position"] for r in out] == [0, 1, 2, 3]
    assert [r["outcome"] for r in out] == ["Passed", "Failed", "Failed", "Failed"]
    assert out[0]["metric"] == 0.5 and out[0]["reason"] is None
    assert out[0]["rule"] == 'ColumnValues "s c" != EMPTY with threshold > 0'
    assert out[1]["reason"] == "metric does not satisfy > 0"


def test_completeness_between(spark):
    df = _frame(spark)
    out = Q.evaluate(df, [Q.completeness("s c", 0.4, 0.8), Q.completeness("s c", 0.75, 1.0),
                          Q.completeness("s c", 0.75, 1.0, inclusive=True),
                          Q.completeness("n", op=">=", bound=1)]).orderBy("position").collect()
    assert [r["outcome"] for r in out] == ["Passed", "Failed", "Passed", "Passed"]
    assert out[0]["metric"] == 0.75


def test_column_count(spark):
    out = Q.evaluate(_frame(spark), [Q.column_count(">", 2), Q.column_count(">", 10)]).collect()
    assert sorted((r["position"], r["outcome"], r["metric"]) for r in out) == [(0, "Passed", 3.0), (1, "Failed", 3.0)]


def test_empty_table_fails_and_empty_rules(spark):
    df = spark.createDataFrame([], "a string")
    out = Q.evaluate(df, [Q.non_empty("a")]).collect()
    assert out[0]["outcome"] == "Failed" and out[0]["metric"] is None
    assert out[0]["reason"] == "no rows to measure"
    empty = Q.evaluate(df, [])
    assert empty.count() == 0 and empty.schema == Q.OUTCOME_SCHEMA


def test_profile(spark):
    df = _frame(spark)
    p = {r["column"]: r for r in Q.profile(df, distinct="exact").collect()}
    rounded = lambda r: {k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()}
    assert [rounded(r) for r in Q.profile(df, distinct=df.columns).collect()] == [rounded(p[c]) for c in df.columns]   # all columns named
    assert set(p) == {"s c", "n", "e"}
    n = p["n"]
    assert (n["rows"], n["nulls"], n["distinct"], n["min"], n["max"]) == (4, 0, 4, "1", "x")
    assert n["uniqueness"] == 1.0 and n["mean"] == 7 / 3 and n["sum"] == 7.0
    assert math.isclose(n["stddev"], math.sqrt(((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 2))
    assert (n["min_length"], n["max_length"]) == (1, 1)
    s = p["s c"]
    assert (s["nulls"], s["distinct"], s["completeness"], s["min"]) == (1, 3, 0.75, "")
    e = p["e"]
    assert (e["nulls"], e["distinct"], e["uniqueness"], e["mean"]) == (4, 0, None, None)


def test_profile_approx(spark):
    p = {r["column"]: r for r in Q.profile(_frame(spark), distinct="approx").collect()}
    assert p["n"]["distinct"] == 4 and p["n"]["uniqueness"] is None


def test_run_checks_names(spark):
    res = Q.run_checks(_frame(spark), [Q.non_empty("n")], statistics=True)
    assert set(res) == {"rule_outcomes", "statistics"}
    assert res["rule_outcomes"].count() == 1 and res["statistics"].count() == 3


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int")
    for mode in ("exact", "approx", ["a"], ["b", "a"]):
        p = {r["column"]: r for r in Q.profile(df, distinct=mode).collect()}
        assert set(p) == {"a", "b"} and p["a"]["rows"] == 0 and p["a"]["distinct"] in (0, None)


def test_profile_typed_min_max(spark):
    df = spark.createDataFrame([(9, 1.5), (10, -2.0), (None, None)], "a int, b double")
    for mode in ("exact", "approx", ["a"], ["b", "a"]):
        p = {r["column"]: r for r in Q.profile(df, distinct=mode).collect()}
        assert (p["a"]["min"], p["a"]["max"]) == ("9", "10")
        assert (p["b"]["min"], p["b"]["max"]) == ("-2.0", "1.5")
        assert p["a"]["type"] == "int" and p["a"]["nulls"] == 1


def test_profile_modes_agree(spark, monkeypatch):
    """On columns of few and many values, also with columns summarised a few at a time."""
    monkeypatch.setattr(states, "COLUMNS_AT_ONCE", 2)
    rows = [(str(i), i, i % 7, None if i % 3 else f"v{i % 50}", float(i) / 4) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id string, n long, few int, some string, d double")
    exact = {r["column"]: r.asDict() for r in Q.profile(df, distinct="exact").collect()}
    auto = {r["column"]: r.asDict() for r in Q.profile(df, distinct=["few", "some"]).collect()}
    named = {r["column"]: r.asDict() for r in Q.profile(df, distinct=["n"]).collect()}
    for c, want in exact.items():
        for k, v in want.items():
            estimated = k in ("distinct", "uniqueness", "distinct_is_exact") and c in ("id", "n", "d")
            if not estimated:
                assert auto[c][k] == v or math.isclose(auto[c][k], v, rel_tol=1e-9), (c, k)
    assert abs(auto["id"]["distinct"] - 20_000) < 2_000 and auto["id"]["uniqueness"] is None
    assert named["n"]["distinct"] == 20_000 and named["n"]["uniqueness"] == 1.0


def test_profile_says_which_counts_are_exact(spark):
    """Estimates lie within three times the sketch's error of 1.6 % of the exact counts."""
    df = spark.range(40_000).selectExpr("cast(id as string) AS many", "cast(id % 9000 as string) AS some", "cast(id % 7 as string) AS few")
    exact, auto, named, approx = ({r["column"]: r for r in Q.run_checks(df, statistics=True, distinct=d)["statistics"].collect()} for d in ("exact", ["few"], ["some", "few"], "approx"))
    flags = lambda p: [p[c].distinct_is_exact for c in df.columns]
    assert flags(exact) == [True] * 3 and flags(auto) == [False, False, True]
    assert flags(named) == [False, True, True] and flags(approx) == [False] * 3
    assert [exact[c]["distinct"] for c in df.columns] == [40_000, 9000, 7]
    for p in (auto, named, approx):
        for c in df.columns:
            n = exact[c]["distinct"]
            assert p[c]["distinct"] == n if p[c].distinct_is_exact else abs(p[c]["distinct"] - n) <= 3 * states.DISTINCT_ERROR * n
    for wrong in ("auto", ["absent"]):
        with pytest.raises(ValueError):
            Q.profile(df, distinct=wrong)


def test_the_size_of_a_table_changes_no_mode(spark):
    """Estimates stay estimates in a table of few values, exact counts exact in one of many."""
    for n in (3, 30_000):
        df = spark.range(n).selectExpr("cast(id as string) AS a", "id AS b")
        assert [(r.distinct_is_exact, r.uniqueness) for r in Q.profile(df).collect()] == [(False, None)] * 2
        assert [(r.distinct_is_exact, r.uniqueness, r.distinct) for r in Q.profile(df, distinct="exact").collect()] == [(True, 1.0, n)] * 2


def _parts(spark):
    rows = [(i % 5, None if i % 11 == 0 else 1e9 + i % 1000 / 7, str(i * 37 % 4001) if i % 3 else "NA", i - 5000, None) for i in range(9000)]
    return spark.createDataFrame(rows, "part int, d double, `te xt` string, n long, e string")


def test_merged_states_are_the_profile_of_all(spark, tmp_dir, monkeypatch):
    df = _parts(spark)
    rows = df.drop("part")
    for part in (0, 1, 2, 3, 4, 1):                       # one part twice
        states.save_states(df.where(f"part = {part}").drop("part"), tmp_dir, str(part))
    states.save_states(rows.where("false"), tmp_dir, "none")
    merged = states.stored_states(spark, tmp_dir)
    got = {r["column"]: r.asDict() for r in Q.profile_of_states(merged, quantiles=[0.25, 0.5]).collect()}
    want = {r["column"]: r.asDict() for r in Q.profile(rows).collect()}
    assert list(got) == rows.columns
    for c, stats in want.items():
        for k, v in stats.items():
            if k == "distinct":       # merged sketches are estimated in another way
                assert abs(got[c][k] - v) <= 3 * states.DISTINCT_ERROR * v
            else:
                assert got[c][k] == v or math.isclose(got[c][k], v, rel_tol=1e-7), (c, k, got[c][k], v)
    for c, p, q in ((c, p, q) for c in ("d", "n") for p, q in ((0.25, "q25"), (0.5, "q50"))):
        values = sorted(float(r[0]) for r in rows.select(c).where(f"{c} IS NOT NULL").collect())
        below, upto = (sum(f(v) for v in values) / len(values) for f in (lambda v: v < got[c][q], lambda v: v <= got[c][q]))
        assert below <= p + 2 * states.RANK_ERROR and upto >= p - 2 * states.RANK_ERROR
    assert got["e"]["q50"] is None and got["e"]["min"] is None
    some = Q.profile_of_states(states.stored_states(spark, tmp_dir, parts=["2"])).where("column = 'n'").first()
    assert some["rows"] == 1800
    # a spread that sums of squares would lose beside the size of the numbers
    exact = [float(r[0]) for r in rows.select("d").where("d IS NOT NULL").collect()]
    mean = math.fsum(exact) / len(exact)
    assert math.isclose(got["d"]["stddev"], math.sqrt(math.fsum((x - mean) ** 2 for x in exact) / (len(exact) - 1)), rel_tol=1e-7)


def test_states_by_part_in_one_pass(spark):
    df = _parts(spark)
    each = states.column_states(df, by=["part"])
    assert each.count() == 5 * 4 and each.columns[:4] == ["part", "position", "column", "type"]
    merged = {r["column"]: r for r in Q.profile_of_states(states.merge_states(each)).collect()}
    assert {c: (r["rows"], r["min"], r["max"]) for c, r in merged.items() if c != "d"} == {
        "te xt": (9000, "0", "NA"), "n": (9000, "-5000", "3999"), "e": (9000, None, None)}
    again = states.merge_states(states.merge_states(each, by=["part"]))
    assert sorted(map(str, Q.profile_of_states(again).drop("mean", "stddev", "sum", "distinct").collect())) == sorted(map(str, Q.profile_of_states(states.merge_states(each)).drop("mean", "stddev", "sum", "distinct").collect()))


def test_states_of_other_types_and_columns(spark, tmp_dir):
    states.save_states(spark.createDataFrame([(9, "x")], "a int, b string"), tmp_dir, "1")
    states.save_states(spark.createDataFrame([("10", 2.5)], "a string, c double"), tmp_dir, "2")
    p = {r["column"]: r for r in Q.profile_of_states(states.stored_states(spark, tmp_dir)).collect()}
    assert (p["a"]["type"], p["a"]["min"], p["a"]["max"], p["a"]["rows"]) == ("string", "10", "9", 2)
    assert (p["c"]["type"], p["c"]["min"], p["b"]["max"], p["b"]["rows"]) == ("double", "2.5", "x", 1)
    assert states.stored_states(spark, f"{tmp_dir}/none") is None
