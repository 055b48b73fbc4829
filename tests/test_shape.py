"""Empty rows and columns, sentinels, high-cardinality columns, merge by name."""

import pytest

from raw2clean.operators import shape


def test_drop_empty_rows_keeps_empty_text(spark):
    df = spark.createDataFrame([(None, None), ("", None), ("a", "b")], "a string, b string")
    assert shape.drop_empty_rows(df).count() == 2


def test_null_sentinels(spark):
    df = spark.createDataFrame([("-888888888", "(X)", 1), ("", "v", 2)], "a string, b string, n int")
    out = shape.null_sentinels(df)
    assert [tuple(r) for r in out.collect()] == [(None, None, 1), (None, "v", 2)]
    assert dict(out.dtypes)["n"] == "int"
    only_a = shape.null_sentinels(df, subset=["a"])
    assert only_a.collect()[0]["b"] == "(X)"


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, ""), (2, None, None)], "a int, b string, c string")
    assert shape.drop_null_columns(df).columns == ["a", "c"]


def test_drop_null_columns_empty_table_keeps_schema(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert shape.drop_null_columns(df).columns == ["a", "b"]


def test_value_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    rows, nn = shape.value_counts(df)
    assert rows == 3 and nn == {"a": 2, "b": 1}
    assert shape.null_counts(df) == {"a": 1, "b": 2}


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_blank_high_cardinality(spark, method):
    rows = [(i, str(i), str(i % 3), str(i % 25)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, p_many string, p_few string, p_25 string")
    out = shape.blank_high_cardinality(df, "p_", threshold=20, method=method)
    assert out.columns == ["id", "p_many", "p_few", "p_25"]
    assert dict(out.dtypes)["p_many"] == "string"
    got = out.where("id = 7").first()
    assert got["p_many"] is None and got["p_few"] == "1" and got["p_25"] is None


def test_blank_high_cardinality_moves_checked_columns_last(spark):
    df = spark.createDataFrame([("1", 1)], "p_x string, other int")
    assert shape.blank_high_cardinality(df, "p_").columns == ["other", "p_x"]
    assert shape.blank_high_cardinality(df, "zz").columns == ["p_x", "other"]


def test_distinct_counts_exact_matches_screen(spark):
    rows = [(str(i % 7), str(i % 19), str(i % 23), str(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    full = shape.distinct_counts(df, df.columns, method="exact")
    assert full == {"a": 7, "b": 19, "c": 23, "d": 500}
    assert shape.more_distinct_than(df, df.columns, 20) == {"a": False, "b": False, "c": True, "d": True}
    for t in (6, 7, 18, 19, 22, 23, 499, 500):
        assert shape.more_distinct_than(df, df.columns, t) == {c: n > t for c, n in full.items()}


def test_merge_by_name_widens_and_keeps_odd_names(spark):
    a = spark.createDataFrame([(1, "x")], ["k.1", "V"])
    b = spark.createDataFrame([("y", 2.5)], ["v", "n"])
    out = shape.merge_by_name([a, b])
    assert out.columns == ["k.1", "V", "n"] and dict(out.dtypes) == {"k.1": "bigint", "V": "string", "n": "double"}
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "x", None), (None, "y", 2.5)]


def test_merge_by_name_and_position(spark):
    a = spark.createDataFrame([("1", "x")], "k string, v string")
    b = spark.createDataFrame([("y", "2")], "v string, k string")
    c = spark.createDataFrame([("3", "z")], "k string, extra string")
    by_name = shape.merge_by_name([a, b, c])
    assert by_name.columns == ["k", "v", "extra"]
    assert sorted(tuple(r) for r in by_name.collect()) == [("1", "x", None), ("2", "y", None), ("3", None, "z")]
    by_pos = shape.merge_by_name([a, b], by="position")
    assert sorted(tuple(r) for r in by_pos.collect()) == [("1", "x"), ("y", "2")]
    assert shape.merge_by_name([]) is None
