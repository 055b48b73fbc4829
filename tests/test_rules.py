"""Each rule on small inputs: kept, nulled, NULL, empty, sentinel; ANSI on and off."""

from helpers import apply_rule, one_col

import pytest

from raw2clean.functions import rules as R


def test_passthrough(ansi_spark):
    assert apply_rule(ansi_spark, R.passthrough(), ["a", None, ""]) == ["a", None, ""]


def test_keep_codes(ansi_spark):
    got = apply_rule(ansi_spark, R.keep_codes(["1", "2"]), ["1", "3", None, "", "01", " 1"])
    assert got == ["1", None, None, None, None, None]


def test_keep_codes_typed_column_compares_text(ansi_spark):
    # an inferred int column: compared as text, never an ANSI cast error
    df = ansi_spark.createDataFrame([(1,), (5,), (None,)], "c int")
    got = [r[0] for r in df.select(R.keep_codes(["1", "2"]).column("c")).collect()]
    assert got == [1, None, None]


def test_keep_codes_ignore_case(ansi_spark):
    got = apply_rule(ansi_spark, R.keep_codes(["Yes", "No"], ignore_case=True), ["yes", "NO", "x"])
    assert got == ["yes", "NO", None]


def test_keep_and_relabel(ansi_spark):
    rule = R.keep_and_relabel(["Male", "Female"], {"Not applicable": "NA"})
    got = apply_rule(ansi_spark, rule, ["Male", "Not applicable", "NA", None, "male"])
    assert got == ["Male", "NA", None, None, None]


def test_text_without_digits(ansi_spark):
    got = apply_rule(ansi_spark, R.text_without_digits(), ["Bank", "Bank 1", "", None, "abc\n"])
    # Java regex: '$' also matches before a final line break
    assert got == ["Bank", None, None, None, "abc\n"]


def test_digits(ansi_spark):
    got = apply_rule(ansi_spark, R.digits(["NA"]), ["0123", "12a", "NA", "-1", "", None, "1.5"])
    assert got == ["0123", None, "NA", None, None, None, None]


def test_numeric_any(ansi_spark):
    got = apply_rule(ansi_spark, R.numeric(), ["1", "-2.5", "abc", "", None, "NA", " 12 ", "1e3"])
    assert got == ["1", "-2.5", None, None, None, None, " 12 ", "1e3"]


def test_numeric_non_negative(ansi_spark):
    got = apply_rule(ansi_spark, R.numeric(low=0), ["0", "-0.1", "7", "x", None])
    assert got == ["0", None, "7", None, None]


def test_numeric_upper_bound(ansi_spark):
    got = apply_rule(ansi_spark, R.numeric(high=100), ["100", "100.5", "-3", "x"])
    assert got == ["100", None, "-3", None]


def test_numeric_with_sentinels(ansi_spark):
    got = apply_rule(ansi_spark, R.numeric(low=0, sentinels=["NA", "EXEMPT"]),
                     ["NA", "EXEMPT", "Exempt", "-1", "3", None])
    assert got == ["NA", "EXEMPT", None, None, "3", None]


def test_numeric_nan_passes_as_in_spark(ansi_spark):
    # Spark reads 'NaN' as a number and NaN >= 0 holds (NaN sorts last)
    assert apply_rule(ansi_spark, R.numeric(low=0), ["NaN"]) == ["NaN"]


def test_integer_text(ansi_spark):
    rule = R.integer_text([10, 11])
    got = apply_rule(ansi_spark, rule, ["1234567890", "12345678901", "123456789", "12345678.7",
                                        "12345abcde", None, "0000451966"])
    assert got == ["1234567890", "12345678901", None, "12345678.7", None, None, "0000451966"]


def test_integer_text_legacy_cast_accepts_fraction(ansi_spark):
    # a legacy cast to bigint takes '12.7' as 12
    assert apply_rule(ansi_spark, R.integer_text([4]), ["12.7", "12.a"]) == ["12.7", None]


def test_text_length_min(ansi_spark):
    got = apply_rule(ansi_spark, R.text_length(min_length=2), ["1", "12", "", None])
    assert got == [None, "12", None, None]


def test_text_length_literal_not_like(ansi_spark):
    # Spark's LIKE has no bracket classes: only the literal text is rejected
    rule = R.text_length(min_length=1, not_like="%[^A-Za-z]%")
    assert apply_rule(ansi_spark, rule, ["06", "x[^A-Za-z]y"]) == ["06", None]


def test_text_length_literal_like_is_always_null(ansi_spark):
    rule = R.text_length(exact=2, like="%[^A-Za-z]%")
    assert apply_rule(ansi_spark, rule, ["CA", "06", "C1"]) == [None, None, None]


def test_text_length_charset_and_sentinels(ansi_spark):
    rule = R.text_length(exact=2, charset="A-Za-z", sentinels=["NA", "EXEMPT"])
    assert apply_rule(ansi_spark, rule, ["CA", "C1", "CAL", "EXEMPT", None]) == ["CA", None, None, "EXEMPT", None]


def test_range_or_number(ansi_spark):
    rule = R.range_or_number(["NA", "EXEMPT"], ["8888", "9999"])
    got = apply_rule(ansi_spark, rule, ["25-34", "<25", "40", "8888", "9999", "NA", "EXEMPT", "", None, "> 74"])
    assert got == ["25-34", None, "40", None, None, "NA", "EXEMPT", None, None, None]


def _tract(spark, rows, style):
    df = spark.createDataFrame(rows, "s string, c string, t string")
    return [r[0] for r in df.select(R.tract_code("s", "c", "t", style).column("x")).collect()]


TRACT_ROWS = [("6", "1", "1234.01"), ("06", "001", "9.1"), ("6", "37", "0201.00"),
              ("6", "37", "123401"), ("6", "37", "NA"), (None, "1", "1"), ("6", "1234", "1.5")]


def test_tract_code_fixed2(ansi_spark):
    got = _tract(ansi_spark, TRACT_ROWS, "fixed2")
    assert got == ["06001123401", "06001000910", "06037020100", "06037123401", None, None, None]


@pytest.mark.parametrize(("tract", "code"), [
    ("12345.01", None), ("9.129", None), ("9.120", "000912"), ("1234567", None), ("1234", "123400"), ("1234.00", "123400"),
    ("1234.", "123400"), ("001234.01", "123401"), ("12345", "012345"), ("001234", "001234"), ("0", "000000"), ("0.5", "000050"),
    ("1.2.3", None), ("-1", None), ("", None), (" 1", None)])
def test_tract_code_cuts_nothing(spark, tract, code):
    assert _tract(spark, [("6", "37", tract)], "fixed2") == [code and "06037" + code]
    assert _tract(spark, [("123", "37", tract), ("6", "1234", tract)], "fixed2") == [None, None]


def test_column_names_with_backticks(spark):
    df = spark.createDataFrame([("1", "2", "3")], ["a`b", "`c`", "d.e"])
    assert [df.select(R.keep_codes(["1", "2", "3"])(c)).first()[0] for c in df.columns] == ["1", "2", "3"]


def test_tract_code_truncate_matches_legacy(ansi_spark):
    got = _tract(ansi_spark, TRACT_ROWS, "truncate")
    # the fraction is lost; non-numeric text is padded as it is; lpad cuts long text
    assert got == ["06001001234", "06001000009", "06037000201", "06037123401", "060370000NA", None,
                   "06123000001"]


def test_rules_agree_across_ansi_modes(spark):
    values = ["1", "-1", "x", "", None, "NA", "12.5", "25-34", "8888"]
    rules = [R.keep_codes(["1"]), R.digits(["NA"]), R.numeric(), R.numeric(low=0, sentinels=["NA"]),
             R.integer_text([2, 4]), R.text_length(min_length=2), R.range_or_number(["NA"], ["8888"])]
    out = {}
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", mode)
        df = one_col(spark, values)
        out[mode] = [tuple(r) for r in df.select(*[r("c").alias(f"r{i}") for i, r in enumerate(rules)]).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "true")
    assert out["true"] == out["false"]


def test_number_guard_equals_plain_cast(ansi_spark):
    from pyspark.sql import functions as F
    values = [" 12 ", "1e3", "NaN", "nan", "inf", "-Infinity", "+INF", "\t5", "1d", "2f", ".5", "+.5",
              "-0", "NA", "Nan", "N", "i", "x1", "", "0x1p3", "١٢", "1_000", " - 1", "--1", None]
    df = one_col(ansi_spark, values)
    got = df.select(R.number("c").alias("a"), F.col("c").try_cast("double").alias("b")).collect()
    for v, r in zip(values, got):
        a, b = r["a"], r["b"]
        assert (a == b) or (a != a and b != b), (v, a, b)


def test_integer_text_edges(ansi_spark):
    rule = R.integer_text([2, 3, 4, 21])
    got = apply_rule(ansi_spark, rule, ["12", " 12", "+12", "-12", "1.", ".5", "1.2.3", "1e3", "12ab",
                                        "123456789012345678901"])
    assert got == ["12", " 12", "+12", "-12", "1.", None, None, None, None, None]


def _all_rules():
    return {
        "passthrough": R.passthrough(), "keep_codes": R.keep_codes(["1", "a'b", "x\\y", 'q"q', "É", "\n"]), "any_case": R.keep_codes(["NA"], ignore_case=True),
        "no_codes": R.keep_codes([]), "relabel": R.keep_and_relabel(["1", "'"], {"NA": "it's \\none\\", "": "-"}), "letters": R.text_without_digits(),
        "digits": R.digits(["NA", "it's"]), "numeric": R.numeric(), "bounds": R.numeric(low=-1.5, high=1e3, sentinels=["NA", "\\"]),
        "integer": R.integer_text([1, 3, 4]), "length": R.text_length(min_length=1, exact=2, sentinels=["Exempt"]),
        "charset": R.text_length(charset="A-Za-z'"), "like": R.text_length(like="%[^A-Za-z]%"), "unlike": R.text_length(min_length=1, not_like="%'%"),
        "range": R.range_or_number(["NA"], ["8888", "it's"]), "tract": R.tract_code("s t", "c`o", "c"), "legacy": R.tract_code("s t", "c`o", "c", style="truncate"),
    }


@pytest.mark.parametrize("escaped", ["true", "false"])
def test_text_and_columns_say_the_same(ansi_spark, escaped):
    """Each rule as SQL text and as a Column, with either way of reading backslashes in SQL."""
    values = [None, "", "1", "12", "NA", "na", "a'b", "x\\y", 'q"q', "É", "\n", "'", "it's", "\\", "1.5", "-2", "1e3", "1000.0", "12.7", " 12 ", "25-34", "8888",
              "abc", "ab", "Exempt", "1234.01", "1234", "9.1", "12345", "1234567", "NaN", "inf", "1d", "[^A-Za-z]", "x\n"]
    df = ansi_spark.createDataFrame([(v, a, b) for v in values for a, b in (("6", "37"), ("123", "1"), (None, "1"))], "c string, `s t` string, `c``o` string")
    ansi_spark.conf.set("spark.sql.parser.escapedStringLiterals", escaped)
    try:
        for name, rule in _all_rules().items():
            assert rule.sql("c") is not None
            as_text = df.selectExpr(f"{rule.sql('c')} AS out")
            as_columns = df.select(rule.build(*[R.as_column(c) for c in rule.input_columns("c")]).alias("out"))
            assert [r[0] for r in as_text.collect()] == [r[0] for r in as_columns.collect()], name
    finally:
        ansi_spark.conf.unset("spark.sql.parser.escapedStringLiterals")


def test_rules_of_ones_own(spark):
    from pyspark.sql import functions as F

    from raw2clean.plans.ruleset import RuleSet
    own = R.Rule("upper", lambda c: F.upper(R.as_column(c)))
    assert own.sql("a") is None
    out = RuleSet({"a": own, "b": R.keep_codes(["x"])}).apply(spark.createDataFrame([("k", "x", "z"), ("l", "y", "z")], "a string, b string, `it's` string"), keep=["it's"])
    assert out.columns == ["it's", "a", "b"] and [tuple(r) for r in out.collect()] == [("z", "K", "x"), ("z", "L", None)]


def test_a_wide_table_is_built_fast(spark):
    import time

    from raw2clean.plans.jobs import clean
    from raw2clean.plans.presets import preset
    rules = preset("2018")
    df = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in rules.inputs))
    clean(df, rules)
    begin = time.perf_counter()
    clean(df, rules)
    assert time.perf_counter() - begin < 1.5
