"""Helpers of the tests of rules and presets."""


def one_col(spark, values, name="c"):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` string")


def apply_rule(spark, rule, values):
    df = one_col(spark, values)
    return [r[0] for r in df.select(rule.column("c")).collect()]
