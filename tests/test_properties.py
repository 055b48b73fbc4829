"""Properties over generated inputs: rules are idempotent, row counts never
grow, dedup output has unique keys, the survivor is the smallest row."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from raw2clean.functions import rules as R
from raw2clean.operators.dedup import dedup_by_key, distinct_rows
from raw2clean.operators.shape import drop_empty_rows
from raw2clean.plans.ruleset import RuleSet

TEXT = st.one_of(st.none(), st.sampled_from(["1", "2", "9", "-3", "0.5", "NA", "EXEMPT", "", "abc",
                                              "25-34", "8888", "Male", "x1", "1234567890"]))
ROWS = st.lists(st.tuples(TEXT, TEXT, TEXT), min_size=0, max_size=25)
SCHEMA = "a string, b string, c string"
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# no relabel (R3) and no composed codes (R14): their outputs are new values
IDEMPOTENT = RuleSet({
    "a": R.numeric(low=0, sentinels=["NA", "EXEMPT"]),
    "b": R.range_or_number(["NA"], ["8888"]),
    "c": R.keep_codes(["1", "2", "Male"]),
})


@SETTINGS
@given(rows=ROWS)
def test_rules_idempotent(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    once = IDEMPOTENT.apply(df)
    twice = IDEMPOTENT.apply(once)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


@SETTINGS
@given(rows=ROWS)
def test_counts_never_grow(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    n = len(rows)
    cleaned = drop_empty_rows(IDEMPOTENT.apply(df))
    assert cleaned.count() <= n
    assert distinct_rows(cleaned).count() <= cleaned.count()
    assert distinct_rows(IDEMPOTENT.apply(df), drop_all_null=True).count() == distinct_rows(cleaned).count()


@SETTINGS
@given(rows=ROWS)
def test_dedup_unique_keys_and_smallest_survivor(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = [tuple(r) for r in dedup_by_key(df, ["a"]).collect()]
    keys = [r[0] for r in out]
    assert len(keys) == len(set(keys)) == len({r[0] for r in rows})

    def order(t):  # NULLs first, then text order
        return tuple((v is not None, v or "") for v in t)
    for a, b, c in out:
        group = [r for r in rows if r[0] == a]
        assert min(group, key=lambda r: order(r[1:]))[1:] == (b, c)
