"""Presets: names, order and counts of each era's rule table."""

import pytest

from raw2clean.plans.presets import DEDUP_KEYS_2007, YEAR_TO_ERA, preset, preset_for_year
from raw2clean.plans.ruleset import MissingColumnsError

COUNTS = {"2000": (23, 22), "2004": (39, 38), "2007": (79, 78), "2018": (99, 99), "2019": (99, 99)}


@pytest.mark.parametrize("era", sorted(COUNTS))
def test_counts(era):
    rs = preset(era)
    outputs, inputs = COUNTS[era]
    assert len(rs.outputs) == outputs
    assert len(rs.inputs) == inputs


def test_orders_and_names():
    assert preset("2000").outputs[:3] == ["activity_year", "respondent_id", "loan_type"]
    assert preset("2000").outputs[11] == "census_tract_id"
    assert preset("2007").outputs[26] == "census_tract"
    assert preset("2007").outputs[-1] == "application_date_indicator"
    h18 = preset("2018").outputs
    assert h18[0] == "activity_year" and h18[-1] == "derived_loan_product_type"
    assert h18.index("co-applicant_race-5") + 4 == h18.index("co-applicant_race-1")
    assert preset("2018").outputs == preset("2019").outputs


def test_tract_code_reads_raw_inputs():
    rs = preset("2007")
    assert rs["census_tract"].input_columns("census_tract") == ("state_code", "county_code",
                                                                "census_tract_number")


def test_dedup_keys_are_outputs():
    outs = set(preset("2007").outputs)
    assert len(DEDUP_KEYS_2007) == 43 and set(DEDUP_KEYS_2007) <= outs
    left_out = outs - set(DEDUP_KEYS_2007)
    assert {"sequence_number", "as_of_year", "census_tract", "state_abbr"} <= left_out


def test_years_map_to_eras():
    assert YEAR_TO_ERA["2003"] == "2000" and YEAR_TO_ERA["2006"] == "2004"
    assert YEAR_TO_ERA["2017"] == "2007" and YEAR_TO_ERA["2023"] == "2019"
    assert preset_for_year(2010).name == "loans_2007"


def test_apply_one_projection(spark):
    rs = preset("2000")
    df = spark.createDataFrame([tuple(["1"] * len(rs.inputs))], ", ".join(f"`{c}` string" for c in rs.inputs))
    out = rs.apply(df)
    assert out.columns == rs.outputs
    row = out.first().asDict()
    assert row["loan_type"] == "1" and row["edit_status"] is None
    assert row["census_tract_id"] == "01001000100"   # tract 1, the code of 1.00


def test_missing_columns(spark):
    rs = preset("2000")
    df = spark.createDataFrame([("1",)], "activity_year string")
    with pytest.raises(MissingColumnsError):
        rs.apply(df)
    out = rs.apply(df, on_missing="null")
    assert out.columns == rs.outputs
    assert rs.apply(df, on_missing="skip").columns == ["activity_year"]


def test_hyphenated_names(spark):
    rs = preset("2018")
    df = spark.createDataFrame([tuple(["1"] * 99)], ", ".join(f"`{c}` string" for c in rs.inputs))
    row = rs.apply(df).first().asDict()
    assert row["denial_reason-1"] == "1" and row["aus-1"] == "1" and row["applicant_age"] == "1"
    assert row["debt_to_income_ratio"] is None and row["census_tract"] is None


def test_presets_follow_the_survey():
    """Columns, order and rule kinds of every era as the survey's appendix lists them; values are compared by the oracles."""
    from raw2clean.plans.survey_rules import SECTIONS, appendix
    kinds = {"R1": "passthrough", "R2": "keep_codes", "R3": "keep_and_relabel", "R4": "text_without_digits", "R5": "digits", "R11": "integer_text",
             "R12": "text_length", "R12b": "text_length", "R13": "range_or_number", "R14": "tract_code"}
    for era in SECTIONS:
        rows, rules = appendix(era), preset(era)
        assert [c for c, _, _ in rows] == rules.outputs
        for c, rule, arguments in rows:
            assert rules[c].kind == kinds.get(rule, "numeric"), (era, c)
            if rule == "R2":
                assert list(rules[c].args[0]) == [v.strip() for v in arguments.split(";")], (era, c)


def test_literal_like_switch(spark):
    df = spark.createDataFrame([("CA",), ("C1",), ("%[",)], "state_abbr string")
    values = lambda rs: [r[0] for r in df.select(rs["state_abbr"].column("state_abbr")).collect()]
    assert values(preset("2007")) == ["CA", None, None]
    assert values(preset("2007", literal_like=True)) == [None, None, None]
    assert preset("2007", literal_like=True).outputs == preset("2007").outputs
    assert preset("2018", literal_like=True).outputs == preset("2018").outputs
