"""Loan cleaning jobs end to end on small CSV files of each layout."""

import csv
import os

from raw2clean.plans.jobs import run_clean, run_quality
from raw2clean.plans.presets import DEDUP_KEYS_2007, preset
from raw2clean.operators import quality as Q


def _csv(path, header, rows, junk_first_line=False):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        if junk_first_line:
            w.writerow([f"x{i}" for i in range(len(header))])
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def _row(cols, **vals):
    return [vals.get(c.replace("-", "_"), "1") for c in cols]


def test_clean_2007_dedups_on_keys(spark, tmp_dir):
    cols = preset("2007").inputs
    base = dict(census_tract_number="1234.01", state_code="6", county_code="37",
                applicant_ethnicity_name="Not applicable", sequence_number="5", loan_type="9",
                agency_name="Bank 1", minority_population="100.5")
    rows = [_row(cols, **base), _row(cols, **{**base, "sequence_number": "3"}),
            _row(cols, **{**base, "sequence_number": "3"}), [None] * len(cols)]
    _csv(f"{tmp_dir}/h.csv", cols, rows)
    out = run_clean(spark, 2010, f"{tmp_dir}/h.csv", f"{tmp_dir}/out")
    got = out.collect()
    assert len(got) == 1 and len(out.columns) == 79
    r = got[0].asDict()
    assert r["sequence_number"] == "3"          # fixed survivor: smallest other columns
    assert r["census_tract"] == "06037123401"
    assert r["applicant_ethnicity_name"] == "NA" and r["loan_type"] is None
    assert r["agency_name"] is None and r["minority_population"] is None
    written = spark.read.option("header", True).csv(f"{tmp_dir}/out")
    assert written.count() == 1 and len(written.columns) == 79
    assert set(DEDUP_KEYS_2007) <= set(out.columns)


def test_clean_2000_promotes_header(spark, tmp_dir):
    cols = preset("2000").inputs
    rows = [_row(cols, census_tract="9.1", state_code="06", county_code="001", loan_amount="-1"),
            _row(cols, census_tract="9.1", state_code="06", county_code="001", loan_amount="-1")]
    _csv(f"{tmp_dir}/h.csv", cols, rows, junk_first_line=True)
    out = run_clean(spark, 2000, f"{tmp_dir}/h.csv", tract_style="truncate")
    got = out.collect()
    assert len(got) == 1 and out.columns == preset("2000").outputs
    assert got[0]["census_tract_id"] == "06001000009" and got[0]["loan_amount"] is None


def test_clean_2018_distinct(spark, tmp_dir):
    cols = preset("2018").inputs
    base = dict(applicant_age="25-34", census_tract="06037123401", county_code="06037",
                debt_to_income_ratio="Exempt", state_code="CA", loan_amount="EXEMPT")
    rows = [_row(cols, **base), _row(cols, **base), _row(cols, **{**base, "applicant_age": "8888"})]
    _csv(f"{tmp_dir}/h.csv", cols, rows)
    out = run_clean(spark, 2018, f"{tmp_dir}/h.csv")
    got = sorted((r["applicant_age"] or "") for r in out.collect())
    assert got == ["", "25-34"]
    r = out.where("applicant_age = '25-34'").first()
    assert r["debt_to_income_ratio"] == "Exempt" and r["state_code"] == "CA" and r["loan_amount"] == "EXEMPT"


def test_quality_job_writes_outcomes(spark, tmp_dir):
    _csv(f"{tmp_dir}/s.csv", ["intersection directions", "plus4", "bd blends"],
         [["a", None, None], [None, None, "B20"]])
    rules = [Q.non_empty(c) for c in ("intersection directions", "plus4", "bd blends")]
    out = run_quality(spark, f"{tmp_dir}/s.csv", rules, out_path=f"{tmp_dir}/qc", fmt="json")
    back = spark.read.json(f"{tmp_dir}/qc")
    assert back.count() == 3
    assert {r["rule"]: r["outcome"] for r in out.collect()} == {
        'ColumnValues "intersection directions" != EMPTY with threshold > 0': "Passed",
        'ColumnValues "plus4" != EMPTY with threshold > 0': "Failed",
        'ColumnValues "bd blends" != EMPTY with threshold > 0': "Passed"}
    stats = run_quality(spark, f"{tmp_dir}/s.csv", statistics=True, result="statistics",
                        out_path=f"{tmp_dir}/stats", fmt="parquet")
    assert stats.count() == 3 and spark.read.parquet(f"{tmp_dir}/stats").count() == 3
    assert os.path.isdir(f"{tmp_dir}/stats")


def test_clean_gives_a_session_the_settings_for_wide_rules(spark):
    from raw2clean.plans.jobs import clean
    from raw2clean.session import WIDE_RULES

    def cleaned(own):
        s = spark.newSession()
        for key, value in {"spark.sql.codegen.hugeMethodLimit": "65535", "spark.sql.codegen.maxFields": "100", **own}.items():
            s.conf.set(key, value)
        rules = preset("2004")
        df = s.createDataFrame([["1"] * len(rules.inputs)] * 2, ", ".join(f"`{c}` string" for c in rules.inputs))
        assert clean(df, rules).count() == 1
        return {key: s.conf.get(key) for key in WIDE_RULES}

    assert cleaned({}) == WIDE_RULES
    assert cleaned({"spark.sql.codegen.maxFields": "77"}) == WIDE_RULES | {"spark.sql.codegen.maxFields": "77"}


def _shuffled(spark):
    """Bytes of the session's shuffle files that are there now."""
    at = spark.sparkContext.getConf().get("spark.local.dir")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(at) for f in files if f.startswith("shuffle_") and f.endswith(".data"))


def test_clean_shuffles_wide_rows_packed(spark, tmp_dir):
    from raw2clean.operators.dedup import distinct_rows
    from raw2clean.plans.jobs import clean
    rules = preset("2018")
    df = spark.range(0, 2_000, 1, 2).selectExpr(*[f"CAST((id + {i}) % 7 AS STRING) AS `{c}`" for i, c in enumerate(rules.inputs)])
    sizes = []
    for out in (distinct_rows(rules.apply(df), drop_all_null=True), clean(df, rules)):
        before = _shuffled(spark)
        assert out.count() == 7
        sizes.append(_shuffled(spark) - before)
    assert 0 < 2 * sizes[1] < sizes[0]


def test_clean_years_frees_what_it_shuffled(spark, tmp_dir):
    from raw2clean.plans.jobs import run_clean_years
    from raw2clean.session import FREE_SHUFFLES
    cols = preset("2004").inputs
    _csv(f"{tmp_dir}/h.csv", cols, [_row(cols, respondent_id=str(i % 900)) for i in range(1_000)])
    before, setting = _shuffled(spark), spark.conf.get(FREE_SHUFFLES)
    out = run_clean_years(spark, {y: f"{tmp_dir}/h.csv" for y in ("2004", "2005")}, f"{tmp_dir}/out")
    assert _shuffled(spark) <= before and spark.conf.get(FREE_SHUFFLES) == setting
    assert [out[y].count() for y in ("2004", "2005")] == [900, 900] and spark.read.option("header", True).csv(f"{tmp_dir}/out").count() == 1_800
