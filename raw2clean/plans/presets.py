"""Rule tables of the five loan-record layouts, held as data.

Each preset is a ``RuleSet`` whose output columns come in the order of the
cleaned table. Eras: ``2000`` (years 2000-2003, 23 columns), ``2004``
(2004-2006, 39), ``2007`` (2007-2017, 79), ``2018`` (2018, 99) and ``2019``
(2019-2023, 99; same table as 2018).

Choices (see README): text-length rules keep their literal LIKE test, which
in Spark SQL only rejects text holding the nine characters ``[^A-Za-z]``;
the two-character state abbreviation asks for two letters; tract codes use
the ``fixed2`` style unless ``tract_style="truncate"`` is passed.
"""

from __future__ import annotations

from raw2clean.functions.rules import (
    digits,
    integer_text,
    keep_and_relabel,
    keep_codes,
    numeric,
    passthrough,
    range_or_number,
    text_length,
    text_without_digits,
    tract_code,
)
from raw2clean.plans.ruleset import RuleSet

# ---------------------------------------------------------------------------
# Fixed values, from here to the end of ``_era_2018``: column names, code lists,
# labels, sentinels, bounds and patterns that must equal the source jobs' for
# equal results. Written as in the source, in source order.
# ---------------------------------------------------------------------------
LITERAL_CLASS = "%[^A-Za-z]%"
NA = ["NA"]
NA_EXEMPT = ["NA", "EXEMPT"]
AGE_EXCLUDE = ["8888", "9999"]

RACE_NAMES_2007 = [
    "American Indian or Alaskan Native", "Asian or Pacific Islander", "Black", "Hispanic",
    "White", "Other", "Native Hawaiian or Other Pacific Islander",
]
CO_RACE_NAMES_2007 = RACE_NAMES_2007 + ["No co-applicant"]
DENIAL_NAMES_2007 = [
    "Debt-to-income ratio", "Employment history", "Credit history", "Collateral",
    "Insufficient cash (downpayment, closing cost)", "Unverifiable information",
    "Credit application incomplete", "Mortgage insurance denied", "Other",
]
NOT_APPLICABLE = {"Not applicable": "NA"}

RACE_2018 = ["1", "2", "21", "22", "23", "24", "25", "26", "27", "3", "4", "41", "42", "43", "44", "5"]
ETHNICITY_2018 = ["1", "11", "12", "13", "14", "2"]
DEBT_TO_INCOME_2018 = [
    "<20%", "20%-<30%", "30%-<36%", "36%", "37%", "38%", "39%", "40%", "41%", "42%", "43%",
    "44%", "45%", "46%", "47%", "48%", "49%", "50%-60%", ">60%", "NA", "Exempt",
]
TOTAL_UNITS_2018 = ["1", "2", "3", "4", "5-24", "25-49", "50-99", "100-149", ">149"]
CO_APPLICANT_AGE_2018 = ["< 25", "25-34", "35-44", "45-54", "55-64", "65-74", "> 74"]
DERIVED_RACE_2018 = [
    "American Indian or Alaska Native", "Asian", "Black or African American",
    "Native Hawaiian or Other Pacific Islander", "White", "2 or more minority races", "Joint",
    "Free Form Text Only", "Race Not Available",
]
DERIVED_ETHNICITY_2018 = [
    "Hispanic or Latino", "Not Hispanic or Latino", "Joint", "Ethnicity Not Available",
    "Free Form Text Only",
]
DWELLING_2018 = [
    "Single Family (1-4 Units):Site-Built", "Multifamily:Site-Built (5+ Units)",
    "Single Family (1-4 Units):Manufactured", "Multifamily:Manufactured (5+ Units)",
]
LOAN_PRODUCT_2018 = [
    "Conventional:First Lien", "FHA:First Lien", "VA:First Lien", "FSA/RHS:First Lien",
    "Conventional:Subordinate Lien", "FHA:Subordinate Lien", "VA:Subordinate Lien",
    "FSA/RHS:Subordinate Lien",
]

# Key columns of the 2007-2017 key dedup, in source order.
DEDUP_KEYS_2007 = [
    "respondent_id", "agency_code", "loan_type", "property_type", "loan_purpose",
    "owner_occupancy", "loan_amount_000s", "preapproval", "action_taken", "msamd",
    "state_code", "county_code", "census_tract_number", "applicant_ethnicity",
    "co_applicant_ethnicity", "applicant_race_1", "applicant_race_2", "applicant_race_3",
    "applicant_race_4", "applicant_race_5", "co_applicant_race_1", "co_applicant_race_2",
    "co_applicant_race_3", "co_applicant_race_4", "co_applicant_race_5", "applicant_sex",
    "co_applicant_sex", "applicant_income_000s", "purchaser_type", "denial_reason_1",
    "denial_reason_2", "denial_reason_3", "rate_spread", "hoepa_status", "lien_status",
    "edit_status", "population", "minority_population", "hud_median_family_income",
    "tract_to_msamd_income", "number_of_owner_occupied_units",
    "number_of_1_to_4_family_units", "application_date_indicator",
]


def _codes(*values: str):
    return keep_codes(values)


def _era_2000(tract_style: str):
    return [
        ("activity_year", passthrough()),
        ("respondent_id", passthrough()),
        ("loan_type", _codes("1", "2", "3", "4")),
        ("loan_purpose", _codes("1", "2", "3", "4")),
        ("occupancy_type", _codes("1", "2", "3")),
        ("loan_amount", numeric(low=0)),
        ("action_taken", _codes("1", "2", "3", "4", "5", "6", "7", "8")),
        ("msamd", digits(NA)),
        ("state_code", text_length(min_length=1, not_like=LITERAL_CLASS)),
        ("county_code", text_length(min_length=2, not_like=LITERAL_CLASS)),
        ("census_tract", numeric()),
        ("census_tract_id", tract_code("state_code", "county_code", "census_tract", tract_style)),
        ("applicant_race_1", _codes("1", "2", "3", "4", "5", "6", "7", "8")),
        ("co_applicant_race_1", _codes("1", "2", "3", "4", "5", "6", "7", "8")),
        ("applicant_sex", _codes("1", "2", "3", "4")),
        ("co_applicant_sex", _codes("1", "2", "3", "4", "5")),
        ("income", numeric(low=0)),
        ("purchaser_type", _codes("0", "1", "2", "3", "4", "5", "6", "7", "8", "9")),
        ("denial_reason_1", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9")),
        ("denial_reason_2", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9")),
        ("denial_reason_3", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9")),
        ("edit_status", _codes("5", "6", "7")),
        ("sequence_number", numeric()),
    ]


def _era_2004(tract_style: str):
    race = ("1", "2", "3", "4", "5", "6", "7")
    co_race = ("1", "2", "3", "4", "5", "6", "7", "8")
    return [
        ("activity_year", passthrough()),
        ("respondent_id", passthrough()),
        ("agency_code", _codes("1", "2", "3", "4", "5", "7", "9")),
        ("loan_type", _codes("1", "2", "3", "4")),
        ("loan_purpose", _codes("1", "2", "3", "4")),
        ("occupancy", _codes("1", "2", "3")),
        ("loan_amount", numeric(low=0)),
        ("action_taken", _codes("1", "2", "3", "4", "5", "6", "7", "8")),
        ("msamd", digits(NA)),
        ("state_code", text_length(min_length=1, not_like=LITERAL_CLASS)),
        ("county_code", text_length(min_length=2, not_like=LITERAL_CLASS)),
        ("census_tract", numeric()),
        ("census_tract_id", tract_code("state_code", "county_code", "census_tract", tract_style)),
        ("applicant_sex", _codes("1", "2", "3", "4")),
        ("co_applicant_sex", _codes("1", "2", "3", "4", "5")),
        ("income", numeric(low=0)),
        ("purchaser_type", _codes("0", "1", "2", "3", "4", "5", "6", "7", "8", "9")),
        ("denial_reason_1", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9")),
        ("denial_reason_2", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9")),
        ("denial_reason_3", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9")),
        ("edit_status", _codes("5", "6", "7")),
        ("property_type", _codes("1", "2", "3")),
        ("preapproval", _codes("1", "2", "3")),
        ("applicant_ethnicity", _codes("1", "2", "3", "4")),
        ("co_applicant_ethnicity", _codes("1", "2", "3", "4", "5")),
        ("applicant_race_1", keep_codes(race)),
        ("applicant_race_2", keep_codes(race)),
        ("applicant_race_3", keep_codes(race)),
        ("applicant_race_4", keep_codes(race)),
        ("applicant_race_5", keep_codes(race)),
        ("co_applicant_race_1", keep_codes(co_race)),
        ("co_applicant_race_2", keep_codes(co_race)),
        ("co_applicant_race_3", keep_codes(co_race)),
        ("co_applicant_race_4", keep_codes(co_race)),
        ("co_applicant_race_5", keep_codes(co_race)),
        ("rate_spread", numeric()),
        ("hoepa_status", _codes("1", "2")),
        ("lien_status", _codes("1", "2", "3", "4")),
        ("sequence_number", numeric()),
    ]


def _era_2007(tract_style: str):
    race = ("1", "2", "3", "4", "5", "6", "7")
    co_race = ("1", "2", "3", "4", "5", "6", "7", "8")
    out = [
        ("as_of_year", passthrough()),
        ("respondent_id", passthrough()),
        ("agency_name", text_without_digits()),
        ("agency_abbr", text_without_digits()),
        ("agency_code", digits()),
        ("loan_type_name", text_without_digits()),
        ("loan_type", _codes("1", "2", "3", "4")),
        ("property_type_name", text_without_digits()),
        ("property_type", _codes("1", "2", "3")),
        ("loan_purpose_name", text_without_digits()),
        ("loan_purpose", _codes("1", "2", "3", "4")),
        ("owner_occupancy_name", text_without_digits()),
        ("owner_occupancy", _codes("1", "2", "3")),
        ("loan_amount_000s", numeric(low=0)),
        ("preapproval_name", text_without_digits()),
        ("preapproval", _codes("1", "2", "3")),
        ("action_taken_name", text_without_digits()),
        ("action_taken", _codes("1", "2", "3", "4", "5", "6", "7", "8")),
        ("msamd_name", text_without_digits()),
        ("msamd", digits(NA)),
        ("state_name", text_without_digits()),
        ("state_abbr", text_length(exact=2, charset="A-Za-z")),
        ("state_code", text_length(min_length=1, not_like=LITERAL_CLASS)),
        ("county_name", text_without_digits()),
        ("county_code", text_length(min_length=2, not_like=LITERAL_CLASS)),
        ("census_tract_number", numeric()),
        ("census_tract", tract_code("state_code", "county_code", "census_tract_number", tract_style)),
        ("applicant_ethnicity_name",
         keep_and_relabel(["Not Hispanic or Latino", "Hispanic or Latino"], NOT_APPLICABLE)),
        ("applicant_ethnicity", _codes("1", "2", "3", "4")),
        ("co_applicant_ethnicity_name",
         keep_and_relabel(["Not Hispanic or Latino", "Hispanic or Latino", "No co-applicant"],
                          NOT_APPLICABLE)),
        ("co_applicant_ethnicity", _codes("1", "2", "3", "4", "5")),
    ]
    for i in range(1, 6):
        out.append((f"applicant_race_name_{i}", keep_and_relabel(RACE_NAMES_2007, NOT_APPLICABLE)))
        out.append((f"applicant_race_{i}", keep_codes(race)))
    for i in range(1, 6):
        out.append((f"co_applicant_race_name_{i}", keep_and_relabel(CO_RACE_NAMES_2007, NOT_APPLICABLE)))
        out.append((f"co_applicant_race_{i}", keep_codes(co_race)))
    out += [
        ("applicant_sex_name", keep_and_relabel(["Male", "Female"], NOT_APPLICABLE)),
        ("applicant_sex", _codes("1", "2", "3", "4")),
        ("co_applicant_sex_name", keep_and_relabel(["Male", "Female", "No co-applicant"], NOT_APPLICABLE)),
        ("co_applicant_sex", _codes("1", "2", "3", "4", "5")),
        ("applicant_income_000s", numeric(low=0)),
        ("purchaser_type_name", text_without_digits()),
        ("purchaser_type", _codes("0", "1", "2", "3", "4", "5", "6", "7", "8", "9")),
    ]
    for i in range(1, 4):
        out.append((f"denial_reason_name_{i}", keep_codes(DENIAL_NAMES_2007)))
        out.append((f"denial_reason_{i}", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9")))
    out += [
        ("rate_spread", numeric()),
        ("hoepa_status_name", _codes("HOEPA loan", "Not a HOEPA loan")),
        ("hoepa_status", _codes("1", "2")),
        ("lien_status_name",
         keep_and_relabel(["Secured by a first lien", "Secured by a subordinate lien",
                           "Not secured by a lien"], {"Not applicable (purchased loans)": "NA"})),
        ("lien_status", _codes("1", "2", "3", "4")),
        ("edit_status_name",
         _codes("No edit failures", "Validity edit failure only", "Quality edit failure only",
                "Validity and quality edit failures")),
        ("edit_status", _codes("5", "6", "7")),
        ("sequence_number", numeric()),
        ("population", numeric()),
        ("minority_population", numeric(high=100)),
        ("hud_median_family_income", numeric()),
        ("tract_to_msamd_income", numeric(low=0)),
        ("number_of_owner_occupied_units", numeric(low=0)),
        ("number_of_1_to_4_family_units", numeric(low=0)),
        ("application_date_indicator", _codes("0", "1", "2")),
    ]
    return out


def _era_2018(tract_style: str):
    num_na = numeric(sentinels=NA_EXEMPT)
    nonneg_na = numeric(low=0, sentinels=NA_EXEMPT)
    nonneg = numeric(low=0)
    out = [
        ("activity_year", passthrough()),
        ("applicant_age", range_or_number(sentinels=NA_EXEMPT, exclude=AGE_EXCLUDE)),
        ("census_tract", integer_text([10, 11])),
        ("county_code", integer_text([4, 5])),
        ("derived_msa-md", integer_text([4, 5])),
        ("discount_points", num_na),
        ("income", num_na),
        ("interest_rate", num_na),
        ("intro_rate_period", nonneg_na),
        ("lei", passthrough()),
        ("lender_credits", num_na),
        ("loan_amount", nonneg_na),
        ("loan_to_value_ratio", nonneg_na),
        ("multifamily_affordable_units", nonneg_na),
        ("origination_charges", nonneg_na),
        ("prepayment_penalty_term", nonneg_na),
        ("property_value", nonneg_na),
        ("rate_spread", num_na),
        ("state_code", text_length(exact=2, not_like=LITERAL_CLASS, sentinels=NA_EXEMPT)),
        ("total_loan_costs", nonneg_na),
        ("total_points_and_fees", nonneg_na),
        ("tract_median_age_of_housing_units", nonneg),
        ("tract_one_to_four_family_homes", nonneg),
        ("tract_owner_occupied_units", nonneg),
        ("tract_to_msa_income_percentage", nonneg),
        ("ffiec_msa_md_median_family_income", nonneg),
        ("tract_minority_population_percent", nonneg),
        ("tract_population", nonneg),
    ]
    for i in range(1, 5):
        out.append((f"denial_reason-{i}", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9")))
    out += [
        ("aus-1", _codes("1", "2", "3", "4", "5", "6", "7", "1111")),
        ("aus-2", _codes("1", "2", "3", "4", "5", "7")),
        ("aus-3", _codes("1", "2", "3", "4", "7")),
        ("aus-4", _codes("1", "2", "3", "4", "7")),
        ("aus-5", _codes("1", "2", "3", "4", "7")),
        ("initially_payable_to_institution", _codes("1", "2", "3", "1111")),
        ("submission_of_application", _codes("1", "2", "3", "1111")),
        ("co-applicant_age_above_62", _codes("yes", "no", "NA")),
        ("co-applicant_age", keep_codes(CO_APPLICANT_AGE_2018)),
        ("applicant_age_above_62", _codes("Yes", "No", "NA")),
        ("co-applicant_sex_observed", _codes("1", "2", "3", "4")),
        ("applicant_sex_observed", _codes("1", "2", "3")),
        ("co-applicant_sex", _codes("1", "2", "3", "4", "5", "6")),
        ("applicant_sex", _codes("1", "2", "3", "4", "6")),
        ("co-applicant_race_observed", _codes("1", "2", "3", "4")),
        ("applicant_race_observed", _codes("1", "2", "3")),
    ]
    for i in range(5, 1, -1):
        out.append((f"co-applicant_race-{i}", keep_codes(RACE_2018)))
    out.append(("co-applicant_race-1", keep_codes(RACE_2018 + ["6", "7", "8"])))
    for i in range(5, 1, -1):
        out.append((f"applicant_race-{i}", keep_codes(RACE_2018)))
    out.append(("applicant_race-1", keep_codes(RACE_2018 + ["6", "7"])))
    out += [
        ("co-applicant_ethnicity_observed", _codes("1", "2", "3", "4")),
        ("applicant_ethnicity_observed", _codes("1", "2", "3")),
    ]
    for i in range(5, 1, -1):
        out.append((f"co-applicant_ethnicity-{i}", keep_codes(ETHNICITY_2018)))
    out.append(("co-applicant_ethnicity-1", keep_codes(ETHNICITY_2018 + ["3", "4", "5"])))
    for i in range(5, 1, -1):
        out.append((f"applicant_ethnicity-{i}", keep_codes(ETHNICITY_2018)))
    out.append(("applicant_ethnicity-1", keep_codes(ETHNICITY_2018 + ["3", "4"])))
    out += [
        ("co-applicant_credit_score_type",
         _codes("1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "1111")),
        ("applicant_credit_score_type", _codes("1", "2", "3", "4", "5", "6", "7", "8", "9", "1111")),
        ("debt_to_income_ratio", keep_codes(DEBT_TO_INCOME_2018)),
        ("total_units", keep_codes(TOTAL_UNITS_2018)),
        ("manufactured_home_land_property_interest", _codes("1", "2", "3", "4", "5", "1111")),
        ("manufactured_home_secured_property_type", _codes("1", "2", "3", "1111")),
        ("occupancy_type", _codes("1", "2", "3")),
        ("construction_method", _codes("1", "2")),
        ("other_nonamortizing_features", _codes("1", "2", "1111")),
        ("balloon_payment", _codes("1", "2", "1111")),
        ("interest_only_payment", _codes("1", "2", "1111")),
        ("negative_amortization", _codes("1", "2", "1111")),
        ("loan_term", nonneg),
        ("hoepa_status", _codes("1", "2", "1111")),
        ("business_or_commercial_purpose", _codes("1", "2", "1111")),
        ("open-end_line_of_credit", _codes("1", "2", "1111")),
        ("reverse_mortgage", _codes("1", "2", "1111")),
        ("lien_status", _codes("1", "2")),
        ("loan_purpose", _codes("1", "2", "31", "32", "4", "5")),
        ("loan_type", _codes("1", "2", "3", "4")),
        ("preapproval", _codes("1", "2")),
        ("purchaser_type", _codes("0", "1", "2", "3", "4", "5", "6", "71", "72", "8", "9")),
        ("action_taken", _codes("1", "2", "3", "4", "5", "6", "7", "8")),
        ("derived_sex", _codes("Male", "Female", "Joint", "Sex Not Available")),
        ("derived_race", keep_codes(DERIVED_RACE_2018)),
        ("derived_ethnicity", keep_codes(DERIVED_ETHNICITY_2018)),
        ("conforming_loan_limit", _codes("C", "NC", "U", "NA")),
        ("derived_dwelling_category", keep_codes(DWELLING_2018)),
        ("derived_loan_product_type", keep_codes(LOAN_PRODUCT_2018)),
    ]
    return out


_ERAS = {"2000": _era_2000, "2004": _era_2004, "2007": _era_2007, "2018": _era_2018, "2019": _era_2018}

# Which preset a data year uses.
YEAR_TO_ERA = {**{str(y): "2000" for y in range(2000, 2004)},
               **{str(y): "2004" for y in range(2004, 2007)},
               **{str(y): "2007" for y in range(2007, 2018)},
               "2018": "2018",
               **{str(y): "2019" for y in range(2019, 2024)}}


def preset(era: str | int, tract_style: str = "fixed2", literal_like: bool = False) -> RuleSet:
    """The rule table of one era (``2000``, ``2004``, ``2007``, ``2018``, ``2019``).

    ``literal_like=True``: the two-character state abbreviation keeps the
    source's LIKE test on the literal text ``[^A-Za-z]``, which no two
    characters pass (R12b): the column is NULL in every row.
    """
    era = str(era)
    if era not in _ERAS:
        raise KeyError(f"unknown era {era!r}; known: {sorted(_ERAS)}")
    rules = dict(_ERAS[era](tract_style))
    if literal_like and "state_abbr" in rules:
        rules["state_abbr"] = text_length(exact=2, like=LITERAL_CLASS)
    return RuleSet(rules, name=f"loans_{era}")


def preset_for_year(year: str | int, tract_style: str = "fixed2", literal_like: bool = False) -> RuleSet:
    return preset(YEAR_TO_ERA[str(year)], tract_style, literal_like)
