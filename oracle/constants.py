"""Values that the SQL twins use, written out here and not taken from the library they check."""

from __future__ import annotations

# State codes, abbreviations and names.
STATES = """
01 AL Alabama
02 AK Alaska
04 AZ Arizona
05 AR Arkansas
06 CA California
08 CO Colorado
09 CT Connecticut
10 DE Delaware
11 DC District of Columbia
12 FL Florida
13 GA Georgia
15 HI Hawaii
16 ID Idaho
17 IL Illinois
18 IN Indiana
19 IA Iowa
20 KS Kansas
21 KY Kentucky
22 LA Louisiana
23 ME Maine
24 MD Maryland
25 MA Massachusetts
26 MI Michigan
27 MN Minnesota
28 MS Mississippi
29 MO Missouri
30 MT Montana
31 NE Nebraska
32 NV Nevada
33 NH New Hampshire
34 NJ New Jersey
35 NM New Mexico
36 NY New York
37 NC North Carolina
38 ND North Dakota
39 OH Ohio
40 OK Oklahoma
41 OR Oregon
42 PA Pennsylvania
44 RI Rhode Island
45 SC South Carolina
46 SD South Dakota
47 TN Tennessee
48 TX Texas
49 UT Utah
50 VT Vermont
51 VA Virginia
53 WA Washington
54 WV West Virginia
55 WI Wisconsin
56 WY Wyoming
60 AS American Samoa
66 GU Guam
69 MP Northern Mariana Islands
72 PR Puerto Rico
78 VI U.S. Virgin Islands
"""
STATE_ROWS = [tuple(line.split(" ", 2)) for line in STATES.strip().splitlines()]

# Action codes and their meanings.
ACTIONS = [
    ("1", "Loan originated"),
    ("2", "Application approved but not accepted"),
    ("3", "Application denied"),
    ("4", "Application withdrawn by applicant"),
    ("5", "File closed for incompleteness"),
    ("6", "Loan purchased by institution"),
    ("7", "Preapproval request denied"),
    ("8", "Preapproval request approved but not accepted"),
]

# Names of each logical field, in order of preference.
KEY_FIELDS = {
    "activity_year": "activity_year raw_activity_year as_of_year".split(),
    "state_code": "state_code".split(),
    "county_code": "county_code".split(),
    "census_tract": "census_tract census_tract_number".split(),
    "lei_or_respondent_id": "lei_or_respondent_id lei respondent_id".split(),
    "lender_name_fields": "respondent_name institution_name lender_name legal_entity_name".split(),
    "loan_amount": "loan_amount loan_amount_000s".split(),
    "loan_type": "loan_type".split(),
    "loan_purpose": "loan_purpose".split(),
    "occupancy_type": "occupancy_type owner_occupancy".split(),
    "action_taken": "action_taken".split(),
    "applicant_income": "income applicant_income_000s".split(),
    "race_fields": "derived_race applicant_race_1 applicant_race_2 applicant_race_3 applicant_race_4 applicant_race_5 co_applicant_race_1 co_applicant_race_2 co_applicant_race_3 co_applicant_race_4 co_applicant_race_5 applicant_race-1 applicant_race-2 applicant_race-3 applicant_race-4 applicant_race-5 co-applicant_race-1 co-applicant_race-2 co-applicant_race-3 co-applicant_race-4 co-applicant_race-5".split(),
}

# Column, type, where the layouts keep it, what it holds, note.
COLUMNS = [
    ("activity_year", "INTEGER", "as_of_year; activity_year", "Year written in the row, as a whole number.", "Need not be the year of the file."),
    ("source_era", "VARCHAR", "file year", "Which of the two layouts the file has.", "The year of the file decides, never a row."),
    ("lender_id", "VARCHAR", "respondent_id; lei", "Whoever reported the loan, under the numbering of the time.", "The two numberings share no key."),
    ("lender_id_type", "VARCHAR", "file year", "Which numbering lender_id uses.", "One value for each layout."),
    ("state_code", "VARCHAR", "state_code", "State as written in the file.", "Kept as text; see the normalised columns for codes."),
    ("county_code", "VARCHAR", "county_code", "County as written in the file.", "Kept as text; see the normalised columns for codes."),
    ("census_tract", "VARCHAR", "census_tract_number; census_tract", "Tract as written in the file.", "Written differently in the two layouts."),
    ("loan_amount", "DOUBLE", "loan_amount_000s; loan_amount", "Amount of the loan in dollars.", "Thousands in the early layout are scaled up."),
    ("loan_type", "VARCHAR", "loan_type", "Code of the kind of loan.", "To be read with the codes of its layout."),
    ("loan_purpose", "VARCHAR", "loan_purpose", "Code of what the loan is for.", "To be read with the codes of its layout."),
    ("occupancy_type", "VARCHAR", "owner_occupancy; occupancy_type", "Code of how the home is used.", "Has another name in the early layout."),
    ("action_taken", "VARCHAR", "action_taken", "Code of how the application ended.", "Panels count each code they know by name."),
    ("applicant_income", "DOUBLE", "applicant_income_000s; income", "Income of the applicant as a number.", "In the unit of the file."),
    ("raw_source_columns", "JSON", "as_of_year,respondent_id,loan_amount_000s,owner_occupancy,applicant_income_000s,census_tract_number; raw_activity_year,lei,loan_amount,occupancy_type,income,census_tract", "The values that were renamed or converted, before that.", "One JSON object a row."),
]
