"""Fixed values of the area data: codes, deny-lists, file layouts and column names."""

from __future__ import annotations

#: Name of the key column shared by every prepared table.
KEY = "County-State"

# State names and postal codes.
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA",
    "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO",
    "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ",
    "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH",
    "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC",
    "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT",
    "Virginia": "VA", "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}

# Entries of the yearly ranking files that are not counties.
HEADER_TOKENS = ["State Abbreviation", "state"]
NON_STATES = ["US", *HEADER_TOKENS, ""]
NON_COUNTIES = [*STATE_CODES, ""]

# Territories left out when a table is prepared state by state.
TERRITORY_NAMES = ["Puerto Rico", "District of Columbia"]
TERRITORY_CODES = ["DC", "PR", "GU", "VI", "AS"]

# States without a school file; every other state has one.
SCHOOL_FILES_MISSING = ["Alaska", "Louisiana", "Maine", "Maryland", "North Carolina", "Texas", "Virginia"]
SCHOOL_FILE_STATES = [s for s in STATE_CODES if s not in SCHOOL_FILES_MISSING]

# Fixed value: name of a yearly ranking file.
RANKING_FILE = "grad_data{year}.csv"
# Column positions in the yearly ranking files (state and county stay put).
RANKING_STATE = 3
RANKING_COUNTY = 4
RANKING_RATE = {
    2010: 88, 2011: 88, 2012: 93, 2013: 99, 2014: 115, 2015: 115,
    2016: 115, 2017: 115, 2018: 128, 2019: 133, 2020: 182, 2021: 477,
}
# Column positions in the single-year export.
SINGLE_YEAR = {"state": 7, "county": 9, "rate": 58}

# Column names of the survey tables and of the measures made from them.
DROPOUT_POPULATION = "Total Population 16 to 19 Years"
DROPOUT_RATE = "Drop_Out_Rate_By_County"
TEEN_POPULATION = "B23027_002E"
TEEN_WORKED = "B23027_003E"
TEEN_RATE = "Percentage of Teens Who Work Part or Full time"
INCOME_FIELD = "B19049_001E"
INCOME = "Median-Household-Income"
GRADUATION_RATE = "Graduation-Rate"
PRIVATE_SHARE = "Percentage-Private-School"
PUBLIC_SHARE = "Percentage-Public-School"

# Survey fields behind the drop-out table.
DROPOUT_FIELDS = {
    "population": "B14005_001E",
    "male": ["B14005_012E", "B14005_013E"],
    "female": ["B14005_026E", "B14005_027E"],
}
