import pytest
from conftest import collected
from pyspark.sql import Observation, functions as F

from areastats.config import (
    DROPOUT_RATE,
    GRADUATION_RATE,
    KEY,
    NON_COUNTIES,
    PRIVATE_SHARE,
    PUBLIC_SHARE,
    RANKING_RATE,
    SCHOOL_FILE_STATES,
    STATE_CODES,
    TEEN_RATE,
)
from areastats.operators.combine import fill_missing
from areastats.operators.measures import count_by_key
from areastats.plans.measures import (
    dropout_rate,
    graduation_rate,
    household_income,
    merge_measures,
    svi_by_area,
    teen_work_rate,
)
from areastats.plans.preparation import (
    graduation_lines,
    prepare_dropouts,
    prepare_income,
    prepare_sites,
    prepare_teens,
    site_lines,
    svi_lines,
)
from areastats.plans.schools import raw_site_keys, shares_from_counts, site_counts, site_keys

FLAT = "COUNTY string, STATE string, NAME string"


def test_fixed_values():
    assert len(STATE_CODES) == len(set(STATE_CODES.values())) == 50
    assert len(NON_COUNTIES) == 51 and len(SCHOOL_FILE_STATES) == 43
    assert sorted(RANKING_RATE) == list(range(2010, 2022))


def test_site_keys(rows):
    records = rows(
        f"properties struct<{FLAT}>",
        [(("Adams", "NE", "a"),), (("", "AL", "b"),), ((None, "AL", "c"),), (("Autauga", None, "d"),), ((" pike", "AR", None),)],
    )
    assert collected(site_keys(records)) == [("ADAMS-NE", "a"), ("PIKE-AR", None)]


def test_raw_site_keys_keep_blank_counties(rows):
    raw = rows(FLAT, [("Adams", "NE", "a"), ("", "AL", "b"), (None, "AL", "c"), ("Pike", None, "d")])
    assert collected(raw_site_keys(raw)) == [("-AL", "b"), ("ADAMS-NE", "a"), ("PIKE", "d")]


def test_site_counts_equal_fill_then_count(rows):
    keyed = f"`{KEY}` string, Name string"
    base = rows(keyed, [("A-AL", "1"), ("A-AL", "2"), (None, "3"), ("D-AL", "4")])
    filler = rows(keyed, [("A-AL", "5"), ("B-AL", "6"), (None, "7")])
    raw = rows(FLAT, [("b", "AL", "8"), ("c", "AL", "9"), ("d", "AL", "x"), (None, "AL", "y")])
    counts = collected(site_counts(base, [filler], [raw], "Public"))
    assert counts == [("A-AL", 2), ("B-AL", 2), ("C-AL", 1), ("D-AL", 1), (None, 1)]
    filled = fill_missing(base, [filler, raw_site_keys(raw)])
    assert counts == collected(count_by_key(filled, "Public"))


def test_shares_drop_areas_with_one_kind_only(rows):
    public = rows(f"`{KEY}` string, Public long", [("a", 3), ("b", 1)])
    private = rows(f"`{KEY}` string, Private long", [("a", 1), ("c", 1)])
    shares = shares_from_counts([public, private])
    assert shares.columns == [KEY, PRIVATE_SHARE, PUBLIC_SHARE]
    assert collected(shares) == [("a", 0.25, 0.75)]


def test_svi(rows):
    records = rows(
        "COUNTY string, ST_ABBR string, RPL_THEMES double",
        [("Adams", "NE", 0.5), ("", "NE", 0.5), ("Pike", "", 0.5), ("Pike", "AR", None), ("Pike", "AL", -999.0)],
    )
    assert collected(svi_by_area(records)) == [("ADAMS-NE", 0.5), ("PIKE-AL", -999.0)]
    assert collected(svi_by_area(records, sentinels=[-999.0])) == [("ADAMS-NE", 0.5)]


def test_graduation(rows):
    data = [
        ("Autauga County", "AL", "0.8"),
        ("Autauga County", "AL", "0.9"),
        ("Autauga County", "AL", ""),
        ("Autauga County", "AL", None),
        ("Autauga County", "AL", "n/a"),
        ("Orleans Parish", "LA", "0.5"),
        ("Iowa", "IA", "0.7"),
        ("Iowa County", "IA", "0.6"),
        ("United States", "US", "0.7"),
        ("county", "state", "rate"),
        ("District of Columbia", "DC", "0.4"),
        (None, "AL", "0.1"),
        ("Pike County", None, "0.1"),
    ]
    result = graduation_rate(rows("COUNTY string, STATE string, RATE string", data))
    assert result.columns == [KEY, GRADUATION_RATE]
    assert [(k, round(v, 9)) for k, v in collected(result)] == [
        ("AUTAUGA-AL", 0.85),
        ("DISTRICT OF COLUMBIA-DC", 0.4),
        ("IOWA-IA", 0.6),
        ("ORLEANS PARISH-LA", 0.5),
    ]


def test_dropout_and_teens(rows):
    d = rows(
        "_c0 string, County string, State string, Total_Dropout string, `Total Population 16 to 19 Years` string",
        [("0", "Autauga ", "Alabama", "3.0", "4"), ("1", "Ponce", "Puerto Rico", "1", "0")],
    )
    assert dropout_rate(d).columns == [KEY, DROPOUT_RATE]
    assert collected(dropout_rate(d)) == [("AUTAUGA-AL", 0.75), ("PONCE", None)]
    assert collected(dropout_rate(d, strict=True)) == [("AUTAUGA-AL", 0.75), (None, None)]
    t = rows("County string, State string, B23027_002E string, B23027_003E string", [("Adams ", "Nebraska", "10", "4")])
    assert teen_work_rate(t).columns == [KEY, TEEN_RATE]
    assert collected(teen_work_rate(t)) == [("ADAMS-NE", 0.4)]


def test_income(rows):
    df = rows("NAME string, State string, B19049_001E double", [("Autauga County", "Alabama", 58731.0), ("Orleans Parish", "Louisiana", None)])
    assert collected(household_income(df)) == [("AUTAUGA-AL", 58731.0), ("ORLEANS PARISH-LA", None)]


def test_merge_keeps_areas_with_every_measure(rows):
    a = rows(f"`{KEY}` string, SVI double", [("a", 0.1), ("b", 0.2)])
    b = rows(f"`{KEY}` string, X double", [("a", 1.0), ("c", 2.0)])
    assert collected(merge_measures([a, b])) == [("a", 0.1, 1.0)]
    assert merge_measures([a, b], "full").count() == 3


@pytest.fixture
def survey(rows):
    fields = ["B14005_001E", "B14005_012E", "B14005_013E", "B14005_026E", "B14005_027E", "B23027_002E", "B23027_003E"]
    schema = "OBJECTID int, NAME string, State string, " + ", ".join(f"{f} double" for f in fields)
    return rows(
        schema,
        [
            (1, "Autauga County", "Alabama", 100.0, 5.0, 2.0, 4.0, 1.0, 90.0, 30.0),
            (2, "Ponce", "Puerto Rico", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ],
    )


def test_prepare_dropouts(survey):
    out = prepare_dropouts(survey)
    assert out.columns == [
        "NAME", "State", "Total Population 16 to 19 Years", "Total_Male_Dropout", "Total_Female_Dropout", "Total_Dropout", "County",
    ]
    assert collected(out) == [("Autauga County", "Alabama", 100.0, 7.0, 5.0, 12.0, "Autauga ")]
    once = {"population": "B14005_001E", "male": ["B14005_012E"], "female": ["B14005_026E"]}
    assert prepare_dropouts(survey, fields=once).first()["Total_Dropout"] == 9.0
    assert collected(dropout_rate(out)) == [("AUTAUGA-AL", 0.12)]


def test_prepare_teens(survey):
    assert collected(prepare_teens(survey)) == [("Autauga County", "Alabama", 90.0, 30.0, "Autauga ")]


def test_prepare_income(survey):
    out = prepare_income(survey)
    assert out.columns == survey.columns
    assert collected(out) == collected(survey.where("State = 'Alabama'"))


def test_prepare_sites(rows):
    public = rows("NAME string, STATE string, LEVEL string", [("a", "AL", "x"), ("b", "PR", "x")])
    private = rows("STATE string, NAME string", [("GA", "c"), ("DC", "d"), (None, "e")])
    assert collected(prepare_sites([public, private])) == [("a", "AL", "x"), ("c", "GA", None)]


def test_text_lines(rows):
    sites = rows(FLAT, [("Adams", "NE", "x"), (None, "NE", "y")])
    assert collected(site_lines(sites)) == [("'Adams-NE' 'x'",)]
    svi = rows("COUNTY string, ST_ABBR string, RPL_THEMES double", [("Adams", "NE", 0.0003), (None, "NE", 1.0), ("Pike", "AR", None)])
    assert collected(svi_lines(svi)) == [("'ADAMS-NE' 0.0003",)]
    rates = rows("COUNTY string, STATE string, RATE string", [("Adams", "NE", "95"), ("Pike", "AR", "")])
    assert collected(graduation_lines(rates)) == [("'ADAMS-NE' 95",)]


def test_key_column_is_reachable(rows):
    df = rows(f"`{KEY}` string", [("a-AL",)])
    assert df.where(F.col(KEY) == "a-AL").count() == 1


def test_rejected_sites_are_counted_in_the_same_pass(spark, rows):
    data = [(("Adams", "NE", "a"),), (("", "AL", "b"),), ((None, "AL", "c"),), (("Autauga", None, "d"),), (("", None, "e"),), (None,)]
    records = rows(f"properties struct<{FLAT}>", data)
    counts = Observation()
    kept = site_keys(records, counts)
    assert kept._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert collected(kept) == collected(site_keys(records)) == [("ADAMS-NE", "a")]
    assert counts.get == {"kept": 1, "no_county": 4, "no_state": 1}
