"""Keyed measures from the vulnerability, ranking and survey tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from areastats.config import (
    DROPOUT_POPULATION,
    DROPOUT_RATE,
    GRADUATION_RATE,
    INCOME,
    INCOME_FIELD,
    KEY,
    NON_COUNTIES,
    NON_STATES,
    STATE_CODES,
    TEEN_POPULATION,
    TEEN_RATE,
    TEEN_WORKED,
)
from areastats.functions.keys import area_key, state_code
from areastats.functions.numbers import ratio, to_double
from areastats.functions.text import strip_anywhere, strip_suffix
from areastats.operators.combine import join_all
from areastats.operators.filters import nonblank, not_listed, present
from areastats.operators.measures import mean_by_key, mean_of_parts
from areastats.operators.project import pick


def svi_by_area(records: DataFrame, sentinels: Sequence[float] = ()) -> DataFrame:
    """``(County-State, SVI)`` of records with county, state and value.

    ``sentinels`` names values that stand for "missing" in the source; by default none do.
    """
    flat = pick(records, {"COUNTY": "COUNTY", "STATE": "ST_ABBR", "SVI": "RPL_THEMES"})
    rows = flat.where(nonblank("COUNTY", "STATE") & present("SVI"))
    if sentinels:
        rows = rows.where(~F.col("SVI").isin(list(sentinels)))
    return rows.select(
        area_key(F.col("COUNTY"), F.col("STATE"), strict=True).alias(KEY), to_double(F.col("SVI")).alias("SVI")
    )


def graduation_rate(
    rows: DataFrame,
    non_states: Sequence[str] = NON_STATES,
    non_counties: Sequence[str] = NON_COUNTIES,
    suffixes: Sequence[str] = (" County",),
    parts: tuple[str, str] | None = None,
) -> DataFrame:
    """Mean rate per area over all years from ``COUNTY, STATE, RATE`` text rows.

    Rows for the nation, for states and left-over header lines go by deny-list, rows without a
    rate by the blank test. A county that is named exactly like a state goes with the states.
    ``parts`` names columns with the sum and number of the rates of a row that stands for many; there is no ``RATE`` then.
    """
    kept = rows.where(not_listed("STATE", non_states) & not_listed("COUNTY", non_counties))
    key = area_key(strip_suffix(F.col("COUNTY"), suffixes), F.col("STATE"), trim=False, upper=False, strict=True)
    if parts:
        total, count = (F.col(f"`{p}`") for p in parts)
        return mean_of_parts(kept.where(count > 0).withColumn(KEY, key), total, count, GRADUATION_RATE)
    kept = kept.where(nonblank("RATE"))
    keyed = kept.select(key.alias(KEY), to_double(F.col("RATE")).alias("rate"))
    return mean_by_key(keyed, F.col("rate"), GRADUATION_RATE)


def _rate(
    rows: DataFrame, part: str, whole: str, name: str, codes: Mapping[str, str], strict: bool
) -> DataFrame:
    key = area_key(F.col("County"), state_code(F.col("State"), codes), strict=strict)
    return rows.select(key.alias(KEY), ratio(F.col(f"`{part}`"), F.col(f"`{whole}`")).alias(name))


def dropout_rate(rows: DataFrame, codes: Mapping[str, str] = STATE_CODES, strict: bool = False) -> DataFrame:
    """Share of 16 to 19 year olds that dropped out, per area (one input row per county)."""
    return _rate(rows, "Total_Dropout", DROPOUT_POPULATION, DROPOUT_RATE, codes, strict)


def teen_work_rate(rows: DataFrame, codes: Mapping[str, str] = STATE_CODES, strict: bool = False) -> DataFrame:
    """Share of 16 to 19 year olds that worked, per area; 0 to 1 despite its name."""
    return _rate(rows, TEEN_WORKED, TEEN_POPULATION, TEEN_RATE, codes, strict)


def household_income(rows: DataFrame, codes: Mapping[str, str] = STATE_CODES, strict: bool = False) -> DataFrame:
    """Median household income per area from ``NAME`` ("X County"), ``State`` and the survey field."""
    county = strip_anywhere(F.col("NAME"))
    key = area_key(county, state_code(F.col("State"), codes), strict=strict)
    return rows.select(key.alias(KEY), F.col(INCOME_FIELD).alias(INCOME))


def merge_measures(tables: Sequence[DataFrame], how: str = "inner") -> DataFrame:
    """One wide table of all measures, by default for the areas that have every one."""
    return join_all(tables, KEY, how)
