"""Survey and school tables as landed, prepared for the measure plans.

The tables used to be fetched state by state and put together again; here one filter and one
projection over the landed table do the same, and reach its scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from areastats.config import (
    DROPOUT_FIELDS,
    DROPOUT_POPULATION,
    TEEN_POPULATION,
    TEEN_WORKED,
    TERRITORY_CODES,
    TERRITORY_NAMES,
)
from areastats.functions.keys import area_key
from areastats.functions.numbers import total
from areastats.functions.text import plain_number, quoted_line, strip_anywhere
from areastats.operators.combine import concat_by_name
from areastats.operators.filters import nonblank, present, without_territories


def prepare_dropouts(
    table: DataFrame,
    territories: Sequence[str] = TERRITORY_NAMES,
    fields: Mapping[str, str | Sequence[str]] = DROPOUT_FIELDS,
) -> DataFrame:
    """Population and drop-outs per county: totals by sex, their sum, and the bare county name.

    With the default fields "no diploma and employed" is added to "no diploma", of which it is
    a part, so employed drop-outs count twice. That is how the published table was made; pass
    other ``fields`` for a single count.
    """
    male, female = (total(*[F.col(c) for c in fields[sex]]) for sex in ("male", "female"))
    return without_territories(table, "State", territories).select(
        "NAME",
        "State",
        F.col(fields["population"]).alias(DROPOUT_POPULATION),
        male.alias("Total_Male_Dropout"),
        female.alias("Total_Female_Dropout"),
        (male + female).alias("Total_Dropout"),
        strip_anywhere(F.col("NAME")).alias("County"),
    )


def prepare_teens(table: DataFrame, territories: Sequence[str] = TERRITORY_NAMES) -> DataFrame:
    """Population and working teens per county, with the bare county name."""
    return without_territories(table, "State", territories).select(
        "NAME", "State", TEEN_POPULATION, TEEN_WORKED, strip_anywhere(F.col("NAME")).alias("County")
    )


def prepare_income(table: DataFrame, territories: Sequence[str] = TERRITORY_NAMES) -> DataFrame:
    """All survey fields of the states.

    They used to be fetched in pages of columns and joined; a landed table needs neither.
    """
    return without_territories(table, "State", territories)


def prepare_sites(
    tables: Sequence[DataFrame], state: str = "STATE", territories: Sequence[str] = TERRITORY_CODES
) -> DataFrame:
    """School tables put together by column name, without territories."""
    return without_territories(concat_by_name(tables), state, territories)


def site_lines(sites: DataFrame) -> DataFrame:
    """Text lines ``'COUNTY-ST' 'NAME'`` of flat site rows that have a county."""
    key = area_key(F.col("COUNTY"), F.col("STATE"), upper=False, trim=False, strict=True)
    return sites.where(present("COUNTY")).select(quoted_line(key, F.col("NAME")).alias("value"))


def _value_line(state: str, value: Column) -> Column:
    key = area_key(F.col("COUNTY"), F.col(state), trim=False, strict=True)
    return quoted_line(key, value, quote_value=False)


def svi_lines(records: DataFrame) -> DataFrame:
    """Text lines ``'COUNTY-ST' 0.5``; the NULL test comes before any text is built."""
    rows = records.where(present("COUNTY", "ST_ABBR", "RPL_THEMES"))
    return rows.select(_value_line("ST_ABBR", plain_number(F.col("RPL_THEMES"))).alias("value"))


def graduation_lines(rows: DataFrame) -> DataFrame:
    """Text lines ``'COUNTY-ST' 95`` of ranking rows that have a rate, which is kept as it is written."""
    return rows.where(nonblank("RATE")).select(_value_line("STATE", F.col("RATE")).alias("value"))
