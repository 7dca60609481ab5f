"""School sites: keyed list, counts with gaps filled from other sources, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from areastats.config import KEY
from areastats.functions.keys import area_key
from areastats.operators.combine import join_all, union_all
from areastats.operators.filters import checked, drop_missing, nonblank, present
from areastats.operators.measures import school_shares
from areastats.operators.project import pick


def site_keys(records: DataFrame, rejected: Observation | None = None) -> DataFrame:
    """Nested school records to ``(County-State, Name)``; records without county or state go.

    County names are trimmed and upper-cased, so the keys agree with those of all other tables.
    ``rejected`` counts the records that go, in the same pass: ``no_county`` and ``no_state``.
    """
    flat = pick(records, {c: f"properties.{c}" for c in ("COUNTY", "STATE", "NAME")})
    if rejected is not None:
        flat = checked(flat, {"no_county": F.coalesce(F.col("COUNTY") == "", F.lit(True)), "no_state": F.col("STATE").isNull()}, rejected)
    keyed = flat.where(nonblank("COUNTY")).select(
        area_key(F.col("COUNTY"), F.col("STATE"), strict=True).alias(KEY), F.col("NAME").alias("Name")
    )
    return keyed.where(present(KEY))


def raw_site_keys(sites: DataFrame) -> DataFrame:
    """Flat ``COUNTY, STATE, NAME`` rows to ``(County-State, Name)``; NULL counties go, blanks stay."""
    return drop_missing(sites, ["COUNTY"]).select(
        area_key(F.col("COUNTY"), F.col("STATE")).alias(KEY), F.col("NAME").alias("Name")
    )


def site_counts(base: DataFrame, fillers: Sequence[DataFrame], raw: Sequence[DataFrame], name: str) -> DataFrame:
    """Sites per area from ``base``, and from the other sources for areas that ``base`` lacks.

    Sources are each compared with the base alone, so two of them may both add to an area. The
    fill depends on keys only, so one aggregation over all sources decides it: no join, and an
    area with a third of all sites is combined on the map side like any other.
    """
    others = [s.where(present(KEY)) for s in [*fillers, *[raw_site_keys(r) for r in raw]]]
    sources = [base.select(KEY, F.lit(True).alias("in_base"))]
    sources += [s.select(KEY, F.lit(False).alias("in_base")) for s in others]
    counts = union_all(sources).groupBy(KEY).agg(F.count_if("in_base").alias("own"), F.count("*").alias("all"))
    return counts.select(KEY, F.when(F.col("own") > 0, F.col("own")).otherwise(F.col("all")).alias(name))


def shares_from_counts(counts: Sequence[DataFrame]) -> DataFrame:
    """Shares of public and private schools for areas that occur in all count tables."""
    return school_shares(join_all(counts))
