"""Files read by column position: the yearly rankings and the single-year export.

Widths differ by year, so every file gets its own scan, projected to the three wanted columns
before the union. The schema is declared, so no job looks at the data first, and the CSV parser
only materialises the selected positions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from areastats.config import HEADER_TOKENS, RANKING_COUNTY, RANKING_RATE, RANKING_STATE, SINGLE_YEAR
from areastats.functions.text import naive_piece
from areastats.operators.combine import union_all


def read_positions(
    spark: SparkSession,
    path: str | list[str],
    positions: Mapping[str, int],
    *,
    header: bool = True,
    quote_aware: bool = True,
) -> DataFrame:
    """Pick columns by position and name them; ``header`` drops the first line of each file.

    Quoted commas are honoured. ``quote_aware=False`` splits at every comma instead, in which
    case header lines have to be removed by a filter on their tokens.
    """
    if not quote_aware:
        lines = spark.read.text(path)
        return lines.select(*[naive_piece(F.col("value"), i).alias(name) for name, i in positions.items()])
    fields = [T.StructField(f"_c{i}", T.StringType()) for i in range(max(positions.values()) + 1)]
    raw = spark.read.schema(T.StructType(fields)).option("header", header).option("enforceSchema", True).csv(path)
    return raw.select(*[F.col(f"_c{i}").alias(name) for name, i in positions.items()])


def read_years(
    spark: SparkSession,
    paths: Mapping[int, str],
    rate_positions: Mapping[int, int] = RANKING_RATE,
    *,
    county: int = RANKING_COUNTY,
    state: int = RANKING_STATE,
    header: bool = False,
    header_tokens: Sequence[str] = HEADER_TOKENS,
    quote_aware: bool = True,
) -> DataFrame:
    """Union of yearly files as ``COUNTY, STATE, RATE``, in the order of the years.

    Each yearly file starts with two header lines. They are recognised by what stands in the
    state column, which is independent of row order and of how the input is cut into parts.
    ``header`` in addition drops the first line of every file, for titles not in the list.
    """
    unknown = sorted(set(paths) - set(rate_positions))
    if unknown:
        raise ValueError(f"no rate position known for {unknown}")
    years = [
        read_positions(
            spark,
            paths[year],
            {"COUNTY": county, "STATE": state, "RATE": rate_positions[year]},
            header=header,
            quote_aware=quote_aware,
        )
        for year in sorted(paths)
    ]
    is_header = F.coalesce(F.col("STATE").isin(list(header_tokens)), F.lit(False))
    return union_all(years).where(~is_header)


def read_single_year(
    spark: SparkSession, path: str | list[str], positions: Mapping[str, int] = SINGLE_YEAR
) -> DataFrame:
    """The single-year export as ``COUNTY, STATE, RATE``; its one header line goes with the scan."""
    return read_positions(
        spark, path, {"COUNTY": positions["county"], "STATE": positions["state"], "RATE": positions["rate"]}
    )
