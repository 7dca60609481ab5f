"""Preparation of landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.config import DROPOUT_POPULATION, TEEN_POPULATION, TEEN_WORKED
from areastats.plans.preparation import (
    graduation_lines,
    prepare_dropouts,
    prepare_income,
    prepare_sites,
    prepare_teens,
    site_lines,
    svi_lines,
)
from areastats.queries.inputs import (
    FLAT_RECORDS,
    GEO,
    RANKING_ROWS,
    customers,
    flat_records,
    geo,
    ranking_rows,
    suppliers,
    svi_records,
    table,
)
from areastats.queries.registry import query

TERRITORY = ["MIDDLE EAST"]

# Which customers each survey field counts, as SQL conditions.
_FIELDS = {
    "B14005_001E": "TRUE",
    "B14005_002E": "c_mktsegment <> 'HOUSEHOLD'",
    "B14005_008E": "c_acctbal > 9000",
    "B14005_012E": "c_mktsegment = 'FURNITURE'",
    "B14005_013E": "c_mktsegment = 'FURNITURE' AND c_acctbal > 0",
    "B14005_016E": "c_mktsegment = 'HOUSEHOLD'",
    "B14005_022E": "c_acctbal > 8000",
    "B14005_026E": "c_mktsegment = 'BUILDING'",
    "B14005_027E": "c_mktsegment = 'BUILDING' AND c_acctbal > 0",
    "B23027_002E": "c_acctbal > 1000",
    "B23027_003E": "c_acctbal > 4000",
}


def survey(spark: SparkSession, sf: str) -> DataFrame:
    """Survey table with one row per nation; its fields are counts of customers."""
    counts = [F.count_if(F.expr(condition)).alias(name) for name, condition in _FIELDS.items()]
    by_nation = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(*counts)
    return by_nation.join(geo(spark, sf), "n_nationkey").select(
        F.col("n_nationkey").alias("OBJECTID"),
        F.concat("n_name", F.lit(" County")).alias("NAME"),
        F.col("r_name").alias("State"),
        *_FIELDS,
    )


_SURVEY = (
    f"{GEO}, survey AS (SELECT n_name || ' County' AS name, n_name || ' ' AS county, r_name AS state, "
    + ", ".join(f"count(*) FILTER (WHERE {condition}) AS {name}" for name, condition in _FIELDS.items())
    + " FROM customer JOIN geo ON c_nationkey = n_nationkey GROUP BY n_name, r_name)"
)


@query(f"""WITH {_SURVEY}
SELECT name AS "NAME", state AS "State", B14005_001E AS "{DROPOUT_POPULATION}",
       CAST(B14005_012E + B14005_013E AS DOUBLE) AS "Total_Male_Dropout",
       CAST(B14005_026E + B14005_027E AS DOUBLE) AS "Total_Female_Dropout",
       CAST(B14005_012E + B14005_013E + B14005_026E + B14005_027E AS DOUBLE) AS "Total_Dropout", county AS "County"
FROM survey WHERE state <> 'MIDDLE EAST'""")
def prep_dropout(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_dropouts(survey(spark, sf), TERRITORY)


@query(f"""WITH {_SURVEY}
SELECT name AS "NAME", state AS "State", B23027_002E AS "{TEEN_POPULATION}", B23027_003E AS "{TEEN_WORKED}",
       county AS "County"
FROM survey WHERE state <> 'MIDDLE EAST'""")
def prep_teens(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_teens(survey(spark, sf), TERRITORY)


@query(f"""WITH {GEO}
SELECT c_custkey AS "OBJECTID", n_name || ' County' AS "NAME", r_name AS "State", c_acctbal AS "B19049_001E",
       c_mktsegment AS "B19049_002E", c_name AS "B19049_003E", upper(r_name) AS "B19049_004E"
FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE r_name <> 'MIDDLE EAST'""")
def prep_income(spark: SparkSession, sf: str) -> DataFrame:
    landed = customers(spark, sf).select(
        F.col("c_custkey").alias("OBJECTID"),
        F.concat("n_name", F.lit(" County")).alias("NAME"),
        F.col("r_name").alias("State"),
        F.col("c_acctbal").alias("B19049_001E"),
        F.col("c_mktsegment").alias("B19049_002E"),
        F.col("c_name").alias("B19049_003E"),
        F.upper("r_name").alias("B19049_004E"),
    )
    return prepare_income(landed, TERRITORY)


@query(f"""WITH {GEO}
SELECT n_name AS "COUNTY", r_name AS "STATE", c_name AS "NAME", coalesce(c_mktsegment, '') AS "KIND"
FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE r_name NOT IN ('MIDDLE EAST', 'EUROPE')
UNION ALL SELECT n_name, r_name, s_name, '' FROM supplier JOIN geo ON s_nationkey = n_nationkey
WHERE r_name NOT IN ('MIDDLE EAST', 'EUROPE')""")
def prep_schools(spark: SparkSession, sf: str) -> DataFrame:
    place = {"n_name": "COUNTY", "r_name": "STATE"}
    public = customers(spark, sf).withColumnsRenamed({**place, "c_name": "NAME", "c_mktsegment": "KIND"})
    private = suppliers(spark, sf).withColumnsRenamed({**place, "s_name": "NAME"})
    tables = [public.select("COUNTY", "STATE", "NAME", "KIND"), private.select("NAME", "STATE", "COUNTY")]
    return prepare_sites(tables, territories=[*TERRITORY, "EUROPE"]).na.fill("", ["KIND"])


@query(f"""WITH {FLAT_RECORDS}
SELECT '''' || county || '-' || state || ''' ''' || name || '''' AS value FROM records
WHERE county IS NOT NULL AND state IS NOT NULL AND name IS NOT NULL""")
def prep_site_text(spark: SparkSession, sf: str) -> DataFrame:
    return site_lines(flat_records(spark, sf)).where("value IS NOT NULL")


@query(f"""WITH {GEO}
SELECT '''' || upper(c_name) || '-' || code || ''' ' || CAST(c_acctbal / 10000 AS VARCHAR) AS value
FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE c_acctbal >= 0 AND code IS NOT NULL AND c_name IS NOT NULL""")
def prep_svi_text(spark: SparkSession, sf: str) -> DataFrame:
    return svi_lines(svi_records(spark, sf))


@query(f"""WITH {RANKING_ROWS}
SELECT '''' || upper(county) || '-' || state || ''' ' || rate AS value FROM ranking
WHERE rate <> '' AND state IS NOT NULL""")
def prep_graduation_text(spark: SparkSession, sf: str) -> DataFrame:
    return graduation_lines(ranking_rows(spark, sf)).where("value IS NOT NULL")
