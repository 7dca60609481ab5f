"""The measure plans: keyed sites, counts, shares, rates and the merged table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from areastats.config import (
    DROPOUT_POPULATION,
    DROPOUT_RATE,
    GRADUATION_RATE,
    INCOME,
    INCOME_FIELD,
    KEY,
    PRIVATE_SHARE,
    PUBLIC_SHARE,
    TEEN_POPULATION,
    TEEN_RATE,
    TEEN_WORKED,
)
from areastats.operators.measures import count_by_key
from areastats.plans.measures import (
    dropout_rate,
    graduation_rate,
    household_income,
    merge_measures,
    svi_by_area,
    teen_work_rate,
)
from areastats.plans.schools import shares_from_counts, site_counts, site_keys
from areastats.queries.inputs import (
    CODES,
    FLAT_RECORDS,
    GEO,
    RANKING_ROWS,
    REGION_NAMES,
    customers,
    dropout_rows,
    flat_records,
    income_rows,
    key,
    nation_facts,
    private_sites,
    public_sites,
    ranking_sums,
    svi_records,
    teen_rows,
)
from areastats.queries.registry import query
from areastats.session import stage


def rounded(df: DataFrame, places: int = 6, **by_name: int) -> DataFrame:
    """Round the double columns, so that the order of float additions does not show."""
    return df.select(
        *[
            F.round(f"`{c}`", by_name.get(c, places)).alias(c) if t == "double" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


@query(f"""WITH {FLAT_RECORDS}
SELECT upper(trim(county)) || '-' || state AS "County-State", name AS "Name" FROM records
WHERE county <> '' AND state IS NOT NULL""")
def site_list(spark: SparkSession, sf: str) -> DataFrame:
    nested = flat_records(spark, sf).select(F.struct("COUNTY", "STATE", "NAME").alias("properties"))
    return site_keys(nested)


@query(f"""WITH {GEO}
SELECT upper(c_name) || '-' || code AS "County-State", round(c_acctbal / 10000, 6) AS "SVI"
FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE c_acctbal >= 0 AND code IS NOT NULL AND c_name <> ''""")
def svi_list(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(svi_by_area(svi_records(spark, sf)))


_GRADUATION = f"""SELECT upper(regexp_replace(county, ' County$', '')) || '-' || state AS area, avg(CAST(rate AS DOUBLE)) AS rate
    FROM ranking WHERE state NOT IN ('US', 'State Abbreviation', 'state', '') AND rate <> ''
      AND county NOT IN ('{"', '".join(REGION_NAMES)}')
    GROUP BY 1"""


@query(f"""WITH {RANKING_ROWS}
SELECT area AS "County-State", round(rate, 4) AS "Graduation-Rate" FROM ({_GRADUATION})""")
def graduation_by_area(spark: SparkSession, sf: str) -> DataFrame:
    rows = ranking_sums(spark, sf)
    return rounded(graduation_rate(rows, non_counties=REGION_NAMES, parts=("rate", "rates")), 4)


_DROPOUT = """SELECT area, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / count(*) AS rate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN geo ON c_nationkey = n_nationkey GROUP BY area"""


@query(f"""WITH {GEO}
SELECT area AS "County-State", round(rate, 6) AS "{DROPOUT_RATE}" FROM ({_DROPOUT})""")
def dropout_by_area(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dropout_rate(dropout_rows(spark, sf), CODES))


_TEENS = """SELECT area, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) AS rate
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey GROUP BY area"""


@query(f"""WITH {GEO}
SELECT area AS "County-State", round(rate, 6) AS "{TEEN_RATE}" FROM ({_TEENS})""")
def teen_work_by_area(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(teen_work_rate(teen_rows(spark, sf), CODES))


_INCOME = """SELECT area, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS income
    FROM customer JOIN geo ON c_nationkey = n_nationkey GROUP BY area"""


@query(f"""WITH {GEO}
SELECT area AS "County-State", round(income, 4) AS "{INCOME}" FROM ({_INCOME})""")
def income_by_area(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(household_income(income_rows(spark, sf), CODES), 4)


@query(f"""WITH {FLAT_RECORDS},
base AS (SELECT area FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE r_name IN ('AFRICA', 'AMERICA')),
filler1 AS (SELECT area FROM supplier JOIN geo ON s_nationkey = n_nationkey),
filler2 AS (SELECT concat_ws('-', upper(trim(county)), state) AS area FROM records WHERE county IS NOT NULL)
SELECT area AS "County-State", count(*) AS "Public" FROM (
    SELECT area FROM base
    UNION ALL SELECT area FROM filler1 WHERE area NOT IN (SELECT area FROM base)
    UNION ALL SELECT area FROM filler2 WHERE area NOT IN (SELECT area FROM base)) GROUP BY area""")
def sites_by_area(spark: SparkSession, sf: str) -> DataFrame:
    base = customers(spark, sf).where(F.col("r_name").isin("AFRICA", "AMERICA"))
    keyed = base.select(key().alias(KEY), F.col("c_name").alias("Name"))
    return site_counts(keyed, [private_sites(spark, sf)], [flat_records(spark, sf)], "Public")


def _shares(spark: SparkSession, sf: str) -> DataFrame:
    public, private = public_sites(spark, sf), private_sites(spark, sf)
    return shares_from_counts([count_by_key(public, "Public"), count_by_key(private, "Private")])


_SHARES = """SELECT area, CAST(private AS DOUBLE) / (public + private) AS private, CAST(public AS DOUBLE) / (public + private) AS public
    FROM (SELECT area, count(*) AS public FROM customer JOIN geo ON c_nationkey = n_nationkey GROUP BY area)
    JOIN (SELECT area, count(*) AS private FROM supplier JOIN geo ON s_nationkey = n_nationkey GROUP BY area) USING (area)"""


@query(f"""WITH {GEO}
SELECT area AS "County-State", round(private, 6) AS "{PRIVATE_SHARE}", round(public, 6) AS "{PUBLIC_SHARE}" FROM ({_SHARES})""")
def shares_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_shares(spark, sf))


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """All measures of an area, from one table of sums that every one of the tables is read for once."""
    facts = stage(nation_facts(spark, sf), "nation-facts")

    def mean(total: str, count: str) -> Column:
        return F.try_divide(F.col(total).cast("double"), F.col(count).cast("double"))

    def having(count: str, **columns: Column) -> DataFrame:
        return facts.where(F.col(count) > 0).select(*[c.alias(n) for n, c in columns.items()])

    place = {"County": F.col("n_name"), "State": F.col("r_name")}
    svi = having("solvents", COUNTY=F.col("n_name"), ST_ABBR=F.col("code"), RPL_THEMES=mean("solvent_balance", "solvents") / 10000)
    counts = [having(n, **{KEY: key(), name: F.col(n)}) for n, name in (("customers", "Public"), ("suppliers", "Private"))]
    dropouts = having("items", **place, Total_Dropout=F.col("returned"), **{DROPOUT_POPULATION: F.col("items")})
    teens = having("orders", **place, **{TEEN_WORKED: F.col("finished"), TEEN_POPULATION: F.col("orders")})
    income = having("customers", NAME=F.concat("n_name", F.lit(" County")), State=F.col("r_name"), **{INCOME_FIELD: mean("balance", "balances")})
    return merge_measures(
        [
            svi_by_area(svi),
            shares_from_counts(counts),
            graduation_rate(ranking_sums(spark, sf, facts), non_counties=REGION_NAMES, parts=("rate", "rates")),
            dropout_rate(dropouts, CODES),
            teen_work_rate(teens, CODES),
            household_income(income, CODES),
        ]
    )


MERGED = f"""{RANKING_ROWS},
merged AS (
    SELECT s.area, svi, private, public, g.rate AS graduation, d.rate AS dropout, t.rate AS teens, income
    FROM (SELECT area, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 10000 AS svi
          FROM customer JOIN geo ON c_nationkey = n_nationkey
          WHERE c_acctbal >= 0 AND code IS NOT NULL GROUP BY area) s
    JOIN ({_SHARES}) USING (area) JOIN ({_GRADUATION}) g USING (area) JOIN ({_DROPOUT}) d USING (area)
    JOIN ({_TEENS}) t USING (area) JOIN ({_INCOME}) USING (area))"""


@query(f"""WITH {MERGED}
SELECT area AS "County-State", round(svi, 6) AS "SVI", round(private, 6) AS "{PRIVATE_SHARE}",
       round(public, 6) AS "{PUBLIC_SHARE}", round(graduation, 4) AS "{GRADUATION_RATE}",
       round(dropout, 6) AS "{DROPOUT_RATE}", round(teens, 6) AS "{TEEN_RATE}", round(income, 4) AS "{INCOME}"
FROM merged""")
def merged_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(merged(spark, sf), **{GRADUATION_RATE: 4, INCOME: 4})
