"""The given tables in the shapes the operators expect.

Counties are nations, states are regions; ``MIDDLE EAST`` has no postal code on purpose. The
joins to ``nation`` and ``region`` are left to Spark, which broadcasts them while they are small.
Facts are aggregated before they are joined wherever the result allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from areastats.config import DROPOUT_POPULATION, INCOME_FIELD, KEY, STATE_CODES, TEEN_POPULATION, TEEN_WORKED
from areastats.functions.keys import area_key, state_code
from areastats.functions.text import plain_number
from areastats.operators.eager import partial_sums, roll_up, totals
from areastats.operators.skew import join_unique

CODES = {"AFRICA": "AF", "AMERICA": "AM", "ASIA": "AS", "EUROPE": "EU"}

_CODE = "CASE r_name WHEN 'AFRICA' THEN 'AF' WHEN 'AMERICA' THEN 'AM' WHEN 'ASIA' THEN 'AS' WHEN 'EUROPE' THEN 'EU' END"
#: The geography as SQL, for reference queries.
GEO = f"""geo AS (
    SELECT n_nationkey, n_name, r_name, {_CODE} AS code,
           concat_ws('-', upper(trim(n_name)), {_CODE}) AS area
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once and declared from then on."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def geo(spark: SparkSession, sf: str) -> DataFrame:
    """``n_nationkey, n_name, r_name, code``."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", "n_name", "r_name", state_code(F.col("r_name"), CODES).alias("code")
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their nation and region."""
    places = geo(spark, sf).withColumnRenamed("n_nationkey", "c_nationkey")
    return table(spark, sf, "customer").join(places, "c_nationkey")


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with their nation and region."""
    places = geo(spark, sf).withColumnRenamed("n_nationkey", "s_nationkey")
    return table(spark, sf, "supplier").join(places, "s_nationkey")


def key() -> Column:
    return area_key(F.col("n_name"), F.col("code"))


def public_sites(spark: SparkSession, sf: str) -> DataFrame:
    return customers(spark, sf).select(key().alias(KEY), F.col("c_name").alias("Name"))


def private_sites(spark: SparkSession, sf: str) -> DataFrame:
    return suppliers(spark, sf).select(key().alias(KEY), F.col("s_name").alias("Name"))


def flat_records(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as ``COUNTY, STATE, NAME``; one segment has a blank county, another none."""
    county = F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") != "MACHINERY", F.col("n_name"))
    return customers(spark, sf).select(
        "c_custkey", county.alias("COUNTY"), F.col("code").alias("STATE"), F.col("c_name").alias("NAME")
    )


FLAT_RECORDS = f"""{GEO}, records AS (
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN ''
                WHEN c_mktsegment <> 'MACHINERY' THEN n_name END AS county,
           code AS state, c_name AS name
    FROM customer JOIN geo ON c_nationkey = n_nationkey)"""


def svi_records(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as vulnerability records; a negative balance means a missing value."""
    svi = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 10000)
    return customers(spark, sf).select(
        F.col("c_name").alias("COUNTY"), F.col("code").alias("ST_ABBR"), svi.alias("RPL_THEMES")
    )


def orders_with_places(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the nation and region of the customer, row by row."""
    places = customers(spark, sf).select(F.col("c_custkey").alias("o_custkey"), "n_name", "r_name", "code")
    return join_unique(table(spark, sf, "orders"), places, "o_custkey")


def ranking_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as ``COUNTY, STATE, RATE`` text rows, with the rows that are not counties.

    Low-priority orders have no rate, and urgent ones stand for the whole nation; every area
    named like a state occurs once more.
    """
    o = orders_with_places(spark, sf)
    rate = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(plain_number(F.col("o_totalprice")))
    state = F.when(F.col("o_orderpriority") == "1-URGENT", "US").otherwise(F.col("code"))
    county = F.when(F.col("o_orderstatus") == "P", F.col("r_name")).otherwise(F.concat("n_name", F.lit(" County")))
    return o.select(county.alias("COUNTY"), state.alias("STATE"), rate.alias("RATE"))


#: Regions play the states, so their names join the deny-list of state-named counties.
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", *STATE_CODES, ""]

RANKING_ROWS = f"""{GEO}, ranking AS (
    SELECT CASE WHEN o_orderstatus = 'P' THEN r_name ELSE n_name || ' County' END AS county,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'US' ELSE code END AS state,
           CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE CAST(o_totalprice AS VARCHAR) END AS rate
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey)"""


#: Orders by whether their county is a region and whether they stand for the nation.
_KINDS = [(region, nation) for region in (False, True) for nation in (False, True)]


def _rate_sums() -> dict[str, Column]:
    """Sum and number of the rates of an order that has one, apart for every kind of order."""
    region = F.coalesce(F.col("o_orderstatus") == "P", F.lit(False))
    nation = F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False))
    rate = F.when(F.coalesce(F.col("o_orderpriority") != "5-LOW", F.lit(True)), F.col("o_totalprice").cast("decimal(18,2)"))
    sums = {}
    for i, (r, n) in enumerate(_KINDS):
        own = F.when((region == r) & (nation == n), rate)
        sums |= {f"rate{i}": own, f"rates{i}": F.when(own.isNotNull(), 1).otherwise(0)}
    return sums


def _people(spark: SparkSession, sf: str, **sums: Column) -> DataFrame:
    keys = [F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")]
    return table(spark, sf, "customer").select(*keys, *[c.alias(n) for n, c in sums.items()])


def _with_places(by_nation: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    return by_nation.join(geo(spark, sf), "n_nationkey")


def order_sums(spark: SparkSession, sf: str, sums: dict[str, Column]) -> DataFrame:
    """Sums over the orders of each nation, with its place."""
    orders = partial_sums(table(spark, sf, "orders"), "o_custkey", sums)
    return _with_places(totals(roll_up(orders, _people(spark, sf), "o_custkey", "n_nationkey"), "n_nationkey"), spark, sf)


def ranking_sums(spark: SparkSession, sf: str, facts: DataFrame | None = None) -> DataFrame:
    """``COUNTY``, ``STATE``, ``rate``, ``rates``: the rows of ``ranking_rows`` with a rate, added up by nation and kind."""
    facts = order_sums(spark, sf, _rate_sums()) if facts is None else facts
    kinds = [
        F.struct(
            (F.col("r_name") if region else F.concat("n_name", F.lit(" County"))).alias("COUNTY"),
            (F.lit("US") if nation else F.col("code")).alias("STATE"),
            F.col(f"rate{i}").alias("rate"),
            F.col(f"rates{i}").alias("rates"),
        )
        for i, (region, nation) in enumerate(_KINDS)
    ]
    return facts.select(F.inline(F.array(*kinds)))


def nation_facts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per nation with every sum that the measures need; each table is read once.

    Items are added up per order, with the orders per customer, with the customers per nation.
    """
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    items = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    items = partial_sums(items, "o_orderkey", {"items": F.lit(1), "returned": returned})
    finished = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    sums = {"orders": F.lit(1), "finished": finished, **_rate_sums()}
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", *[c.alias(n) for n, c in sums.items()])
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    solvent = F.when(F.col("c_acctbal") >= 0, balance)
    people = _people(
        spark, sf, customers=F.lit(1), balance=balance, balances=F.when(balance.isNotNull(), 1).otherwise(0),
        solvent_balance=solvent, solvents=F.when(solvent.isNotNull(), 1).otherwise(0),
    )
    per_customer = roll_up(items, orders, "o_orderkey", "o_custkey")
    per_nation = roll_up(per_customer, people, "o_custkey", "n_nationkey")
    sellers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), F.lit(1).alias("suppliers"))
    return _with_places(totals(per_nation.unionByName(sellers, allowMissingColumns=True), "n_nationkey"), spark, sf)


def counts_by_nation(spark: SparkSession, sf: str, by_customer: DataFrame, *names: str) -> DataFrame:
    """Add up per-customer counts (``o_custkey`` and ``names``) by nation, then look up the place."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    by_nation = by_customer.join(people, "o_custkey").groupBy("c_nationkey").agg(*[F.sum(n).alias(n) for n in names])
    return by_nation.join(geo(spark, sf).withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")


def dropout_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Per nation: lineitems as population, returned ones as drop-outs.

    Lineitems are counted per order, these per customer, these per nation: each join has one
    row per key on both sides, whatever the distribution of lineitems.
    """
    per_order = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("population"), F.count_if(F.col("l_returnflag") == "R").alias("dropouts"))
    )
    per_customer = (
        per_order.join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
        .groupBy("o_custkey")
        .agg(F.sum("population").alias("population"), F.sum("dropouts").alias("dropouts"))
    )
    return counts_by_nation(spark, sf, per_customer, "population", "dropouts").select(
        F.concat("n_name", F.lit(" County")).alias("NAME"),
        F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("County"),
        F.col("r_name").alias("State"),
        F.col("population").cast("string").alias(DROPOUT_POPULATION),
        F.col("dropouts").cast("string").alias("Total_Dropout"),
    )


def teen_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Per nation: orders as population, finished ones as those who worked."""
    per_customer = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("population"), F.count_if(F.col("o_orderstatus") == "F").alias("worked"))
    )
    return counts_by_nation(spark, sf, per_customer, "population", "worked").select(
        F.concat("n_name", F.lit(" County")).alias("NAME"),
        F.col("n_name").alias("County"),
        F.col("r_name").alias("State"),
        F.col("population").alias(TEEN_POPULATION),
        F.col("worked").alias(TEEN_WORKED),
    )


def exact_mean(column: str) -> Column:
    """Mean of a column with two decimals, exact and so independent of the order of rows."""
    return F.try_divide(F.sum(F.col(column).cast("decimal(18,2)")).cast("double"), F.count(column).cast("double"))


def income_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Per nation: mean account balance as income."""
    by_nation = table(spark, sf, "customer").groupBy("c_nationkey").agg(exact_mean("c_acctbal").alias(INCOME_FIELD))
    return by_nation.join(geo(spark, sf).withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey").select(
        F.concat("n_name", F.lit(" County")).alias("NAME"), F.col("r_name").alias("State"), INCOME_FIELD
    )


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer: balance as input; number, sum and mean of the orders as outputs, where known."""
    per_customer = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("*").cast("double").alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spent"),
        )
        .withColumn("mean_order", F.col("spent") / F.col("orders"))
    )
    people = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("SVI"))
    return people.join(per_customer, "c_custkey").na.drop()


FEATURES = """features AS (
    SELECT c_custkey, c_acctbal AS "SVI", orders, spent, spent / orders AS mean_order
    FROM customer JOIN (
        SELECT o_custkey, CAST(count(*) AS DOUBLE) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
        FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
    WHERE c_acctbal IS NOT NULL AND spent IS NOT NULL)"""
