"""Joins, fills, unions and grouped measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.config import KEY
from areastats.operators.combine import concat_by_name, fill_missing, join_all, merge_pages
from areastats.operators.measures import count_by_key, distinct_values, key_count, mean_by_key
from areastats.operators.project import pages
from areastats.queries.inputs import GEO, customers, key, orders_with_places, private_sites, table
from areastats.queries.registry import query


@query("""WITH per_customer AS (
    SELECT o_custkey, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY o_custkey),
returned AS (
    SELECT o_custkey, count(*) AS returned FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'R' GROUP BY o_custkey)
SELECT c_custkey, c_acctbal AS balance, orders, CAST(spent AS DOUBLE) AS spent, returned
FROM customer JOIN per_customer p ON c_custkey = p.o_custkey JOIN returned r ON c_custkey = r.o_custkey""")
def join_all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    balance = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    spent = orders.groupBy("c_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spent")
    )
    per_order = (
        table(spark, sf, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("returned"))
    )
    returned = per_order.join(orders, "o_orderkey").groupBy("c_custkey").agg(F.sum("returned").alias("returned"))
    counts = count_by_key(orders, "orders", "c_custkey")
    return join_all([balance, counts, spent, returned], "c_custkey")


def _fill_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, list[DataFrame]]:
    """Base: customers of two regions; fillers: all suppliers, and customers with some keys missing."""
    c = customers(spark, sf).withColumnRenamed("c_name", "Name")
    base = c.where(F.col("r_name").isin("AFRICA", "AMERICA")).select(key().alias(KEY), "Name")
    some_key = F.when(F.col("c_mktsegment") != "MACHINERY", key())
    filler = c.where(F.col("r_name") != "EUROPE").select(some_key.alias(KEY), "Name")
    return base, [private_sites(spark, sf), filler]


_FILL = f"""WITH {GEO},
base AS (SELECT area, c_name AS name FROM customer JOIN geo ON c_nationkey = n_nationkey
         WHERE r_name IN ('AFRICA', 'AMERICA')),
filler1 AS (SELECT area, s_name AS name FROM supplier JOIN geo ON s_nationkey = n_nationkey),
filler2 AS (SELECT area, c_name AS name FROM customer JOIN geo ON c_nationkey = n_nationkey
            WHERE r_name <> 'EUROPE' AND c_mktsegment <> 'MACHINERY'),
filled AS (SELECT * FROM base UNION ALL SELECT * FROM filler1 WHERE area NOT IN (SELECT area FROM base))
"""


@query(_FILL + """SELECT area AS "County-State", name AS "Name" FROM (
SELECT * FROM filled UNION ALL SELECT * FROM filler2 WHERE area NOT IN (SELECT area FROM base))""")
def fill_missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    base, fillers = _fill_inputs(spark, sf)
    return fill_missing(base, fillers)


@query(_FILL + """SELECT area AS "County-State", name AS "Name" FROM (
SELECT * FROM filled UNION ALL SELECT * FROM filler2 WHERE area NOT IN (SELECT area FROM filled))""")
def fill_missing_in_turn(spark: SparkSession, sf: str) -> DataFrame:
    base, fillers = _fill_inputs(spark, sf)
    return fill_missing(base, fillers, sequential=True)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def column_pages_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merge_pages(pages(table(spark, sf, "orders").drop("o_orderdate"), "o_orderkey", 2))


@query(f"""WITH {GEO}
SELECT coalesce(CASE WHEN c_mktsegment <> 'MACHINERY' THEN area END, '(none)') AS "County-State", count(*) AS "Public"
FROM customer JOIN geo ON c_nationkey = n_nationkey GROUP BY 1""", name="count_by_key")
def count_per_key(spark: SparkSession, sf: str) -> DataFrame:
    some_key = F.when(F.col("c_mktsegment") != "MACHINERY", key())
    counts = count_by_key(customers(spark, sf).select(some_key.alias(KEY)), "Public")
    return counts.na.fill("(none)", [KEY])


@query(f"""WITH {GEO}
SELECT area AS "County-State", round(avg(o_totalprice), 4) AS price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey GROUP BY area""", name="mean_by_key")
def mean_per_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = orders_with_places(spark, sf).select(key().alias(KEY), "o_totalprice")
    return mean_by_key(rows, F.col("o_totalprice"), "price").withColumn("price", F.round("price", 4))


@query("""SELECT count(*) AS rows, count(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END) AS keyed,
       count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END) AS keys FROM orders""")
def key_set_size(spark: SparkSession, sf: str) -> DataFrame:
    some_key = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return key_count(table(spark, sf, "orders").select(some_key.alias(KEY)))


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(table(spark, sf, "orders"), "o_custkey", "o_orderstatus")


@query("""SELECT c_custkey AS id, c_name AS name, coalesce(c_mktsegment, '') AS segment, '' AS origin FROM customer
UNION ALL SELECT s_suppkey, s_name, '', 'supplier' FROM supplier""")
def union_by_name_missing(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").selectExpr("c_custkey id", "c_name name", "c_mktsegment segment")
    s = table(spark, sf, "supplier").selectExpr("'supplier' origin", "s_name name", "s_suppkey id")
    return concat_by_name([c, s]).na.fill("", ["segment", "origin"])
