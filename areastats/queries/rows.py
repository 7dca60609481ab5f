"""Projection, filters and scalar functions, row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.config import KEY
from areastats.functions.activations import ACTIVATIONS
from areastats.functions.keys import area_key, key_state
from areastats.functions.numbers import ratio, total
from areastats.functions.text import strip_anywhere, strip_suffix
from areastats.operators.filters import (
    drop_missing,
    keep_keys,
    listed,
    nonblank,
    not_listed,
    present,
    without_territories,
)
from areastats.operators.project import drop_present, inputs_first, rename
from areastats.queries.inputs import FLAT_RECORDS, GEO, customers, flat_records, key, table
from areastats.queries.registry import query


@query("""SELECT o_totalprice AS price, o_orderkey AS order_id, o_custkey AS "Customer Id", o_totalprice * 2 AS double_price
FROM orders""")
def project_rename_drop(spark: SparkSession, sf: str) -> DataFrame:
    df = rename(
        table(spark, sf, "orders"),
        {"o_orderkey": "order_id", "o_custkey": "Customer Id", "o_totalprice": "price", "absent": "x"},
    )
    df = df.withColumn("double_price", F.col("price") * 2)
    df = drop_present(df, ["_c0", "O_ORDERSTATUS", "o_orderdate", "o_orderpriority", "absent"])
    return inputs_first(df, ["price"])


@query(f"""WITH {FLAT_RECORDS}
SELECT c_custkey, 'nonblank' AS rule FROM records WHERE county <> ''
UNION ALL SELECT c_custkey, 'present' FROM records WHERE county IS NOT NULL AND state IS NOT NULL
UNION ALL SELECT c_custkey, 'no missing' FROM records WHERE county IS NOT NULL""")
def nonempty_notnull_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = flat_records(spark, sf)
    rules = {
        "nonblank": rows.where(nonblank("COUNTY")),
        "present": rows.where(present("COUNTY", "STATE")),
        "no missing": drop_missing(rows, ["COUNTY"]),
    }
    first, *rest = [df.select("c_custkey", F.lit(rule).alias("rule")) for rule, df in rules.items()]
    for df in rest:
        first = first.unionByName(df)
    return first


@query(f"""WITH {GEO}
SELECT c_custkey, r_name FROM customer JOIN geo ON c_nationkey = n_nationkey
WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE', '') AND r_name NOT IN ('EUROPE', 'ASIA')""")
def denylist_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = customers(spark, sf).where(not_listed("c_mktsegment", ["BUILDING", "FURNITURE", ""]))
    return without_territories(rows, "r_name", ["EUROPE", "ASIA"]).select("c_custkey", "r_name")


@query("""SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def allowlist_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").where(listed("o_orderpriority", ["1-URGENT", "2-HIGH"]))
    wanted = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    kept = keep_keys(orders, wanted.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")
    return kept.select("o_orderkey", "o_custkey", "o_orderpriority")


@query(f"""WITH {GEO}
SELECT c_custkey, area AS "County-State" FROM customer JOIN geo ON c_nationkey = n_nationkey""")
def natural_key(spark: SparkSession, sf: str) -> DataFrame:
    # Blanks and case are added first, for the key to remove.
    df = customers(spark, sf).withColumn("n_name", F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
    return df.select("c_custkey", key().alias(KEY))


@query(f"""WITH {GEO}
SELECT c_custkey, n_name || '-' || code AS "County-State" FROM customer JOIN geo ON c_nationkey = n_nationkey
WHERE code IS NOT NULL""")
def strict_key(spark: SparkSession, sf: str) -> DataFrame:
    strict = area_key(F.col("n_name"), F.col("code"), upper=False, trim=False, strict=True)
    return customers(spark, sf).select("c_custkey", strict.alias(KEY)).where(present(KEY))


@query(f"""WITH {GEO}
SELECT c_custkey, upper(CASE c_mktsegment WHEN 'BUILDING' THEN n_name WHEN 'MACHINERY' THEN n_name || ' Parish'
       WHEN 'FURNITURE' THEN 'County Line' ELSE n_name || ' county' END) AS county
FROM customer JOIN geo ON c_nationkey = n_nationkey""", name="strip_suffix")
def strip_suffix_county(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    county = (
        F.when(segment == "BUILDING", F.concat("n_name", F.lit(" County")))
        .when(segment == "MACHINERY", F.concat("n_name", F.lit(" Parish")))
        .when(segment == "FURNITURE", F.lit("County Line County"))
        .otherwise(F.concat("n_name", F.lit(" county")))
    )
    return customers(spark, sf).select("c_custkey", strip_suffix(county).alias("county"))


@query("""SELECT doc_id, md5(replace(text, 'the', '')) AS digest, length(replace(text, 'the', '')) AS n FROM documents""", name="strip_anywhere")
def strip_anywhere_text(spark: SparkSession, sf: str) -> DataFrame:
    text = strip_anywhere(F.col("text"), "the")
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text).alias("digest"), F.length(text).cast("long").alias("n")
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') AND o_orderpriority IS NOT NULL THEN o_orderstatus END AS state
FROM orders""")
def key_state_part(spark: SparkSession, sf: str) -> DataFrame:
    # Order priorities hold a hyphen themselves, as some county names do.
    full = F.concat_ws("-", "o_orderpriority", "o_orderstatus")
    return table(spark, sf, "orders").select("o_orderkey", key_state(full, codes=["F", "O"]).alias("state"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(coalesce(
       CASE l_returnflag WHEN 'R' THEN l_quantity END / nullif(l_discount, 0), -1), 6) AS rate
FROM lineitem""")
def safe_ratio(spark: SparkSession, sf: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("string")
    text = F.when(F.col("l_returnflag") == "A", "").when(F.col("l_returnflag") == "R", quantity).otherwise("n/a")
    rate = F.round(F.coalesce(ratio(text, F.col("l_discount")), F.lit(-1.0)), 6)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", rate.alias("rate"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice + l_discount + l_tax, 4) AS whole FROM lineitem""")
def column_sum(spark: SparkSession, sf: str) -> DataFrame:
    whole = total(F.col("l_extendedprice").cast("string"), F.col("l_discount"), F.col("l_tax"))
    items = table(spark, sf, "lineitem")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", F.round(whole, 4).alias("whole"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
       round(tanh(z), 6) AS tanh, round(1 - tanh(z) * tanh(z), 6) AS tanh_slope,
       round(1 / (1 + exp(-z)), 6) AS sig, round(1 / (1 + exp(-z)) * (1 - 1 / (1 + exp(-z))), 6) AS sig_slope,
       greatest(z, 0.0::DOUBLE) AS relu, CASE WHEN z > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS relu_slope
FROM (SELECT *, l_quantity / 8 - 3 AS z FROM lineitem)""")
def activation_values(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").withColumn("z", F.col("l_quantity") / 8 - 3)
    columns = []
    for name in ("tanh", "sig", "relu"):
        value = ACTIVATIONS[name].value(F.col("z"))
        slope = ACTIVATIONS[name].slope(F.col("z"), value)
        columns += [F.round(value, 6).alias(name), F.round(slope, 6).alias(f"{name}_slope")]
    return df.select("l_orderkey", "l_linenumber", "l_partkey", *columns)
