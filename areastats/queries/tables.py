"""Sources and sinks: the tables are written in a format and read back by the reader under test."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from areastats.config import KEY
from areastats.functions.text import file_label, quoted_line
from areastats.operators.combine import union_all
from areastats.operators.measures import count_by_key
from areastats.operators.project import pick, rename
from areastats.plans.schools import raw_site_keys, site_keys
from areastats.queries.inputs import FLAT_RECORDS, GEO, customers, flat_records, geo, private_sites, public_sites, suppliers, table
from areastats.queries.registry import query
from areastats.session import shared_folder, stage
from areastats.sources.catalog import read_each, read_together, route_by_key, table_query
from areastats.sources.flat import read_csv, read_states, typed
from areastats.sources.nested import SITE_SCHEMA, read_json, write_json_arrays
from areastats.sources.positional import read_positions, read_single_year, read_years
from areastats.sources.sinks import preview, rewrite_states, write_by_state, write_csv, write_lines

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_header_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    write_csv(table(spark, sf, "orders").select(ORDER_COLUMNS), path)
    return typed(read_csv(spark, path), {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double"})


@query(f"""WITH {GEO}
SELECT area AS "County-State", count(*) AS "Public" FROM customer JOIN geo ON c_nationkey = n_nationkey GROUP BY area""")
def csv_single_file_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    write_csv(count_by_key(public_sites(spark, sf), "Public"), path, parts=1)
    return typed(read_csv(spark, path, [KEY, "Public"]), {"Public": "long"})


#: Position of the rate in the yearly files made from orders.
RATE_POSITIONS = {1995: 6, 1996: 6, 1997: 8, 1998: 8, 1999: 11, 2000: 15, 2001: 20}


def _county() -> Column:
    return F.concat(F.coalesce("o_orderpriority", F.lit("?")), F.lit(", X County"))


def yearly_files(spark: SparkSession, sf: str) -> dict[int, str]:
    """Orders as one positional file set per year, of different widths, with two header lines each."""
    # An order from before or after goes into the nearest file.
    first, last = min(RATE_POSITIONS), max(RATE_POSITIONS)
    year = F.greatest(F.lit(first), F.least(F.lit(last), F.year("o_orderdate")))
    o = table(spark, sf, "orders").withColumn("year", year)
    positions = F.create_map(*[F.lit(x) for x in chain.from_iterable(RATE_POSITIONS.items())])
    line = F.concat(
        F.lit("a,b,c,"),
        F.coalesce("o_orderstatus", F.lit("")),
        F.concat(F.lit(',"'), _county(), F.lit('"')),
        F.expr("repeat(',', p - 4)"),
        F.coalesce(F.col("o_totalprice").cast("string"), F.lit("")),
        F.lit(",z"),
    )
    body = o.withColumn("p", positions[F.col("year")]).select("year", line.alias("line"))
    headers = [
        (year, f"h,h,h,{token},County{',' * (at - 4)}Rate,h")
        for year, at in RATE_POSITIONS.items()
        for token in ("State Abbreviation", "state")
    ]
    path = shared_folder(spark, "years")
    lines = spark.createDataFrame(headers, "year int, line string").unionByName(body)
    lines.write.partitionBy("year").text(path)
    return {year: f"{path}/year={year}" for year in RATE_POSITIONS}


_YEARS = """SELECT coalesce(o_orderpriority, '?') || ', X County' AS "COUNTY", o_orderstatus AS "STATE", o_totalprice AS "RATE"
FROM orders"""


@query(_YEARS)
def csv_positional_years(spark: SparkSession, sf: str) -> DataFrame:
    years = read_years(spark, yearly_files(spark, sf), RATE_POSITIONS)
    return typed(years, {"RATE": "double"})


@query(_YEARS)
def csv_single_year(spark: SparkSession, sf: str) -> DataFrame:
    columns = {7: F.col("o_orderstatus"), 9: _county(), 58: F.col("o_totalprice")}
    row = [columns.get(i, F.lit(None).cast("string")).alias(f"x{i}") for i in range(59)]
    path = shared_folder(spark, "year")
    write_csv(table(spark, sf, "orders").select(*row), path)
    return typed(read_single_year(spark, path), {"RATE": "double"})


def quoted_file(spark: SparkSession, sf: str) -> str:
    path = shared_folder(spark, "quoted")
    label = F.concat("c_name", F.lit(", "), "c_mktsegment")
    table(spark, sf, "customer").na.fill("?").select("c_custkey", label.alias("label")).write.csv(path)
    return path


@query("SELECT c_custkey, coalesce(c_name, '?') || ', ' || coalesce(c_mktsegment, '?') AS label FROM customer")
def quoted_csv_split(spark: SparkSession, sf: str) -> DataFrame:
    df = read_positions(spark, quoted_file(spark, sf), {"c_custkey": 0, "label": 1}, header=False)
    return typed(df, {"c_custkey": "long"})


@query("""SELECT c_custkey, '"' || coalesce(c_name, '?') AS second, ' ' || coalesce(c_mktsegment, '?') || '"' AS third FROM customer""")
def naive_csv_split(spark: SparkSession, sf: str) -> DataFrame:
    positions = {"c_custkey": 0, "second": 1, "third": 2}
    df = read_positions(spark, quoted_file(spark, sf), positions, quote_aware=False)
    return typed(df, {"c_custkey": "long"})


def json_folder(spark: SparkSession, sf: str) -> str:
    """Customers as nested records in JSON arrays."""
    record = F.struct(F.col("n_name").alias("COUNTY"), F.col("code").alias("STATE"), F.col("c_name").alias("NAME"))
    path = shared_folder(spark, "json")
    rows = customers(spark, sf).withColumn("state", F.col("r_name"))
    write_json_arrays(rows, F.to_json(F.struct(record.alias("properties"))), path)
    return path


SITE_FIELDS = {c: f"properties.{c}" for c in ("COUNTY", "STATE", "NAME")}


@query(f"""WITH {GEO}
SELECT n_name AS "COUNTY", coalesce(code, '') AS "STATE", c_name AS "NAME"
FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE r_name IN ('AFRICA', 'ASIA', 'MIDDLE EAST')""")
def json_array_scan(spark: SparkSession, sf: str) -> DataFrame:
    sites = read_json(spark, json_folder(spark, sf), SITE_SCHEMA, states=["AFRICA", "ASIA", "MIDDLE EAST"])
    return pick(sites, SITE_FIELDS).na.fill("", ["STATE"])


@query(f"""WITH {GEO}
SELECT n_name AS "COUNTY", coalesce(code, '') AS "STATE", c_name AS "NAME" FROM customer JOIN geo ON c_nationkey = n_nationkey""")
def json_inferred_scan(spark: SparkSession, sf: str) -> DataFrame:
    return pick(read_json(spark, json_folder(spark, sf)), SITE_FIELDS).na.fill("", ["STATE"])


@query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def json_field_project(spark: SparkSession, sf: str) -> DataFrame:
    parsed = table(spark, sf, "events").withColumn("props", F.from_json("props", "k double"))
    return pick(parsed, {"event_id": "event_id", "event_type": "event_type", "k": "props.k"})


@query(f"""WITH {GEO}
SELECT area AS "County-State", c_name AS "Name" FROM customer JOIN geo ON c_nationkey = n_nationkey
UNION ALL SELECT area, s_name FROM supplier JOIN geo ON s_nationkey = n_nationkey
UNION ALL SELECT concat_ws('-', upper(trim(n_name)), code), s_name
FROM supplier JOIN geo ON s_nationkey = n_nationkey WHERE code IS NOT NULL""")
def dir_union_by_role(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "sources")
    s = suppliers(spark, sf)
    write_csv(public_sites(spark, sf), f"{path}/a_keyed")
    write_csv(private_sites(spark, sf), f"{path}/b_keyed")
    county = F.when(F.col("code").isNotNull(), F.col("n_name"))
    raw = s.select(county.alias("COUNTY"), F.col("code").alias("STATE"), F.col("s_name").alias("NAME"))
    write_csv(raw, f"{path}/c_raw")
    roles = route_by_key(read_each(spark, path))
    return union_all([roles.base, *roles.fillers, *[raw_site_keys(r) for r in roles.raw]])


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def pushdown_table_query(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return table_query(orders, F.col("o_orderstatus") == "F", ["o_custkey", "o_orderpriority"], distinct=True)


@query(f"""WITH {GEO}
SELECT '''' || area || ''' ''' || c_name || '''' AS value FROM customer JOIN geo ON c_nationkey = n_nationkey
WHERE c_name IS NOT NULL""")
def text_line_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "lines")
    write_lines(public_sites(spark, sf), quoted_line(F.col(KEY), F.col("Name")), path)
    return spark.read.option("lineSep", "\r\n").text(path)


@query(f"""WITH {GEO}
SELECT c_custkey, c_name, r_name AS "State" FROM customer JOIN geo ON c_nationkey = n_nationkey""")
def partitioned_state_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "states")
    write_by_state(rename(customers(spark, sf).select("c_custkey", "c_name", "r_name"), {"r_name": "State"}), path)
    return typed(read_csv(spark, path), {"c_custkey": "long"})


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def preview_limit(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(o.orderBy(F.desc("o_totalprice"), "o_orderkey"))


def _part_path() -> Column:
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    return F.concat(F.lit("/in/"), F.col("p_type"), F.lit("/"), name, F.lit(".csv"))


@query("SELECT p_partkey, replace(p_name, ' ', '_') || '.csv' AS label FROM part")
def file_label_of_path(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", file_label(_part_path()).alias("label"))


def _by_region(spark: SparkSession, sf: str, *regions: str) -> DataFrame:
    rows = customers(spark, sf).select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"), F.col("r_name").alias("State"))
    return rows.where(F.col("State").isin(list(regions))) if regions else rows


@query(f"""WITH {GEO}, rows AS (SELECT c_custkey, c_name, c_acctbal AS balance, r_name AS state FROM customer JOIN geo ON c_nationkey = n_nationkey)
SELECT c_custkey, c_name, state AS "State" FROM rows WHERE state IN ('AFRICA', 'AMERICA')
UNION ALL SELECT c_custkey, c_name, state FROM rows WHERE state = 'AMERICA'
UNION ALL SELECT c_custkey, c_name, state FROM rows WHERE state = 'ASIA' AND balance >= 0
UNION ALL SELECT c_custkey, c_name, state FROM rows WHERE state = 'EUROPE'""")
def save_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Two states written, one appended again, one rewritten by a later run, one rewritten twice."""
    path = shared_folder(spark, "states")
    write_by_state(_by_region(spark, sf, "MIDDLE EAST"), path)
    write_by_state(_by_region(spark, sf, "AFRICA", "AMERICA", "ASIA"), path, mode="overwrite")
    write_by_state(_by_region(spark, sf, "AMERICA"), path, mode="append")
    write_by_state(_by_region(spark, sf), path, mode="ignore")
    rewrite_states(_by_region(spark, sf, "ASIA").where("balance >= 0"), path)
    for _ in range(2):
        rewrite_states(_by_region(spark, sf, "EUROPE"), path)
    return typed(read_states(spark, path, ["c_custkey", "c_name", "balance"]).drop("balance"), {"c_custkey": "long"})


def pruned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers of two states by a list, and of the states of a table by a join."""
    path = shared_folder(spark, "states")
    write_by_state(_by_region(spark, sf), path)
    columns = ["c_custkey", "c_name", "balance"]
    codes = geo(spark, sf).where(F.col("code").like("A%") & (F.col("r_name") != "ASIA")).select(F.col("r_name").alias("State"), "code")
    return read_states(spark, path, columns, ["ASIA", "EUROPE"]), read_states(spark, path, columns, codes.distinct())


@query(f"""WITH {GEO}
SELECT 'list' AS found, c_custkey, r_name AS "State" FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE r_name IN ('ASIA', 'EUROPE')
UNION ALL SELECT code, c_custkey, r_name FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE r_name IN ('AFRICA', 'AMERICA')""")
def pruned_states(spark: SparkSession, sf: str) -> DataFrame:
    listed, joined = pruned(spark, sf)
    rows = listed.withColumn("code", F.lit("list")).unionByName(joined)
    return typed(rows.select(F.col("code").alias("found"), "c_custkey", "State"), {"c_custkey": "long"})


REGION_FILES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query(f"""WITH {GEO}
SELECT r_name || '.csv' AS source, c_custkey FROM customer JOIN geo ON c_nationkey = n_nationkey
UNION ALL SELECT r_name || '.csv', c_custkey FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE r_name IN ('ASIA', 'EUROPE')""")
def source_of_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the same columns in one scan, and some of them one by one; the scan says where each row is from."""
    path = shared_folder(spark, "sources")
    for region in REGION_FILES:
        write_csv(_by_region(spark, sf, region).select("c_custkey", "c_name"), f"{path}/{region}.csv")
    rows = read_together(spark, path, ["c_custkey", "c_name"])
    some = union_all(list(read_each(spark, path, ["ASIA.csv", "EUROPE.csv"], label="source").values()))
    return typed(union_all([rows, some]).select("source", "c_custkey"), {"c_custkey": "long"})


@query(f"""WITH {FLAT_RECORDS}
SELECT 'no_county' AS reason, count(*) AS n FROM records WHERE coalesce(county, '') = ''
UNION ALL SELECT 'no_state', count(*) FROM records WHERE county <> '' AND state IS NULL
UNION ALL SELECT 'kept', count(*) FROM records WHERE county <> '' AND state IS NOT NULL
UNION ALL SELECT 'rows', count(*) FROM records WHERE county <> '' AND state IS NOT NULL""")
def rejected_sites(spark: SparkSession, sf: str) -> DataFrame:
    """How many records the keyed list leaves out and why, counted while the list is written, and its rows."""
    nested = flat_records(spark, sf).select(F.struct("COUNTY", "STATE", "NAME").alias("properties"))
    counts = Observation("sites")
    kept = stage(site_keys(nested, counts), "sites")
    found = [F.struct(F.lit(k).alias("reason"), F.lit(n).cast("long").alias("n")) for k, n in counts.get.items()]
    rows = kept.agg(F.count("*").alias("n")).select(F.lit("rows").alias("reason"), "n")
    return spark.range(1).select(F.inline(F.array(*found))).unionByName(rows)
