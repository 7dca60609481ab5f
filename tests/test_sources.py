import json
from pathlib import Path
from urllib.parse import urlparse

import pytest
from conftest import collected
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from areastats.functions.text import quoted_line
from areastats.operators.project import pick
from areastats.session import shared_folder, stage, staged
from areastats.sources.catalog import list_sources, read_each, read_together, route_by_key, table_query, with_source
from areastats.sources.flat import read_csv, read_states, typed
from areastats.sources.nested import SITE_SCHEMA, SVI_SCHEMA, read_json, write_json_arrays
from areastats.sources.positional import read_positions, read_single_year, read_years
from areastats.sources.sinks import preview, rewrite_states, write_by_state, write_csv, write_lines


def part_files(folder, suffix="csv"):
    return sorted(folder.rglob(f"part-*.{suffix}"))


def test_csv_is_all_strings_with_null_for_empty(spark, tmp_path):
    (tmp_path / "t.csv").write_text(',NAME,n\n0,"Autauga, X County",1.5\n1,,x\n')
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["_c0", "NAME", "n"]
    assert {t for _, t in df.dtypes} == {"string"}
    assert collected(typed(df, {"n": "double"})) == [("0", "Autauga, X County", 1.5), ("1", None, None)]


def test_declared_csv_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\n")
    assert collected(read_csv(spark, str(tmp_path / "t.csv"), ["x", "y"])) == [("1", "2")]


def line(width, at):
    cells = [""] * width
    for i, v in at.items():
        cells[i] = v
    return ",".join(cells)


def test_years_of_different_width(spark, tmp_path):
    for year, position in ((2010, 88), (2021, 477)):
        text = [
            line(position + 3, {3: "State Abbreviation", 4: "Name", position: "Rate"}),
            line(position + 3, {3: "state", 4: "county", position: "v023"}),
            line(position + 3, {3: "AL", 4: '"Autauga, X County"', position: "0.8"}),
            line(position + 3, {3: "US", 4: "United States", position: ""}),
        ]
        (tmp_path / f"{year}.csv").write_text("\n".join(text) + "\n")
    paths = {y: str(tmp_path / f"{y}.csv") for y in (2021, 2010)}
    expected = [("Autauga, X County", "AL", "0.8"), ("United States", "US", None)] * 2
    assert collected(read_years(spark, paths)) == sorted(expected, key=repr)
    assert collected(read_years(spark, paths, header=True)) == sorted(expected, key=repr)
    # A plain split counts the quoted comma, so the value one place further left is taken.
    plain = collected(read_years(spark, paths, quote_aware=False))
    assert ('"Autauga', "AL", "") in plain and len(plain) == 4


def test_unknown_year_is_an_error(spark):
    with pytest.raises(ValueError, match="1999"):
        read_years(spark, {1999: "x"})


def test_short_rows_give_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\n3\n")
    df = read_positions(spark, str(tmp_path / "t.csv"), {"x": 0, "y": 1})
    assert collected(df) == [("1", "2"), ("3", None)]


def test_single_year(spark, tmp_path):
    text = [line(60, {7: "state", 9: "county", 58: "rate"}), line(60, {7: "AL", 9: "Autauga", 58: "95"})]
    (tmp_path / "t.csv").write_text("\n".join(text))
    assert collected(read_single_year(spark, str(tmp_path / "t.csv"))) == [("Autauga", "AL", "95")]


def test_json_arrays_and_state_files(spark, tmp_path):
    for state, code in (("Alabama", "AL"), ("New York", "NY"), ("York", "YO")):
        records = [{"properties": {"COUNTY": "Kings", "STATE": code, "NAME": f"S{i}", "X": 1}} for i in range(2)]
        (tmp_path / f"schools.{state}.raw_data.json").write_text(json.dumps(records, indent=2))
    fields = {c: f"properties.{c}" for c in ("COUNTY", "STATE", "NAME")}
    everything = pick(read_json(spark, str(tmp_path), SITE_SCHEMA), fields)
    assert everything.count() == 6
    some = pick(read_json(spark, str(tmp_path), SITE_SCHEMA, states=["New York", "Alabama"]), fields)
    assert {r["STATE"] for r in some.collect()} == {"NY", "AL"}
    assert read_json(spark, str(tmp_path)).count() == 6


def test_json_svi_schema(spark, tmp_path):
    (tmp_path / "svi.Alabama.json").write_text('[{"COUNTY": "Autauga", "ST_ABBR": "AL", "RPL_THEMES": null},\n {"COUNTY": null, "RPL_THEMES": 1}]')
    assert collected(read_json(spark, str(tmp_path), SVI_SCHEMA)) == [("Autauga", "AL", None), (None, None, 1.0)]


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"COUNTY": "A", "ST_ABBR": "AL", "RPL_THEMES": 0.5}\n' * 3)
    assert read_json(spark, str(tmp_path), SVI_SCHEMA, multi_line=False).count() == 3


def test_directory_roles(spark, rows, tmp_path):
    write_csv(rows("`County-State` string, Name string", [("A-AL", "x")]), str(tmp_path / "b_keyed"))
    (tmp_path / "a_raw.csv").write_text("COUNTY,STATE,NAME\nB,AL,y\n")
    (tmp_path / "c_keyed.csv").write_text("County-State,Name\nC-AL,z\n")
    (tmp_path / "_hidden").write_text("")
    assert list_sources(spark, str(tmp_path)) == ["a_raw.csv", "b_keyed", "c_keyed.csv"]
    frames = read_each(spark, str(tmp_path))
    roles = route_by_key(frames)
    assert collected(roles.base) == [("A-AL", "x")]
    assert [collected(f) for f in roles.fillers] == [[("C-AL", "z")]]
    assert [f.columns for f in roles.raw] == [["COUNTY", "STATE", "NAME"]]
    assert collected(route_by_key(frames, base="c_keyed.csv").base) == [("C-AL", "z")]
    assert list(read_each(spark, str(tmp_path), ["c_keyed.csv"])) == ["c_keyed.csv"]


def test_directory_without_use_is_an_error(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="no data files"):
        read_each(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no table"):
        route_by_key({"x": rows("a string", [("1",)])})


def test_table_query(rows):
    df = rows("s string, a int", [("x", 1), ("x", 1), ("y", 2)])
    assert collected(table_query(df, F.col("s") == "x", ["a"], distinct=True)) == [(1,)]
    assert table_query(df).count() == 3


def test_number_of_parts_is_as_asked(spark, tmp_path):
    df = spark.range(100).repartition(4)
    write_csv(df, str(tmp_path / "many"))
    write_csv(df, str(tmp_path / "one"), parts=1)
    write_csv(df, str(tmp_path / "three"), parts=3)
    counts = {n: len(part_files(tmp_path / n)) for n in ("many", "one", "three")}
    assert counts["one"] == 1 and counts["many"] > 1 and counts["three"] == 3
    assert all(read_csv(spark, str(tmp_path / n)).count() == 100 for n in counts)


def test_save_mode(spark, tmp_path):
    df = spark.range(3)
    write_csv(df, str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        write_csv(df, str(tmp_path / "t"))
    write_csv(df, str(tmp_path / "t"), mode="append")
    assert read_csv(spark, str(tmp_path / "t")).count() == 6


def test_text_lines(spark, rows, tmp_path):
    df = rows("k string, n string", [("A-AL", "x"), (None, "y")])
    write_lines(df, quoted_line(F.col("k"), F.col("n")), str(tmp_path / "t"))
    assert b"".join(p.read_bytes() for p in part_files(tmp_path / "t", "txt")) == b"'A-AL' 'x'\r\n"


def test_folder_per_state(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "IF(id < 400, 'AL', CONCAT('S', id % 3)) AS State").repartition(16)
    write_by_state(df, str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t").glob("State=*")) == ["State=AL", "State=S0", "State=S1", "State=S2"]
    assert len(part_files(tmp_path / "t")) == 4
    back = read_csv(spark, str(tmp_path / "t"))
    assert back.where("State = 'AL'").count() == 400 and back.count() == 1000


def test_preview(spark):
    assert preview(spark.range(100)).count() == 20


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    one, other = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(f"{base.rstrip('/')}/areastats-") and one != other


def test_stage_keeps_rows(spark):
    assert collected(stage(spark.range(3), "rows")) == [(0,), (1,), (2,)]


def test_staged_table_goes_after_use(spark):
    with staged(spark.range(3), "rows") as df:
        folder = Path(urlparse(df.inputFiles()[0]).path).parent
        assert df.count() == 3 and folder.exists()
    assert not folder.exists()


def files(path):
    return [p for p in path.rglob("*") if p.is_file() and not p.name.startswith(("_", "."))]


def test_json_arrays_are_packed_by_bytes(spark, tmp_path):
    """One state has most records; a record larger than a file stands alone; no state is a state of its own."""
    rows = spark.range(4000).selectExpr(
        "IF(id % 10 = 0, IF(id % 20 = 0, NULL, 'Ohio'), 'New York') AS place", "id", "CONCAT('x', REPEAT('y', id % 50)) AS t"
    )
    rows = rows.unionByName(spark.range(1).selectExpr("'Ohio' AS place", "-1L AS id", "REPEAT('z', 30000) AS t"))
    write_json_arrays(rows, F.to_json(F.struct("id", "t")), str(tmp_path / "j"), "place", file_bytes=10_000)
    back = read_json(spark, str(tmp_path / "j"), T.StructType.fromDDL("id long, t string, place string"))
    assert collected(back.select("id", "t", "place")) == collected(rows.select("id", "t", "place"))
    sizes = sorted(p.stat().st_size for p in files(tmp_path / "j"))
    total = sum(sizes)
    assert sizes[-1] > 30_000 and sizes[-2] < 10_200 and len(sizes) < 2 * total / 10_000 + 3
    empty = rows.limit(0)
    write_json_arrays(empty, F.to_json(F.struct("id")), str(tmp_path / "none"), "place")
    assert files(tmp_path / "none") == []


def test_rewritten_states_leave_the_others(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    write_by_state(rows("a int, State string", [(1, "Ohio"), (2, "Utah"), (3, None)]), path)
    for _ in range(2):
        rewrite_states(rows("a int, State string", [(7, "Ohio"), (8, "Iowa")]), path)
    back = read_states(spark, path, ["a"])
    assert collected(back) == [("2", "Utah"), ("3", None), ("7", "Ohio"), ("8", "Iowa")]
    rewrite_states(rows("a int, State string", []), path)
    assert back.count() == 4
    assert collected(read_states(spark, path, ["a"], ["Utah", "Iowa"])) == [("2", "Utah"), ("8", "Iowa")]


def test_states_are_pruned_by_a_list_and_by_a_table(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    write_by_state(spark.range(1000).selectExpr("id", "CONCAT('s', id % 20) AS State"), path)
    spark.range(20).selectExpr("CONCAT('s', id) AS State", "id AS n").write.parquet(str(tmp_path / "dim"))
    listed = read_states(spark, path, ["id"], ["s3", "s4"])
    text = listed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [State" in text and "PushedFilters: []" in text and listed.count() == 100
    dim = spark.read.parquet(str(tmp_path / "dim")).where("n > 17")
    joined = read_states(spark, path, ["id"], dim)
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100 and joined.columns == ["State", "id", "n"]


def test_rows_carry_their_source(spark, tmp_path):
    (tmp_path / "d" / "north east.csv").mkdir(parents=True)
    (tmp_path / "d" / "north east.csv" / "part-0.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d" / "south.csv").write_text("a,b\n3,4\n")
    rows = read_together(spark, str(tmp_path / "d"), ["a", "b"])
    assert collected(rows) == [("1", "2", "north east.csv"), ("3", "4", "south.csv")]
    one = read_each(spark, str(tmp_path / "d"), label="from")
    assert collected(one["south.csv"]) == [("3", "4", "south.csv")] and one["north east.csv"].first()["from"] == "north east.csv"
    with pytest.raises(ValueError, match="already"):
        with_source(rows, "b")
