"""The jobs end to end, from landed files to an evaluated model."""

import json

import pytest
from conftest import collected

from areastats import jobs
from areastats.config import KEY, RANKING_RATE
from areastats.sources.flat import read_csv

COUNTIES = [f"C{i}" for i in range(40)]


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    """Raw files for forty counties of Alabama, some of them in every source."""
    root = tmp_path_factory.mktemp("landed")
    for kind, per_county in (("public", 3), ("private", 1)):
        (root / kind).mkdir()
        sites = [
            {"properties": {"COUNTY": c, "STATE": "AL", "NAME": f"{c} {i}"}} for c in COUNTIES[:30] for i in range(per_county)
        ]
        (root / kind / "schools.Alabama.raw_data.json").write_text(json.dumps(sites))
        (root / kind / "schools.Texas.raw_data.json").write_text("[]")
    (root / "svi").mkdir()
    svi = [{"COUNTY": c, "ST_ABBR": "AL", "RPL_THEMES": i / 40} for i, c in enumerate(COUNTIES)]
    (root / "svi" / "svi.Alabama.json").write_text(json.dumps(svi))
    (root / "grad").mkdir()
    for year, position in RANKING_RATE.items():
        lines = []
        for state, county, rate in [("State Abbreviation", "Name", "Rate"), ("state", "county", "v"), ("AL", "Alabama", "0.5")] + [
            ("AL", f"{c} County", f"0.{50 + i}") for i, c in enumerate(COUNTIES)
        ]:
            cells = [""] * (position + 1)
            cells[3], cells[4], cells[position] = state, county, rate
            lines.append(",".join(cells))
        (root / "grad" / f"grad_data{year}.csv").write_text("\n".join(lines))
    (root / "dropouts.csv").write_text(
        ",NAME,State,Total Population 16 to 19 Years,Total_Male_Dropout,Total_Female_Dropout,Total_Dropout,County\n"
        + "".join(f"{i},{c} County,Alabama,100,1,1,{i},{c} \n" for i, c in enumerate(COUNTIES))
    )
    (root / "teens.csv").write_text(
        ",NAME,State,B23027_002E,B23027_003E,County\n"
        + "".join(f"{i},{c} County,Alabama,50,{i},{c} \n" for i, c in enumerate(COUNTIES))
    )
    (root / "income.csv").write_text(
        ",NAME,State,B19049_001E\n" + "".join(f"{i},{c} County,Alabama,{40000 + i}\n" for i, c in enumerate(COUNTIES))
    )
    (root / "extra").mkdir()
    (root / "extra" / "arcgis.csv").write_text("COUNTY,STATE,NAME\n" + "".join(f"{c},AL,x\n" for c in COUNTIES[20:35]) + ",AL,y\n")
    return root


def test_all_jobs(spark, landed, tmp_path):
    def run(*args):
        jobs.run(spark, jobs.parser().parse_args([str(a) for a in args]))

    prepared, counts = tmp_path / "prepared", tmp_path / "counts"
    for kind in ("public", "private"):
        sources = tmp_path / f"{kind}_sources"
        run("sites", landed / kind, sources / "keyed", "--single-file", "--school-states")
        (sources / "arcgis.csv").write_text((landed / "extra" / "arcgis.csv").read_text())
        run("counts", sources, counts / kind, "--kind", kind, "--base", "keyed")
    assert read_csv(spark, str(counts / "public")).columns == [KEY, "Public"]
    got = dict(collected(read_csv(spark, str(counts / "public"))))
    assert (len(got), got["C0-AL"], got["C25-AL"], got["C34-AL"]) == (35, "3", "3", "1")

    run("shares", counts, prepared / "shares")
    run("svi", landed / "svi", prepared / "svi")
    run("graduation", landed / "grad", prepared / "graduation", "--single-file")
    run("dropouts", landed / "dropouts.csv", prepared / "dropouts")
    run("teens", landed / "teens.csv", prepared / "teens")
    run("income", landed / "income.csv", prepared / "income")
    run("merge", prepared, tmp_path / "merged", "--single-file")
    merged = read_csv(spark, str(tmp_path / "merged"))
    assert merged.count() == 35 and len(merged.columns) == 8

    run("train", tmp_path / "merged", tmp_path / "trained", "--epochs", 3, "--hidden", 2)
    assert read_csv(spark, str(tmp_path / "trained" / "history")).count() == 3
    assert collected(read_csv(spark, str(tmp_path / "trained" / "rows"))) == [("35", "0")]
    run("train", tmp_path / "merged", tmp_path / "again", "--epochs", 2, "--model", tmp_path / "trained" / "model", "--save-every", 1)
    assert {p.name for p in (tmp_path / "again").iterdir()} == {"history", "rows", "model", "model-epoch-4", "model-epoch-5"}
    run("evaluate", tmp_path / "merged", tmp_path / "errors", "--model", tmp_path / "trained" / "model")
    assert read_csv(spark, str(tmp_path / "errors")).count() == 14

    run("predict", tmp_path / "merged", tmp_path / "predicted", "--model", tmp_path / "trained" / "model")
    predicted = read_csv(spark, str(tmp_path / "predicted"))
    outputs = [c for c in merged.columns if c not in (KEY, "SVI")]
    assert predicted.columns == [*merged.columns, *(f"predicted {c}" for c in outputs), "part"]
    assert predicted.where(" and ".join(f"`predicted {c}` is not null" for c in outputs)).count() == 35
    assert {r.part for r in predicted.select("part").distinct().collect()} == {"train", "test"}
    run("sweep", tmp_path / "merged", tmp_path / "grid", "--grid-epochs", 1, 2, "--layers", "", "3,2", "--activations", "sig")
    grid = {(r.epochs, r.hidden, r.activation) for r in read_csv(spark, str(tmp_path / "grid")).collect()}
    assert grid == {(e, h, "sig") for e in "12" for h in ("[]", "[3,2]")}

    run("site-lines", landed / "public", tmp_path / "lines")
    assert spark.read.text(str(tmp_path / "lines")).where("value = '''C0-AL'' ''C0 0'''").count() == 1
    run("svi-lines", landed / "svi", tmp_path / "svi_lines")
    assert spark.read.text(str(tmp_path / "svi_lines")).count() == 40


def test_preparation_jobs(spark, tmp_path):
    fields = ["B14005_001E", "B14005_012E", "B14005_013E", "B14005_026E", "B14005_027E", "B23027_002E", "B23027_003E"]
    header = "OBJECTID,NAME,State," + ",".join(fields)
    (tmp_path / "survey.csv").write_text(f"{header}\n1,Adams County,Nebraska,100,5,2,4,1,90,30\n2,P,Puerto Rico,1,1,1,1,1,1,1\n")
    for job, columns in (("prepare-dropouts", 7), ("prepare-teens", 5), ("prepare-income", 10)):
        args = [job, str(tmp_path / "survey.csv"), str(tmp_path / job)]
        jobs.run(spark, jobs.parser().parse_args(args))
        out = read_csv(spark, str(tmp_path / job))
        assert out.count() == 1 and len(out.columns) == columns
    jobs.run(spark, jobs.parser().parse_args(["dropouts", str(tmp_path / "prepare-dropouts"), str(tmp_path / "rate")]))
    assert collected(read_csv(spark, str(tmp_path / "rate"))) == [("ADAMS-NE", "0.12")]
    (tmp_path / "sites").mkdir()
    (tmp_path / "sites" / "a.csv").write_text("NAME,STATE,LEVEL\nx,AL,1\ny,PR,1\n")
    (tmp_path / "sites" / "b.csv").write_text("STATE,NAME\nGA,z\n")
    args = ["prepare-sites", str(tmp_path / "sites"), str(tmp_path / "by_state"), "--by-state", "STATE"]
    jobs.run(spark, jobs.parser().parse_args(args))
    assert sorted(p.name for p in (tmp_path / "by_state").glob("STATE=*")) == ["STATE=AL", "STATE=GA"]
