"""Command line: read, run a plan, write. ``spark-submit job.py <job> ...``."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.config import RANKING_FILE, RANKING_RATE, SCHOOL_FILE_STATES
from areastats.model.network import Model
from areastats.model.store import load_model, save_model
from areastats.model.sweep import ACTIVATIONS, EPOCHS, HIDDEN
from areastats.operators.project import pick
from areastats.plans.measures import (
    dropout_rate,
    graduation_rate,
    household_income,
    merge_measures,
    svi_by_area,
    teen_work_rate,
)
from areastats.plans.preparation import (
    graduation_lines,
    prepare_dropouts,
    prepare_income,
    prepare_sites,
    prepare_teens,
    site_lines,
    svi_lines,
)
from areastats.plans.regression import evaluate_on_merged, predict_on_merged, sweep_on_merged, train_on_merged
from areastats.plans.schools import shares_from_counts, site_counts, site_keys
from areastats.sources.catalog import read_each, route_by_key
from areastats.sources.flat import read_csv
from areastats.sources.nested import SITE_SCHEMA, SVI_SCHEMA, read_json
from areastats.sources.positional import read_single_year, read_years
from areastats.sources.sinks import write_by_state, write_csv, write_lines

Args = argparse.Namespace
Job = Callable[[SparkSession, Args], DataFrame]

def _years(spark: SparkSession, a: Args) -> DataFrame:
    return read_years(spark, {y: f"{a.input}/{RANKING_FILE.format(year=y)}" for y in a.years or RANKING_RATE})


def _sites(spark: SparkSession, a: Args) -> DataFrame:
    return read_json(spark, a.input, SITE_SCHEMA, states=a.states)


def _counts(spark: SparkSession, a: Args) -> DataFrame:
    roles = route_by_key(read_each(spark, a.input, a.names), base=a.base)
    return site_counts(roles.base, roles.fillers, roles.raw, a.kind.capitalize())


def _tables(spark: SparkSession, a: Args) -> list[DataFrame]:
    return list(read_each(spark, a.input, a.names).values())


def _flat_sites(spark: SparkSession, a: Args) -> DataFrame:
    return pick(_sites(spark, a), {c: f"properties.{c}" for c in ("COUNTY", "STATE", "NAME")})


def _train(spark: SparkSession, a: Args) -> DataFrame:
    def save(epoch: int, model: Model) -> None:
        if a.save_every and epoch % a.save_every == 0:
            save_model(spark, model, f"{a.output}/model-epoch-{epoch}", a.mode)

    start = load_model(spark, a.model) if a.model else None
    merged = read_csv(spark, a.input)
    model = train_on_merged(
        merged, a.inputs, a.hidden, a.epochs, a.rate, a.activation, a.seed, start=start, after_epoch=save,
        group_inputs=a.group_inputs,
    )
    save_model(spark, model, f"{a.output}/model", a.mode)
    write_csv(model.spec.incomplete_count(merged), f"{a.output}/rows", mode=a.mode)
    history = model.history_table(spark)
    return history.selectExpr("epoch", "cost", "array_join(transform(mean_error, e -> string(e)), ' ') AS mean_error")


def _sweep(spark: SparkSession, a: Args) -> DataFrame:
    layers = [[int(n) for n in text.split(",") if n.strip()] for text in a.layers] if a.layers else HIDDEN
    return sweep_on_merged(
        read_csv(spark, a.input), a.inputs, a.grid_epochs, layers, a.activations, a.rate, a.seed, group_inputs=a.group_inputs
    )


JOBS: dict[str, Job] = {
    "sites": lambda s, a: site_keys(_sites(s, a)),
    "svi": lambda s, a: svi_by_area(read_json(s, a.input, SVI_SCHEMA, states=a.states)),
    "graduation": lambda s, a: graduation_rate(_years(s, a)),
    "dropouts": lambda s, a: dropout_rate(read_csv(s, a.input)),
    "teens": lambda s, a: teen_work_rate(read_csv(s, a.input)),
    "income": lambda s, a: household_income(read_csv(s, a.input)),
    "counts": _counts,
    "shares": lambda s, a: shares_from_counts(_tables(s, a)),
    "merge": lambda s, a: merge_measures(_tables(s, a), a.how),
    "train": _train,
    "evaluate": lambda s, a: evaluate_on_merged(load_model(s, a.model), read_csv(s, a.input)),
    "predict": lambda s, a: predict_on_merged(load_model(s, a.model), read_csv(s, a.input)),
    "sweep": _sweep,
    "prepare-dropouts": lambda s, a: prepare_dropouts(read_csv(s, a.input)),
    "prepare-teens": lambda s, a: prepare_teens(read_csv(s, a.input)),
    "prepare-income": lambda s, a: prepare_income(read_csv(s, a.input)),
    "prepare-sites": lambda s, a: prepare_sites(_tables(s, a)),
    "site-lines": lambda s, a: site_lines(_flat_sites(s, a)),
    "svi-lines": lambda s, a: svi_lines(read_json(s, a.input, SVI_SCHEMA, states=a.states)),
    "graduation-lines": lambda s, a: graduation_lines(read_single_year(s, a.input)),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="areastats", description=__doc__)
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("input", help="file or folder")
    p.add_argument("output", help="folder to write, outside the input folder")
    p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "append", "ignore"])
    p.add_argument("--parts", type=int, help="write so many parts, each by one task")
    p.add_argument("--single-file", action="store_const", const=1, dest="parts", help="write one part, by one task")
    p.add_argument("--by-state", metavar="COLUMN", help="one folder per value of this column")
    p.add_argument("--states", nargs="*", help="read the files of these states only")
    p.add_argument("--school-states", action="store_const", dest="states", const=SCHOOL_FILE_STATES)
    p.add_argument("--years", nargs="*", type=int, help="years of the graduation files")
    p.add_argument("--names", nargs="*", help="tables of the input folder, in order")
    p.add_argument("--base", help="counts: the table that the others fill")
    p.add_argument("--kind", choices=["public", "private"], default="public")
    p.add_argument("--how", default="inner", help="merge: how to join")
    p.add_argument("--model", help="evaluate, predict: folder of the model; train: go on with this one")
    p.add_argument("--save-every", type=int, help="train: also store the model every so many epochs")
    p.add_argument("--inputs", nargs="*", default=["SVI"], help="train, sweep: input columns")
    p.add_argument("--hidden", nargs="*", type=int, default=[], help="train: sizes of the hidden layers")
    p.add_argument("--epochs", type=int, default=150)
    p.add_argument("--group-inputs", action="store_true", help="train: add rows up per distinct input first")
    p.add_argument("--grid-epochs", nargs="*", type=int, default=list(EPOCHS), help="sweep: numbers of epochs")
    p.add_argument("--layers", nargs="*", help='sweep: layer lists such as "" or "3,10,10"')
    p.add_argument("--activations", nargs="*", default=list(ACTIVATIONS), help="sweep: activations")
    p.add_argument("--rate", type=float, default=0.1)
    p.add_argument("--activation", default="tanh")
    p.add_argument("--seed", type=int, default=0)
    return p


def run(spark: SparkSession, a: Args) -> None:
    """Run one job in the given session."""
    result = JOBS[a.job](spark, a)
    if a.job.endswith("-lines"):
        write_lines(result, F.col("value"), a.output, mode=a.mode)
    elif a.by_state:
        write_by_state(result, a.output, a.by_state, mode=a.mode)
    else:
        path = f"{a.output}/history" if a.job == "train" else a.output
        write_csv(result, path, parts=a.parts, mode=a.mode)


def main() -> None:
    a = parser().parse_args()
    spark = SparkSession.builder.appName("areastats").getOrCreate()
    try:
        run(spark, a)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
