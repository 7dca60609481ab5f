"""Errors of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from areastats.functions.numbers import to_double
from areastats.model.network import Model
from areastats.model.predict import predict, prediction_name

#: Name of the row over all outputs together.
OVERALL = "(all)"


def residual_sums(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, output, n, sum_r, sum_r2)`` with residual = predicted - actual, in one aggregation."""
    entries = []
    for actual, predicted in pairs:
        r = F.col(f"`{predicted}`") - to_double(F.col(f"`{actual}`"))
        entries.append(
            F.struct(
                F.lit(actual).alias("output"),
                F.count(r).alias("n"),
                F.sum(r).alias("sum_r"),
                F.sum(r * r).alias("sum_r2"),
            )
        )
    return df.groupBy(*by).agg(F.array(*entries).alias("entries")).select(*by, F.inline("entries"))


def residual_metrics(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Errors per output, and over all outputs in the row ``(all)``, for each value of ``by``.

    ``rmse`` is the root of the mean squared residual. ``abs_mean_residual`` is the absolute
    mean residual, in which errors of opposite sign cancel; it is kept for comparison with
    figures that were made that way. ``sse`` is half the sum of squares.
    """
    # One row per output here, so stacking the overall row next to each is cheaper than a
    # second aggregation over the data.
    rows = residual_sums(df, pairs, by).withColumn("output", F.explode(F.array(F.col("output"), F.lit(OVERALL))))
    return rows.groupBy(*by, "output").agg(*error_columns(F.sum("n"), F.sum("sum_r"), F.sum("sum_r2")))


def error_columns(n: Column, sum_r: Column, sum_r2: Column) -> list[Column]:
    """The metrics as columns, from the number, sum and sum of squares of residuals."""
    return [
        n.alias("n"),
        (0.5 * sum_r2).alias("sse"),
        F.try_divide(sum_r2, n).alias("mse"),
        F.sqrt(F.try_divide(sum_r2, n)).alias("rmse"),
        F.abs(F.try_divide(sum_r, n)).alias("abs_mean_residual"),
    ]


def evaluate(model: Model, df: DataFrame, part: Column | None = None) -> DataFrame:
    """Errors of a model on the complete rows of a table, for each value of ``part`` if given."""
    extra = [] if part is None else [part.alias("part")]
    rows = predict(model, model.spec.complete(df, *extra))
    pairs = [(c, prediction_name(c)) for c in model.spec.outputs]
    return residual_metrics(rows, pairs, ["part"] if extra else [])
