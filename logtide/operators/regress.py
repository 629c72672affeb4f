"""One-feature least squares without intercept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 0.001


def scale_feature(points: DataFrame) -> DataFrame:
    """Divide the feature by its largest size, so that gradient steps stay stable."""
    largest = points.agg(F.max(F.abs("feature"))).scalar()
    return points.withColumn("feature", F.coalesce(F.try_divide("feature", largest), F.lit(0.0)))


def _sums(points: DataFrame) -> DataFrame:
    x, y = F.col("feature"), F.col("label")
    return points.agg(
        F.count("*").alias("n"),
        F.sum(x * x).alias("sxx"),
        F.sum(x * y).alias("sxy"),
        F.sum(y * y).alias("syy"),
    )


def _with_error(fitted: DataFrame) -> DataFrame:
    """Mean squared error from the sums: sum (y - wx)^2 = syy - 2 w sxy + w^2 sxx."""
    w = F.col("weight")
    rest = F.col("syy") - F.lit(2.0) * w * F.col("sxy") + w * w * F.col("sxx")
    return fitted.select("n", "weight", F.try_divide(rest, "n").alias("mse"))


def linear_sgd(points: DataFrame, iterations: int = 20, step: float = 1.0) -> DataFrame:
    """One row: n, weight, mse after full-batch gradient steps of step / sqrt(t).

    The gradient only needs n, sum(x^2) and sum(xy), so the data is read once
    and the steps run on those three numbers. They stop once a step is below
    0.001 * max(|w|, 1). Unscaled features make the steps diverge; see
    :func:`scale_feature` or :func:`linear_exact`.
    """

    def advance(state: Column, t: Column) -> Column:
        gradient = (state.w * F.col("sxx") - F.col("sxy")) / F.col("n")
        moved = state.w - F.lit(step) / F.sqrt(t.cast("double")) * gradient
        small = F.abs(moved - state.w) < F.lit(TOLERANCE) * F.greatest(F.abs(moved), F.lit(1.0))
        return F.struct(
            F.when(state.done, state.w).otherwise(moved).alias("w"),
            (state.done | small).alias("done"),
        )

    start = F.struct(F.lit(0.0).alias("w"), F.lit(False).alias("done"))
    steps = F.sequence(F.lit(1), F.lit(iterations))
    weight = F.aggregate(steps, start, advance, lambda state: state.w)
    return _with_error(_sums(points).withColumn("weight", weight))


def linear_exact(points: DataFrame) -> DataFrame:
    """One row: n, weight = sum(xy) / sum(x^2), mse."""
    return _with_error(_sums(points).withColumn("weight", F.try_divide("sxy", "sxx")))
