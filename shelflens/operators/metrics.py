"""How far predictions are off."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def regression_metrics(actual: str, predicted: str) -> dict[str, Column]:
    """`mae`, `rmse` and `r2` as aggregates, for one pass with or without groups.

    `r2` is null below two rows; when the actual values are all the same it is
    1 for perfect predictions and 0 otherwise.
    """
    y, error = F.col(actual).cast("double"), F.col(actual) - F.col(predicted)
    squared = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    r2 = (
        F.when(F.count(y) < 2, F.lit(None).cast("double"))
        .when(spread > 0, 1 - squared / spread)
        .otherwise(F.when(squared == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    )
    return {"mae": F.avg(F.abs(error)), "rmse": F.sqrt(F.avg(error * error)), "r2": r2}
