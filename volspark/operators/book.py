"""Contract books: scenario ladders."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spot_ladder(
    contracts: DataFrame, x_min: float, x_max: float, n: int, strike: str = "strike"
) -> DataFrame:
    """n + 1 log-spaced scenario spots per contract: S_i = K exp(x_min + i (x_max - x_min) / n)."""
    dx = (float(x_max) - float(x_min)) / n
    return (
        contracts.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n))))
        .withColumn("x", F.lit(float(x_min)) + F.col("step") * F.lit(dx))
        .withColumn("scenario_spot", F.col(strike) * F.exp("x"))
    )
