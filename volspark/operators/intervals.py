"""Point-in-interval lookup as a bucketed equi-join."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import TIME_BUCKETS, time_bucket


def interval_lookup(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    at: str,
    outputs: Mapping[str, str],
    values: Sequence[str],
    closed: str = "right",
) -> DataFrame:
    """Left-join each point to the one interval of its key that holds ``at``.

    ``intervals`` has the keys, ``lo``, ``hi`` (a NULL end is open) and ``values``. ``outputs`` maps
    new columns to SQL text over the point, ``_at``, ``_lo``, ``_hi`` and the underscored values.

    The intervals of a key are disjoint, so a point matches at most one of them. Each interval is
    repeated for the time buckets it touches, and the bucket in the join key keeps the candidates
    per point to the few intervals that touch its bucket, whatever the size of the key. No
    broadcast is forced: Spark broadcasts the intervals when their size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, where adaptive
    execution splits a skewed partition of points.
    """
    left = points.selectExpr("*", f"{at} as _at").withColumn("_bucket", time_bucket("_at"))
    first = F.when(F.col("lo").isNull(), F.lit(0)).otherwise(time_bucket("lo"))
    last = F.when(F.col("hi").isNull(), F.lit(TIME_BUCKETS - 1)).otherwise(time_bucket("hi"))
    right = intervals.select(
        *[F.col(k).alias(f"_key_{k}") for k in on],
        *[F.col(v).alias(f"_{v}") for v in ("lo", "hi", *values)],
        F.explode(F.sequence(first, last)).alias("_touched"),
    )
    above, below = (">", "<=") if closed == "right" else (">=", "<")
    clauses = [f"{k} = _key_{k}" for k in on] + [
        "_bucket = _touched",
        f"(_lo is null or _at {above} _lo)",
        f"(_hi is null or _at {below} _hi)",
    ]
    return left.join(right, F.expr(" and ".join(clauses)), "left").selectExpr(
        *points.columns, *[f"{text} as {name}" for name, text in outputs.items()]
    )
