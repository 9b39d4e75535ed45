"""Ordered computations per key that never put a whole key into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. Here the order axis is
cut into buckets: the window runs inside (key, bucket), a second window runs over one summary row
per bucket, and the two are put together. The result is exact for any data.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

# Bucket scale for year fractions, two buckets per doubling of days, up to a century.
TIME_BUCKETS = 31


def time_bucket(T: str) -> Column:
    """Logarithmic bucket of a year fraction, non-decreasing in T, between 0 and TIME_BUCKETS - 1."""
    return F.expr(
        f"least(cast(floor(log2(1D + greatest({T}, 0D) * 365D) * 2D) as int), {TIME_BUCKETS - 1})"
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    bucket: Column,
    previous: str | None = None,
    following: Sequence[str] = (),
    running: str | None = None,
) -> DataFrame:
    """Add what is asked for, by ``order`` within ``keys``:

    * ``previous``: the named column of the row before;
    * ``next``: a struct of the named columns of the row after;
    * ``running``: the sum of the named column up to and including this row.

    ``order`` is unique within ``keys``.
    """
    parts = [*keys, "_bucket"]
    inside = W.Window.partitionBy(*parts).orderBy(order)
    across = W.Window.partitionBy(*keys).orderBy("_bucket")
    summary, from_edges, from_rows, outputs = [], [], [], []
    if previous:
        summary.append(F.max_by(previous, order).alias("_last"))
        from_edges.append(F.lag("_last").over(across).alias("_before"))
        from_rows += [
            F.lag(previous).over(inside).alias("_previous"),
            F.row_number().over(inside).alias("_position"),
        ]
        outputs.append("case when _position > 1 then _previous else _before end as previous")
    if following:
        item = F.struct(*following)
        summary.append(F.min_by(item, F.col(order)).alias("_first"))
        from_edges.append(F.lead("_first").over(across).alias("_after"))
        from_rows.append(F.lead(item).over(inside).alias("_next"))
        outputs.append("coalesce(_next, _after) as next")
    if running:
        earlier = across.rowsBetween(W.Window.unboundedPreceding, -1)
        so_far = inside.rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
        summary.append(F.sum(running).alias("_sum"))
        from_edges.append(F.sum("_sum").over(earlier).alias("_carried"))
        from_rows.append(F.sum(running).over(so_far).alias("_running"))
        outputs.append("coalesce(_carried, 0D) + coalesce(_running, 0D) as running")
    rows = df.withColumn("_bucket", bucket)
    edges = rows.groupBy(*parts).agg(*summary).select(*parts, *from_edges)
    rows = rows.select("*", *from_rows)
    return rows.join(edges, parts, "left").selectExpr(*df.columns, *outputs)
