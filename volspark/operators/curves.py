"""Zero curves: validation, snapshot of a wide history, and rate lookups."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .intervals import interval_lookup
from .ordered import time_bucket, with_neighbours

SEQ_PER_BUCKET = 4096


def validate_curve(rates: DataFrame, keys: Sequence[str] = ("curve_id",)) -> DataFrame:
    """Curves whose tenors, in ``seq`` order, are not strictly increasing or are missing.

    A NULL tenor is a violation of its own, and the next one is compared with the last before it.
    ``seq`` is the row position carried as a column, a number or a ``file_position``. Output: keys,
    ``violations`` (offending rows) and ``rows``; an empty result means every curve is valid.
    """
    if isinstance(rates.schema["seq"].dataType, T.StructType):
        bucket = F.struct("seq.file", "seq.block", F.floor(F.col("seq.line") / SEQ_PER_BUCKET).alias("line"))
    else:
        bucket = F.floor(F.col("seq") / F.lit(SEQ_PER_BUCKET))
    known = rates.where("tenor is not null")
    checked = with_neighbours(known, keys, "seq", bucket, previous="tenor")
    missing = rates.where("tenor is null").select(*keys, "tenor", F.col("tenor").alias("previous"))
    bad = F.col("tenor").isNull() | (F.col("tenor") <= F.col("previous"))
    return (
        checked.select(*keys, "tenor", "previous").unionByName(missing)
        .groupBy(*keys)
        .agg(
            F.sum(F.when(bad, 1).otherwise(0)).alias("violations"),
            F.count("*").alias("rows"),
        )
        .where(F.col("violations") > 0)
    )


def sound_curves(
    rates: DataFrame, keys: Sequence[str] = ("curve_id",)
) -> tuple[DataFrame, DataFrame]:
    """Nodes of the curves that pass ``validate_curve``, and the report on those that do not."""
    report = validate_curve(rates, keys)
    return rates.join(report.select(*keys), list(keys), "left_anti"), report


def marked_curves(rates: DataFrame, keys: Sequence[str] = ("curve_id",)) -> DataFrame:
    """``rates`` with ``sound``: whether the curve passes ``validate_curve``."""
    bad = validate_curve(rates, keys).select(*keys, F.lit(True).alias("_bad"))
    return rates.join(bad, list(keys), "left").selectExpr(*rates.columns, "_bad is null as sound")


def curve_snapshot(
    history: DataFrame, tenors: Mapping[str, float], keys: Sequence[str] = ("curve_id",)
) -> DataFrame:
    """Latest complete day of a wide daily history (one percent column per tenor), as long rows.

    Days with any missing tenor are skipped, the last remaining day wins, and rates come out as
    decimals with six places.
    """
    complete = history.dropna(how="any", subset=list(tenors))
    last = complete.groupBy(*keys).agg(
        F.max(F.struct("asof", *tenors)).alias("day")
    )
    nodes = F.explode(
        F.array(
            *[
                F.struct(F.lit(float(t)).alias("tenor"), F.col("day")[c].alias("percent"))
                for c, t in tenors.items()
            ]
        )
    )
    return last.select(*keys, F.col("day.asof").alias("asof"), nodes.alias("node")).select(
        *keys,
        "asof",
        "node.tenor",
        F.round(F.col("node.percent") / 100.0, 6).alias("rate"),
    )


def curve_segments(rates: DataFrame, keys: Sequence[str] = ("curve_id",)) -> DataFrame:
    """Half-open pieces (lo, hi] of each curve: flat, linear between nodes, flat.

    Output: keys, lo, hi (NULL = open end), ``rate_lo`` at lo and ``slope``; the rate at T is
    ``rate_lo + slope * (T - lo)``, with slope 0 on the flat ends.
    """
    nodes = with_neighbours(
        rates.select(*keys, "tenor", "rate"), keys, "tenor", time_bucket("tenor"),
        following=("tenor", "rate"),
    )
    pieces = nodes.selectExpr(
        *keys, "tenor as lo", "next.tenor as hi", "rate as rate_lo",
        "coalesce(try_divide(next.rate - rate, next.tenor - tenor), 0D) as slope",
    )
    head = rates.groupBy(*keys).agg(
        F.lit(None).cast("double").alias("lo"), F.min("tenor").alias("hi"),
        F.min_by("rate", "tenor").alias("rate_lo"), F.lit(0.0).alias("slope"),
    )
    return head.unionByName(pieces)


def zero_rate(
    points: DataFrame,
    segments: DataFrame,
    at: str = "T",
    keys: Sequence[str] = ("curve_id",),
    name: str = "rate",
) -> DataFrame:
    """Add the zero rate at ``at``: linear between nodes, flat outside."""
    rate = "_rate_lo + coalesce(_at - _lo, 0D) * _slope"
    return interval_lookup(points, segments, keys, at, {name: rate}, ("rate_lo", "slope"))


def discount_factor(rate: str = "rate", T: str = "T") -> Column:
    """exp(-r T)."""
    return F.expr(f"exp(-({rate}) * ({T}))")


def forward_rate(
    points: DataFrame,
    segments: DataFrame,
    start: str = "T1",
    end: str = "T2",
    keys: Sequence[str] = ("curve_id",),
    name: str = "forward_rate",
) -> DataFrame:
    """Add (r2 T2 - r1 T1) / (T2 - T1); NULL when the two dates coincide."""
    both = points.selectExpr("*", f"{start} as _t1", f"{end} as _t2")
    both = zero_rate(both, segments, "_t1", keys, "_r1")
    both = zero_rate(both, segments, "_t2", keys, "_r2")
    return both.selectExpr(
        *points.columns, f"try_divide(_r2 * _t2 - _r1 * _t1, _t2 - _t1) as {name}"
    )
