"""Discrete dividends: look-back, interval selection, present values and forwards."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .curves import discount_factor, zero_rate
from .intervals import interval_lookup
from .ordered import time_bucket, with_neighbours

# Fixed value: days of dividend history kept by the cleaning step.
LOOKBACK_DAYS = 730


def dividend_lookback(
    paid: DataFrame, asof: Column, date: str = "pay_date", days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Drop the time of day and zone, keep payments of the last ``days`` days (and later ones)."""
    return paid.withColumn(date, F.to_date(date)).where(
        F.col(date) >= F.date_sub(asof, days)
    )


def dividends_in_interval(dividends: DataFrame, start, end, T: str = "T") -> DataFrame:
    """Dividends paid in (start, end]; the ends may be numbers or columns."""
    start = start if isinstance(start, Column) else F.lit(float(start))
    end = end if isinstance(end, Column) else F.lit(float(end))
    return dividends.where((F.col(T) > start) & (F.col(T) <= end))


def cumulative_pv(
    dividends: DataFrame, keys: Sequence[str], start: float = 0.0
) -> DataFrame:
    """Step function of discounted cash paid in (start, T], as intervals [lo, hi) with ``pv``.

    ``dividends`` carries keys, T, alpha and its discount factor ``df``. Payments on one day are
    summed before anything is shuffled by order, and the running sum is cut into time buckets.
    """
    daily = (
        dividends.where(F.col("T") > start)
        .groupBy(*keys, "T")
        .agg(F.expr("sum(coalesce(alpha * df, 0D))").alias("cash"))
    )
    steps = with_neighbours(
        daily, keys, "T", time_bucket("T"), following=("T",), running="cash"
    )
    return steps.selectExpr(*keys, "T as lo", "next.T as hi", "running as pv")


def pv_dividends(
    points: DataFrame,
    dividends: DataFrame,
    segments: DataFrame,
    keys: Sequence[str] = ("underlier",),
    curve_keys: Sequence[str] = ("curve_id",),
    start: float = 0.0,
    at: str = "T",
    name: str = "pv_div",
    whole: bool = False,
) -> DataFrame:
    """Add the value at time 0 of the cash dividends paid in (start, T]; 0 where there are none.

    Each point is matched to one step of the cumulative sum rather than to every dividend before
    it, so the join never fans out. The proportional part ``beta`` does not enter. ``dividends``
    carries the curve keys. With ``whole``, for keys of few rows, each key's points and dividends are
    put into one order and summed in it: where both are dealt by key alike, nothing moves.
    """
    discounted = zero_rate(dividends, segments, "T", curve_keys, "zero").withColumn(
        "df", discount_factor("zero", "T")
    )
    if whole:
        return _summed_pv(points, discounted.where(F.col("T") > start), keys, at, name)
    steps = cumulative_pv(discounted, keys, start)
    return interval_lookup(
        points, steps, keys, at, {name: "coalesce(_pv, 0D)"}, ("pv",), closed="left"
    )


def _summed_pv(points: DataFrame, discounted: DataFrame, keys: Sequence[str], at: str, name: str) -> DataFrame:
    """``points`` with the discounted cash of their key up to ``at``."""
    cash = discounted.select(*keys, F.col("T").alias(at), F.expr("alpha * df").alias("_cash"))
    both = points.withColumn("_asked", F.lit(True)).unionByName(cash, allowMissingColumns=True)
    so_far = W.Window.partitionBy(*keys).orderBy(at).rangeBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    pv = F.coalesce(F.sum("_cash").over(so_far), F.lit(0.0)).alias(name)
    return both.select("*", pv).where("_asked").select(*points.columns, name)


def forward_price(spot: str, pv_div: str, df: str) -> Column:
    """(S - PV of dividends up to T) / df(T)."""
    return F.try_divide(F.col(spot) - F.col(pv_div), F.col(df))
