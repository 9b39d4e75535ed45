"""Snapshots of many dates at once: histories of spots, curves and dividends, as of each quote's day."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.dates import year_frac
from .curves import curve_segments, zero_rate
from .dividends import pv_dividends
from .ordered import TIME_BUCKETS
from .snapshot import attach_slices, mark_unsound

# Rows of curves that are broadcast at most, and of any other history or of the quotes
# in a task, about.
MOST_SENT = 1_000_000
TASK_ROWS = 250_000


def last_day(
    points: DataFrame, history: DataFrame, keys: Sequence[str], day: str = "asof", name: str = "day"
) -> DataFrame:
    """(keys, ``day``, ``name``): the last day of ``history`` up to each date of ``points``, NULL
    where there is none.

    Only the different dates of a key meet in a task, so its size is bounded by the calendar,
    however many rows the key has.
    """
    known = history.select(*keys, day, F.lit(True).alias("_known"))
    asked = points.select(*keys, day, F.lit(False).alias("_known"))
    days = known.unionByName(asked).where(F.col(day).isNotNull()).groupBy(*keys, day).agg(
        F.bool_or("_known").alias("_known"), F.bool_or(~F.col("_known")).alias("_asked")
    )
    so_far = W.Window.partitionBy(*keys).orderBy(day).rowsBetween(W.Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("_known"), F.col(day)), ignorenulls=True).over(so_far)
    return days.withColumn(name, last).where("_asked").select(*keys, day, name)


def dividends_of_dates(
    dates: DataFrame, paid: DataFrame, keys: Sequence[str] = ("underlier",), dealt: bool = False
) -> DataFrame:
    """The payments after each date of ``dates`` (keys, asof, horizon in years, ...) up to its horizon,
    as (T, alpha, beta) beside the columns of ``dates``.

    Dates and payments meet by key and calendar year, so a key's dates are paired with the payments
    of the years they reach into and not with its whole history. Where both are ``dealt`` by key
    already, they meet by key alone and nothing moves; different ones of a key are bounded by the
    calendar. Both sides grow with the market and are merged: a size that Spark guesses for payments
    from an ``explode`` is too small, and a broadcast would have to fit into the driver and every
    executor.
    """
    horizon = F.expr("date_add(asof, cast(least(ceil(horizon * 365.25D), 36525D) as int))")
    reached, cash = dates.withColumn("_to", horizon), paid.select(*keys, "pay_date", F.col("amount").alias("alpha"))
    on = list(keys)
    if not dealt:
        on.append("_year")
        reached = reached.withColumn("_year", F.explode(F.sequence(F.year("asof"), F.year("_to"))))
        cash = cash.withColumn("_year", F.year("pay_date"))
    inside = reached.join(cash.hint("merge"), on).where("pay_date > asof and pay_date <= _to")
    return inside.select(
        *dates.columns, year_frac(F.col("asof"), "pay_date").alias("T"), "alpha", F.lit(0.0).alias("beta")
    ).drop("horizon")


def with_last_spot(
    asked: DataFrame, spots: DataFrame, tasks: int, keys: Sequence[str] = ("underlier",)
) -> DataFrame:
    """The different rows of ``asked`` (keys, asof, ...) with the last spot up to their day, the larger
    if the day has two, and that day (``spot_asof``). Both are NULL where there is none.

    Rows and spots move once, dealt by key to ``tasks`` tasks, and what comes out lies that way. Only
    the different rows of a key are kept in a task, however often they come.
    """
    known = spots.select(*keys, "asof", "spot", F.lit(True).alias("_known"))
    both = asked.withColumn("_known", F.lit(False)).unionByName(known, allowMissingColumns=True)
    dealt = both.where(" and ".join(f"{k} is not null" for k in (*keys, "asof"))).repartition(tasks, *keys)
    rows = dealt.groupBy(*asked.columns, "_known").agg(F.max("spot").alias("spot"))
    so_far = W.Window.partitionBy(*keys).orderBy("asof", F.desc("_known"))
    so_far = so_far.rowsBetween(W.Window.unboundedPreceding, 0)
    day = F.when(F.col("_known"), F.struct(F.col("asof").alias("day"), "spot"))
    found = rows.withColumn("_last", F.last(day, ignorenulls=True).over(so_far)).where("not _known")
    return found.select(*asked.columns, "_last.spot", F.col("_last.day").alias("spot_asof"))


def _groups(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """The number of different ``keys``, and that of rows."""
    counts = df.groupBy(*keys).count().agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0)))
    return tuple(counts.first())


def enrich_dates(quotes: DataFrame, spots: DataFrame, rates: DataFrame, paid: DataFrame) -> DataFrame:
    """``enrich_quotes`` for quotes of many dates.

    ``quotes`` has underlier, curve_id and asof (a DATE); ``spots`` (underlier, asof, spot), ``rates``
    (curve_id, asof, tenor, rate) and ``paid`` (underlier, pay_date, amount) are whole histories. A
    quote gets the last spot and the last curve up to its day (``spot_asof`` and ``curve_asof`` tell
    which) and the payments after it. Everything is looked up for the different (underlier, curve,
    date, T), and the quotes move once, to meet them.

    The keys of the quotes, the spots and the payments move once too, dealt by underlier, and every
    lookup runs where they lie. The curves come to them: they are broadcast, whatever Spark guesses
    their size to be, if they are counted to be at most about ``MOST_SENT`` rows; with more of them
    Spark plans these joins, and the keys move again.
    """
    market, curve = ["underlier", "curve_id", "asof"], ["curve_id", "curve_asof"]
    keys = [*market, "T"]
    days, rows = _groups(quotes, ("curve_id", "asof"))
    curves, points = _groups(rates, ("curve_id", "asof"))
    sent = F.broadcast if days + TIME_BUCKETS * curves + 2 * points <= MOST_SENT else lambda df: df
    context = quotes.sparkSession.sparkContext
    tasks = max(context.defaultParallelism, -(-max(rows, spots.count(), paid.count()) // TASK_ROWS))

    asked = quotes.select(*keys).where(" and ".join(f"{k} is not null" for k in keys))
    slices = with_last_spot(asked, spots, tasks)
    nodes = rates.withColumnRenamed("asof", "curve_asof")
    curve_days = mark_unsound(last_day(quotes, rates, ("curve_id",), name="curve_asof"), nodes, curve)
    slices = slices.join(sent(curve_days), ["curve_id", "asof"], "left")
    # the spots are not needed here, but without them the dealt rows would be others and dealt twice
    dates = slices.groupBy(*market, "curve_asof", "spot", "spot_asof").agg(F.max("T").alias("horizon"))
    daily = paid.where("underlier is not null").repartition(tasks, "underlier")
    daily = daily.groupBy("underlier", "pay_date").agg(F.sum("amount").alias("amount"))
    cash = dividends_of_dates(dates, daily, dealt=True)
    segments = sent(curve_segments(nodes.where("sound") if "sound" in nodes.columns else nodes, curve))
    slices = zero_rate(slices, segments, "T", curve, "r")
    slices = pv_dividends(slices, cash, segments, market, curve, whole=True)
    found = attach_slices(quotes, slices, keys)
    return found.select(
        *keys, *[c for c in quotes.columns if c not in keys], "curve_asof", "spot", "r", "df", "pv_div", "forward",
        "spot_asof", "mid", "k", "status",
    )
