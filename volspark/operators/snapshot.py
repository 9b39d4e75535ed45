"""Market snapshots: spots, curves and dividends brought to the quotes that need them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quotes import log_moneyness, mid
from .curves import curve_segments, discount_factor, zero_rate
from .dividends import forward_price, pv_dividends


# Column of stored quotes: a hash of T. Spark does not use a bucketing by a DOUBLE in joins.
MATURITY = "maturity"


def maturity_keys(quotes: DataFrame) -> list[str]:
    return [MATURITY] if MATURITY in quotes.columns else []


def latest_spot(spots: DataFrame, keys: Sequence[str] = ("underlier",)) -> DataFrame:
    """Most recent spot per key; the larger value wins if a day has two."""
    last = spots.groupBy(*keys).agg(F.max(F.struct("asof", "spot")).alias("_last"))
    return last.select(*keys, "_last.spot", "_last.asof")


def expiry_forwards(
    quotes: DataFrame,
    spots: DataFrame,
    rates: DataFrame,
    dividends: DataFrame,
    keys: Sequence[str] = ("underlier",),
    curve_keys: Sequence[str] = ("curve_id",),
) -> DataFrame:
    """Rate, discount factor, dividend value and forward per distinct (keys, curve, T).

    A chain lists hundreds of strikes per expiry, so the three lookups run on this much smaller
    table of expiries and not on the quotes.
    """
    join_keys = list(dict.fromkeys([*keys, *curve_keys, *maturity_keys(quotes)]))
    known = rates.where("sound") if "sound" in rates.columns else rates
    segments = curve_segments(known, curve_keys)
    slices = quotes.select(*join_keys, "T").distinct()
    slices = slices.join(spots.select(*keys, "spot"), list(keys), "left")
    slices = zero_rate(slices, segments, "T", curve_keys, "r")
    slices = slices.withColumn("df", discount_factor("r", "T"))
    slices = pv_dividends(slices, dividends, segments, keys, curve_keys)
    return slices.withColumn("forward", forward_price("spot", "pv_div", "df"))


def enrich_quotes(
    quotes: DataFrame,
    spots: DataFrame,
    rates: DataFrame,
    dividends: DataFrame,
    keys: Sequence[str] = ("underlier",),
    curve_keys: Sequence[str] = ("curve_id",),
) -> DataFrame:
    """Quotes with spot, r, df, pv_div, forward, mid, k = ln(K/F) and status.

    No quote is lost: status is ok, no_spot or no_curve (no spot or no curve for the quote's
    market), invalid_curve (a curve that ``rates`` marks as not ``sound``), no_maturity (no T), and
    what depends on the missing part is NULL. ``keys`` identify a market (say underlier and date)
    and ``curve_keys`` its curve; quotes and dividends carry both. Quotes move at most once, to
    meet their expiry slice.
    """
    join_keys = list(dict.fromkeys([*keys, *curve_keys, *(maturity_keys(quotes) or ["T"])]))
    slices = expiry_forwards(quotes, spots, rates, dividends, keys, curve_keys)
    return attach_slices(quotes, mark_unsound(slices, rates, curve_keys), join_keys)


def mark_unsound(slices: DataFrame, rates: DataFrame, curve_keys: Sequence[str]) -> DataFrame:
    """``slices`` with ``unsound``: whether ``rates`` marks the curve as not ``sound``."""
    if "sound" not in rates.columns:
        return slices.withColumn("unsound", F.lit(False))
    bad = rates.where("not sound").select(*curve_keys, F.lit(True).alias("unsound")).distinct()
    return slices.join(bad, list(curve_keys), "left")


def attach_slices(quotes: DataFrame, slices: DataFrame, join_keys: Sequence[str]) -> DataFrame:
    """Quotes with the columns of their expiry slice, mid, k and status, and with df and forward, which
    follow from the others, if the slices lack them."""
    if MATURITY in join_keys:  # equal hashes need not be equal maturities
        named = {k: f"_{k}" for k in (*join_keys, "T")}
        equal = " and ".join([*(f"{k} = {named[k]}" for k in join_keys), "not (T < _T or T > _T)"])
        joined = quotes.join(slices.withColumnsRenamed(named), F.expr(equal), "left").drop(*named.values())
    else:
        joined = quotes.join(slices, list(join_keys), "left")
    if "forward" not in slices.columns:
        joined = joined.withColumn("df", discount_factor("r", "T"))
        joined = joined.withColumn("forward", forward_price("spot", "pv_div", "df"))
    return (
        joined
        .withColumn("mid", mid())
        .withColumn("k", log_moneyness("strike", "forward"))
        .withColumn(
            "status",
            F.expr(
                "case when T is null then 'no_maturity' when spot is null then 'no_spot' "
                "when unsound then 'invalid_curve' when r is null then 'no_curve' else 'ok' end"
            ),
        )
        .drop("unsound")
    )
