"""Option-chain operators: cleaning, filters, counts and the call/put parity table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.dates import expiry_years
from ..functions.quotes import has_exercise, is_two_sided, mid
from ..sources.chain import CHAIN_COLUMNS

# Expiry range in days and the smallest bid kept by the cleaning step.
MIN_DAYS = 7
MAX_DAYS = 365
MIN_BID = 0.05


def normalise_chain(raw: DataFrame, asof: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Clean a downloaded chain: 7 to 365 days to expiry, traded volume, bid above five cents.

    Adds daysToExpiry, T = round(days / 365, 6) and exerciseType, then keeps the chain-file
    columns that exist (plus ``keep``), in file order. ``raw`` carries ``expiration`` and ``type``.
    """
    days = F.datediff(F.col("expiration"), asof)
    cleaned = (
        raw.where(days.between(MIN_DAYS, MAX_DAYS))
        .where(F.coalesce(F.col("volume"), F.lit(0)) > 0)
        .where((F.col("bid") > MIN_BID) & ~F.isnan("bid"))
        .withColumn("daysToExpiry", days)
        .withColumn("T", expiry_years("daysToExpiry"))
        .withColumn("exerciseType", F.lit("american"))
    )
    present = [c for c in CHAIN_COLUMNS if c in cleaned.columns]
    return cleaned.select(*keep, *present)


def union_chains(calls: DataFrame, puts: DataFrame) -> DataFrame:
    """Calls and puts as one table, columns matched by name, missing ones NULL."""
    return calls.unionByName(puts, allowMissingColumns=True)


def two_sided(quotes: DataFrame) -> DataFrame:
    return quotes.where(is_two_sided())


def europeans(quotes: DataFrame) -> DataFrame:
    return quotes.where(has_exercise("european"))


def americans(quotes: DataFrame) -> DataFrame:
    return quotes.where(has_exercise("american"))


def first_n(
    quotes: DataFrame, n: int, order: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """First ``n`` rows by ``order``, overall or per key.

    Both forms keep at most ``n`` rows per task before any exchange (top-k sort, rank limit), so a
    hot key costs no more than a cold one.
    """
    if not keys:
        return quotes.orderBy(*order).limit(n)
    ranked = quotes.withColumn(
        "rank", F.row_number().over(W.Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("rank") <= n)


def chain_summary(quotes: DataFrame, keys: Sequence[str] = ("underlier",)) -> DataFrame:
    """Quotes, volume and open interest per key and side."""
    return quotes.groupBy(*keys, "is_call").agg(
        F.count("*").alias("quotes"),
        F.sum("volume").alias("volume"),
        F.sum("open_interest").alias("open_interest"),
    )


def parity_by_strike(
    quotes: DataFrame,
    keys: Sequence[str] = ("underlier",),
    price: Column | None = None,
    strike_keys: Sequence[str] = ("strike", "T"),
    carried: Sequence[str] = ("forward", "df"),
) -> DataFrame:
    """Call/put parity residual C - P - df (F - K) per strike and expiry that has both sides.

    One aggregation instead of a self-join: the extreme residuals over every call/put pair of a
    strike follow from each side's extremes, so repeated quotes never multiply into pairs.
    Output: keys, strike keys, ``pairs``, ``residual_lo``, ``residual_hi``, ``worst``.
    """
    price = mid() if price is None else price
    call, put = F.col("is_call"), ~F.col("is_call")
    sides = quotes.withColumn("price", price).groupBy(*keys, *strike_keys).agg(
        F.count_if(call).alias("calls"),
        F.count_if(put).alias("puts"),
        F.min(F.when(call, F.col("price"))).alias("call_lo"),
        F.max(F.when(call, F.col("price"))).alias("call_hi"),
        F.min(F.when(put, F.col("price"))).alias("put_lo"),
        F.max(F.when(put, F.col("price"))).alias("put_hi"),
        *[F.min(c).alias(c) for c in carried],
    )
    fair = F.col("df") * (F.col("forward") - F.col("strike"))
    return (
        sides.where((F.col("calls") > 0) & (F.col("puts") > 0))
        .withColumn("pairs", F.col("calls") * F.col("puts"))
        .withColumn("residual_lo", F.col("call_lo") - F.col("put_hi") - fair)
        .withColumn("residual_hi", F.col("call_hi") - F.col("put_lo") - fair)
        .withColumn("worst", F.greatest(F.abs("residual_lo"), F.abs("residual_hi")))
        .select(*keys, *strike_keys, "pairs", "residual_lo", "residual_hi", "worst")
    )


def parity_report(by_strike: DataFrame, keys: Sequence[str] = ("underlier",)) -> DataFrame:
    """Strikes, pairs and largest absolute parity residual per key."""
    return by_strike.groupBy(*keys).agg(
        F.count("*").alias("strikes"),
        F.sum("pairs").alias("pairs"),
        F.max("worst").alias("max_residual"),
    )
