"""Implied volatility by Arrow batches: every row of a batch iterates together."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.backend import ARRAY, INLINE, sql
from ..functions.black import undiscounted
from ..functions.normal import pdf

RESULT = "sigma double, iterations int, status string"
METHODS = ("bracketed", "newton")

# Smallest usable vega and price tolerance of the plain Newton iteration, for the
# inversion from a spot and from a forward, and the seed of the latter.
SPOT_MIN_VEGA = 1e-10
FORWARD_MIN_VEGA = 1e-12
PRICE_TOLERANCE = 1e-8
FORWARD_SEED = 0.3

STEP_TOLERANCE = 1e-12
ROUNDING = 1e-13  # a price this close to its bound, relative to the asset, is on the bound


def _price_and_vega(forward, strike, root_t, df, sign, sigma):
    stdev = sigma * root_t
    upper = np.log(forward / strike) / stdev + 0.5 * stdev
    price = df * undiscounted(forward, strike, stdev, sign, ARRAY)
    return price, df * forward * root_t * pdf(upper, ARRAY)


def _newton(price, forward, strike, root_t, df, sign, seed, tol, max_iter, min_vega):
    """Plain Newton; a vanishing vega or a non-positive vol ends a row without a result."""
    sigma = np.full(price.shape, seed)
    count = np.zeros(price.shape, dtype=np.int32)
    solved = np.zeros(price.shape, dtype=bool)
    live = np.arange(price.size)
    for i in range(max_iter):
        model, vega = _price_and_vega(
            forward[live], strike[live], root_t[live], df[live], sign[live], sigma[live]
        )
        miss = model - price[live]
        hit = np.abs(miss) < tol
        solved[live[hit]], count[live[hit]] = True, i
        go = ~hit & (np.abs(vega) >= min_vega)
        live = live[go]
        if not live.size:
            break
        sigma[live] -= miss[go] / vega[go]
        live = live[sigma[live] > 0.0]
    return sigma, count, solved


def _bracketed(price, forward, strike, root_t, df, sign, slack, lo, hi, max_iter):
    """Newton kept inside a shrinking bracket, with bisection whenever a step leaves it.

    The price rises with the vol, so [lo, hi] brackets the root or there is none. The start is the
    vol of steepest price, from which Newton approaches the root from one side.
    """
    low = np.full(price.shape, lo)
    high = np.full(price.shape, hi)
    at_lo, _ = _price_and_vega(forward, strike, root_t, df, sign, low)
    at_hi, _ = _price_and_vega(forward, strike, root_t, df, sign, high)
    outside = sign * (forward - strike) <= 0.0
    inside = (at_lo <= price + slack) & (price <= at_hi)
    steepest = np.sqrt(2.0 * np.abs(np.log(forward / strike))) / root_t
    sigma = np.clip(steepest, max(lo, 1e-3), hi)
    count = np.zeros(price.shape, dtype=np.int32)
    solved = np.zeros(price.shape, dtype=bool)
    live = np.flatnonzero(inside)
    for i in range(max_iter):
        if not live.size:
            break
        x = sigma[live]
        model, vega = _price_and_vega(
            forward[live], strike[live], root_t[live], df[live], sign[live], x
        )
        miss = model - price[live]
        low[live] = np.where(miss <= 0.0, x, low[live])
        high[live] = np.where(miss >= 0.0, x, high[live])
        # Far out of the money the log of the price is the better-behaved function of the vol.
        logs = outside[live] & (model > 0.0)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            gap = np.where(logs, model * np.log(model / price[live]), miss)
            step = x - gap / vega
        usable = (step > low[live]) & (step < high[live])
        moved = np.where(usable, step, 0.5 * (low[live] + high[live]))
        moved = np.where(miss == 0.0, x, moved)
        done = np.abs(moved - x) <= STEP_TOLERANCE * np.maximum(1.0, x)
        sigma[live] = moved
        solved[live[done]], count[live[done]] = True, i
        live = live[~done]
    return sigma, count, solved


def call_signs(is_call):
    """+1 for calls and -1 for puts, and where the side is known at all."""
    side = pd.Series(is_call).astype("boolean")
    calls = side.fillna(False).to_numpy(dtype=bool)
    return np.where(calls, 1.0, -1.0), side.notna().to_numpy()


def invert(price, forward, strike, T, df, is_call, method="bracketed", lo=1e-4, hi=5.0,
           tol=PRICE_TOLERANCE, max_iter=200, seed=None, min_vega=SPOT_MIN_VEGA):
    """Implied vols of arrays of quotes, as the frame the Arrow function returns."""
    price, forward, strike, T, df = (
        np.asarray(v, dtype=np.float64) for v in (price, forward, strike, T, df)
    )
    sign, known_side = call_signs(is_call)
    given = np.isfinite([price, forward, strike, T, df]).all(axis=0)
    valid = given & known_side & (price > 0) & (forward > 0) & (strike > 0) & (T > 0) & (df > 0)
    with np.errstate(invalid="ignore"):
        floor = np.maximum(df * sign * (forward - strike), 0.0)
        ceiling = df * np.where(sign > 0, forward, strike)
        slack = ROUNDING * ceiling
        bounded = valid & (price >= floor - slack) & (price < ceiling)
    pick = np.flatnonzero(bounded)
    rows = (price[pick], forward[pick], strike[pick], np.sqrt(T[pick]), df[pick], sign[pick])
    if method == "newton":
        start = 0.5 * (lo + hi) if seed is None else seed
        vol, used, good = _newton(*rows, start, tol, max_iter, min_vega)
    else:
        vol, used, good = _bracketed(*rows, slack[pick], lo, hi, max_iter)
    sigma = np.full(price.shape, np.nan)
    iterations = np.zeros(price.shape, dtype=np.int32)
    status = np.where(valid, "no_arbitrage_violation", "invalid_input").astype(object)
    sigma[pick] = np.where(good, vol, np.nan)
    iterations[pick] = used
    status[pick] = np.where(good, "ok", "did_not_converge")
    solved = status == "ok"
    return pd.DataFrame(
        {
            "sigma": pd.Series(sigma).where(solved, None).astype("Float64"),
            "iterations": pd.Series(iterations).where(solved, None).astype("Int32"),
            "status": status,
        }
    )


def implied_vol_forward(
    price, forward, strike, T, df, is_call, method: str = "bracketed", lo: float = 1e-4,
    hi: float = 5.0, tol: float = PRICE_TOLERANCE, max_iter: int = 100,
    seed: float | None = FORWARD_SEED, min_vega: float = FORWARD_MIN_VEGA,
) -> Column:
    """Struct ``sigma, iterations, status`` from a price, a forward and a discount factor.

    ``status`` is ok, invalid_input, no_arbitrage_violation (price outside its model-free bounds)
    or did_not_converge; ``sigma`` is NULL unless ok. ``newton`` starts at ``seed`` and stops on
    the price error; ``bracketed`` converges on the vol for every root inside [lo, hi].
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; expected one of {METHODS}")

    @F.pandas_udf(RESULT)
    def inverted(p: pd.Series, f: pd.Series, k: pd.Series, t: pd.Series, d: pd.Series,
                 c: pd.Series) -> pd.DataFrame:
        return invert(p, f, k, t, d, c, method, lo, hi, tol, max_iter, seed, min_vega)

    return inverted(*[sql(c).column for c in (price, forward, strike, T, df, is_call)])


def implied_vol(
    price, S, K, T, r, q, is_call, method: str = "bracketed", lo: float = 1e-4,
    hi: float = 5.0, tol: float = PRICE_TOLERANCE, max_iter: int = 200,
) -> Column:
    """The same struct from spot, rate and dividend yield; ``newton`` starts at (lo + hi) / 2."""
    S, T, r, q = sql(S), sql(T), sql(r), sql(q)
    forward = S * INLINE.exp((r - q) * T)
    return implied_vol_forward(
        price, forward, K, T, INLINE.exp(-(r * T)), is_call, method, lo, hi, tol, max_iter,
        seed=None, min_vega=SPOT_MIN_VEGA,
    )


def with_implied_vol(enriched: DataFrame, price: str = "mid", **options) -> DataFrame:
    """Add sigma, iterations and status to quotes that carry forward, df, strike and T.

    A quote that already has a status other than ok (from ``enrich_quotes``) keeps it.
    """
    kept = [c for c in enriched.columns if c not in ("sigma", "iterations", "status")]
    before = F.col("status") if "status" in enriched.columns else F.lit("ok")
    solved = enriched.withColumn(
        "_iv", implied_vol_forward(price, "forward", "strike", "T", "df", "is_call", **options)
    )
    return solved.select(
        *kept, "_iv.sigma", "_iv.iterations",
        F.when(before == "ok", F.col("_iv.status")).otherwise(before).alias("status"),
    )


def price_weight(k: str = "k", T: str = "T", sigma: str = "sigma") -> Column:
    """Weight of a solved vol in a fit: its squared vega, as a share of the largest.

    Far from the money a price hardly depends on its vol, and rounding of the price decides the
    vol found. So weighted, vols count as much as their prices say, and no quote has to be dropped.
    """
    return F.expr(f"exp(-power(-{k} / ({sigma} * sqrt({T})) + 5e-1 * {sigma} * sqrt({T}), 2))")
