"""Black-Scholes and Black (forward form) closed forms.

Calls and puts share one expression: with e = +1 for a call and -1 for a put,
price = e * (S' N(e d1) - K' N(e d2)). Invalid inputs (non-positive S, K, T or sigma) give NULL.

``bs_price`` and its like return one Column. ``with_price`` and its like take a DataFrame and add
the same value through staged projections; prefer them when a formula feeds further formulas.
"""

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame

from .backend import INLINE, Staged, positive, sql
from .normal import cdfs, pdf


def call_sign(is_call, m=INLINE):
    """+1 for calls, -1 for puts."""
    return 2.0 * m.indicator(is_call) - 1.0


def undiscounted(forward, strike, stdev, sign, m=INLINE):
    """Black price before discounting; ``stdev`` is sigma * sqrt(T)."""
    (upper,) = m.let(m.log(forward / strike) / stdev + 0.5 * stdev)
    asset, bond = cdfs([sign * upper, sign * (upper - stdev)], m)
    return sign * (forward * asset - strike * bond)


def _stdev(T, sigma):
    return positive(sigma) * INLINE.sqrt(positive(T))


def _carried(S, T, r, q):
    """Forward of a spot with continuous carry."""
    return positive(S) * INLINE.exp((sql(r) - sql(q)) * sql(T))


def _discount(T, r):
    return INLINE.exp(-(sql(r) * sql(T)))


def _upper(S, K, T, r, q, sigma):
    sd = _stdev(T, sigma)
    drift = (sql(r) - sql(q)) * sql(T)
    return (INLINE.log(positive(S) / positive(K)) + drift) / sd + 0.5 * sd


def d1(S, K, T, r, q, sigma) -> Column:
    return _upper(S, K, T, r, q, sigma).column


def d2(S, K, T, r, q, sigma) -> Column:
    return (_upper(S, K, T, r, q, sigma) - _stdev(T, sigma)).column


def _price(forward, K, T, df, sigma, is_call, m):
    forward, strike, sd, sign = m.let(
        sql(forward), positive(K), _stdev(T, sigma), call_sign(sql(is_call))
    )
    return sql(df) * undiscounted(forward, strike, sd, sign, m)


def _vega(forward, K, T, df, sigma, m):
    forward, sd = m.let(sql(forward), _stdev(T, sigma))
    (upper,) = m.let(m.log(forward / positive(K)) / sd + 0.5 * sd)
    return sql(df) * forward * m.sqrt(positive(T)) * pdf(upper, m)


def black_price(F, K, T, df, sigma, is_call) -> Column:
    """Price from a forward and a discount factor."""
    return _price(positive(F), K, T, df, sigma, is_call, INLINE).column


def bs_price(S, K, T, r, q, sigma, is_call) -> Column:
    """Price from spot, rate and continuous dividend yield."""
    return _price(
        _carried(S, T, r, q), K, T, _discount(T, r), sigma, is_call, INLINE
    ).column


def black_vega(F, K, T, df, sigma) -> Column:
    return _vega(positive(F), K, T, df, sigma, INLINE).column


def bs_vega(S, K, T, r, q, sigma) -> Column:
    return _vega(_carried(S, T, r, q), K, T, _discount(T, r), sigma, INLINE).column


def with_black_price(
    frame: DataFrame, name: str, F="forward", K="strike", T="T", df="df", sigma="sigma",
    is_call="is_call",
) -> DataFrame:
    """Add ``name``: price from a forward and a discount factor."""
    m = Staged(frame)
    price = _price(positive(F), K, T, df, sigma, is_call, m)
    return m.done(**{name: price})


def with_bs_price(
    frame: DataFrame, name: str, S="spot", K="strike", T="T", r="r", q="q", sigma="sigma",
    is_call="is_call",
) -> DataFrame:
    """Add ``name``: price from spot, rate and continuous dividend yield."""
    m = Staged(frame)
    price = _price(_carried(S, T, r, q), K, T, _discount(T, r), sigma, is_call, m)
    return m.done(**{name: price})


GREEKS = ("delta", "gamma", "vega", "theta", "rho", "vanna", "volga")


def _greeks(S, K, T, r, q, sigma, is_call, m):
    spot, strike, vol, T, sign = m.let(
        positive(S), positive(K), positive(sigma), positive(T), call_sign(sql(is_call))
    )
    r, q = sql(r), sql(q)
    root_t, carry, df = m.let(m.sqrt(T), m.exp(-(q * T)), m.exp(-(r * T)))
    (sd,) = m.let(vol * root_t)
    (upper,) = m.let((m.log(spot / strike) + (r - q) * T) / sd + 0.5 * sd)
    (lower,) = m.let(upper - sd)
    n1, n2 = cdfs([sign * upper, sign * lower], m)
    asset, bond, density = m.let(carry * n1, strike * df * n2, carry * pdf(upper, m))
    (vega,) = m.let(spot * root_t * density)
    return SimpleNamespace(
        delta=sign * asset,
        gamma=density / (spot * sd),
        vega=vega,
        theta=sign * (q * spot * asset - r * bond) - 0.5 * spot * density * vol / root_t,
        rho=sign * T * bond,
        vanna=-(density * lower / vol),
        volga=vega * upper * lower / vol,
    )


def bs_greeks(S, K, T, r, q, sigma, is_call) -> Column:
    """Closed-form Greeks as one struct: delta, gamma, vega, theta, rho, vanna, volga.

    Theta is per year of calendar time; vega, rho, vanna and volga are per unit of vol or rate.
    """
    values = _greeks(S, K, T, r, q, sigma, is_call, INLINE)
    fields = ", ".join(f"'{g}', {getattr(values, g)}" for g in GREEKS)
    return sql(f"named_struct({fields})").column


def with_bs_greeks(
    frame: DataFrame, S="spot", K="strike", T="T", r="r", q="q", sigma="sigma",
    is_call="is_call", prefix: str = "",
) -> DataFrame:
    """Add the Greeks of ``bs_greeks`` as columns."""
    m = Staged(frame)
    values = _greeks(S, K, T, r, q, sigma, is_call, m)
    return m.done(**{prefix + g: getattr(values, g) for g in GREEKS})


def parity_residual(call, put, S, K, T, r, q) -> Column:
    """C - P - (S e^{-qT} - K e^{-rT}); zero for European prices on one smile."""
    fair = sql(S) * _discount(T, q) - sql(K) * _discount(T, r)
    return (sql(call) - sql(put) - fair).column
