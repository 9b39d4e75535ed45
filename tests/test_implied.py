"""Implied volatility: golden run, statuses, and round trips."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from volspark.functions.backend import ARRAY
from volspark.functions.black import bs_price, undiscounted
from volspark.operators import implied


def prices(forward, strike, T, df, sigma, sign):
    return df * undiscounted(forward, strike, sigma * np.sqrt(T), sign, ARRAY)


def test_golden_round_trip(spark):
    terms = (60.0, 65.0, 0.25, 0.08, 0.0)
    row = spark.range(1).select(bs_price(*terms, 0.2, True).alias("price"))
    newton = row.select(implied.implied_vol(
        "price", *terms, True, method="newton", lo=0.01, hi=2.0, tol=1e-8, max_iter=200).alias("iv")).first().iv
    assert newton.sigma == pytest.approx(0.2, abs=1e-8)
    assert (newton.iterations, newton.status) == (4, "ok")
    solved = row.select(implied.implied_vol("price", *terms, True).alias("iv")).first().iv
    assert solved.sigma == pytest.approx(0.2, abs=1e-12) and solved.status == "ok"


def test_statuses(spark):
    nan = float("nan")
    rows = [("ok", 10.0, 100.0, 100.0, 1.0, 0.97, True), ("invalid_input", -1.0, 100.0, 100.0, 1.0, 0.97, True),
            ("invalid_input", 0.0, 100.0, 100.0, 1.0, 0.97, True), ("invalid_input", 10.0, 100.0, 100.0, 0.0, 0.97, True),
            ("invalid_input", nan, 100.0, 100.0, 1.0, 0.97, True), ("invalid_input", None, 100.0, 100.0, 1.0, 0.97, True),
            ("invalid_input", 10.0, 100.0, 100.0, 1.0, 0.97, None), ("invalid_input", 10.0, 100.0, 0.0, 1.0, 0.97, False),
            ("no_arbitrage_violation", 98.0, 100.0, 100.0, 1.0, 0.97, True),
            ("no_arbitrage_violation", 1.0, 120.0, 100.0, 1.0, 0.97, True),
            ("no_arbitrage_violation", 1.0, 100.0, 120.0, 1.0, 0.97, False),
            ("did_not_converge", 96.99, 100.0, 100.0, 1e-4, 0.97, True)]
    df = spark.createDataFrame(rows, "want string, price double, f double, k double, t double, df double, c boolean")
    for method in ("bracketed", "newton"):
        got = df.select("want", implied.implied_vol_forward("price", "f", "k", "t", "df", "c", method=method).alias("iv"))
        for row in got.collect():
            if row.want == "did_not_converge" and method == "newton":
                continue  # the plain iteration is not confined to a range of vols
            assert row.iv.status == row.want
            assert (row.iv.sigma is None) == (row.want != "ok")


def test_bracketed_recovers_every_identifiable_vol():
    """Includes the quotes on which plain Newton steps to a negative vol."""
    rng = np.random.default_rng(6)
    n = 20_000
    T, sigma = rng.uniform(0.01, 3, n), rng.uniform(0.03, 1.5, n)
    k = rng.uniform(-3, 3, n) * sigma * np.sqrt(T)
    forward, df = rng.uniform(10, 1000, n), rng.uniform(0.8, 1.0, n)
    strike, sign = forward * np.exp(k), np.where(rng.random(n) < 0.5, 1.0, -1.0)
    price = prices(forward, strike, T, df, sigma, sign)
    got = implied.invert(price, forward, strike, T, df, sign > 0)
    assert (got.status == "ok").all()
    assert np.abs(got.sigma.to_numpy(dtype=float) - sigma).max() < 1e-7
    plain = implied.invert(price, forward, strike, T, df, sign > 0, "newton", 0.01, 2.0)
    failed = plain.status == "did_not_converge"
    assert 0 < failed.mean() < 0.2
    again = prices(forward, strike, T, df, plain.sigma.fillna(0.2).to_numpy(dtype=float), sign)
    assert np.abs(again - price)[~failed].max() < 1e-7


@settings(max_examples=200, deadline=None)
@given(st.floats(0.02, 3), st.floats(0.01, 5), st.floats(-12, 12), st.booleans())
def test_far_prices_reprice(sigma, T, deviations, is_call):
    forward, df = 100.0, 0.95
    strike = forward * np.exp(np.clip(deviations * sigma * np.sqrt(T), -8, 8))
    sign = 1.0 if is_call else -1.0
    price = prices(np.array([forward]), np.array([strike]), np.array([T]), df, np.array([sigma]), sign)
    got = implied.invert(price, [forward], [strike], [T], [df], [is_call]).iloc[0]
    if price[0] > 0 and price[0] < df * (forward if is_call else strike) * (1 - 1e-13):
        assert got.status == "ok"
        again = prices(forward, strike, T, df, float(got.sigma), sign)
        assert abs(again - price[0]) < 1e-9 * max(forward, strike)
