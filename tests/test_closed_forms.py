"""Golden values, identities and guards of the scalar functions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from volspark.functions import black, quotes, ssvi
from volspark.functions.backend import ARRAY, INLINE, Sql, sql
from volspark.functions.dates import expiry_years, parse_date, year_frac
from volspark.functions.local_vol import local_vol, with_local_vol
from volspark.functions.normal import cdfs, norm_cdf, norm_pdf

GOLDEN_SURFACE = (-0.3, 0.5, 0.3, 0.04)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_sql_text_keeps_the_meaning_of_nested_arithmetic(spark):
    a, b, c = sql(7.0), sql(-3.0), sql("2e0 + 3e0")
    for text, expected in [
        (a - (b - c), 15.0), ((a - b) - c, 5.0), (a * (b + c), 14.0), (a / (c - 5.0), None),
        (-(a - b) * c, -50.0), (1.0 - a * b, 22.0), (a - b * c + 1.0, 23.0),
        (2.0 / (a + b) / c, 0.1), (-a * -b, -21.0),
    ]:
        assert value(spark, text.column) == expected
    assert value(spark, ((a > b) & (c <= 5.0)).column) is True
    assert value(spark, INLINE.indicator(a < b).column) == 0.0
    assert isinstance(a + 1, Sql)


def test_normal_distribution_matches_erfc(spark):
    x = np.concatenate([np.linspace(-40, 40, 4001), [0.0, -0.0, 7.0710678, -7.0710679]])
    exact = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])
    assert np.abs(cdfs([x], ARRAY)[0] - exact).max() < 3e-16
    rows = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = rows.select(norm_cdf("x").alias("c"), norm_pdf("x").alias("p")).toPandas()
    assert np.abs(got["c"].to_numpy() - exact).max() < 3e-16
    assert np.abs(got["p"] - np.exp(-x * x / 2) / math.sqrt(2 * math.pi)).max() < 1e-16


def test_black_scholes_golden_values(spark):
    terms = (60.0, 65.0, 0.25, 0.08, 0.0, 0.2)
    call = value(spark, black.bs_price(*terms, True))
    put = value(spark, black.bs_price(*terms, False))
    assert call == pytest.approx(1.0414543725, abs=1e-10)
    assert put == pytest.approx(4.7543681375, abs=1e-10)
    assert call - put == pytest.approx(-3.7129137649, abs=1e-10)
    assert value(spark, black.bs_price(100.0, 100.0, 1.0, 0.05, 0.02, 0.2, True)) == pytest.approx(
        9.2270055082, abs=1e-9
    )
    assert value(spark, black.bs_price(100.0, 100.0, 1.0, 0.05, 0.02, 0.2, False)) == pytest.approx(
        6.3300806275, abs=1e-9
    )
    residual = black.parity_residual(call, put, 60.0, 65.0, 0.25, 0.08, 0.0)
    assert abs(value(spark, residual)) < 1e-12


@pytest.fixture(scope="module")
def book(spark):
    rng = np.random.default_rng(3)
    rows = [
        (float(s), float(k), float(t), float(r), float(q), float(v), bool(c))
        for s, k, t, r, q, v, c in zip(
            rng.uniform(50, 150, 200), rng.uniform(50, 150, 200), rng.uniform(0.05, 3, 200),
            rng.uniform(-0.02, 0.1, 200), rng.uniform(0, 0.05, 200), rng.uniform(0.05, 0.9, 200),
            rng.random(200) < 0.5,
        )
    ]
    return spark.createDataFrame(
        rows, "spot double, strike double, T double, r double, q double, sigma double, is_call boolean"
    ).cache()


def test_forms_of_the_same_price_agree(book):
    names = ("spot", "strike", "T", "r", "q", "sigma", "is_call")
    rows = black.with_bs_price(book, "staged").withColumn("inline", black.bs_price(*names))
    rows = rows.withColumn("df", F.exp(-F.col("r") * F.col("T"))).withColumn(
        "forward", F.col("spot") * F.exp((F.col("r") - F.col("q")) * F.col("T"))
    )
    rows = black.with_black_price(rows, "forward_form").toPandas()
    assert (rows.staged - rows.inline).abs().max() < 1e-11
    assert (rows.staged - rows.forward_form).abs().max() < 1e-11
    assert (rows.staged > 0).all()


def test_price_rises_with_vol_and_stays_inside_its_bounds(book):
    rows = book.selectExpr("* except (sigma)", "sigma as id", "explode(sequence(1, 20)) as step")
    rows = rows.withColumn("sigma", F.expr("step / 1e1"))
    rows = black.with_bs_price(rows, "price").toPandas().sort_values("sigma")
    df = np.exp(-rows.r * rows["T"])
    sign = np.where(rows.is_call, 1, -1)
    asset = rows.spot * np.exp(-rows.q * rows["T"])
    assert (rows.price >= np.maximum(sign * (asset - rows.strike * df), 0) - 1e-12).all()
    assert (rows.price < np.where(rows.is_call, asset, rows.strike * df)).all()
    steps = rows.groupby(["id", "strike"]).price.diff().dropna()
    assert len(steps) == 200 * 19 and (steps > -1e-12).all()


def test_greeks_match_finite_differences(book):
    def price(**shift):
        terms = {n: f"{n} + {shift.get(n, 0.0)!r}D" for n in ("spot", "T", "r", "sigma")}
        return black.bs_price(
            terms["spot"], "strike", terms["T"], terms["r"], "q", terms["sigma"], "is_call"
        )

    h = 1e-4
    g = black.bs_greeks("spot", "strike", "T", "r", "q", "sigma", "is_call")
    greeks = black.with_bs_greeks(book, prefix="staged_").select("*", g.alias("g"))
    rows = greeks.select(
        "*", "g.*", price().alias("mid"),
        *[price(**{n: s * h}).alias(f"{n}_{d}") for n in ("spot", "T", "r", "sigma")
          for d, s in (("up", 1), ("down", -1))],
        price(spot=h, sigma=h).alias("uu"), price(spot=h, sigma=-h).alias("ud"),
        price(spot=-h, sigma=h).alias("du"), price(spot=-h, sigma=-h).alias("dd"),
        black.bs_vega("spot", "strike", "T", "r", "q", "sigma").alias("vega_column"),
    ).drop("g").toPandas()
    slope = lambda n: (rows[f"{n}_up"] - rows[f"{n}_down"]) / (2 * h)
    bend = lambda n: (rows[f"{n}_up"] - 2 * rows.mid + rows[f"{n}_down"]) / (h * h)
    close = lambda a, b, tol: ((a - b).abs() / (1 + b.abs())).max() < tol
    assert close(slope("spot"), rows.delta, 1e-6)
    assert close(bend("spot"), rows.gamma, 1e-4)
    assert close(slope("sigma"), rows.vega, 1e-4)
    assert close(-slope("T"), rows.theta, 1e-4)
    assert close(slope("r"), rows.rho, 1e-4)
    assert close(bend("sigma"), rows.volga, 1e-3)
    assert close((rows.uu - rows.ud - rows.du + rows.dd) / (4 * h * h), rows.vanna, 1e-4)
    assert close(rows.vega_column, rows.vega, 1e-12)
    for name in black.GREEKS:
        assert close(rows[f"staged_{name}"], rows[name], 1e-11)


def test_invalid_inputs_give_null_and_never_nan(spark):
    rows = spark.createDataFrame(
        [(0.0, 1.0, 1.0, 0.2), (1.0, 0.0, 1.0, 0.2), (1.0, 1.0, 0.0, 0.2), (1.0, 1.0, 1.0, 0.0),
         (-1.0, 1.0, 1.0, 0.2), (1.0, 1.0, -1.0, 0.2), (1.0, 1.0, 1.0, -0.2),
         (float("nan"), 1.0, 1.0, 0.2), (1.0, 1.0, float("nan"), 0.2), (None, 1.0, 1.0, 0.2)],
        "spot double, strike double, T double, sigma double",
    )
    terms = ("spot", "strike", "T", 0.05, 0.0, "sigma")
    got = black.with_bs_price(rows, "staged", r=0.05, q=0.0, is_call=True).select(
        "staged", black.bs_price(*terms, True).alias("p"), black.d1(*terms).alias("d1"),
        black.bs_vega(*terms).alias("v"),
        black.bs_greeks(*terms, True)["gamma"].alias("g"),
    )
    for row in got.collect():
        assert all(v is None for v in row)
    bad = rows.where("spot is null or spot <= 0 or isnan(spot)")
    assert bad.where(quotes.log_moneyness("strike", "spot").isNotNull()).isEmpty()


def test_dates(spark):
    df = spark.createDataFrame([("2026-05-16", "2027-05-16"), ("2026-05-16", "2026-05-11"),
                                ("2026-05-16", "soon")], "a string, b string")
    got = [r.v for r in df.select(year_frac(parse_date("a"), parse_date("b")).alias("v")).collect()]
    assert got == [365 / 365.25, -5 / 365.25, None]
    days = spark.createDataFrame([(7,), (200,)], "days int")
    assert [r.v for r in days.select(expiry_years("days").alias("v")).collect()] == [
        round(7 / 365, 6), round(200 / 365, 6)]


def test_ssvi_golden_values(spark):
    iv = lambda k, T: value(spark, ssvi.ssvi_iv(k, T, *GOLDEN_SURFACE))
    assert value(spark, ssvi.ssvi_w(0.0, 1.0, *GOLDEN_SURFACE)) == pytest.approx(0.04, abs=1e-15)
    assert iv(-0.5, 1.0) == pytest.approx(0.2249489398, abs=1e-10)
    assert iv(0.5, 1.0) == pytest.approx(0.1908234048, abs=1e-10)
    assert value(spark, ssvi.ssvi_arb_free(-0.3, 0.5, 0.3)) is True
    assert value(spark, ssvi.ssvi_arb_free(-0.7, 8.0, 0.5)) is False
    assert value(spark, ssvi.ssvi_arb_free(0.99, 5.0, 0.5)) is False
    assert value(spark, ssvi.ssvi_arb_free(-0.3, 0.5, 0.6)) is False
    lv = lambda k, T: value(spark, local_vol(k, T, *GOLDEN_SURFACE))
    assert lv(0.0, 1.0) == pytest.approx(0.1986760694, abs=1e-10)
    assert lv(-0.3, 0.5) == pytest.approx(0.2327755975, abs=1e-10)
    assert lv(0.3, 0.5) == pytest.approx(0.1880375570, abs=1e-10)
    assert iv(0.1, 0.0) is None and iv(0.1, -1.0) is None and lv(0.1, 0.0) is None


def test_ssvi_derivatives_match_finite_differences():
    rng = np.random.default_rng(5)
    n, h = 500, 1e-5
    k, T = rng.uniform(-1, 1, n), rng.uniform(0.05, 3, n)
    params = [rng.uniform(*b, n) for b in ((-0.9, 0.9), (0.1, 2.0), (0.05, 0.5), (0.01, 0.5))]
    at = lambda k, T, p: ssvi.smile(k, T, *p, ARRAY)
    s = at(k, T, params)
    up, down = at(k + h, T, params), at(k - h, T, params)
    assert np.allclose(ssvi.slope_in_k(s), (up.w - down.w) / (2 * h), rtol=1e-6, atol=1e-9)
    assert np.allclose(ssvi.curvature_in_k(s), (up.w - 2 * s.w + down.w) / h**2, atol=1e-4)
    up, down = at(k, T + h, params), at(k, T - h, params)
    assert np.allclose(ssvi.slope_in_T(s), (up.w - down.w) / (2 * h), rtol=1e-6, atol=1e-9)
    iv, *slopes = ssvi.vol_jacobian(s, ARRAY)
    for i, slope in enumerate(slopes):
        moved = [[p + (d * h if i == j else 0) for j, p in enumerate(params)] for d in (1, -1)]
        up, down = (ssvi.vol(at(k, T, p), ARRAY) for p in moved)
        assert np.allclose(slope, (up - down) / (2 * h), rtol=1e-5, atol=1e-8)


def test_columns_and_arrays_agree_on_local_vol(spark):
    rng = np.random.default_rng(9)
    rows = [tuple(map(float, r)) for r in np.column_stack(
        [rng.uniform(-1, 1, 300), rng.uniform(0.02, 3, 300), rng.uniform(-0.9, 0.9, 300),
         rng.uniform(0.1, 8, 300), rng.uniform(0.05, 1.4, 300), rng.uniform(0.01, 0.5, 300)])]
    df = spark.createDataFrame(rows, "k double, T double, rho double, eta double, gam double, nu double")
    got = with_local_vol(df).withColumn("inline", local_vol()).toPandas()
    from volspark.functions.local_vol import dupire_terms

    t = dupire_terms(ssvi.smile(*(got[c].to_numpy() for c in ("k", "T", "rho", "eta", "gam", "nu")),
                                ARRAY), ARRAY)
    fine = (t.g > 0) & (t.dw_dT >= 0) & (t.w >= 1e-6)
    assert (got.local_vol.notna().to_numpy() == fine).all() and 0 < fine.sum() < 300
    assert np.allclose(got.local_vol[fine], np.sqrt(t.dw_dT[fine] / t.g[fine]), rtol=1e-12)
    assert np.allclose(got.inline[fine], got.local_vol[fine], rtol=1e-12)
    assert got.reason.isna().to_numpy()[fine].all() and got.reason[~fine].notna().all()


def test_theta_and_phi_columns_equal_the_staged_terms(spark):
    rows = spark.createDataFrame(
        [(0.1, 0.5, -0.3, 0.5, 0.3, 0.04), (0.1, 0.0, -0.3, 0.5, 0.3, 0.04)],
        "k double, T double, rho double, eta double, gam double, nu double")
    inline = rows.select("*", ssvi.ssvi_theta().alias("th"), ssvi.ssvi_phi().alias("ph"))
    for r in ssvi.with_ssvi_terms(inline).collect():
        assert r.th == r.theta and (r.ph is None) == (r.phi is None)
        assert r.ph is None or abs(r.ph - r.phi) < 1e-12
