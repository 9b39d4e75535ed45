"""One job per operator over the full tables; keys match ``oracles.ORACLES``."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoint import scratch_folder
from ..functions import black, local_vol, quotes as quote_columns, ssvi
from ..functions.dates import parse_date, year_frac
from ..functions.normal import norm_cdf, norm_pdf
from ..operators import (
    book, calibrate, chain, curves, dividends, history, implied, snapshot, surfaces,
)
from ..sources import chain as chain_source
from ..sources.folder import write_market
from ..sources.market import CALL_FILE, future_dividends, read_market, read_rates, underlier_in
from ..sources.sink import write_table
from . import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FLAT_TERMS = ("spot", "strike", "T", tables.FLAT_RATE, 0.0)
SPOT_FORM = (*FLAT_TERMS, "sigma_true")
CANDIDATES = [
    (rho, eta, gam, nu)
    for rho in (-0.7, -0.5, -0.3, -0.1)
    for eta in (0.5, 0.9, 3.0)
    for gam in (0.2, 0.3, 0.45)
    for nu in (0.03, 0.05, 0.07, 0.1)
]
K_GRID = [round(-0.4 + 0.1 * i, 1) for i in range(9)]
T_GRID = [0.25, 0.5, 1.0, 2.0]
WIDE_K_GRID = [round(-1.0 + 0.1 * i, 1) for i in range(21)]
WIDE_T_GRID = [0.05, 0.25, 1.0, 2.0]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def r6(c: str | Column, name: str, digits: int = 6) -> Column:
    return F.round(F.expr(c) if isinstance(c, str) else c, digits).alias(name)


# Sources and snapshot preparation


@query
def chain_scan(spark, sf):
    return chain_source.parse_chain(tables.chain_text(spark, sf), F.col("side"), ("underlier",))


@query
def chain_rejects(spark, sf):
    """Lines that the chain reader drops, by cause and side."""
    rejects = chain_source.chain_rejects(tables.chain_text(spark, sf), ("side",))
    return chain_source.reject_report(rejects, ("side",))


def _written_market(spark, sf) -> str:
    """The path of a market folder with the chain, spots, curve and dividends of all suppliers."""
    folder = scratch_folder(spark, "market")
    curve = tables.rates(spark, sf).where("curve_id = 0").select("tenor", "rate")
    write_market(
        folder, tables.folder_quotes(spark, sf), tables.folder_spots(spark, sf), curve,
        tables.folder_dividends(spark, sf),
    )
    return folder


@query
def market_folder(spark, sf):
    """A market folder written and read back: its quotes, enriched."""
    market = read_market(spark, _written_market(spark, sf), tables.ASOF)
    return snapshot.enrich_quotes(*market).select(
        "underlier", "is_call", "strike", r6("T", "T", 8), "exercise", "bid", "ask", "volume",
        "open_interest", "spot", r6("pv_div", "pv_div"), r6("forward", "forward", 5), "status",
    )


@query
def first_calls_in_file(spark, sf):
    """The first five good calls of every underlier, in the order of the lines of its chain file."""
    path = f"{_written_market(spark, sf)}/*{CALL_FILE}"
    calls = chain_source.read_chain(spark, path, True, ("underlier", "position"))
    calls = calls.withColumn("underlier", underlier_in("position.file", CALL_FILE))
    first = chain.first_n(calls, 5, ("position",), ("underlier",))
    return first.select("underlier", "rank", "strike", r6("T", "T", 8), "exercise", "bid", "ask", "volume", "open_interest")


@query
def spot_latest(spark, sf):
    history = tables.load(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("underlier"),
        F.to_date("l_shipdate").alias("asof"),
        F.col("l_extendedprice").alias("spot"),
    )
    return snapshot.latest_spot(history)


@query
def curve_validate(spark, sf):
    nodes = (
        tables.load(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("curve_id"), F.col("l_linenumber").alias("seq"))
        .agg(F.max("l_quantity").alias("tenor"))
        .withColumn("tenor", F.expr("case when seq <> 2 or curve_id % 4 <> 0 then tenor end"))
    )
    return curves.validate_curve(nodes)


@query
def curve_file_validate(spark, sf):
    """Curves written to a file each, in the order of their nodes, and checked as they are read."""
    folder = scratch_folder(spark, "curves")
    nodes = tables.curve_nodes(spark, sf).repartition("curve_id").sortWithinPartitions("curve_id", "seq")
    nodes.drop("seq").write.partitionBy("curve_id").option("header", True).csv(folder)
    rates = read_rates(spark, f"{folder}", ("curve_id",))
    return curves.validate_curve(rates).select(F.col("curve_id").cast("int").alias("curve_id"), "violations", "rows")


@query
def dividends_future(spark, sf):
    future = future_dividends(tables.paid_dividends(spark, sf), tables.ASOF)
    return future.select("underlier", "pay_date", r6("T", "T"), "alpha", "beta")


def _market(spark, sf):
    future = future_dividends(tables.paid_dividends(spark, sf), tables.ASOF)
    return tables.spots(spark, sf), tables.rates(spark, sf), tables.with_curve(future)


def _enriched(spark, sf):
    rows = tables.with_curve(tables.priced_quotes(spark, sf, dealt=True)).drop("spot", "k")
    return snapshot.enrich_quotes(rows, *_market(spark, sf))


@query
def quotes_enriched(spark, sf):
    """With underliers that have no spot, and curves that are missing."""
    spots, rates, paid = _market(spark, sf)
    market = spots.where("underlier % 17 <> 0"), rates.where("curve_id % 11 <> 3"), paid
    rows = tables.with_curve(tables.priced_quotes(spark, sf)).drop("spot", "k")
    return snapshot.enrich_quotes(rows, *market).select(
        "quote_id", "status", "spot", r6("r", "r"), r6("df", "df"), r6("pv_div", "pv_div", 5),
        r6("forward", "forward", 5), r6("mid", "mid", 5), r6("k", "k"),
    )


@query
def quotes_enriched_dates(spark, sf):
    """Quotes of many dates, each with the last spot and curve up to its day and later payments."""
    histories = (source(spark, sf) for source in (tables.spot_history, tables.curve_history, tables.payment_history))
    return history.enrich_dates(tables.dated_quotes(spark, sf), *histories).select(
        "quote_id", "status", "spot", "spot_asof", "curve_asof", r6("r", "r", 8), r6("pv_div", "pv_div", 5),
        r6("forward", "forward", 4), r6("k", "k"),
    )


@query
def chain_normalise(spark, sf):
    raw = tables.chain(spark, sf).select(
        "quote_id",
        F.date_add(tables.asof(), F.col("days") * 2 - 30).alias("expiration"),
        F.when(F.col("is_call"), "call").otherwise("put").alias("type"),
        "strike",
        F.when(F.col("qty") % 9 == 0, 0.05).otherwise(F.col("qty") / 8.0).alias("bid"),
        (F.col("qty") / 4.0).alias("ask"),
        F.when(F.col("qty") % 10 != 0, F.col("volume") - 5).alias("volume"),
        F.col("open_interest").alias("openInterest"),
    )
    return chain.normalise_chain(raw, tables.asof(), ("quote_id",)).withColumn(
        "strike", r6("strike", "strike", 5)
    )


@query
def chain_union(spark, sf):
    rows = tables.quotes(spark, sf)
    calls = rows.where("is_call").select("quote_id", "underlier", "volume")
    puts = rows.where("not is_call").select("underlier", "quote_id", "open_interest")
    return chain.union_chains(calls, puts)


@query
def dividend_lookback(spark, sf):
    paid = tables.paid_dividends(spark, sf).withColumn(
        "pay_date", F.col("pay_date").cast("timestamp")
    )
    return dividends.dividend_lookback(paid, F.to_date(F.lit("1996-12-01")))


@query
def curve_snapshot(spark, sf):
    snap = curves.curve_snapshot(tables.rate_history(spark, sf), tables.HISTORY_TENORS)
    return snap.select("curve_id", "asof", r6("tenor", "tenor"), "rate")


# Scalar columns


@query
def year_fraction(spark, sf):
    text = F.date_format("l_shipdate", "yyyy-MM-dd")
    pivot = F.to_date(F.lit("1998-06-15"))
    return tables.load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        r6(year_frac(pivot, parse_date(text)), "years"),
        r6(year_frac(pivot, "l_shipdate", 365.0), "years_365"),
    )


@query
def quote_mid(spark, sf):
    return tables.priced_quotes(spark, sf).select(
        "quote_id", r6("bid", "bid", 5), r6("ask", "ask", 5), r6(quote_columns.mid(), "mid", 5)
    )


@query
def log_moneyness(spark, sf):
    strike = "case when qty <> 50 then strike else 0e0 end"
    return tables.chain(spark, sf).select(
        "quote_id", r6(quote_columns.log_moneyness(strike, "spot * exp(T * 3e-2)"), "k")
    )


@query
def normal_cdf(spark, sf):
    x = "(l_quantity - 25.5e0) / 3e0 + l_discount"
    return tables.load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r6(norm_cdf(x), "cdf", 9), r6(norm_pdf(x), "pdf", 9)
    )


@query
def bs_d1_d2(spark, sf):
    return tables.chain(spark, sf).select(
        "quote_id", r6(black.d1(*SPOT_FORM), "d1"), r6(black.d2(*SPOT_FORM), "d2")
    )


@query
def bs_price(spark, sf):
    return tables.with_flat_price(tables.chain(spark, sf)).select(
        "quote_id", r6("price", "price", 5)
    )


@query
def bs_price_column(spark, sf):
    """The same price as one inline Column."""
    return tables.chain(spark, sf).select(
        "quote_id", r6(black.bs_price(*SPOT_FORM, "is_call"), "price", 5)
    )


def _with_forward(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", "exp(T * -3e-2) as df", "spot * exp(T * 1e-2) as forward")


@query
def black_price(spark, sf):
    rows = _with_forward(tables.chain(spark, sf))
    priced = black.with_black_price(rows, "price", sigma="sigma_true")
    return priced.select("quote_id", r6("price", "price", 5))


@query
def black_vega(spark, sf):
    return _with_forward(tables.chain(spark, sf)).select(
        "quote_id",
        r6(black.black_vega("forward", "strike", "T", "df", "sigma_true"), "vega", 5),
        r6(black.bs_vega(*SPOT_FORM), "spot_vega", 5),
    )


@query
def bs_greeks(spark, sf):
    rows = tables.chain(spark, sf).drop("rho")
    rows = black.with_bs_greeks(rows, r=0.03, q=0.01, sigma="sigma_true")
    return rows.select("quote_id", *[r6(g, g, 5) for g in black.GREEKS])


@query
def ssvi_iv(spark, sf):
    rows = tables.with_surface(tables.quotes(spark, sf))
    return ssvi.with_ssvi_terms(rows).select(
        "quote_id", r6("theta", "theta"), r6("phi", "phi"), r6("w", "w", 8), r6("iv", "iv", 8)
    )


@query
def ssvi_derivs(spark, sf):
    rows = tables.with_surface(tables.quotes(spark, sf))
    return ssvi.with_ssvi_terms(rows).select(
        "quote_id", *[r6(n, n) for n in ("w", "dw_dk", "d2w_dk2", "dw_dt")]
    )


def _surfaces(spark, sf):
    """A surface per underlier; every fourth is stretched until it admits arbitrage."""
    return _stretched(
        tables.with_surface(tables.spots(spark, sf).select("underlier"))
    ).withColumnRenamed("underlier", "surface_id")


def _stretched(df: DataFrame) -> DataFrame:
    return df.withColumn("eta", F.expr("case when underlier % 4 = 0 then eta * 9e0 else eta end"))


@query
def ssvi_arb_free(spark, sf):
    return _surfaces(spark, sf).select("surface_id", ssvi.ssvi_arb_free().alias("arb_free"))


@query
def dupire_local_vol(spark, sf):
    rows = _stretched(tables.with_surface(tables.quotes(spark, sf)))
    return local_vol.with_local_vol(rows).select(
        "quote_id", r6("local_vol", "local_vol"), "reason"
    )


# Filters, limits, counts


@query
def two_sided(spark, sf):
    rows = tables.quotes(spark, sf).selectExpr(
        "quote_id",
        "case when qty % 10 = 0 then 0e0 when qty % 10 = 1 then double('nan') else qty / 8e0 end "
        "as bid",
        "case when qty % 7 = 0 then -1e0 else qty / 4e0 end as ask",
    )
    return chain.two_sided(rows)


@query
def exercise_split(spark, sf):
    rows = tables.quotes(spark, sf).withColumn(
        "exercise", F.expr("case when days % 2 = 0 then initcap(exercise) else exercise end")
    )
    american = chain.americans(rows).selectExpr("quote_id", "'a' as style")
    return american.unionByName(chain.europeans(rows).selectExpr("quote_id", "'e' as style"))


@query
def top_calls(spark, sf):
    calls = tables.quotes(spark, sf).where("is_call")
    best = chain.first_n(calls, 5, ("days", "qty"), ("underlier",))
    return best.select("underlier", "rank", "quote_id")


@query
def first_calls(spark, sf):
    calls = tables.quotes(spark, sf).where("is_call")
    return chain.first_n(calls, 5, ("underlier", "days", "qty")).select(
        "quote_id", "underlier", "days", "qty"
    )


@query
def chain_summary(spark, sf):
    return chain.chain_summary(tables.quotes(spark, sf))


@query
def future_dividend_counts(spark, sf):
    future = future_dividends(tables.paid_dividends(spark, sf), tables.ASOF)
    return future.groupBy("underlier").agg(F.count("*").alias("dividends"))


# Curve and dividend lookups


def _long_dated(spark, sf):
    """Quotes with maturities from days to decades, many of them on a curve node."""
    T = (
        "case days % 10 when 0 then 25e-2 when 1 then 31e0 else days * days / 3650e0 end"
    )
    return tables.with_curve(tables.quotes(spark, sf)).withColumn("T", F.expr(T))


@query
def zero_rate(spark, sf):
    segments = curves.curve_segments(tables.rates(spark, sf))
    return curves.zero_rate(_long_dated(spark, sf), segments).select("quote_id", r6("rate", "rate", 8))


@query
def discount_factor(spark, sf):
    segments = curves.curve_segments(tables.rates(spark, sf))
    found = curves.zero_rate(_long_dated(spark, sf), segments)
    return found.select("quote_id", r6(curves.discount_factor("rate", "T"), "df", 8))


@query
def forward_rate(spark, sf):
    segments = curves.curve_segments(tables.rates(spark, sf))
    points = tables.with_curve(tables.quotes(spark, sf))
    found = curves.forward_rate(
        points, segments, "days / 365e0", "days / 365e0 + (qty - 1) / 1e1"
    )
    return found.select("quote_id", r6("forward_rate", "forward_rate", 7))


@query
def pv_dividends(spark, sf):
    _, rates, future = _market(spark, sf)
    segments = curves.curve_segments(rates)
    points = tables.quotes(spark, sf).select("underlier", "T").distinct()
    found = dividends.pv_dividends(points, future, segments, start=0.125)
    return found.select("underlier", r6("T", "T", 8), r6("pv_div", "pv_div"))


@query
def forward_price(spark, sf):
    points = tables.with_curve(tables.quotes(spark, sf))
    found = snapshot.expiry_forwards(points, *_market(spark, sf))
    return found.select(
        "underlier", r6("T", "T", 8), r6("df", "df", 8), r6("forward", "forward", 5)
    )


@query
def dividends_in_interval(spark, sf):
    _, _, future = _market(spark, sf)
    start = F.col("underlier") % 3 * 0.25
    inside = dividends.dividends_in_interval(future, start, start + 0.5)
    return inside.select("underlier", "pay_date", "alpha", "beta")


# Call/put parity


def _both_sides(spark, sf):
    """A call and a put at every strike, with mids that deviate from parity by half a spread."""
    rows = _with_forward(tables.chain(spark, sf, dealt=True).drop("is_call"))
    rows = rows.selectExpr("*", "explode(array(true, false)) as is_call")
    rows = black.with_black_price(rows, "fair", sigma="sigma_true")
    return rows.withColumn(
        "price", F.expr("fair + case when is_call then spread_frac else -spread_frac end")
    )


def _parity(spark, sf):
    return chain.parity_by_strike(
        _both_sides(spark, sf), ("underlier",), F.col("price"), ("qty", "days"),
        ("forward", "df", "strike"),
    )


@query
def parity_by_strike(spark, sf):
    return _parity(spark, sf).select(
        "underlier", "qty", "days", "pairs", r6("residual_lo", "residual_lo"),
        r6("residual_hi", "residual_hi"), r6("worst", "worst"),
    )


@query
def parity_residual(spark, sf):
    report = chain.parity_report(_parity(spark, sf))
    return report.select(
        "underlier", "strikes", "pairs", r6("max_residual", "max_residual")
    )


@query
def parity_column(spark, sf):
    rows = tables.with_flat_price(tables.chain(spark, sf), "call", is_call=True)
    rows = tables.with_flat_price(rows, "put", is_call=False)
    residual = black.parity_residual("call", "put", *FLAT_TERMS)
    return rows.select("quote_id", (F.abs(residual) < 1e-9).alias("holds"))


# Grids


@query
def ssvi_grid(spark, sf):
    rows = surfaces.iv_grid(_surfaces(spark, sf), T_GRID, K_GRID)
    return rows.select("surface_id", "T", "k", r6("iv", "iv", 8))


@query
def local_vol_grid(spark, sf):
    rows = surfaces.local_vol_grid(_surfaces(spark, sf), T_GRID, K_GRID)
    return rows.select("surface_id", "T", "k", r6("local_vol", "local_vol"), "reason")


@query
def surface_arbitrage(spark, sf):
    grid = surfaces.local_vol_grid(_surfaces(spark, sf), WIDE_T_GRID, WIDE_K_GRID)
    return surfaces.arbitrage_report(grid)


@query
def spot_ladder(spark, sf):
    rows = book.spot_ladder(tables.contracts(spark, sf), -0.5, 0.5, 8)
    return black.with_bs_price(rows, "price", S="scenario_spot").select(
        "contract_id", "step", r6("scenario_spot", "scenario_spot", 5), r6("price", "price", 5)
    )


# Calibration


def _surface_quotes(spark, sf):
    rows = ssvi.with_ssvi_iv(tables.with_surface(tables.quotes(spark, sf)))
    return rows.selectExpr(
        "underlier as surface_id", "T", "k", "iv", "1e0 / (spread_frac + 1e-2) as weight"
    )


@query
def ssvi_sse(spark, sf):
    sets = _surfaces(spark, sf).selectExpr("*", "explode(sequence(0, 2)) as param_id")
    sets = sets.withColumn("nu", F.expr("nu + param_id * 1e-2"))
    scored = surfaces.ssvi_sse(_surface_quotes(spark, sf), sets)
    return scored.select("surface_id", "param_id", r6("sse", "sse", 8))


@query
def ssvi_sse_weighted(spark, sf):
    sets = _surfaces(spark, sf).selectExpr("* except (nu)", "nu + 2e-2 as nu", "0 as param_id")
    scored = surfaces.ssvi_sse(_surface_quotes(spark, sf), sets, weight="weight")
    return scored.select("surface_id", "param_id", r6("sse", "sse"))


@query
def ssvi_grid_fit(spark, sf):
    best = surfaces.best_candidate(_surface_quotes(spark, sf), CANDIDATES)
    return best.select("surface_id", "rho", "eta", "gam", "nu", r6("sse", "sse", 8), "param_id")


def _fitted(frame: DataFrame) -> DataFrame:
    return frame.select("surface_id", *[r6(p, p, 4) for p in ssvi.PARAMS], "status")


@query
def ssvi_calibrate(spark, sf):
    return _fitted(calibrate.calibrate_ssvi(_surface_quotes(spark, sf)))


@query
def ssvi_calibrate_distributed(spark, sf):
    """The same fit with every surface treated as too large for one task."""
    return _fitted(calibrate.calibrate_ssvi(_surface_quotes(spark, sf), weight="weight", max_rows=0))


MANY = 10  # quotes near the money that pin down a surface
BOUND_CANDIDATES = [
    (rho, round(4.0 / (1.0 + abs(rho)) - 1e-6, 6), gam, nu)
    for rho in (-0.8, -0.6, -0.4, -0.2, 0.0)
    for gam in (0.2, 0.3, 0.4, 0.5)
    for nu in (0.03, 0.05, 0.08, 0.12)
]


@query
def ssvi_calibrate_bound(spark, sf):
    """Quotes of surfaces beyond the wing limit: no candidate on the limit may fit better."""
    rows = tables.with_surface(tables.quotes(spark, sf)).withColumn("eta", F.col("eta") * 6)
    quotes = ssvi.with_ssvi_iv(rows).selectExpr("underlier as surface_id", "T", "k", "iv")
    best = surfaces.best_candidate(quotes, BOUND_CANDIDATES).select("surface_id", "sse")
    fit = calibrate.calibrate_ssvi(quotes).withColumnRenamed("sse", "fitted")
    return best.join(fit, "surface_id").select(
        "surface_id", "status", r6("sse", "best_candidate", 7),
        F.expr("fitted <= sse * (1 + 1e-9) + 1e-12").alias("as_good"),
        F.expr("eta * (1 + abs(rho)) <= 4").alias("within_limit"),
    )


# Implied vol


@query
def implied_vol(spark, sf):
    """Inversion of the whole chain, with some prices out of bounds and some not positive."""
    rows = tables.with_flat_price(tables.chain(spark, sf), "fair").selectExpr(
        "*", "case qty when 50 then spot * 3e0 when 49 then -1e0 else fair end as price"
    )
    rows = rows.withColumn("iv", implied.implied_vol("price", *FLAT_TERMS, "is_call"))
    rows = black.with_bs_price(rows, "again", r=tables.FLAT_RATE, q=0.0, sigma="iv.sigma")
    return rows.select(
        "quote_id", "iv.status",
        r6(F.when(tables.is_liquid(), F.col("iv.sigma")), "sigma"),
        F.expr("abs(again - price) < 1e-7 as reprices"),
    )


@query
def implied_vol_fwd(spark, sf):
    rows = black.with_black_price(_enriched(spark, sf), "theory", sigma="sigma_true")
    solved = implied.with_implied_vol(rows, "theory")
    solved = black.with_black_price(solved, "again", sigma="sigma")
    return solved.select(
        "quote_id", "status", r6(F.when(tables.is_liquid(), F.col("sigma")), "sigma"),
        F.expr("abs(again - theory) < 1e-7 as reprices"),
    )


def _chain_surfaces(spark, sf):
    """Vols of all chain prices, and a row per underlier: the fit to all of its invertible quotes."""
    rows = ssvi.with_ssvi_iv(_enriched(spark, sf), "model_iv")
    priced = black.with_black_price(rows, "theory", sigma="model_iv")
    vols = implied.with_implied_vol(priced, "theory").withColumn("weight", implied.price_weight())
    folder = scratch_folder(spark, "vols")
    write_table(
        vols.selectExpr("underlier as surface_id", "T", "k", "model_iv", "status", "sigma as iv", "weight"), folder
    )
    vols = spark.read.parquet(folder)
    fitted = calibrate.calibrate_ssvi(vols.where("status = 'ok'"), weight="weight", stored=True)
    fitted = vols.select("surface_id").distinct().join(fitted, "surface_id", "left")
    return vols, fitted.fillna("invalid_input", ["status"])


CHAIN_GRID = [0.25, 0.5, 1.0], [-0.1, 0.0, 0.1]


@query
def chain_to_local_vol(spark, sf):
    """From chain prices to local vols: implied vols, surfaces fitted to them, and their grids.

    All quotes count in the fits. Shown are, as in the SQL, underliers with at least ``MANY`` quotes
    near the money; ``chain_to_local_vol_all`` shows every one.
    """
    vols, fitted = _chain_surfaces(spark, sf)
    near = vols.where("abs(k) <= 1e0 * model_iv * sqrt(T)").groupBy("surface_id").count()
    many = near.where(F.col("count") >= MANY)
    grid = surfaces.local_vol_grid(fitted.join(many, "surface_id", "left_semi"), *CHAIN_GRID)
    return grid.select("surface_id", "T", "k", r6("local_vol", "local_vol", 3), "reason")


@query
def chain_to_local_vol_all(spark, sf):
    """The same for every underlier of the chain, with the status of its fit."""
    _, fitted = _chain_surfaces(spark, sf)
    grid = surfaces.local_vol_grid(fitted, *CHAIN_GRID)
    return grid.select("surface_id", "status", "T", "k", r6("local_vol", "local_vol", 3), "reason")


@query
def call_vol_report(spark, sf):
    """Mid, moneyness and vol of the first five calls of every underlier, by the plain iteration."""
    rows = black.with_black_price(_enriched(spark, sf).drop("mid"), "mid", sigma="sigma_true")
    first = chain.first_n(rows.where("is_call"), 5, ("days", "qty"), ("underlier",))
    solved = implied.with_implied_vol(first, method="newton")
    solved = black.with_black_price(solved, "again", sigma="sigma")
    return solved.select(
        "underlier", "rank", r6("strike", "strike", 5), r6("T", "T"), r6("mid", "mid", 5),
        r6("k", "k"), r6(F.when(tables.is_liquid(0.5), F.col("sigma")), "sigma", 5),
        F.expr("status <> 'ok' or abs(again - mid) < 1e-7 as reprices"),
    )


@query
def implied_vol_newton(spark, sf):
    """The plain iteration."""
    rows = tables.with_flat_price(tables.chain(spark, sf))
    inverted = implied.implied_vol(
        "price", *FLAT_TERMS, "is_call", method="newton", lo=0.01, hi=2.0, tol=1e-8, max_iter=200
    )
    rows = black.with_bs_price(
        rows.withColumn("iv", inverted), "again", r=tables.FLAT_RATE, q=0.0, sigma="iv.sigma"
    )
    return rows.select(
        "quote_id",
        "iv.status",
        r6(F.when(tables.is_liquid(), F.col("iv.sigma")), "sigma", 5),
        F.expr("coalesce(abs(again - price) < 1e-7, true) as reprices"),
    )
