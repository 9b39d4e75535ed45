"""Sources, sink, curves, dividends and snapshots."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from volspark.functions.backend import ARRAY
from volspark.functions.black import undiscounted
from volspark.operators import curves, dividends, snapshot
from volspark.operators.implied import with_implied_vol
from volspark.operators.ordered import time_bucket, with_neighbours
from volspark.sources.chain import CHAIN_COLUMNS, read_chain
from volspark.sources.market import (
    future_dividends, read_dividends, read_market, read_rates, read_spots,
)
from volspark.sources.sink import write_table

GOOD = "2026-06-19,0.09315,34,call,american,300,5.1,5.3,5.2,12.0,7,0.2"

# The zero curve of the sample day.
SAMPLE_CURVE = (
    (1.0 / 12.0, 0.0372), (0.25, 0.0369), (0.5, 0.0376), (1.0, 0.0379),
    (2.0, 0.04), (5.0, 0.0413), (10.0, 0.0447), (30.0, 0.0502),
)


def chain_file(folder, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "calls.csv").write_text("\n".join([",".join(CHAIN_COLUMNS), *lines]) + "\n")
    return str(folder)


def test_read_chain_keeps_good_lines_only(spark, tmp_path):
    path = chain_file(tmp_path / "c", [
        GOOD,
        GOOD.replace("american", "American").replace(",300,", ",301,"),
        GOOD.replace("american", "european").replace(",300,", ",302,"),
        GOOD.replace(",12.0,", ",,"),  # blank volume
        GOOD.replace(",300,", ",n/a,"),  # strike is not a number
        GOOD.replace(",5.1,", ",nan,"),
        GOOD.replace(",5.1,", ",0,"),
        GOOD.replace(",5.3,", ",-1,"),
        GOOD.replace(",12.0,", ",12abc,"),
        GOOD.replace(",300,", ",303,").rsplit(",", 1)[0],  # last column missing, never read
        "",
    ])
    rows = read_chain(spark, path, True).orderBy("strike").collect()
    assert [r.strike for r in rows] == [300.0, 301.0, 302.0, 303.0]
    assert [r.exercise for r in rows] == ["american", "american", "european", "american"]
    assert rows[0].asDict() == {
        "strike": 300.0, "T": 0.09315, "is_call": True, "exercise": "american", "bid": 5.1,
        "ask": 5.3, "volume": 12, "open_interest": 7}


def test_partition_directories_become_columns(spark, tmp_path):
    chain_file(tmp_path / "underlier=abc", [GOOD])
    chain_file(tmp_path / "underlier=xyz", [GOOD, GOOD])
    rows = read_chain(spark, str(tmp_path), False, keep=("underlier",))
    assert {(r.underlier, r["count"]) for r in rows.groupBy("underlier").count().collect()} == {
        ("abc", 1), ("xyz", 2)}
    assert not rows.first().is_call


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """The reference market of 2026-05-16: spot, treasury curve and paid dividends."""
    folder = tmp_path_factory.mktemp("market")
    (folder / "spot.csv").write_text("date,spot\n2026-05-16,300.23\n")
    lines = "".join(f"{t!r},{r:.6f}\n" for t, r in SAMPLE_CURVE)
    (folder / "rates.csv").write_text("tenor,rate\n" + lines)
    (folder / "dividends.csv").write_text(
        "Date,amount\n2024-08-12,0.25\n2025-11-10,0.26\n2026-05-11,0.27\n"
        "2026-08-10 00:00:00-04:00,0.5\n")
    return folder


def test_market_of_the_sample_day(spark, files):
    spot = read_spots(spark, str(files / "spot.csv"))
    assert spot.collect() == [(dt.date(2026, 5, 16), 300.23)]
    rates = read_rates(spark, str(files / "rates.csv")).withColumn("curve_id", F.lit("usd"))
    paid = read_dividends(spark, str(files / "dividends.csv"), "2026-05-16")
    assert [(r.pay_date, r.alpha, r.beta) for r in paid.collect()] == [
        (dt.date(2026, 8, 10), 0.5, 0.0)]
    quotes = spark.createDataFrame([("a", "usd", t) for t in (0.25, 0.5, 1.0)],
                                   "underlier string, curve_id string, T double")
    spots = spot.withColumn("underlier", F.lit("a"))
    none = paid.limit(0).selectExpr("'a' as underlier", "'usd' as curve_id", "T", "alpha", "beta")
    rows = snapshot.expiry_forwards(quotes, spots, rates, none).orderBy("T").collect()
    assert rows[1].r == pytest.approx(0.0376, abs=1e-15)
    assert rows[2].df == pytest.approx(0.9628092170, abs=1e-10)
    assert [r.forward for r in rows] == pytest.approx(
        [303.0124360, 305.9277147, 311.8270938], abs=1e-7)


def test_market_folder_to_implied_vols(spark, files, tmp_path):
    """A folder of two underliers, from files to vols; quotes are made from a known vol."""
    rate, T, sigma = 0.0376, 0.5, 0.25
    header = ",".join(CHAIN_COLUMNS) + "\n"
    for name, spot in (("abc", 300.23), ("xyz", 50.0)):
        (tmp_path / f"{name}_spot.csv").write_text(f"date,spot\n2026-05-15,7.0\n2026-05-16,{spot}\n2026-05-17,9.0\n")
        (tmp_path / f"{name}_dividends.csv").write_text("Date,amount\n2026-05-11,0.27\n2027-05-11,9.0\n")
        forward, df = spot * np.exp(rate * T), np.exp(-rate * T)
        for kind, sign in (("calls", 1.0), ("puts", -1.0)):
            lines = []
            for strike in (0.9 * spot, spot, 1.1 * spot):
                sd = sigma * np.sqrt(T)
                p = float(df * undiscounted(forward, strike, sd, sign, ARRAY))
                lines.append(f"2026-11-14,{T},182,{kind[:-1]},american,{strike!r},{p!r},{p!r},{p!r},10,20,0.2\n")
            (tmp_path / f"{name}_{kind}.csv").write_text(header + "".join(lines))
    (tmp_path / "treasury_rates.csv").write_text((files / "rates.csv").read_text())
    market = read_market(spark, str(tmp_path), "2026-05-16")
    rows = with_implied_vol(snapshot.enrich_quotes(*market)).toPandas()
    assert len(rows) == 12 and set(rows.underlier) == {"abc", "xyz"}
    assert rows.is_call.sum() == 6 and (rows.exercise == "american").all()
    assert np.abs(rows.sigma - sigma).max() < 1e-9
    assert np.allclose(rows.k, np.log(rows.strike / rows.forward))
    assert (rows.pv_div == 0).all()  # one payment is past, the other after expiry


def test_quotes_without_spot_curve_or_maturity_stay(spark):
    quotes = spark.createDataFrame(
        [("a", "usd", 0.5, 100.0), ("b", "usd", 0.5, 100.0), ("a", "eur", 0.5, 100.0), ("a", "usd", None, 100.0)],
        "underlier string, curve_id string, T double, strike double",
    ).selectExpr("*", "1D as bid", "2D as ask")
    spots = spark.createDataFrame([("a", 100.0)], "underlier string, spot double")
    none = spark.createDataFrame([], "underlier string, curve_id string, T double, alpha double, beta double")
    rates = curve(spark, SAMPLE_CURVE).withColumn("curve_id", F.lit("usd"))
    got = sorted((r.underlier, r.curve_id, r.status, r.k is None)
                 for r in snapshot.enrich_quotes(quotes, spots, rates, none).collect())
    assert got == [("a", "eur", "no_curve", True), ("a", "usd", "no_maturity", True),
                   ("a", "usd", "ok", False), ("b", "usd", "no_spot", True)]


def test_null_tenors_are_violations(spark):
    rows = [("good", 0, 0.25), ("good", 1, 0.5), ("null", 0, 0.5), ("null", 1, None), ("null", 2, 0.25), ("one", 0, None)]
    nodes = spark.createDataFrame(rows, "curve_id string, seq int, tenor double")
    sound, report = curves.sound_curves(nodes)
    assert {r.curve_id: (r.violations, r.rows) for r in report.collect()} == {"null": (2, 3), "one": (1, 1)}
    assert {r.curve_id for r in sound.collect()} == {"good"}


def test_write_table_round_trip(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id % 3 as int) as part", "id / 7e0 as x")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        write_table(df, path, fmt, partition_by=("part",))
        back = spark.read.schema("id long, x double, part int").option("header", True)
        back = back.format(fmt).load(path).select("id", "part", "x")
        assert sorted(back.collect()) == sorted(df.collect())
    plain = str(tmp_path / "plain")
    write_table(df, plain)
    assert spark.read.parquet(plain).count() == 100
    with pytest.raises(ValueError):
        write_table(df, plain, "orc")


def curve(spark, nodes, curve_id="c"):
    return spark.createDataFrame(
        [(curve_id, i, float(t), float(r)) for i, (t, r) in enumerate(nodes)],
        "curve_id string, seq int, tenor double, rate double")


def lookup(spark, nodes, at):
    points = spark.createDataFrame([("c", float(t)) for t in at], "curve_id string, T double")
    segments = curves.curve_segments(curve(spark, nodes))
    rows = curves.zero_rate(points, segments).collect()
    assert len(rows) == len(at)
    return {r.T: r.rate for r in rows}


def test_zero_rate_edges(spark):
    at = [-1.0, 0.0, 0.01, 1 / 12, 0.1, 0.25, 0.3, 0.5, 30.0, 31.0, 500.0]
    got = lookup(spark, SAMPLE_CURVE, at)
    t, r = zip(*SAMPLE_CURVE)
    for point in at:
        assert got[point] == pytest.approx(np.interp(point, t, r), abs=1e-15)


@pytest.mark.parametrize("count", [1, 2, 5000])
def test_zero_rate_matches_interpolation_for_any_curve(spark, count):
    """A curve with thousands of nodes stands for a hot key: its segments spread over buckets."""
    rng = np.random.default_rng(count)
    t = np.unique(rng.uniform(0.001, 60, count))
    r = rng.uniform(-0.01, 0.1, t.size)
    at = np.unique(np.concatenate([rng.uniform(-1, 120, 300), t[:50]]))
    got = lookup(spark, list(zip(t, r)), at)
    assert np.allclose([got[x] for x in at], np.interp(at, t, r), atol=1e-12)


def test_forward_rate(spark):
    segments = curves.curve_segments(curve(spark, SAMPLE_CURVE))
    points = spark.createDataFrame([("c", 0.5, 2.0), ("c", 1.0, 1.0)],
                                   "curve_id string, T1 double, T2 double")
    rows = {r.T1: r.forward_rate for r in curves.forward_rate(points, segments).collect()}
    assert rows[0.5] == pytest.approx((0.04 * 2 - 0.0376 * 0.5) / 1.5, abs=1e-15)
    assert rows[1.0] is None


def test_validate_curve(spark):
    good = curve(spark, [(t, 0.0) for t in (0.1, 0.2, 0.3)], "good")
    flat = curve(spark, [(t, 0.0) for t in (0.1, 0.2, 0.2)], "flat")
    down = curve(spark, [(t, 0.0) for t in (0.3, 0.2, 0.1)], "down")
    long = curve(spark, [(t / 10, 0.0) for t in range(1, 9001)], "long")
    broken = curve(spark, [(t / 10, 0.0) for t in range(1, 9001)], "broken").withColumn(
        "tenor", F.when(F.col("seq") == 4096, 1.0).otherwise(F.col("tenor")))
    rates = good.union(flat).union(down).union(long).union(broken)
    got = {r.curve_id: (r.violations, r.rows) for r in curves.validate_curve(rates).collect()}
    assert got == {"flat": (1, 3), "down": (2, 3), "broken": (1, 9000)}


def test_neighbours_match_plain_windows(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", float(t), float(v)) for t, v in zip(
        rng.permutation(4000) / 400, rng.uniform(-1, 1, 4000))] + [("one", 0.5, 2.0)]
    df = spark.createDataFrame(rows, "key string, T double, v double")
    got = with_neighbours(df, ["key"], "T", time_bucket("T"), "v", ("T", "v"), "v").toPandas()
    assert len(got) == 4001
    got = got[got.key == "hot"].sort_values("T").reset_index(drop=True)
    assert np.allclose(got.running, got.v.cumsum())
    assert np.allclose(got.previous[1:], got.v[:-1]) and np.isnan(got.previous[0])
    assert [n.T for n in got.next[:-1]] == list(got["T"][1:]) and got.next.iloc[-1] is None


def test_dividend_values_and_intervals(spark):
    paid = spark.createDataFrame([("a", "c", 0.25, 2.0, 0.0), ("a", "c", 0.75, 1.0, 0.02)],
                                 "underlier string, curve_id string, T double, alpha double, beta double")
    segments = curves.curve_segments(curve(spark, [(0.0, 0.05), (5.0, 0.05)]))
    at = (0.1, 0.25, 0.5, 0.75, 1.0, 40.0)
    points = spark.createDataFrame([("a", t) for t in at] + [("none", 1.0)],
                                   "underlier string, T double")
    rows = dividends.pv_dividends(points, paid, segments).collect()
    got = {(r.underlier, r.T): r.pv_div for r in rows}
    first, both = 2 * np.exp(-0.0125), 2.9383500187
    assert [got["a", t] for t in at] == pytest.approx([0, first, first, both, both, both], abs=1e-10)
    assert got["none", 1.0] == 0.0
    later = dividends.pv_dividends(points, paid, segments, start=0.25).collect()
    assert {r.T: r.pv_div for r in later if r.underlier == "a"}[1.0] == pytest.approx(
        both - first, abs=1e-10)
    count = lambda a, b: dividends.dividends_in_interval(paid, a, b).count()
    assert (count(0, 0.5), count(0, 1), count(0.5, 1), count(0.25, 0.75)) == (1, 2, 1, 1)


def test_dividends_of_a_hot_underlier_match_brute_force(spark):
    rng = np.random.default_rng(2)
    T = np.round(rng.uniform(0.01, 10, 3000), 2)  # many payments share a date
    alpha = rng.uniform(0, 1, 3000)
    paid = spark.createDataFrame(
        [("hot", "c", float(t), float(a)) for t, a in zip(T, alpha)] + [("b", "c", 1.0, 1.0)],
        "underlier string, curve_id string, T double, alpha double").withColumn("beta", F.lit(0.0))
    segments = curves.curve_segments(curve(spark, SAMPLE_CURVE))
    at = np.unique(np.round(rng.uniform(0, 12, 400), 2))
    points = spark.createDataFrame([("hot", float(t)) for t in at], "underlier string, T double")
    got = {r.T: r.pv_div for r in dividends.pv_dividends(points, paid, segments).collect()}
    t, r = zip(*SAMPLE_CURVE)
    pv = alpha * np.exp(-np.interp(T, t, r) * T)
    assert len(got) == at.size
    assert np.allclose([got[x] for x in at], [pv[T <= x].sum() for x in at], atol=1e-9)


def test_dividend_look_back_strips_time(spark):
    paid = spark.createDataFrame(
        [(dt.datetime(2024, 5, 16, 23, 59),), (dt.datetime(2024, 5, 15, 23, 59),)],
        "pay_date timestamp")
    kept = dividends.dividend_lookback(paid, F.to_date(F.lit("2026-05-16"))).collect()
    assert [r.pay_date for r in kept] == [dt.date(2024, 5, 16)]


def test_future_dividends_are_strictly_later(spark):
    paid = spark.createDataFrame(
        [(dt.date(2026, 5, 16), 1.0), (dt.date(2026, 5, 17), 2.0)], "pay_date date, amount double")
    assert [r.alpha for r in future_dividends(paid, "2026-05-16").collect()] == [2.0]


def test_curve_snapshot_takes_last_complete_day(spark):
    history = spark.createDataFrame(
        [("c", dt.date(2026, 5, 1), 3.0, 4.0), ("c", dt.date(2026, 5, 2), 3.123456789, 4.5),
         ("c", dt.date(2026, 5, 3), None, 5.0), ("gaps", dt.date(2026, 5, 3), None, 5.0)],
        "curve_id string, asof date, m1 double, y1 double")
    rows = curves.curve_snapshot(history, {"m1": 1 / 12, "y1": 1.0}).collect()
    assert [(r.curve_id, r.asof.day, r.tenor, r.rate) for r in sorted(rows, key=lambda r: r.tenor)] == [
        ("c", 2, 1 / 12, 0.031235), ("c", 2, 1.0, 0.045)]


def test_latest_spot(spark):
    rows = [("a", dt.date(2026, 1, 1), 9.0), ("a", dt.date(2026, 1, 2), 5.0),
            ("a", dt.date(2026, 1, 2), 6.0), ("b", dt.date(2025, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "underlier string, asof date, spot double")
    got = {r.underlier: (r.asof, r.spot) for r in snapshot.latest_spot(df).collect()}
    assert got == {"a": (dt.date(2026, 1, 2), 6.0), "b": (dt.date(2025, 1, 1), 1.0)}


def test_enrich_keeps_every_quote_of_several_dates(spark):
    day = lambda d: dt.date(2026, 1, d)
    quotes = spark.createDataFrame(
        [("a", day(d), "c", 100.0 + i, 0.5 * (1 + i % 2), 4.0, 6.0) for d in (1, 2) for i in range(6)],
        "underlier string, asof date, curve_id string, strike double, T double, bid double, ask double")
    spots = spark.createDataFrame([("a", day(1), 100.0), ("a", day(2), 110.0)],
                                  "underlier string, asof date, spot double")
    rates = spark.createDataFrame(
        [("c", day(d), t, r + d / 100) for d in (1, 2) for t, r in SAMPLE_CURVE],
        "curve_id string, asof date, tenor double, rate double")
    paid = spark.createDataFrame([("a", day(2), "c", 0.75, 2.0, 0.0)],
                                 "underlier string, asof date, curve_id string, T double, alpha double, beta double")
    rows = snapshot.enrich_quotes(quotes, spots, rates, paid, ("underlier", "asof"),
                                  ("curve_id", "asof")).toPandas()
    assert len(rows) == 12 and (rows.mid == 5.0).all()
    later = rows[(rows["asof"] == day(2)) & (rows["T"] == 1.0)]
    r = np.interp(1.0, *zip(*SAMPLE_CURVE)) + 0.02
    paid_r = np.interp(0.75, *zip(*SAMPLE_CURVE)) + 0.02
    forward = (110 - 2 * np.exp(-paid_r * 0.75)) / np.exp(-r)
    assert np.allclose(later.forward, forward) and np.allclose(later.k, np.log(later.strike / forward))
    assert (rows[rows["asof"] == day(1)].pv_div == 0).all()
