"""Chain cleaning, filters, counts and parity."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from volspark.operators import chain
from volspark.plans import tables
from volspark.plans.queries import QUERIES


def test_normalise_chain(spark):
    asof = F.to_date(F.lit("2026-05-16"))
    day = lambda n: dt.date(2026, 5, 16) + dt.timedelta(days=n)
    rows = [(day(7), "call", 1.0, 10, 0.06), (day(365), "put", 2.0, 1, 1.0),
            (day(6), "call", 3.0, 10, 1.0), (day(366), "call", 4.0, 10, 1.0),
            (day(30), "call", 5.0, None, 1.0), (day(30), "call", 6.0, 0, 1.0),
            (day(30), "call", 7.0, 5, 0.05), (day(30), "call", 8.0, 5, float("nan"))]
    raw = spark.createDataFrame(rows, "expiration date, type string, strike double, volume int, bid double")
    got = chain.normalise_chain(raw, asof)
    assert got.columns == ["expiration", "T", "daysToExpiry", "type", "exerciseType", "strike", "bid", "volume"]
    assert [(r.strike, r["T"], r.exerciseType) for r in got.orderBy("strike").collect()] == [
        (1.0, round(7 / 365, 6), "american"), (2.0, 1.0, "american")]


def test_union_filters_and_split(spark):
    calls = spark.createDataFrame([(1, "American", 1.0, 2.0)], "id int, exercise string, bid double, ask double")
    puts = spark.createDataFrame([(2, " european", 0.5, float("nan")), (3, "AMERICAN", 1.0, 1.0)],
                                 "id int, exercise string, bid double, ask double").withColumn("extra", F.lit(1))
    both = chain.union_chains(calls, puts)
    assert both.count() == 3 and both.where("extra is null").count() == 1
    assert sorted(r.id for r in chain.two_sided(both).collect()) == [1, 3]
    assert sorted(r.id for r in chain.americans(both).collect()) == [1, 3]
    assert [r.id for r in chain.europeans(both).collect()] == [2]


def test_first_n_and_summary(spark):
    rows = [("a", True, i, 1, 10) for i in range(9)] + [("b", False, 5, 2, 20)]
    df = spark.createDataFrame(rows, "underlier string, is_call boolean, k int, volume int, open_interest int")
    assert [r.k for r in chain.first_n(df, 3, ("k", "underlier")).collect()] == [0, 1, 2]
    best = chain.first_n(df, 2, ("k",), ("underlier",))
    assert sorted((r.underlier, r.k, r["rank"]) for r in best.collect()) == [("a", 0, 1), ("a", 1, 2), ("b", 5, 1)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    got = {(r.underlier, r.is_call): (r.quotes, r.volume, r.open_interest)
           for r in chain.chain_summary(df).collect()}
    assert got == {("a", True): (9, 9, 90), ("b", False): (1, 2, 20)}


def test_parity_equals_the_pairwise_join_even_with_copies(spark):
    rng = np.random.default_rng(4)
    rows = [("u", float(k), 0.5, bool(c), float(p), 100.0, 0.98)
            for k in (90, 100, 110) for c in (True, False) for p in rng.uniform(1, 20, 30)]
    rows += [("u", 120.0, 0.5, True, 1.0, 100.0, 0.98)]  # no put: no pair
    rows += [("u", 90.0, 0.5, True, 7.0, 100.0, 0.98)] * 2000  # copies of one quote
    df = spark.createDataFrame(rows, "underlier string, strike double, T double, is_call boolean, p double, forward double, df double")
    got = chain.parity_by_strike(df, price=F.col("p")).toPandas().set_index("strike")
    for strike in (90.0, 100.0, 110.0):
        calls = np.array([r[4] for r in rows if r[1] == strike and r[3]])
        puts = np.array([r[4] for r in rows if r[1] == strike and not r[3]])
        pairs = calls[:, None] - puts[None, :] - 0.98 * (100 - strike)
        row = got.loc[strike]
        assert row.pairs == pairs.size
        assert row.residual_lo == pytest.approx(pairs.min())
        assert row.residual_hi == pytest.approx(pairs.max())
        assert row.worst == pytest.approx(np.abs(pairs).max())
    assert 120.0 not in got.index
    report = chain.parity_report(chain.parity_by_strike(df, price=F.col("p"))).first()
    assert report.strikes == 3 and report.max_residual == pytest.approx(got.worst.max())


def test_tasks_of_the_parity_table_do_not_grow_with_it(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(tables, "TASK_ROWS", 300)
    items = tables.load(spark, sf, "lineitem").count()
    dealt = tables.dealt_spot_quotes(spark, sf)
    sizes = dealt.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(sizes) == -(-items // 300) > 10 and max(r["count"] for r in sizes) < 600
    plain = tables.quotes(spark, sf).join(tables.spots(spark, sf), "underlier").select(dealt.columns)
    assert plain.exceptAll(dealt).count() == dealt.exceptAll(plain).count() == 0
    parity = QUERIES["parity_by_strike"](spark, sf)
    assert parity.rdd.getNumPartitions() == len(sizes)
