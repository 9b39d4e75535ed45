"""Quotes stored in buckets are enriched where they lie."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from volspark.operators import snapshot
from volspark.sources.stored import open_quotes, store_quotes


@pytest.fixture
def market(spark):
    rng = random.Random(3)
    quotes = [(i, f"u{rng.randrange(20)}", rng.choice(["usd", "eur"]), rng.choice([0.1, 0.5, 1.0, None]), 90.0 + i % 20, 1.0, 2.0)
              for i in range(3000)]
    return (
        spark.createDataFrame(quotes, "id int, underlier string, curve_id string, T double, strike double, bid double, ask double"),
        spark.createDataFrame([(f"u{i}", 100.0 + i) for i in range(19)], "underlier string, spot double"),
        spark.createDataFrame([("usd", 0.25, 0.01), ("usd", 1.0, 0.02)], "curve_id string, tenor double, rate double"),
        spark.createDataFrame([(f"u{i}", "usd", 0.3, 1.0, 0.0) for i in range(20)],
                              "underlier string, curve_id string, T double, alpha double, beta double"),
    )


@pytest.fixture
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.fixture
def stored(spark, tmp_path, market):
    name = f"quotes_{dt.datetime.now():%H%M%S%f}"
    yield store_quotes(market[0], name, str(tmp_path / "quotes"), 8)
    spark.sql(f"drop table {name}")
    spark.sql("drop table if exists opened_quotes")


def found(df):
    return sorted(map(str, df.select(*sorted(set(df.columns) - {"maturity"})).collect()))


def depth(line):
    return len(line) - len(line.lstrip(" :+-*()0123456789"))


def test_stored_quotes_are_not_shuffled(spark, market, stored, no_broadcast):
    rows = snapshot.enrich_quotes(stored, *market[1:])
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    scans = [i for i, line in enumerate(plan) if "FileScan parquet" in line and "strike" in line]
    assert len(scans) == 1 and "Bucketed: true" in plan[scans[0]]
    at = depth(plan[scans[0]])
    above = []
    for line in reversed(plan[: scans[0]]):
        if depth(line) < at:
            at = depth(line)
            above.append(line)
    assert any("Join" in line for line in above) and not [line for line in above if "Exchange" in line]


def test_stored_quotes_give_the_same_rows(spark, market, stored, tmp_path):
    want = found(snapshot.enrich_quotes(*market))
    assert found(snapshot.enrich_quotes(stored, *market[1:])) == want
    again = open_quotes(spark, "opened_quotes", str(tmp_path / "quotes"), stored.schema, 8)
    assert found(snapshot.enrich_quotes(again, *market[1:])) == want
    statuses = {r.status for r in snapshot.enrich_quotes(stored, *market[1:]).select("status").distinct().collect()}
    assert statuses == {"ok", "no_spot", "no_curve", "no_maturity"}


def test_maturities_of_one_hash_stay_apart(spark, market):
    quotes = market[0].withColumn("maturity", F.lit(1).cast("long"))
    assert found(snapshot.enrich_quotes(quotes, *market[1:])) == found(snapshot.enrich_quotes(*market))
