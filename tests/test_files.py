"""Order of lines in files, rejected lines, and market folders."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from volspark.operators import chain, curves, snapshot
from volspark.sources import chain as chain_source
from volspark.sources.chain import CHAIN_COLUMNS, observed_chain, read_chain, read_chain_text
from volspark.sources.folder import OWN_FILES, write_market
from volspark.sources.market import CALL_FILE, SHARED, read_market, read_rates, underlier_in, underlier_of


@pytest.fixture
def small_splits(spark):
    """Files are cut every few hundred bytes, so that one file is read by many tasks."""
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def line(strike, bid="5.1"):
    return f"2026-06-19,0.09315,34,call,american,{strike},{bid},5.3,5.2,12.0,7,0.2"


def chain_files(folder, files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in files.items():
        (folder / name).write_text("\n".join([",".join(CHAIN_COLUMNS), *lines]) + "\n")
    return str(folder)


def test_positions_sort_as_the_lines_do(spark, tmp_path, small_splits):
    rng = random.Random(1)
    strikes = {f"{name}_calls.csv": [rng.randint(1, 10**rng.randint(1, 9)) for _ in range(n)]
               for name, n in (("a", 400), ("b", 3), ("c", 150))}
    path = chain_files(tmp_path / "c", {f: [line(s) for s in listed] for f, listed in strikes.items()})
    rows = read_chain(spark, path, True, ("position",))
    assert rows.rdd.getNumPartitions() > 20
    got = [int(r.strike) for r in rows.repartition(7).orderBy("position").collect()]
    assert got == [s for f in sorted(strikes) for s in strikes[f]]
    first = chain.first_n(rows, 5, ("position",))
    assert [int(r.strike) for r in first.collect()] == strikes["a_calls.csv"][:5]
    named = rows.withColumn("underlier", underlier_of("position.file", CALL_FILE))
    ranked = chain.first_n(named, 5, ("position",), ("underlier",)).orderBy("underlier", "rank").collect()
    assert [(r.underlier, int(r.strike)) for r in ranked] == [
        (f[0], s) for f in sorted(strikes) for s in strikes[f][:5]]


def test_first_lines_need_no_sort_of_the_files(spark, tmp_path):
    path = chain_files(tmp_path / "c", {"a_calls.csv": [line(s) for s in range(9)]})
    rows = read_chain(spark, path, True, ("position",))
    plan = chain.first_n(rows, 5, ("position",))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_curve_files_are_checked_in_file_order(spark, tmp_path, small_splits):
    tenors = [i / 10 for i in range(1, 2001)]
    broken = tenors[:1200] + [tenors[1199]] + tenors[1200:]
    for name, listed in (("good", tenors), ("broken", broken), ("gap", [0.1, None, 0.2]), ("down", [0.3, 0.2, 0.1])):
        folder = tmp_path / "r" / f"curve_id={name}"
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text("tenor,rate\n" + "".join(f"{'' if t is None else t},0.01\n" for t in listed))
    rates = read_rates(spark, str(tmp_path / "r"), ("curve_id",))
    assert rates.rdd.getNumPartitions() > 10
    want = {"broken": (1, 2001), "gap": (1, 3), "down": (2, 3)}
    assert {r.curve_id: (r.violations, r.rows) for r in curves.validate_curve(rates).collect()} == want
    marked = curves.marked_curves(rates).select("curve_id", "sound").distinct().collect()
    assert sorted((r.curve_id, r.sound) for r in marked) == [("broken", False), ("down", False), ("gap", False), ("good", True)]
    whole = read_rates(spark, str(tmp_path / "r" / "curve_id=good" / "x.csv")).orderBy("seq").collect()
    assert [r.tenor for r in whole] == tenors


BAD = [
    (line("n/a"), "malformed_strike"), (line(300, ""), "malformed_bid"), (line(300, "nan"), "malformed_bid"),
    (line(300, "0"), "one_sided"), (line("n/a", "0"), "malformed_strike"), (line(300).replace("0.09315", "x"), "malformed_T"),
    (line(300).replace(",5.3,", ",-1,"), "one_sided"), (line(300).replace(",5.3,", ",,"), "malformed_ask"),
    (line(300).replace(",12.0,", ",12abc,"), "malformed_volume"), (line(300).replace(",7,", ",99999999999,"), "malformed_openInterest"),
    ("2026-06-19,0.1,34,call", "malformed_strike"),
]


def test_rejected_lines_have_a_cause(spark, tmp_path):
    path = chain_files(tmp_path / "c", {"a_calls.csv": [line(300), *(text for text, _ in BAD), line(301)]})
    raw = read_chain_text(spark, path)
    rejects = chain_source.chain_rejects(raw, ("position",))
    assert [r.cause for r in rejects.orderBy("position").collect()] == [cause for _, cause in BAD]
    report = {r.cause: r.rows for r in chain_source.reject_report(rejects).collect()}
    assert report == Counter(cause for _, cause in BAD)
    quotes, seen = observed_chain(raw, True)
    assert sorted(r.strike for r in quotes.collect()) == [300.0, 301.0]
    counted = seen.get
    assert counted.pop("rows") == len(BAD) + 2
    assert {cause: n for cause, n in counted.items() if n} == report
    assert quotes.count() + rejects.count() == raw.count()


def market_tables(spark, many):
    rows = [("hot", True, "2026-11-14", 0.5, 100.0 + i / 8, 1.0, 2.0, i, 3) for i in range(many)]
    rows += [("cold", side, "2026-11-14", 0.5, 90.0, 1.5, 2.5, 4, 5) for side in (True, False)]
    rows += [("hot", False, "2026-12-14", 0.6, 90.0, 0.0, 2.5, 4, 5)]
    quotes = spark.createDataFrame(
        rows, "underlier string, is_call boolean, expiration string, T double, strike double, bid double, "
        "ask double, volume int, openInterest int")
    spots = spark.createDataFrame(
        [(u, dt.date(2026, 5, d), 100.0 + d) for u in ("hot", "cold") for d in (15, 16, 17)],
        "underlier string, date date, spot double")
    rates = spark.createDataFrame([(1.0, 0.02), (0.25, 0.01)], "tenor double, rate double")
    paid = spark.createDataFrame(
        [("hot", dt.date(2026, 6, 1), 0.5), ("hot", dt.date(2026, 1, 1), 9.0)], "underlier string, Date date, amount double")
    return quotes, spots, rates, paid


def test_market_folder_round_trip(spark, tmp_path):
    many = 3000
    tables = market_tables(spark, many)
    folder = f"file://{tmp_path}/market"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_market(folder, *tables)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    root = tmp_path / "market"
    assert sorted(p.name for p in root.iterdir()) == sorted(
        [f"{u}_{k}.csv" for u in ("hot", "cold") for k in ("calls", "puts", "spot")] + ["hot_dividends.csv", "treasury_rates.csv"])
    assert (root / "hot_calls.csv").is_dir() and (root / "cold_calls.csv").is_file()  # the hot file spans tasks
    assert (root / "treasury_rates.csv").read_text() == "tenor,rate\n0.25,0.01\n1.0,0.02\n"
    market = read_market(spark, folder, "2026-05-16")
    assert market.curve_report().count() == 0
    quotes = snapshot.enrich_quotes(*market).collect()
    assert len(quotes) == many + 2 and all(r.status == "ok" and r.spot == 116.0 for r in quotes)
    assert {r.underlier: r.pv_div > 0 for r in quotes} == {"hot": True, "cold": False}
    assert sorted(r.strike for r in quotes if r.underlier == "hot") == [100.0 + i / 8 for i in range(many)]
    calls = read_chain(spark, f"{folder}/*{CALL_FILE}", True, ("position",)).where(F.col("position.file").contains("hot"))
    assert [r.strike for r in calls.orderBy("position").collect()] == [100.0 + i / 8 for i in range(many)]


def test_quotes_of_an_unsound_curve_are_marked(spark, tmp_path):
    write_market(str(tmp_path / "m"), *market_tables(spark, 3))
    (tmp_path / "m" / "treasury_rates.csv").write_text("tenor,rate\n1.0,0.02\n0.25,0.01\n")
    market = read_market(spark, str(tmp_path / "m"), "2026-05-16")
    assert [(r.curve_id, r.violations, r.rows) for r in market.curve_report().collect()] == [("usd", 1, 2)]
    rows = snapshot.enrich_quotes(*market).collect()
    assert {r.status for r in rows} == {"invalid_curve"} and len(rows) == 5
    assert all(r.r is None and r.forward is None and "_unsound" not in r for r in rows)


def test_market_folder_refuses(spark, tmp_path):
    quotes, *others = market_tables(spark, 3)
    folder = tmp_path / "m"
    write_market(str(folder), quotes, *others)
    with pytest.raises(FileExistsError):
        write_market(str(folder), quotes, *others)
    for bad in ("a/b", None):
        with pytest.raises(Exception, match="underlier"):
            write_market(str(tmp_path / "bad"), quotes.withColumn("underlier", F.lit(bad).cast("string")), *others)
    assert not [p for p in (tmp_path / "bad").rglob("*") if p.is_file()]
    empty = [t.limit(0) for t in (quotes, *others)]
    write_market(str(tmp_path / "none"), *empty)
    assert not (tmp_path / "none").exists() or not list((tmp_path / "none").iterdir())


def test_many_underliers_share_files(spark, tmp_path):
    many = 3000
    tables = market_tables(spark, many)
    names = {"hot": "hot, the \"first\"", "cold": " cold "}
    renamed = [t.replace(names, subset="underlier") if "underlier" in t.columns else t for t in tables]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_market(str(tmp_path / "m"), *renamed, own_files=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(p.name for p in (tmp_path / "m").iterdir()) == [
        f"{SHARED}_{kind}.csv" for kind in ("calls", "dividends", "puts", "spot")] + ["treasury_rates.csv"]
    assert (tmp_path / "m" / f"{SHARED}_calls.csv").is_dir()  # the calls span tasks
    assert (tmp_path / "m" / "treasury_rates.csv").read_text() == "tenor,rate\n0.25,0.01\n1.0,0.02\n"
    write_market(str(tmp_path / "own"), *tables)
    own = snapshot.enrich_quotes(*read_market(spark, str(tmp_path / "own"), "2026-05-16"))
    shared = snapshot.enrich_quotes(*read_market(spark, str(tmp_path / "m"), "2026-05-16"))
    assert Counter(shared.collect()) == Counter(own.replace(names, subset="underlier").select(shared.columns).collect())
    calls = read_chain(spark, f"{tmp_path}/m/*{CALL_FILE}", True, ("underlier", "position"))
    calls = calls.withColumn("underlier", underlier_in("position.file", CALL_FILE)).orderBy("position").collect()
    assert [(r.underlier, r.strike) for r in calls] == [(" cold ", 90.0)] + [
        (names["hot"], 100.0 + i / 8) for i in range(many)]
    (tmp_path / "m" / "late_calls.csv").write_text("\n".join([",".join([*CHAIN_COLUMNS, "more"]), line(7) + ",text"]))
    added = read_market(spark, str(tmp_path / "m"), "2026-05-16").quotes
    assert added.count() == many + 3 and added.where("underlier = 'late'").count() == 1
    for bad in (SHARED, "a\nb"):
        with pytest.raises(Exception, match="underlier"):
            write_market(str(tmp_path / "bad"), tables[0].withColumn("underlier", F.lit(bad)), *tables[1:])


def test_more_underliers_make_no_more_files(spark, tmp_path):
    quotes, spots, rates, paid = market_tables(spark, 1)
    number = F.explode(F.expr(f"transform(sequence(0, {OWN_FILES}), i -> string(i))"))
    several = [t.where("underlier = 'hot'").withColumn("underlier", number) for t in (quotes, spots, paid)]
    write_market(str(tmp_path / "m"), several[0], several[1], rates, several[2])
    assert len([p for p in (tmp_path / "m").rglob("*.csv") if p.is_file()]) < 30
    rows = snapshot.enrich_quotes(*read_market(spark, str(tmp_path / "m"), "2026-05-16")).collect()
    assert sorted(int(r.underlier) for r in rows) == list(range(OWN_FILES + 1)) and {r.status for r in rows} == {"ok"}
