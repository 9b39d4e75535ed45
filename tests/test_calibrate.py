"""SSVI errors, candidates, calibration and arbitrage report."""

from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from volspark.functions import ssvi
from volspark.functions.backend import ARRAY
from volspark.operators import calibrate, surfaces
from volspark.plans import queries, tables

TRUE = (-0.3, 0.5, 0.3, 0.04)
T_GRID = [0.25, 0.5, 1.0, 2.0]
K_GRID = [-0.4, -0.2, -0.1, 0.0, 0.1, 0.2, 0.4]

# Golden grids for TRUE: implied vols over K_GRID, and local vols at -0.3, -0.1, 0, 0.1, 0.3.
GOLDEN_IV = {
    0.25: (0.231785, 0.214433, 0.206652, 0.2, 0.194942, 0.191838, 0.1916),
    0.5: (0.224903, 0.21132, 0.205264, 0.2, 0.195775, 0.192793, 0.190822),
    1.0: (0.219338, 0.208834, 0.204147, 0.2, 0.196521, 0.19382, 0.190981),
    2.0: (0.214805, 0.206818, 0.203231, 0.2, 0.197187, 0.194849, 0.191746),
}
GOLDEN_LOCAL = {
    0.25: (0.242966, 0.211222, 0.199204, 0.191257, 0.189807),
    0.5: (0.232776, 0.208388, 0.198966, 0.192195, 0.188038),
    1.0: (0.224521, 0.206013, 0.198676, 0.193032, 0.187667),
    2.0: (0.217725, 0.203969, 0.198349, 0.193771, 0.188203),
}


def surface_table(spark, *params):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(params)],
                                 "surface_id int, rho double, eta double, gam double, nu double")


def test_golden_grids(spark):
    table = surface_table(spark, TRUE)
    iv = {(r["T"], r.k): r.iv for r in surfaces.iv_grid(table, T_GRID, K_GRID).collect()}
    assert len(iv) == 28
    for T, row in GOLDEN_IV.items():
        assert [iv[T, k] for k in K_GRID] == pytest.approx(row, abs=6e-7)
    ks = (-0.3, -0.1, 0.0, 0.1, 0.3)
    lv = {(r["T"], r.k): r for r in surfaces.local_vol_grid(table, T_GRID, ks).collect()}
    for T, row in GOLDEN_LOCAL.items():
        assert [lv[T, k].local_vol for k in ks] == pytest.approx(row, abs=6e-7)
        assert all(lv[T, k].reason is None for k in ks)


def test_arbitrage_report_on_bad_surfaces(spark):
    table = surface_table(spark, (-0.7, 8.0, 0.5, 0.04), (-0.9, 6.0, 0.9, 0.04),
                          (-0.5, 3.0, 1.4, 0.04), (0.99, 5.0, 0.5, 1.0), TRUE)
    ks = [round(-1 + 0.1 * i, 1) for i in range(21)]
    grid = surfaces.local_vol_grid(table, [0.05, 0.25, 1.0, 2.0], ks)
    got = {r.surface_id: (r.points, r.butterfly) for r in surfaces.arbitrage_report(grid).collect()}
    assert got == {0: (84, 29), 1: (84, 47), 2: (84, 80), 3: (84, 49), 4: (84, 0)}
    free = [r.v for r in table.orderBy("surface_id").select(ssvi.ssvi_arb_free().alias("v")).collect()]
    assert free == [False, False, False, False, True]


def quotes_of(seed, count, rows=(20, 40)):
    rng = np.random.default_rng(seed)
    frames, truth = [], {}
    for i in range(count):
        p = (rng.uniform(-0.8, 0.5), rng.uniform(0.3, 1.5), rng.uniform(0.1, 0.45), rng.uniform(0.02, 0.2))
        n = rng.integers(*rows)
        k, T = rng.uniform(-0.5, 0.5, n), rng.uniform(0.05, 2, n)
        frames.append(pd.DataFrame({"surface_id": f"s{i}", "T": T, "k": k,
                                    "iv": ssvi.vol(ssvi.smile(k, T, *p, ARRAY), ARRAY)}))
        truth[f"s{i}"] = p
    return pd.concat(frames), truth


@pytest.mark.parametrize("max_rows", [calibrate.MAX_ROWS, 0])
def test_sample_surface_is_recovered(spark, max_rows):
    quotes = surfaces.iv_grid(surface_table(spark, TRUE), T_GRID, K_GRID).select("surface_id", "T", "k", "iv")
    row = calibrate.calibrate_ssvi(quotes, max_rows=max_rows).first()
    assert (row.rho, row.eta, row.gam, row.nu) == pytest.approx(TRUE, abs=1e-6)
    assert row.status == "ok" and row.sse < 1e-20 and row.iterations < 15


def test_bundled_fit_recovers_random_surfaces():
    quotes, truth = quotes_of(7, 300)
    frame = quotes.rename(columns={"surface_id": "surface"}).assign(weight=1.0)
    got = calibrate.fit_bundle(frame).set_index("surface")
    assert (got.status == "ok").all()
    error = np.abs(got.loc[list(truth), list(ssvi.PARAMS)].to_numpy() - np.array(list(truth.values())))
    assert error.max() < 1e-4


# Days and places of quotes on which the descent from ``START`` ends on the lower bound of gam.
TRAP = (
    (10, 40), (24, 39), (41, 38), (47, 42), (50, 43), (64, 24), (92, 24), (96, 17), (136, 29), (139,
    36), (148, 16), (160, 35), (182, 39), (208, 29), (243, 20), (244, 21), (250, 42), (266, 28), (271,
    34), (287, 43), (288, 30), (290, 10), (312, 49), (320, 44), (329, 4), (353, 7), (357, 35),
)


@pytest.mark.parametrize("max_rows", [calibrate.MAX_ROWS, 0])
def test_local_minimum_on_the_edge_of_the_box_is_left(spark, max_rows):
    true = (-0.4, 0.7, 0.45, 0.1)
    T, k = np.array([d / 365 for d, _ in TRAP]), np.array([(q - 25) / 62.5 for _, q in TRAP])
    iv = ssvi.vol(ssvi.smile(k, T, *true, ARRAY), ARRAY)
    quotes = spark.createDataFrame(pd.DataFrame({"surface_id": 1, "T": T, "k": k, "iv": iv}))
    row = calibrate.calibrate_ssvi(quotes, max_rows=max_rows).first()
    assert (row.rho, row.eta, row.gam, row.nu) == pytest.approx(true, abs=1e-6)
    assert row.status == "ok" and row.sse < 1e-15


def test_distributed_fit_equals_bundled_fit_on_noisy_quotes(spark):
    """Noise, weights, and one surface made almost only of copies of a single quote."""
    quotes, _ = quotes_of(8, 12)
    rng = np.random.default_rng(1)
    quotes["iv"] += rng.normal(0, 1e-3, len(quotes))
    quotes["w"] = rng.uniform(0.5, 2.0, len(quotes))
    copies = quotes[quotes.surface_id == "s0"].iloc[[0] * 500]
    df = spark.createDataFrame(pd.concat([quotes, copies]))
    fits = [calibrate.calibrate_ssvi(df, weight="w", max_rows=m).toPandas().set_index("surface_id").sort_index()
            for m in (calibrate.MAX_ROWS, 0, 100)]
    for other in fits[1:]:  # all large; and only the hot surface large
        assert (other.status == fits[0].status).all()
        assert np.allclose(other.sse, fits[0].sse, rtol=1e-6)
        assert np.allclose(other[list(ssvi.PARAMS)], fits[0][list(ssvi.PARAMS)], atol=1e-4)
    assert len(fits[0]) == 12 and (fits[0].sse > 0).all()


def test_invalid_surfaces_are_reported_and_do_not_disturb_others(spark):
    quotes, truth = quotes_of(9, 2)
    bad = pd.DataFrame({"surface_id": ["few"] * 3 + ["null"] * 5 + ["expired"] * 5, "T": [1.0] * 8 + [0.0] * 5,
                        "k": np.linspace(-0.2, 0.2, 13), "iv": [0.2] * 3 + [None] + [0.2] * 9})
    fit = calibrate.calibrate_ssvi(spark.createDataFrame(pd.concat([quotes, bad]))).toPandas().set_index("surface_id")
    assert set(fit.index[fit.status == "invalid_input"]) == {"few", "null", "expired"}
    assert fit.loc[["few", "null", "expired"], list(ssvi.PARAMS)].isna().all().all()
    for name, p in truth.items():
        assert fit.loc[name, list(ssvi.PARAMS)].to_list() == pytest.approx(p, abs=1e-4)
    nothing = calibrate.calibrate_ssvi(spark.createDataFrame(bad))
    assert nothing.count() == 3
    assert calibrate.calibrate_ssvi(spark.createDataFrame(bad).limit(0)).count() == 0


def test_fit_on_a_bound(spark):
    """The best gamma of this surface lies outside the box, so the fit ends on its bound."""
    rng = np.random.default_rng(3)
    k, T = rng.uniform(-0.5, 0.5, 60), rng.uniform(0.05, 2, 60)
    iv = ssvi.vol(ssvi.smile(k, T, -0.4, 0.8, 0.65, 0.05, ARRAY), ARRAY)
    row = calibrate.fit_bundle(pd.DataFrame({"surface": 1, "T": T, "k": k, "iv": iv, "weight": 1.0})).iloc[0]
    assert row.status == "ok" and row.gam == 0.5 and row.iterations < calibrate.MAX_ITERATIONS


def test_sse_and_best_candidate_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(surfaces, "SLICE_ROWS", 10)  # every surface is gathered in slices
    quotes, _ = quotes_of(10, 5)
    quotes["w"] = 2.0
    df = spark.createDataFrame(pd.concat([quotes, quotes[quotes.surface_id == "s1"].iloc[[0] * 50]]))
    candidates = [(-0.5, 0.5, 0.3, 0.05), (-0.5, 4.0, 0.3, 0.05), (0.1, 1.0, 0.2, 0.1), (-0.2, 0.7, 0.4, 0.08)]
    local = df.toPandas()

    def sse(rows, p):
        if not ssvi.arb_free(*map(np.float64, p[:3]), ARRAY):
            return surfaces.PENALTY
        model = ssvi.vol(ssvi.smile(rows.k.to_numpy(), rows["T"].to_numpy(), *p, ARRAY), ARRAY)
        return ((model - rows.iv.to_numpy()) ** 2).sum()

    want = {s: [sse(rows, p) for p in candidates] for s, rows in local.groupby("surface_id")}
    params = spark.createDataFrame([(s, i, *p) for s in want for i, p in enumerate(candidates)],
                                   "surface_id string, param_id int, rho double, eta double, gam double, nu double")
    for r in surfaces.ssvi_sse(df, params).collect():
        assert r.sse == pytest.approx(want[r.surface_id][r.param_id], rel=1e-9)
    for r in surfaces.ssvi_sse(df, params, weight="w").collect():
        if r.sse != surfaces.PENALTY:
            assert r.sse == pytest.approx(2 * want[r.surface_id][r.param_id], rel=1e-9)
    for r in surfaces.best_candidate(df, candidates).collect():
        assert r.param_id == int(np.argmin(want[r.surface_id]))
        assert (r.rho, r.eta, r.gam, r.nu) == candidates[r.param_id]
        assert r.sse == pytest.approx(min(want[r.surface_id]), rel=1e-9)


def test_candidates_that_drop_out_early_are_no_better():
    rng = np.random.default_rng(8)
    sets = [(rng.uniform(-0.9, 0.9), rng.uniform(0.2, 3), rng.choice([0.2, 0.4, 0.7]), rng.choice([0.03, 0.1])) for _ in range(60)]
    sets += sets[:5]  # equal sets tie
    count = rng.integers(1, 60, 300)
    owner = np.repeat(np.arange(300), count)
    k, T = rng.uniform(-0.6, 0.6, owner.size), rng.uniform(0.02, 2, owner.size)
    params = [rng.choice([s[i] for s in sets], 300)[owner] for i in range(4)]
    iv = ssvi.vol(ssvi.smile(k, T, *params, ARRAY), ARRAY) + rng.normal(0, 0.01, owner.size)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    chosen = surfaces.Candidates(sets)
    for weight in (rng.uniform(0, 2, owner.size), rng.uniform(-1, 2, owner.size)):
        want = np.empty((300, len(sets)))
        for i, p in enumerate(sets):
            miss = ssvi.vol(ssvi.smile(k, T, *p, ARRAY), ARRAY) - iv
            want[:, i] = np.add.reduceat(weight * miss * miss, first)
            if not ssvi.arb_free(*map(np.float64, p[:3]), ARRAY):
                want[:, i] = surfaces.PENALTY
        sse, best = chosen.best(T, k, iv, weight, first)
        assert (best == want.argmin(axis=1)).all()
        assert np.allclose(sse, want.min(axis=1), rtol=1e-9, atol=1e-14)
    assert (best < 60).all() and len(set(best)) > 20


def test_large_surfaces_start_near_the_end(spark, monkeypatch):
    """A surface in many slices, and one whose first slice cannot be fitted, end where a whole fit ends."""
    monkeypatch.setattr(calibrate, "SLICE_ROWS", 40)
    rng = np.random.default_rng(5)
    frames = []
    for name, n in (("many", 700), ("few", 5)):
        k, T = rng.uniform(-0.5, 0.5, n), rng.uniform(0.05, 2, n)
        iv = ssvi.vol(ssvi.smile(k, T, -0.4, 0.8, 0.3, 0.05, ARRAY), ARRAY) + rng.normal(0, 2e-3, n)
        frames.append(pd.DataFrame({"surface_id": name, "T": T, "k": k, "iv": iv}))
    quotes = pd.concat(frames)
    fit = calibrate.calibrate_ssvi(spark.createDataFrame(quotes), max_rows=0).toPandas().set_index("surface_id")
    whole = calibrate.fit_bundle(quotes.rename(columns={"surface_id": "surface"}).assign(weight=1.0)).set_index("surface")
    assert fit.status["many"] == "ok" and fit.iterations["many"] <= whole.iterations["many"]
    for name in fit.index[fit.status == "ok"]:
        assert np.allclose(fit.loc[name, list(ssvi.PARAMS)].astype(float), whole.loc[name, list(ssvi.PARAMS)].astype(float), atol=1e-4)
    assert fit.status["few"] == whole.status["few"]


def test_fit_beyond_the_wing_limit_is_no_worse_than_a_feasible_search():
    """Noisy quotes of surfaces beyond eta (1 + |rho|) = 4; most fits end on the limit."""
    rng = np.random.default_rng(17)
    frames, best = [], {}
    for i in range(100):
        p = (rng.uniform(-0.9, 0.9), rng.uniform(3, 6), rng.uniform(0.05, 0.5), rng.uniform(0.01, 0.2))
        k, T = rng.uniform(-0.6, 0.6, 45), rng.uniform(0.05, 2, 45)
        iv = ssvi.vol(ssvi.smile(k, T, *p, ARRAY), ARRAY) + rng.normal(0, 0.003, 45)
        frames.append(pd.DataFrame({"surface": i, "T": T, "k": k, "iv": iv, "weight": 1.0}))
        centre, width, low = np.array([p[0], 4.0, p[2], p[3]]), 1.0, np.inf
        for _ in range(60):  # random search in (rho, u, gam, nu) around the best point so far
            x = centre + width * rng.normal(0, (0.3, 1.0, 0.1, 0.05), (200, 4))
            x = np.clip(x, (-0.99, 0.02, 0.01, 0.001), (0.99, 4.0, 0.5, 1.0))
            sets = [v[:, None] for v in (x[:, 0], x[:, 1] / (1 + abs(x[:, 0])), x[:, 2], x[:, 3])]
            model = ssvi.vol(ssvi.smile(k[None], T[None], *sets, ARRAY), ARRAY)
            sse = ((model - iv) ** 2).sum(1)
            if sse.min() < low:
                low, centre = sse.min(), x[sse.argmin()]
            else:
                width *= 0.8
        best[i] = low
    fit = calibrate.fit_bundle(pd.concat(frames)).set_index("surface")
    wing = fit.eta * (1 + fit.rho.abs())
    assert (wing <= ssvi.WING_LIMIT).all() and (wing > 3.999).sum() > 50
    ok = fit[fit.status == "ok"]
    assert len(ok) > 90
    assert (ok.sse <= 1.01 * pd.Series(best)[ok.index]).all()


def test_an_iteration_of_the_distributed_fit_leaves_the_quotes_in_place(spark, monkeypatch):
    plans, keep = [], calibrate.checkpointed

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return keep(df)

    monkeypatch.setattr(calibrate, "checkpointed", spy)
    quotes, _ = quotes_of(8, 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        calibrate.calibrate_ssvi(spark.createDataFrame(quotes), max_rows=0).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    steps = [p for p in plans if any("HashJoin" in line for line in p) and any("slice" in line for line in p)]
    assert steps
    for plan in steps:
        at = next(i for i, line in enumerate(plan) if "InMemoryTableScan" in line)
        depth = len(plan[at]) - len(plan[at].lstrip(" :+-"))
        for line in reversed(plan[:at]):  # ancestors up to the join
            own = len(line) - len(line.lstrip(" :+-"))
            if own < depth:
                assert "Exchange" not in line
                depth = own
            if "HashJoin" in line and own == depth:
                break


def test_an_exchange_of_partial_sums_follows_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    quotes, _ = quotes_of(8, 2)
    df = spark.createDataFrame(pd.concat([quotes, quotes[quotes.surface_id == "s0"].iloc[[0] * 2000]]))
    params = spark.createDataFrame([("s0", 0, *TRUE), ("s1", 0, *TRUE)],
                                   "surface_id string, param_id int, rho double, eta double, gam double, nu double")
    try:
        scored = surfaces.ssvi_sse(df, params)
        plan = scored._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("Exchange") < plan.index("SortMergeJoin")
    assert scored.count() == 2


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="tables are not here")
def test_every_underlier_of_the_chain_is_fitted(spark):
    """On all of its quotes: those far from the money neither drop out nor spoil the fit."""
    sf = "/root/testdata/sf0.001"
    asked = {r.underlier for r in tables.chain(spark, sf).select("underlier").distinct().collect()}
    got = queries.QUERIES["chain_to_local_vol_all"](spark, sf).collect()
    assert {r.surface_id for r in got} == asked and len(got) == 9 * len(asked)
    assert {r.status for r in got} == {"ok"}
    shown = {r.surface_id for r in queries.QUERIES["chain_to_local_vol"](spark, sf).collect()}
    assert shown < asked


def test_tasks_hold_few_quotes_at_a_time_and_lose_none(monkeypatch):
    monkeypatch.setattr(surfaces, "QUOTES_TOGETHER", 50)
    quotes, _ = quotes_of(11, 40)
    rows = quotes.rename(columns={"surface_id": "surface"}).assign(slices=1, weight=1.0).sort_values("surface")
    sets = [(-0.3, 0.5, 0.3, 0.05), (0.0, 1.0, 0.4, 0.1), (-0.5, 0.9, 0.2, 0.03)]
    chosen, held = surfaces.Candidates(sets), []
    best = chosen.best
    chosen.best = lambda T, *rest: held.append(len(T)) or best(T, *rest)
    score = surfaces._candidate_scores(chosen)
    batches = [rows.iloc[i : i + 17] for i in range(0, len(rows), 17)]
    got = pd.concat(score(iter(batches))).set_index("surface")
    assert max(held) < 50 + 17 + 40 and sum(held) == len(rows)
    monkeypatch.setattr(surfaces, "QUOTES_TOGETHER", 10**9)
    want = pd.concat(score(iter([rows]))).set_index("surface")
    assert set(got.index) == set(want.index) and len(got) == 40
    assert (got.param_id == want.param_id.loc[got.index]).all() and np.allclose(got.sse, want.sse.loc[got.index])


def test_sets_are_not_broadcast(spark, capsys):
    sets = surface_table(spark, TRUE).selectExpr("*", "explode(sequence(0, 2)) as param_id")
    quotes = spark.range(100).selectExpr("cast(id % 2 as int) as surface_id", "1e0 as T", "id / 1e2 as k", "2e-1 as iv")
    surfaces.ssvi_sse(quotes, sets).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stored_quotes_are_not_copied(spark, tmp_path, monkeypatch):
    frame, _ = quotes_of(3, 6)
    spark.createDataFrame(frame).write.parquet(str(tmp_path / "quotes"))
    stored = spark.read.parquet(str(tmp_path / "quotes"))
    copied = []
    monkeypatch.setattr(calibrate, "checkpointed", lambda df: copied.append(df.columns) or df.checkpoint())
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    want = calibrate.calibrate_ssvi(stored).toPandas().set_index("surface_id").sort_index()
    assert sum("iv" in columns for columns in copied) == 1
    copied.clear()
    got = calibrate.calibrate_ssvi(stored, stored=True).toPandas().set_index("surface_id").sort_index()
    assert not any("iv" in columns for columns in copied)
    pd.testing.assert_frame_equal(got, want, rtol=1e-6)
    assert (got["status"] == "ok").all()
