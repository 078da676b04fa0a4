import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dusklark.operators import events as V
from dusklark.operators import likelihood as L
from dusklark.operators import measures as M
from dusklark.operators import spend as S


def pmf(k, mu, r):
    p = r / (r + mu)
    return math.exp(math.lgamma(k + r) - math.lgamma(r) - math.lgamma(k + 1) + r * math.log(p) + k * math.log(1 - p))


def test_expected_sales_and_tail(spark):
    cases = [(0.5, 1.2, 0), (0.5, 1.2, 1), (3.0, 0.7, 5), (12.0, 4.0, 25), (0.01, 2.0, 3)]
    df = spark.createDataFrame(cases, "mu double, r double, q long")
    out = df.select("mu", "r", "q", L.expected_sales(F.col("mu"), F.col("r"), F.col("q")).alias("e"), L.log_survival(F.col("mu"), F.col("r"), F.col("q")).alias("t")).collect()
    for x in out:
        want = sum(min(k, x["q"]) * pmf(k, x["mu"], x["r"]) for k in range(600))
        tail = sum(pmf(k, x["mu"], x["r"]) for k in range(x["q"], 600))
        assert x["e"] == pytest.approx(want, abs=1e-9)
        assert x["t"] == pytest.approx(math.log(tail), abs=1e-6)
    assert spark.createDataFrame([(1.0, 1.0, None)], "mu double, r double, q long").select(L.expected_sales(F.col("mu"), F.col("r"), F.col("q"))).first()[0] is None


def test_grid_posterior_finds_a_known_elasticity(spark):
    rng = np.random.default_rng(5)
    ratio = rng.uniform(-0.6, 0.2, 4000)
    mu = 2.0 * np.exp(-1.5 * ratio)
    k = rng.negative_binomial(1.5, 1.5 / (1.5 + mu))
    stock = rng.integers(1, 12, 4000)
    sold = np.minimum(k, stock)
    rows = [("c", int(a), int(b), 2.0, 1.5, float(x)) for a, b, x in zip(sold, stock, ratio)] + [("c", None, 1, 1.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "cell string, k long, stock long, mu double, r double, log_ratio double")
    grid = np.linspace(-4, -0.05, 200)
    got = L.grid_posterior(df, "cell", grid, -1.0, 0.6).first()
    assert got["n"] == 4000 and abs(got["mean"] + 1.5) < 4 * got["std"] + 0.05 and got["std"] < 0.3
    assert L.grid_posterior(df.limit(0), "cell", grid, -1.0, 0.6).count() == 0


def test_dispersion_fit(spark):
    rng = np.random.default_rng(2)
    k = rng.negative_binomial(0.8, 0.8 / (0.8 + 2.0), 20_000)
    df = spark.createDataFrame([("g", 2.0, int(x)) for x in k] + [("g", None, 1), ("g", 1.0, -1)], "g string, mu double, k long")
    r = L.fit_dispersion(df, "g").first()
    assert r["n"] == 20_000 and abs(r["r"] - 0.8) < 0.05


def test_dispersion_fit_is_censored_at_the_stock(spark):
    rng = np.random.default_rng(6)
    k, stock = rng.negative_binomial(0.8, 0.8 / (0.8 + 2.0), 20_000), rng.integers(0, 6, 20_000)
    df = spark.createDataFrame([("g", 2.0, int(min(a, q)), int(q)) for a, q in zip(k, stock)] + [("g", 2.0, 1, None)], "g string, mu double, k long, stock long")
    r = L.fit_dispersion(df, "g", stock="stock").first()
    assert r["n"] == (stock >= 1).sum() and abs(r["r"] - 0.8) < 0.06
    assert abs(L.fit_dispersion(df, "g").first()["r"] - 0.8) > 0.06


def test_log_tail_reaches_beyond_the_last_digit():
    for k, mu, r in ((1, 0.5, 0.3), (4, 2.0, 0.8), (40, 0.5, 2.0), (25, 1.0, 40.0), (60, 20.0, 0.05)):
        want = math.log(sum(pmf(j, mu, r) for j in range(k, k + 20_000)))
        assert L._log_tail(np.array([k]), np.array([mu]), r)[0] == pytest.approx(want, rel=1e-6)


def test_dispersion_falls_back_and_is_clamped(spark):
    rng = np.random.default_rng(7)
    rows = []
    for p, ch, r, n in (("a", "x", 0.5, 3000), ("a", "thin", 0.5, 150), ("b", "y", 5.0, 3000), ("rare", "z", 0.5, 60), (None, "w", 0.9, 3000)):
        k, stock = rng.negative_binomial(r, r / (r + 2.0), n), rng.integers(0, 9, n)
        rows += [(p, ch, 2.0, int(min(a, q)), int(q)) for a, q in zip(k, stock)]
    df = spark.createDataFrame(rows, "p string, c string, mu double, k long, stock long")
    got = {(r["parent"], r["child"]): r for r in L.dispersion_levels(df, "p", "c", "stock").collect()}
    assert {key: r["level"] for key, r in got.items()} == {("a", "x"): "child", ("a", "thin"): "parent", ("b", "y"): "child", ("rare", "z"): "global", (None, "w"): "child", (None, None): "global"}
    assert got[("a", "thin")]["level_n"] == got[("a", "x")]["n"] + got[("a", "thin")]["n"]
    assert abs(got[("a", "x")]["r"] - 0.5) < 0.08 and abs(got[(None, "w")]["r"] - 0.9) < 0.15
    fits = [got[key]["fitted"] for key in (("a", "x"), ("b", "y"), (None, "w"), ("a", "thin"), ("b", "y"), (None, None))]
    assert got[("b", "y")]["r"] == pytest.approx(np.percentile(fits, 90)) and got[("rare", "z")]["r"] == got[(None, None)]["r"]
    top = L.dispersion_levels(df, "p", "c", "stock", clamp=0.5).filter("child = 'y'").first()
    assert top["r"] == pytest.approx(np.percentile(fits, 50)) and top["r"] < top["fitted"]
    assert L.dispersion_levels(df.limit(0), "p", "c", "stock").count() == 0


def ledger(spark, rows):
    return spark.createDataFrame(rows, "day string, costs array<double>, extra string")


def spend(rows, tau):
    return sum(np.mean([c for c in cs if c <= tau]) if any(c <= tau for c in cs) else 0.0 for _, cs, _ in rows)


def test_spend_curve_matches_direct_sums(spark):
    rng = random.Random(1)
    rows = [("d", [round(rng.lognormvariate(3, 1), 1) for _ in range(rng.randrange(0, 9))], "x") for _ in range(80)]
    curve = S.spend_curve(ledger(spark, rows)).collect()
    for r in curve[::7]:
        assert r["spend"] == pytest.approx(spend(rows, r["tau"]), abs=1e-6)
    best = S.solve_threshold(ledger(spark, rows), 900.0).first()
    assert best["tau"] == max(r["tau"] for r in curve if r["spend"] < 900.0)
    assert S.solve_threshold(ledger(spark, []), 1.0).count() == 0
    assert S.spend_curve(ledger(spark, [("d", None, "x"), ("d", [None, float("nan")], "x")])).count() == 0


def test_running_total_in_ranges(spark):
    df = spark.createDataFrame([(float(i % 50), 1.0) for i in range(500)] + [(None, 9.0)], "o double, v double")
    got = [r["running"] for r in S.running_total(df, "o", "v", 8).orderBy("o").collect()]
    assert got == [10.0 * (i + 1) for i in range(50)]


def test_clustered_ratio_and_variance_share(spark):
    rng = np.random.default_rng(3)
    rows = [(int(u), float(y), float(x)) for u in range(40) for y, x in zip(rng.gamma(2, 1, 5), rng.gamma(5, 1, 5))] + [(99, None, 1.0)]
    df = spark.createDataFrame(rows, "u long, y double, x double")
    got = M.clustered_ratio(df, ["u"], "y", "x").first()
    sums = {}
    for u, y, x in rows:
        a = sums.setdefault(u, [0.0, 0.0])
        a[0] += y or 0.0
        a[1] += x
    y, x = np.array(list(sums.values())).T
    q = y.sum() / x.sum()
    assert got["ratio"] == pytest.approx(q) and got["se"] == pytest.approx(math.sqrt(np.var(y - q * x, ddof=1) / (len(y) * x.mean() ** 2)))
    groups = [(g, float(v)) for g in range(30) for v in rng.normal(g % 3, 1, rng.integers(1, 7))]
    keep = [(g, v) for g, v in groups if sum(1 for h, _ in groups if h == g) >= 3]
    means = [np.mean([v for h, v in keep if h == g]) for g in {g for g, _ in keep}]
    want = np.clip(np.var(means, ddof=1) / np.var([v for _, v in keep], ddof=1), 0, 0.95)
    assert M.intra_class(spark.createDataFrame(groups, "g long, v double"), ["g"], "v").first()["rho"] == pytest.approx(want)


def test_bins_streaks_smoothing_top_and_arm(spark):
    gaps = spark.createDataFrame([(0.0,), (-0.2,), (0.2,), (-0.15,), (0.01,), (None,)], "g double")
    assert [r[0] for r in gaps.select(M.right_closed_bin(F.col("g"), M.GAP_EDGES)).collect()] == [4 if 0.0 > M.GAP_EDGES[4] else 3, None, 7 if 0.2 <= M.GAP_EDGES[8] else None, 0 if -0.15 <= M.GAP_EDGES[1] else 1, 4, None]
    s = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 9.0), ("a", 3, None), ("b", 1, 9.0), ("b", 2, 9.0)], "p string, o long, v double")
    assert sorted(map(tuple, M.trailing_streak(s, ["p"], "o", F.col("v") > 5).collect())) == [("a", 0), ("b", 2)]
    line = spark.createDataFrame([(i, float(i)) for i in range(6)], "o long, v double")
    assert [(r["smooth"], r["smooth_before"]) for r in M.smoothed(line, "o", "v", 2).orderBy("o").collect()] == [(None, None), (0.5, None), (1.5, None), (2.5, 0.5), (3.5, 1.5), (4.5, 2.5)]
    t = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), (None, 2)], "k string, n long")
    assert sorted(map(tuple, M.top_with_other(t, "k", ["n"], "n", 2).collect())) == [("a", 5), ("b", 5), ("other", 3)]
    arms = spark.range(2000).select(M.arm([F.col("id").cast("string"), F.lit("AA1")], 0.5).alias("a")).groupBy("a").count().collect()
    assert all(900 < r["count"] < 1100 for r in arms)
    assert M.hash_sample(line, "o", 3, 1).collect() == M.hash_sample(line.repartition(5), "o", 3, 1).collect()


OUT = "outcome_id string, decision_id string, units_sold long, starting_inventory long, ending_inventory long, applied_price double, is_stockout boolean, execution_status string, finalized_at string, adjustment_reason string"


def test_outcomes_are_quarantined_with_reasons(spark):
    good = ("o", "d", 1, 3, 2, 9.0, False, "ok", "2026-01-01T00:00:00Z", None)
    rows = [good, ("o", "d", 1, 3, 0, 9.0, False, "ok", "2026-01-01", "episode_close_write_off"), ("o", "d", -2, 3, 5, 9.0, False, "ok", "2026-01-01", None), ("o", "d", 1, 3, 0, float("nan"), None, "ok", "soon", " ")]
    ok, bad = V.split(spark.createDataFrame(rows, OUT), V.outcome_problems())
    assert ok.count() == 2
    assert sorted(tuple(r["problems"]) for r in bad.collect()) == [("is_stockout missing", "stock does not reconcile", "applied_price not finite", "finalized_at unreadable"), ("units_sold negative",)]


def test_level_factors_recover_a_known_factor(spark):
    rng = np.random.default_rng(9)
    rows = []
    for p, ch, f in (("a", "x", 1.45), ("a", "y", 1.45), ("b", "z", 0.7)):
        mu = rng.choice([0.5, 1.0, 2.0], 6000)
        k = rng.negative_binomial(1.0, 1.0 / (1.0 + f * mu))
        stock = rng.integers(1, 8, 6000)
        rows += [(p, ch, float(m), int(q), int(min(a, q))) for m, q, a in zip(mu, stock, k)]
    df = spark.createDataFrame(rows + [("a", None, 1.0, 3, None)], "p string, c string, mu double, stock long, k long")
    got = {(r["parent"], r["child"]): r["factor"] for r in L.level_factors(df, "p", "c").collect()}
    assert abs(got[("a", "x")] - 1.45) < 0.1 and abs(got[("b", "z")] - 0.7) < 0.06
    assert L.level_factors(df.limit(0), "p", "c").count() == 0


def test_baseline_follows_the_hour(spark):
    from dusklark.operators.baseline import fit_baseline, predict

    rng = np.random.default_rng(4)
    rows = [(int(h), "a" if i % 2 else "b", int(rng.poisson(0.2 * h))) for i, h in enumerate(rng.integers(1, 12, 3000))] + [(None, None, 1), (3, "a", None)]
    df = spark.createDataFrame(rows, "hour long, cat string, k long")
    out = predict(fit_baseline(df, "k", ["hour"], ["cat"]), df.unionByName(spark.createDataFrame([(5, "new", 0)], df.schema)), ["hour"], ["cat"])
    means = {r["hour"]: r["m"] for r in out.groupBy("hour").agg(F.avg("expected").alias("m")).collect() if r["hour"]}
    assert means[11] > 2 * means[2] and out.filter("expected IS NULL").count() == 0
