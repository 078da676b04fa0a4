"""Negative-binomial counts, censored at the stock on hand: expectations, tails, likelihoods over a parameter grid."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dusklark.session import written

#: Rows of a batch that are multiplied with the grid at a time.
BLOCK = 1024


def demand_at(mu_ref: Column, discount: Column, reference: Column, elasticity: Column, floor: float = 0.01) -> Column:
    """Expected demand at a discount, scaled from the reference discount by a constant elasticity; never below ``floor``."""
    return F.greatest(mu_ref * F.pow((1 - discount) / (1 - reference), elasticity), F.lit(floor))


def _walk(mu: Column, r: Column, upto: Column, weight) -> Column:
    """Sum over k = 0 .. upto - 1 of weight(k) times the probability of k, by the recurrence of the probabilities."""
    p = r / (r + mu)
    start = F.struct(F.pow(p, r).alias("pmf"), F.lit(0.0).alias("sum"))

    def step(acc, k):
        total = acc["sum"] + weight(k) * acc["pmf"]
        return F.struct((acc["pmf"] * (k + r) / (k + 1) * (1 - p)).alias("pmf"), total.alias("sum"))

    ks = F.when(upto >= 1, F.sequence(F.lit(0), upto.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(ks, start, step, lambda acc: acc["sum"])


def expected_sales(mu: Column, r: Column, stock: Column) -> Column:
    """E[min(D, stock)] for negative-binomial demand with mean ``mu`` and dispersion ``r``; 0 without stock, NULL for NULL."""
    return F.when(stock.isNotNull(), F.greatest(stock, F.lit(0)) - _walk(mu, r, stock, lambda k: stock - k))


def log_survival(mu: Column, r: Column, k: Column) -> Column:
    """ln P(D >= k); 0 for k below 1. Tails under 1e-9 are reported as that."""
    return F.ln(F.greatest(1 - _walk(mu, r, k, lambda _: F.lit(1.0)), F.lit(1e-9)))


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.vectorize(math.lgamma, otypes=[float])(x)


def grid_loglik(k: np.ndarray, stock: np.ndarray, mu: np.ndarray, r: np.ndarray, log_ratio: np.ndarray, grid: np.ndarray, floor: float = 0.01) -> np.ndarray:
    """Summed log-likelihood of each grid value; sales that reached the stock only say that demand was at least that."""
    out = np.zeros(len(grid))
    for a in range(0, len(k), BLOCK):
        s = slice(a, a + BLOCK)
        m = np.maximum(mu[s, None] * np.exp(grid[None, :] * log_ratio[s, None]), floor)
        rr = r[s, None]
        p = rr / (rr + m)
        full = k[s] >= stock[s]
        const = _lgamma(k[s] + r[s]) - _lgamma(r[s]) - _lgamma(k[s] + 1.0)
        exact = const[:, None] + rr * np.log(p) + k[s, None] * np.log1p(-p)
        out += exact[~full].sum(0)
        if full.any():
            q, rf, pf = np.maximum(stock[s][full], 1).astype(int), rr[full], p[full]
            pmf, below = pf**rf, np.zeros_like(pf)
            for j in range(int(q.max())):
                on = (q > j)[:, None]
                below += np.where(on, pmf, 0.0)
                pmf = pmf * (j + rf) / (j + 1) * (1 - pf)
            out += np.log(np.maximum(1 - below, 1e-9)).sum(0)
    return out


def grid_posterior(df: DataFrame, cell: str, grid: np.ndarray, prior_mean: float, prior_std: float, floor: float = 0.01) -> DataFrame:
    """Posterior moments of an elasticity per cell: ``cell, n, mean, std, mode``.

    df: ``cell, k, stock, mu, r, log_ratio``; rows with a NULL among them are left out. Each task sums its rows'
    log-likelihood over the grid, so one array per task and cell is all that is shuffled.
    """
    values = grid.tolist()

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        counts: dict[str, int] = {}
        g = np.array(values)
        for f in frames:
            for key, x in f.groupby("cell", dropna=False):
                part = grid_loglik(x["k"].to_numpy(float), x["stock"].to_numpy(float), x["mu"].to_numpy(float), x["r"].to_numpy(float), x["log_ratio"].to_numpy(float), g, floor)
                sums[key] = sums.get(key, 0) + part
                counts[key] = counts.get(key, 0) + len(x)
        yield pd.DataFrame({"cell": list(sums), "n": [counts[s] for s in sums], "ll": [v.tolist() for v in sums.values()]})

    rows = df.select(F.col(cell).alias("cell"), *[F.col(c).cast("double").alias(c) for c in ("k", "stock", "mu", "r", "log_ratio")]).dropna()
    parts = rows.mapInPandas(partial, "cell string, n long, ll array<double>")
    counts = parts.groupBy("cell").agg(F.sum("n").alias("n"))
    ll = parts.select("cell", F.posexplode("ll").alias("i", "x")).groupBy("cell", "i").agg(F.sum("x").alias("x"))
    eps = F.element_at(F.lit(values), F.col("i") + 1)
    post = ll.withColumn("eps", eps).withColumn("lp", F.col("x") - 0.5 * F.pow((F.col("eps") - prior_mean) / prior_std, 2))
    top = post.groupBy("cell").agg(F.max("lp").alias("top"))
    w = post.join(top, "cell").withColumn("w", F.exp(F.col("lp") - F.col("top")))
    m = w.groupBy("cell").agg(F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("eps")).alias("s1"), F.sum(F.col("w") * F.col("eps") * F.col("eps")).alias("s2"), F.max_by("eps", "lp").alias("mode"))
    mean = F.col("s1") / F.col("sw")
    return m.join(counts, "cell").select("cell", "n", mean.alias("mean"), F.sqrt(F.greatest(F.col("s2") / F.col("sw") - mean * mean, F.lit(0.0))).alias("std"), "mode")


def _log_tail(k: np.ndarray, mu: np.ndarray, r: float) -> np.ndarray:
    """ln P(D >= k) for k of 1 and more. Where little is left above the sum up to k, the tail itself is summed, so none is cut off."""
    p = r / (r + mu)
    pmf, below = p**r, np.zeros_like(mu)
    for j in range(int(k.max(initial=0))):
        below += np.where(k > j, pmf, 0.0)
        pmf = pmf * (j + r) / (j + 1) * (1 - p)
    far = 1 - below < 1e-6
    out = np.log(np.where(far, 1.0, 1 - below))
    if far.any():
        j, m, q = k[far].astype(float), mu[far], 1 - p[far]
        start = _lgamma(j + r) - math.lgamma(r) - _lgamma(j + 1.0) + r * np.log1p(-q) + j * np.log(q)
        term, total = np.ones_like(m), np.ones_like(m)
        for _ in range(100_000):
            term = term * (j + r) / (j + 1) * q
            total, j = total + term, j + 1
            if (term < 1e-12 * total).all():
                break
        out[far] = start + np.log(total)
    return out


def _dispersion_counts(df: DataFrame, keys: dict[str, Column], stock: str | None) -> DataFrame:
    """Rows by ``keys, mu, k, full``; ``full``: demand was at least k. Rows without stock say nothing and are left out."""
    kept = df.dropna(subset=["mu", "k"] + [stock] * bool(stock)).filter("mu > 0 AND k >= 0")
    full = F.lit(False)
    if stock:
        kept, full = kept.filter(F.col(stock) >= 1), F.col("k") >= F.col(stock)
    return kept.groupBy(*[v.alias(n) for n, v in keys.items()], F.col("mu").cast("double").alias("mu"), F.col("k").cast("long").alias("k"), full.alias("full")).agg(F.count(F.lit(1)).alias("n"))


def _fit_r(x: pd.DataFrame, low: float, high: float) -> tuple[float, float, bool]:
    """Dispersion, its log-likelihood, and whether the search over ln r closed in on a finite one."""
    full = x["full"].to_numpy(bool)
    mu, k, n = x["mu"].to_numpy(), x["k"].to_numpy(), x["n"].to_numpy(float)
    ks, at = np.unique(k[~full], return_inverse=True)

    def ll(log_r: float) -> float:
        r = math.exp(log_r)
        p = r / (r + mu[~full])
        const = _lgamma(ks + r) - math.lgamma(r) - _lgamma(ks + 1.0)
        exact = (n[~full] * (const[at] + r * np.log(p) + k[~full] * np.log1p(-p))).sum()
        return float(exact + (n[full] * _log_tail(k[full], mu[full], r)).sum())

    a, b, phi = math.log(low), math.log(high), (math.sqrt(5) - 1) / 2
    c, d = b - phi * (b - a), a + phi * (b - a)
    fc, fd = ll(c), ll(d)
    for _ in range(60):
        if fc > fd:
            b, d, fd = d, c, fc
            c = b - phi * (b - a)
            fc = ll(c)
        else:
            a, c, fc = c, d, fd
            d = a + phi * (b - a)
            fd = ll(d)
    best = (a + b) / 2
    return math.exp(best), ll(best), bool(b - a < 1e-5 and math.isfinite(ll(best)))


def fit_dispersion(df: DataFrame, group: str, low: float = 0.05, high: float = 50.0, stock: str | None = None) -> DataFrame:
    """Dispersion of each group by maximum likelihood: ``group, n, r, loglik``.

    df: ``group, mu, k`` and, if named, ``stock``: rows that sold it out only say that demand was at least k, and rows
    without any are left out. Rows are counted by (mu, k) first, which is all the likelihood needs; the counts of a
    group, not its rows, reach one task. Golden-section search over ln r in ``[ln low, ln high]``.
    """
    counts = _dispersion_counts(df, {"grp": F.col(group)}, stock)

    def fit(x: pd.DataFrame) -> pd.DataFrame:
        r, loglik, _ = _fit_r(x, low, high)
        return pd.DataFrame({"grp": [x["grp"].iloc[0]], "n": [int(x["n"].sum())], "r": [r], "loglik": [loglik]})

    return counts.groupBy("grp").applyInPandas(fit, "grp string, n long, r double, loglik double")


def dispersion_levels(df: DataFrame, parent: str, child: str, stock: str, least: int = 200, clamp: float = 0.9, low: float = 0.05, high: float = 50.0) -> DataFrame:
    """Dispersion of each child, its parent's or the overall one: ``parent, child, n, level, level_n, r, fitted, loglik``.

    df: ``parent, child, mu, k, stock``, read as by ``fit_dispersion``. A child or parent has a dispersion of its own
    from ``least`` rows on and if the search converged; else the next level's holds. ``fitted`` is the maximum, ``r`` is
    at most the quantile ``clamp`` of all fits that count. ``n`` is the child's rows, ``level_n`` those of the fit used.
    The row with neither parent nor child is the overall one, for those not met here.
    """
    cells = written(_dispersion_counts(df, {"p": F.col(parent).cast("string"), "c": F.col(child).cast("string")}, stock), "dispersion")  # read for three levels and the children

    def fit(x: pd.DataFrame) -> pd.DataFrame:
        n, level = int(x["n"].sum()), x["level"].iloc[0]
        r, loglik, ok = _fit_r(x, low, high) if level == "global" or n >= least else (None, None, False)
        return pd.DataFrame({"level": [level], "name": [x["name"].iloc[0]], "n": [n], "r": [r], "loglik": [loglik], "ok": [ok or level == "global"]})

    at = lambda level, name: cells.groupBy(F.lit(level).alias("level"), name.alias("name"), "mu", "k", "full").agg(F.sum("n").alias("n"))
    levels = at("child", F.col("c")).filter("name IS NOT NULL").unionByName(at("parent", F.col("p")).filter("name IS NOT NULL")).unionByName(at("global", F.lit("")))
    fits = levels.groupBy("level", "name").applyInPandas(fit, "level string, name string, n long, r double, loglik double, ok boolean").filter("ok")
    fits = written(fits, "dispersion-fits")  # read for the clamp and each level
    cap = fits.agg(F.percentile("r", F.lit(clamp)).alias("cap"))  # one row
    of = lambda level, tag: fits.filter(F.col("level") == level).select(F.col("name").alias(tag), F.struct(F.lit(level).alias("level"), F.col("n").alias("level_n"), F.col("r").alias("fitted"), "loglik").alias(f"_{tag}"))
    leaves = cells.groupBy("p", "c").agg(F.sum("n").alias("n"))
    whole = of("global", "g").drop("g")  # one row
    none = F.lit(None).cast("string")
    leaves = leaves.filter("p IS NOT NULL OR c IS NOT NULL").unionByName(fits.filter("level = 'global'").select(none.alias("p"), none.alias("c"), "n"))
    x = leaves.join(of("child", "c"), "c", "left").join(of("parent", "p"), "p", "left").crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(cap))
    x = x.withColumn("f", F.coalesce("_c", "_p", "_g"))
    return x.select(F.col("p").alias("parent"), F.col("c").alias("child"), "n", "f.level", "f.level_n", F.least("f.fitted", "cap").alias("r"), "f.fitted", "f.loglik")


def expected_min(mu: np.ndarray, r: float, stock: np.ndarray) -> np.ndarray:
    """E[min(D, stock)] for arrays."""
    p = r / (r + mu)
    pmf, out = p**r, stock.astype(float).copy()
    for k in range(int(stock.max(initial=0))):
        out -= np.where(stock > k, (stock - k) * pmf, 0.0)
        pmf = pmf * (k + r) / (k + 1) * (1 - p)
    return out


def level_factors(df: DataFrame, parent: str, child: str, r: float = 1.0, weight: float = 100.0, low: float = 0.1, high: float = 10.0) -> DataFrame:
    """Factors on expected demand that make censored expectations meet the units sold: ``parent, child, n, factor``.

    df: ``parent, child, mu, stock, k``. A child's own factor is drawn towards its parent's, and the parent's towards
    the overall one, in logarithms and by ``n / (n + weight)``. Rows are counted by (mu, stock) first; the counts of a
    group, not its rows, reach one task.
    """
    cells = df.dropna(subset=["mu", "stock", "k"]).filter("mu > 0 AND stock >= 0").groupBy(F.col(parent).alias("p"), F.col(child).alias("c"), F.col("mu").cast("double").alias("mu"), F.col("stock").cast("long").alias("stock"))
    cells = cells.agg(F.count(F.lit(1)).alias("n"), F.sum("k").cast("double").alias("sold"))

    def solve(x: pd.DataFrame) -> pd.DataFrame:
        mu, stock, n, sold = x["mu"].to_numpy(), x["stock"].to_numpy(), x["n"].to_numpy(float), float(x["sold"].sum())
        a, b = low, high
        for _ in range(40):
            m = math.sqrt(a * b)
            a, b = (m, b) if float((n * expected_min(m * mu, r, stock)).sum()) < sold else (a, m)
        return pd.DataFrame({"p": [x["p"].iloc[0]], "c": [x["c"].iloc[0]], "n": [int(n.sum())], "f": [math.sqrt(a * b)]})

    def at(level: DataFrame, *keys: str) -> DataFrame:
        return level.groupBy(*keys).applyInPandas(solve, "p string, c string, n long, f double")

    summed = lambda p, c: cells.groupBy(p.alias("p"), c.alias("c"), "mu", "stock").agg(F.sum("n").alias("n"), F.sum("sold").alias("sold"))
    none = F.lit(None).cast("string")
    top = at(summed(none, none), "p", "c").select(F.col("f").alias("ft"))  # one row
    mid = at(summed(F.col("p"), none), "p", "c").select("p", F.col("n").alias("np"), F.col("f").alias("fp"))
    own = at(cells, "p", "c").join(mid.crossJoin(F.broadcast(top)), "p")
    shrunk = lambda n, f, to: F.exp((n * F.ln(f) + weight * F.ln(to)) / (n + weight))
    mid_f = shrunk(F.col("np"), F.col("fp"), F.col("ft"))
    return own.select(F.col("p").alias("parent"), F.col("c").alias("child"), "n", shrunk(F.col("n"), F.col("f"), mid_f).alias("factor"))
