"""Queries that hold predictions against what happened, and the noise of daily series: levels, slopes, windows, arms, durations."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dusklark.config import Config
from dusklark.functions.numbers import ratio
from dusklark.functions.text import label
from dusklark.operators import likelihood as L
from dusklark.operators import measures as M
from dusklark.plans.events import D, O, decisions, outcomes
from dusklark.plans.hourly import _EDGE, H, count, hours, r
from dusklark.plans.quality import _label
from dusklark.session import table

CFG = Config()
c = F.col
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# Predictions: the training span's mean of category and hour, taken to the actual price by the working elasticity, and
# what of it the stock can meet: E[min(D, q)] for geometric demand, mu (1 - (mu / (1 + mu))^q).
ELASTICITY = -1.0
_P = f"""b AS (SELECT category AS bk, hour_of_day AS bh, avg(units_sold) AS m FROM h WHERE date BETWEEN DATE '{CFG.train_start}' AND DATE '{CFG.train_end}' AND units_sold >= 0 GROUP BY 1, 2),
p0 AS (SELECT h.*, total_discount - d_ref AS gap, greatest(m * pow((1 - total_discount) / (1 - d_ref), {ELASTICITY}), {CFG.demand_floor}) AS mu
  FROM h JOIN b ON category IS NOT DISTINCT FROM bk AND hour_of_day = bh WHERE units_sold >= 0 AND starting_inventory >= 0 AND total_discount < 1),
p AS (SELECT *, mu * (1 - pow(mu / (1 + mu), starting_inventory)) AS predicted,
  CASE WHEN date BETWEEN DATE '{CFG.train_start}' AND DATE '{CFG.train_end}' THEN 'train' WHEN date BETWEEN DATE '{CFG.calib_start}' AND DATE '{CFG.calib_end}' THEN 'calib' WHEN date BETWEEN DATE '{CFG.test_start}' AND DATE '{CFG.test_end}' THEN 'test' ELSE 'none' END AS span FROM p0)"""


def predicted(spark, d) -> DataFrame:
    """The prepared rows with ``gap, mu, predicted, span``; rows of a category and hour that training lacks are left out."""
    x = hours(spark, d)
    train = c("date").between(F.lit(CFG.train_start).cast("date"), F.lit(CFG.train_end).cast("date"))
    base = x.filter(train & (c("units_sold") >= 0)).groupBy(c("category").alias("_k"), c("hour_of_day").alias("_h")).agg(F.avg("units_sold").alias("_m"))
    y = x.filter("units_sold >= 0 AND starting_inventory >= 0 AND total_discount < 1").join(base, c("category").eqNullSafe(c("_k")) & (c("hour_of_day") == c("_h")))
    y = y.withColumn("gap", c("total_discount") - c("d_ref")).withColumn("mu", L.demand_at(c("_m"), c("total_discount"), c("d_ref"), F.lit(ELASTICITY), CFG.demand_floor))
    within = lambda name: c("date").between(F.lit(getattr(CFG, f"{name}_start")).cast("date"), F.lit(getattr(CFG, f"{name}_end")).cast("date"))
    span = F.when(within("train"), "train").when(within("calib"), "calib").when(within("test"), "test").otherwise("none")
    return y.drop("_k", "_h", "_m").withColumn("predicted", c("mu") * (1 - F.pow(c("mu") / (1 + c("mu")), c("starting_inventory")))).withColumn("span", span)


_RATIO = "count(*) AS row_count, round(sum(units_sold) / nullif(sum(predicted), 0), 6) AS ratio"


def _sold_ratio(x: DataFrame, scope: str, name) -> DataFrame:
    return x.groupBy(F.lit(scope).alias("scope"), name.cast("string").alias("name")).agg(count().alias("row_count"), r(ratio(F.sum("units_sold"), F.sum("predicted"))).alias("ratio"))


@query(f"""WITH {H}, {_P}, g AS (SELECT * FROM p WHERE span IN ('calib', 'test'))
SELECT 'overall' AS scope, CAST(NULL AS VARCHAR) AS name, {_RATIO} FROM g UNION ALL SELECT 'anchor', NULL, {_RATIO} FROM g WHERE abs(gap) <= {CFG.tier_step / 2} HAVING count(*) > 0
UNION ALL SELECT 'gap', CAST(CAST({_EDGE} AS INTEGER) AS VARCHAR) AS name, {_RATIO} FROM g WHERE {_EDGE} IS NOT NULL GROUP BY 2 UNION ALL SELECT 'category', category, {_RATIO} FROM g GROUP BY 2""")
def rep_level_slope(spark, d):
    """Units sold over units predicted at the actual price: overall, at the anchor (level), by distance from it (slope), by category."""
    g = predicted(spark, d).filter("span IN ('calib', 'test')")
    none = F.lit(None)
    at_anchor = g.filter(F.abs("gap") <= CFG.tier_step / 2)
    by_gap = g.withColumn("bin", M.right_closed_bin(c("gap"), M.GAP_EDGES)).filter("bin IS NOT NULL")
    return _sold_ratio(g, "overall", none).unionByName(_sold_ratio(at_anchor, "anchor", none)).unionByName(_sold_ratio(by_gap, "gap", c("bin"))).unionByName(_sold_ratio(g, "category", c("category")))


@query(f"""WITH {H}, {_P} SELECT CASE WHEN grouping(span) = 0 THEN 'window' WHEN grouping(week) = 0 THEN 'week' ELSE 'all' END AS scope, coalesce(span, strftime(week, '%Y-%m-%d')) AS name, count(*) AS row_count,
  round(sum(units_sold) / nullif(sum(predicted), 0), 6) AS ratio, round(sum(units_sold) / nullif(sum(mu), 0), 6) AS over_raw, round(sum(predicted) / nullif(sum(mu), 0), 6) AS shrinkage,
  round(avg(CASE WHEN units_sold >= starting_inventory THEN 1.0 ELSE 0.0 END), 6) AS censored, round(avg(abs(predicted - units_sold)), 6) AS mae, round(avg(predicted - units_sold), 5) AS bias
FROM (SELECT *, CAST(date_trunc('week', date) AS DATE) AS week FROM p) GROUP BY GROUPING SETS ((), (span), (week))""")
def rep_fidelity(spark, d):
    """How predictions meet sales by window, by week and over all, with the share that stock takes off them: one pass over grouping sets."""
    x = predicted(spark, d).withColumn("week", F.date_trunc("week", "date").cast("date"))
    e = c("predicted") - c("units_sold")
    g = x.groupingSets([[], [c("span")], [c("week")]], c("span"), c("week")).agg(
        F.grouping("span").alias("gs"), F.grouping("week").alias("gw"), count().alias("row_count"), r(ratio(F.sum("units_sold"), F.sum("predicted"))).alias("ratio"), r(ratio(F.sum("units_sold"), F.sum("mu"))).alias("over_raw"),
        r(ratio(F.sum("predicted"), F.sum("mu"))).alias("shrinkage"), r(M.share(c("units_sold") >= c("starting_inventory"))).alias("censored"), r(F.avg(F.abs(e))).alias("mae"), r(F.avg(e), 5).alias("bias"))
    scope = F.when(c("gs") == 0, "window").when(c("gw") == 0, "week").otherwise("all")
    return g.select(scope.alias("scope"), F.coalesce("span", F.date_format("week", "yyyy-MM-dd")).alias("name"), "row_count", "ratio", "over_raw", "shrinkage", "censored", "mae", "bias")


_ARM = "CASE WHEN CAST('0x' || substr(md5(concat_ws('|', CAST(sku_id AS VARCHAR), fc)), 1, 8) AS BIGINT) / 4294967296.0 < 0.5 THEN 'treatment' ELSE 'control' END"
_DAYS = f"""s AS (SELECT date, {_ARM} AS arm, sum(units_sold * (original_price * (1 - total_discount) - cost)) / nullif(sum(units_sold * original_price * (1 - total_discount)), 0) AS margin,
  1 - sum(units_sold) / nullif(sum(starting_inventory), 0) AS unsold FROM h WHERE units_sold >= 0 AND starting_inventory >= units_sold AND original_price > 0 AND cost > 0 AND total_discount BETWEEN 0 AND 0.99 GROUP BY 1, 2),
m AS (SELECT date, arm, CASE WHEN count(margin) OVER w = 7 THEN avg(margin) OVER w END AS margin, CASE WHEN count(unsold) OVER w = 7 THEN avg(unsold) OVER w END AS unsold FROM s WINDOW w AS (PARTITION BY arm ORDER BY date ROWS 6 PRECEDING)),
x AS (SELECT t.date, 1 - t.margin / nullif(k.margin, 0) AS margin, t.unsold / nullif(k.unsold, 0) - 1 AS unsold FROM m t JOIN m k ON t.date = k.date AND t.arm = 'treatment' AND k.arm = 'control')"""


def deterioration(spark, d) -> DataFrame:
    """``date, margin, unsold``: how much worse the treatment's seven-day mean is than the control's, relative to it."""
    x = hours(spark, d).filter("units_sold >= 0 AND starting_inventory >= units_sold AND original_price > 0 AND cost > 0 AND total_discount BETWEEN 0 AND 0.99")
    price = c("original_price") * (1 - c("total_discount"))
    s = x.groupBy("date", M.arm([c("sku_id").cast("string"), c("fc")], CFG.arm_allocation).alias("arm")).agg(
        ratio(F.sum(c("units_sold") * (price - c("cost"))), F.sum(c("units_sold") * price)).alias("margin"), (1 - ratio(F.sum("units_sold"), F.sum("starting_inventory"))).alias("unsold"))
    w = W.partitionBy("arm").orderBy("date").rowsBetween(1 - CFG.smoothing_days, 0)  # one row per day and arm by now
    full = lambda v: F.when(F.count(v).over(w) == CFG.smoothing_days, F.avg(v).over(w))
    m = s.select("date", "arm", full("margin").alias("margin"), full("unsold").alias("unsold"))
    of = lambda arm, v: F.max(F.when(c("arm") == arm, c(v)))
    g = m.groupBy("date").agg(*[of(a, v).alias(f"{a[0]}_{v}") for a in ("treatment", "control") for v in ("margin", "unsold")], F.count_distinct("arm").alias("arms")).filter("arms = 2")
    over = lambda v: c(f"t_{v}") / F.when(c(f"c_{v}") != 0, c(f"c_{v}"))
    return g.select("date", (1 - over("margin")).alias("margin"), (over("unsold") - 1).alias("unsold"))


@query(f"WITH {H}, {_DAYS} SELECT date, round(margin, 6) AS margin, round(unsold, 6) AS unsold FROM x")
def rep_deterioration(spark, d):
    """Daily deterioration of the treatment against the control, both smoothed over seven days."""
    return deterioration(spark, d).select("date", r("margin").alias("margin"), r("unsold").alias("unsold"))


@query(f"""WITH {H}, {_DAYS}, l AS (SELECT 'margin' AS metric, margin AS v FROM x WHERE margin IS NOT NULL UNION ALL SELECT 'unsold', unsold FROM x WHERE unsold IS NOT NULL), c AS (SELECT metric, v, median(v) OVER (PARTITION BY metric) AS mid FROM l)
SELECT metric, count(*) AS days, round(3 * stddev_samp(v), 6) AS three_sigma, round(3 * 1.4826 * median(abs(v - mid)), 6) AS robust_three_sigma FROM c GROUP BY 1""")
def rep_noise_floor(spark, d):
    """Three times the spread of each deterioration series, plain and robust: what a threshold must lie above."""
    x = deterioration(spark, d)
    long = x.select(F.explode(F.create_map(F.lit("margin"), c("margin"), F.lit("unsold"), c("unsold"))).alias("metric", "v")).filter("v IS NOT NULL")  # a row per day
    mid = long.groupBy("metric").agg(F.median("v").alias("mid"))
    y = long.join(F.broadcast(mid), "metric")  # two rows
    return y.groupBy("metric").agg(count().alias("days"), r(3 * F.stddev_samp("v")).alias("three_sigma"), r(3 * 1.4826 * F.median(F.abs(c("v") - c("mid")))).alias("robust_three_sigma"))


@query(f"""WITH {D} SELECT {_label("category")} AS category, count(*) AS decision_count, count(*) FILTER (is_exploration) AS forced, round(avg(CASE WHEN affordable_set_size = 0 THEN 1.0 ELSE 0.0 END), 6) AS empty_share,
  round(avg(abs(ln((1 - applied_discount) / (1 - reference_discount)))) FILTER (is_exploration AND applied_discount < 1 AND reference_discount < 1), 6) AS mean_log_ratio, round(coalesce(sum(exploration_cost) FILTER (is_exploration), 0), 2) AS cost,
  round(arg_max(epsilon_posterior_mean, struct_pack(v := posterior_version, k := key)), 6) AS mean, round(arg_max(epsilon_posterior_std, struct_pack(v := posterior_version, k := key)), 6) AS std, max(posterior_version) AS version FROM d GROUP BY 1""")
def rep_learning(spark, d):
    """Forced decisions, their cost and price moves, and the latest posterior, per category."""
    forced = F.coalesce(c("is_exploration"), F.lit(False))
    move = F.when(forced & (c("applied_discount") < 1) & (c("reference_discount") < 1), F.abs(F.ln((1 - c("applied_discount")) / (1 - c("reference_discount")))))
    last = F.struct("posterior_version", "key")
    return decisions(spark, d).groupBy(label(c("category")).alias("category")).agg(
        count().alias("decision_count"), count(forced).alias("forced"), r(M.share(c("affordable_set_size") == 0)).alias("empty_share"), r(F.avg(move)).alias("mean_log_ratio"),
        F.round(F.coalesce(F.sum(F.when(forced, c("exploration_cost"))), F.lit(0.0)), 2).alias("cost"), r(F.max_by("epsilon_posterior_mean", last)).alias("mean"), r(F.max_by("epsilon_posterior_std", last)).alias("std"), F.max("posterior_version").alias("version"))


DEFF = 3.347
_PAIRS = f"""x AS (SELECT {_label('d.category')} AS cell, o.units_sold AS k, o.starting_inventory AS q, d.reference_mu AS mu0, d.dispersion_r AS r, ln((1 - d.applied_discount) / (1 - d.reference_discount)) AS lr
  FROM o JOIN d ON o.key = d.key WHERE o.units_sold >= 0 AND o.starting_inventory > 0 AND d.reference_mu > 0 AND d.dispersion_r > 0 AND d.applied_discount < 1 AND d.reference_discount < 1)"""


def pairs(spark, d) -> DataFrame:
    """Outcomes with their decisions: ``cell, k, q, mu0, r, lr``."""
    o = outcomes(spark, d).filter("units_sold >= 0 AND starting_inventory > 0").select("key", c("units_sold").alias("k"), c("starting_inventory").alias("q"))
    x = decisions(spark, d).filter("reference_mu > 0 AND dispersion_r > 0 AND applied_discount < 1 AND reference_discount < 1")
    return o.join(x.select("key", label(c("category")).alias("cell"), c("reference_mu").alias("mu0"), c("dispersion_r").alias("r"), F.ln((1 - c("applied_discount")) / (1 - c("reference_discount"))).alias("lr")), "key")


@query(f"""WITH {D}, {O}, {_PAIRS} SELECT cell, count(*) AS n, round(sum(greatest(mu0 * exp(-1.0 * lr), 0.01) * lr * lr), 4) AS information, round(sum(greatest(mu0 * exp(-1.0 * lr), 0.01) * lr * lr) / {DEFF}, 4) AS effective,
  round(avg(CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END), 4) AS zero_share, round(avg(CASE WHEN k >= q THEN 1.0 ELSE 0.0 END), 4) AS stockout_share FROM x WHERE cell IS NOT NULL GROUP BY 1""")
def stat_information(spark, d):
    """Information on the elasticity per category at the prior mean, plain and divided by the design effect."""
    info = F.greatest(c("mu0") * F.exp(ELASTICITY * c("lr")), F.lit(CFG.demand_floor)) * c("lr") * c("lr")
    return pairs(spark, d).filter("cell IS NOT NULL").groupBy("cell").agg(
        count().alias("n"), r(F.sum(info), 4).alias("information"), r(F.sum(info) / DEFF, 4).alias("effective"), r(M.share(c("k") == 0), 4).alias("zero_share"), r(M.share(c("k") >= c("q")), 4).alias("stockout_share"))


BINS = 10


@query(f"""WITH {D}, {O}, {_PAIRS}, y AS (SELECT *, pow(r / (r + mu0), r) AS p0, greatest(mu0 * exp(-1.0 * lr), 0.01) AS mu FROM x), e AS (SELECT [{", ".join(f"quantile_cont(mu, {i / BINS})" for i in range(1, BINS))}] AS edges FROM y),
b AS (SELECT y.*, len(list_filter(edges, lambda v: v <= mu)) AS bin, pow(r / (r + mu), r) AS z FROM y, e)
SELECT bin, count(*) AS n, round(min(mu), 6) AS low, round(max(mu), 6) AS high, round(avg(z), 6) AS expected, round(avg(CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END), 6) AS observed,
  round((avg(CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END) - avg(z)) / sqrt(greatest(avg(z) * (1 - avg(z)), 1e-12) / count(*)), 4) AS score FROM b GROUP BY 1""")
def agg_quantile_bins(spark, d):
    """Share of hours without a sale, expected and observed, in ten bins between the quantiles of expected demand."""
    x = pairs(spark, d).withColumn("mu", F.greatest(c("mu0") * F.exp(ELASTICITY * c("lr")), F.lit(CFG.demand_floor)))
    edges = x.agg(F.percentile("mu", F.array(*[F.lit(i / BINS) for i in range(1, BINS)])).alias("edges"))  # one row
    y = x.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda v: v <= c("mu"))).cast("long")).withColumn("p", F.pow(c("r") / (c("r") + c("mu")), c("r")))
    g = y.groupBy("bin").agg(count().alias("n"), F.min("mu").alias("low"), F.max("mu").alias("high"), F.avg("p").alias("e"), M.share(c("k") == 0).alias("o"))
    return g.select("bin", "n", r("low").alias("low"), r("high").alias("high"), r("e").alias("expected"), r("o").alias("observed"), r((c("o") - c("e")) / F.sqrt(F.greatest(c("e") * (1 - c("e")), F.lit(1e-12)) / c("n")), 4).alias("score"))


@query("""WITH v AS (SELECT value, min(value) OVER () AS lo, max(value) OVER () AS hi FROM events WHERE isfinite(value)) SELECT CAST(least(floor((value - lo) / nullif(hi - lo, 0) * 20), 19) AS BIGINT) AS bin, count(*) AS n, round(sum(value), 2) AS total FROM v GROUP BY 1""")
def agg_equal_bins(spark, d):
    """Twenty bins of equal width between the smallest and the largest value."""
    x = table(spark, d, "events").filter(~F.isnan("value") & (F.abs("value") < float("inf"))).select("value")
    ends = x.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))  # one row
    width = F.when(c("hi") != c("lo"), c("hi") - c("lo"))
    return x.crossJoin(F.broadcast(ends)).groupBy(F.least(F.floor((c("value") - c("lo")) / width * 20), F.lit(19)).cast("long").alias("bin")).agg(count().alias("n"), F.round(F.sum("value"), 2).alias("total"))


#: What a trial needs: error of the first kind, power, the smallest relative effect to be seen, and the candidate lengths.
ALPHA, POWER, EFFECT, WEEKS = 0.05, 0.8, 0.10, (2, 3, 4, 6, 8)
Z = NormalDist().inv_cdf(1 - ALPHA / 2) + NormalDist().inv_cdf(POWER)
_ARMS = (CFG.arm_allocation * (1 - CFG.arm_allocation)) ** -0.5


@query(f"""WITH {H}, n AS (SELECT min(date) AS a, max(date) AS z FROM h), t AS (SELECT unnest([{", ".join(map(str, WEEKS))}]) AS weeks),
u AS (SELECT weeks, date_diff('day', a, date) // (7 * weeks) AS block, sku_id, fc, coalesce(sum(units_sold), 0) AS y, coalesce(sum(starting_inventory), 0) AS x FROM h, n, t WHERE date_diff('day', a, date) // (7 * weeks) < (date_diff('day', a, z) + 1) // (7 * weeks) GROUP BY 1, 2, 3, 4),
g AS (SELECT weeks, block, sum(y) / sum(x) AS q, count(*) AS m, avg(x) AS mx FROM u GROUP BY 1, 2 HAVING count(*) > 1 AND avg(x) > 0),
s AS (SELECT u.weeks, u.block, any_value(q) AS q, sqrt(var_samp(y - q * x) / (any_value(m) * any_value(mx) * any_value(mx))) AS se FROM u JOIN g ON u.weeks = g.weeks AND u.block = g.block GROUP BY 1, 2),
e AS (SELECT weeks, count(*) AS blocks, median(se) AS se, median(q) AS q FROM s GROUP BY 1)
SELECT weeks, blocks, round(se, 6) AS se_pooled, round({_ARMS} * se, 6) AS se_difference, round({Z!r} * {_ARMS} * se, 5) AS effect_abs, round({Z!r} * {_ARMS} * se / q, 4) AS effect_rel, {Z!r} * {_ARMS} * se / q <= {EFFECT} AS meets FROM e""")
def stat_trial_lengths(spark, d):
    """The smallest effect that a trial of so many weeks would show, from the errors of past blocks of that length."""
    x = hours(spark, d).select("date", "sku_id", "fc", "units_sold", "starting_inventory")
    ends = x.agg(F.min("date").alias("a"), F.max("date").alias("z"))  # one row
    day = x.groupBy("date", "sku_id", "fc").agg(F.sum("units_sold").alias("y"), F.sum("starting_inventory").alias("x"))
    t = day.crossJoin(F.broadcast(ends)).withColumn("weeks", F.explode(F.array(*[F.lit(w) for w in WEEKS])))
    t = t.withColumn("block", F.floor(F.datediff("date", "a") / (7 * c("weeks")))).filter(c("block") < F.floor((F.datediff("z", "a") + 1) / (7 * c("weeks"))))
    u = t.groupBy("weeks", "block", "sku_id", "fc").agg(F.coalesce(F.sum("y"), F.lit(0)).alias("y"), F.coalesce(F.sum("x"), F.lit(0)).alias("x"))
    g = u.groupBy("weeks", "block").agg(count().alias("m"), F.sum("y").alias("sy"), F.sum("x").alias("sx"), F.var_samp("y").alias("vy"), F.var_samp("x").alias("vx"), F.covar_samp("y", "x").alias("cyx")).filter("m > 1 AND sx > 0")
    q, mx = c("sy") / c("sx"), c("sx") / c("m")
    s = g.select("weeks", q.alias("q"), F.sqrt(F.greatest((c("vy") - 2 * q * c("cyx") + q * q * c("vx")) / (c("m") * mx * mx), F.lit(0.0))).alias("se"))  # a row per block
    e = s.groupBy("weeks").agg(count().alias("blocks"), F.median("se").alias("se"), F.median("q").alias("q"))
    diff = _ARMS * c("se")
    return e.select("weeks", "blocks", r("se").alias("se_pooled"), r(diff).alias("se_difference"), r(Z * diff, 5).alias("effect_abs"), r(Z * diff / c("q"), 4).alias("effect_rel"), (Z * diff / c("q") <= EFFECT).alias("meets"))


@query(f"""WITH {D} SELECT key, sha256(key) AS digest, substr(sha256(concat_ws('|', episode_id, "timestamp")), 1, 16) AS made_id, printf('%.2f', applied_price) AS price, printf('%.1f%%', applied_discount * 100) AS percent, lpad(CAST(hour_of_day AS VARCHAR), 2, '0') AS hour FROM d
WHERE applied_price IS NOT NULL AND applied_discount IS NOT NULL AND hour_of_day IS NOT NULL""")
def fn_digests_formats(spark, d):
    """SHA-256, an identifier made from other columns, and numbers as text."""
    x = decisions(spark, d).filter("applied_price IS NOT NULL AND applied_discount IS NOT NULL AND hour_of_day IS NOT NULL")
    return x.select("key", F.sha2("key", 256).alias("digest"), F.substring(F.sha2(F.concat_ws("|", "episode_id", "timestamp"), 256), 1, 16).alias("made_id"), F.format_string("%.2f", "applied_price").alias("price"), F.format_string("%.1f%%", c("applied_discount") * 100).alias("percent"), F.lpad(c("hour_of_day").cast("string"), 2, "0").alias("hour"))


@query(f"""WITH {D}, k AS (SELECT {_label("category")} AS cell, avg(epsilon_posterior_mean) AS m, count(*) AS n FROM d GROUP BY 1), own AS (SELECT * FROM k WHERE cell IS NOT NULL AND n >= 30), g AS (SELECT avg(epsilon_posterior_mean) AS m FROM d)
SELECT key, coalesce(own.cell, 'GLOBAL') AS cell, round(coalesce(own.m, g.m), 6) AS mean FROM d LEFT JOIN own ON {_label("d.category")} = own.cell, g""")
def join_cells(spark, d):
    """Each decision's cell: its category's where that has rows enough, else the global one."""
    x = decisions(spark, d).withColumn("_k", label(c("category")))
    own = x.groupBy(c("_k").alias("cell")).agg(F.avg("epsilon_posterior_mean").alias("m"), count().alias("n")).filter("cell IS NOT NULL AND n >= 30").drop("n")
    whole = x.agg(F.avg("epsilon_posterior_mean").alias("g"))  # one row
    return x.join(own, c("_k") == c("cell"), "left").crossJoin(F.broadcast(whole)).select("key", F.coalesce("cell", F.lit("GLOBAL")).alias("cell"), r(F.coalesce("m", "g")).alias("mean"))


@query("""SELECT event_id, CAST(json_extract(doc, '$.props.k') AS BIGINT) AS k, json_extract_string(doc, '$.head.kind') AS kind FROM (SELECT event_id, '{"head":{"kind":"' || event_type || '"},"props":' || props || '}' AS doc FROM events)""")
def fn_json_nested(spark, d):
    """Values at paths inside nested JSON that was put together from columns."""
    x = table(spark, d, "events")
    head = F.to_json(F.struct(F.struct(c("event_type").alias("kind")).alias("head"), F.from_json("props", "k long").alias("props")))
    return x.select("event_id", F.get_json_object(head, "$.props.k").cast("long").alias("k"), F.get_json_object(head, "$.head.kind").alias("kind"))
