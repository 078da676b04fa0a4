"""Queries over the decision and outcome logs and the ledger: matching, validation, statistics, scalar functions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dusklark.config import Config
from dusklark.functions.text import identifier, instant, label
from dusklark.operators import events as V
from dusklark.operators import likelihood as L
from dusklark.operators import measures as M
from dusklark.operators import spend as S
from dusklark.operators.once import single_winners
from dusklark.plans.feeds import _INSTANT, _same
from dusklark.plans.hourly import H, count, hours, r
from dusklark.plans.quality import _label
from dusklark.session import table

CFG = Config()
c = F.col
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def decisions(spark, d) -> DataFrame:
    """One row per decision: the first received."""
    x = V.with_key(table(spark, d, "decision_log"), "decision_id").filter("key IS NOT NULL")
    return single_winners(x, "key", [c("received_at"), c("delivery_id")])


def outcomes(spark, d) -> DataFrame:
    """One row per outcome: the first finalised, then the first received."""
    x = V.with_key(V.with_key(table(spark, d, "outcome_log"), "outcome_id", "okey"), "decision_id").filter("okey IS NOT NULL")
    return single_winners(x, "okey", [instant(c("finalized_at")), c("received_at"), c("delivery_id")])


D = f"""d AS (SELECT *, {_same("decision_id")} AS key FROM decision_log WHERE {_same("decision_id")} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_same("decision_id")} ORDER BY received_at NULLS LAST, delivery_id) = 1)"""
O = f"""o AS (SELECT *, {_same("outcome_id")} AS okey, {_same("decision_id")} AS key FROM outcome_log WHERE {_same("outcome_id")} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {_same("outcome_id")} ORDER BY {_INSTANT} NULLS LAST, received_at NULLS LAST, delivery_id) = 1)"""


# -- matching and validation -------------------------------------------------------------------------------------------
@query(f"WITH {D}, {O} SELECT strftime(received_at, '%Y-%m') AS month, count(*) AS outcomes, count(*) FILTER (EXISTS (SELECT 1 FROM d WHERE d.key = o.key)) AS matched FROM o GROUP BY 1")
def log_matched(spark, d):
    """Outcomes whose decision is known, per month of receipt."""
    o, k = outcomes(spark, d), decisions(spark, d).select("key")
    month = F.date_format("received_at", "yyyy-MM").alias("month")
    both = o.join(k, "key", "left_semi").select(month, F.lit(1).alias("m")).unionByName(o.join(k, "key", "left_anti").select(month, F.lit(0).alias("m")))
    return both.groupBy("month").agg(count().alias("outcomes"), F.sum("m").alias("matched"))


@query(f"WITH {D}, {O} SELECT o.okey, d.episode_id, d.hour_of_day, o.units_sold, round(d.applied_price - o.applied_price, 6) AS price_gap FROM o JOIN d ON o.key = d.key")
def join_outcomes_decisions(spark, d):
    """Outcomes with the decision they name."""
    o = outcomes(spark, d).select("okey", "key", "units_sold", c("applied_price").alias("op"))
    k = decisions(spark, d).select("key", "episode_id", "hour_of_day", c("applied_price").alias("dp"))
    return o.join(k, "key").select("okey", "episode_id", "hour_of_day", "units_sold", r(c("dp") - c("op")).alias("price_gap"))


_BAD = " ".join(f"WHEN n = {i} THEN '{f} missing'" for i, f in enumerate(V.OUTCOME_REQUIRED))


@query(f"""WITH {O}, p AS (SELECT okey, unnest(list_filter([{', '.join(f"CASE WHEN {f} IS NULL THEN '{f} missing' END" for f in V.OUTCOME_REQUIRED)},
  {', '.join(f"CASE WHEN {f} < 0 THEN '{f} negative' END" for f in ('units_sold', 'starting_inventory', 'ending_inventory'))},
  CASE WHEN ending_inventory <> starting_inventory - units_sold AND coalesce(trim(adjustment_reason), '') = '' AND units_sold >= 0 AND starting_inventory >= 0 AND ending_inventory >= 0 THEN 'stock does not reconcile' END,
  CASE WHEN isnan(applied_price) OR isinf(applied_price) THEN 'applied_price not finite' END], lambda x: x IS NOT NULL)) AS problem FROM o) SELECT problem, count(*) AS outcomes FROM p GROUP BY 1""")
def log_quarantine(spark, d):
    """Quarantined outcomes by reason."""
    _, bad = V.split(outcomes(spark, d), V.outcome_problems())
    return bad.select(F.explode("problems").alias("problem")).groupBy("problem").agg(count().alias("outcomes"))


@query(f"WITH k AS (SELECT {_same('decision_id')} AS key, received_at FROM decision_log) SELECT count(*) AS deliveries, count(DISTINCT key) AS decisions, round((count(*) - count(DISTINCT key)) / count(*), 6) AS duplicate_share FROM k WHERE key IS NOT NULL")
def log_duplicates(spark, d):
    """Share of repeated deliveries."""
    x = V.with_key(table(spark, d, "decision_log"), "decision_id").filter("key IS NOT NULL").groupBy("key").agg(count().alias("n"))
    return x.agg(F.sum("n").alias("deliveries"), count().alias("decisions")).select("deliveries", "decisions", r((c("deliveries") - c("decisions")) / c("deliveries")).alias("duplicate_share"))


@query(f"WITH {D}, {O}, v AS (SELECT DISTINCT {_same('decision_id')} AS key FROM decision_voids) SELECT d.key FROM d WHERE d.key NOT IN (SELECT key FROM v WHERE key IS NOT NULL) AND EXISTS (SELECT 1 FROM o WHERE o.key = d.key)")
def log_unconsumed(spark, d):
    """Decisions with an outcome that weren't consumed (here: withdrawn)."""
    done = V.with_key(table(spark, d, "decision_voids"), "decision_id").filter("key IS NOT NULL")
    x = decisions(spark, d).select("key").join(outcomes(spark, d).filter("key IS NOT NULL"), "key", "left_semi")
    return V.unconsumed(x, done, "key")


@query(f"WITH {D} SELECT key, received_at FROM d ORDER BY received_at DESC, key LIMIT 500")
def top_recent(spark, d):
    """The 500 latest decisions."""
    return decisions(spark, d).orderBy(c("received_at").desc(), "key").limit(500).select("key", "received_at")


@query(f"WITH {O} SELECT execution_failure_reason AS reason, count(*) AS outcomes, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM o GROUP BY 1")
def agg_reason_counts(spark, d):
    """Counts and shares by reason of failure."""
    x = outcomes(spark, d).groupBy(c("execution_failure_reason").alias("reason")).agg(count().alias("outcomes"))
    t = x.agg(F.sum("outcomes").alias("_t"))  # one row
    return x.crossJoin(F.broadcast(t)).select("reason", "outcomes", r(c("outcomes") / c("_t")).alias("share"))


@query(f"""WITH {D}, {O} SELECT {_label('d.category')} AS category, count(*) AS n, CAST(sum(o.units_sold) AS BIGINT) AS sold, round(sum(o.units_sold * o.applied_price), 0) AS revenue,
  round(sum(o.units_sold) / nullif(sum(o.starting_inventory), 0), 6) AS cleared, round(avg(d.applied_discount), 6) AS mean_discount FROM o JOIN d ON o.key = d.key WHERE o.units_sold >= 0 AND o.starting_inventory >= 0 AND isfinite(o.applied_price) GROUP BY 1""")
def rep_business(spark, d):
    """Sales, revenue, clearance and discount per category of the matched outcomes."""
    o = outcomes(spark, d).filter("units_sold >= 0 AND starting_inventory >= 0 AND applied_price IS NOT NULL AND NOT isnan(applied_price)").select("key", "units_sold", "starting_inventory", "applied_price")
    k = decisions(spark, d).select("key", label(c("category")).alias("category"), "applied_discount")
    stock = F.sum("starting_inventory")
    return o.join(k, "key").groupBy("category").agg(
        count().alias("n"), F.sum("units_sold").alias("sold"), F.round(F.sum(c("units_sold") * c("applied_price")), 0).alias("revenue"), r(F.when(stock != 0, F.sum("units_sold") / stock)).alias("cleared"), r(F.avg("applied_discount")).alias("mean_discount")
    )


@query(f"WITH {D} SELECT CAST(date_trunc('week', received_at) AS DATE) AS week, count(*) AS n, round(avg(CASE WHEN is_exploration THEN 1.0 ELSE 0.0 END), 6) AS explored, round(quantile_cont(solver_latency_s, 0.95), 6) AS p95, round(max(nb_tail_mass_max), 6) AS tail FROM d GROUP BY 1")
def rep_safety(spark, d):
    """Weekly exploration share, latency percentile and tail mass."""
    return decisions(spark, d).groupBy(F.date_trunc("week", "received_at").cast("date").alias("week")).agg(
        count().alias("n"), r(M.share(c("is_exploration"))).alias("explored"), r(F.percentile("solver_latency_s", F.lit(0.95))).alias("p95"), r(F.max("nb_tail_mass_max")).alias("tail")
    )


# -- statistics --------------------------------------------------------------------------------------------------------
_PMF = "exp(lgamma(k + r) - lgamma(r) - lgamma(k + 1) + r * ln(r / (r + mu)) + k * ln(mu / (r + mu)))"


@query(f"""WITH {D}, x AS (SELECT key, greatest(reference_mu, 1e-6) AS mu, dispersion_r AS r, q_remaining AS q FROM d WHERE dispersion_r > 0 AND reference_mu IS NOT NULL AND q_remaining >= 0),
k AS (SELECT key, mu, r, q, unnest(range(0, q)) AS k FROM x WHERE q > 0), s AS (SELECT key, sum((q - k) * {_PMF}) AS s, sum({_PMF}) AS below FROM k GROUP BY 1)
SELECT x.key, round(q - coalesce(s, 0), 6) AS expected, round(ln(greatest(1 - coalesce(below, 0), 1e-9)), 4) AS log_tail FROM x LEFT JOIN s ON x.key = s.key""")
def stat_expected_sales(spark, d):
    """Expected sales under the stock on hand, and the log probability of selling out, without a UDF."""
    x = decisions(spark, d).filter("dispersion_r > 0 AND reference_mu IS NOT NULL AND q_remaining >= 0")
    mu = F.greatest(c("reference_mu"), F.lit(1e-6))
    return x.select("key", r(L.expected_sales(mu, c("dispersion_r"), c("q_remaining"))).alias("expected"), r(L.log_survival(mu, c("dispersion_r"), c("q_remaining")), 4).alias("log_tail"))


GRID = np.linspace(-4.0, -0.05, 801)


def _pairs(spark, d) -> DataFrame:
    o = outcomes(spark, d).filter("units_sold >= 0 AND starting_inventory > 0").select("key", c("units_sold").alias("k"), c("starting_inventory").alias("stock"))
    x = decisions(spark, d).filter("reference_mu > 0 AND dispersion_r > 0 AND applied_discount < 1 AND reference_discount < 1")
    x = x.select("key", label(c("category")).alias("category"), c("reference_mu").alias("mu"), c("dispersion_r").alias("r"), F.ln((1 - c("applied_discount")) / (1 - c("reference_discount"))).alias("log_ratio"))
    return o.join(x, "key").filter("category IS NOT NULL")


@query(f"""WITH {D}, {O}, x AS (SELECT {_label('d.category')} AS cell, o.units_sold AS k, o.starting_inventory AS q, d.reference_mu AS mu0, d.dispersion_r AS r, ln((1 - d.applied_discount) / (1 - d.reference_discount)) AS lr
  FROM o JOIN d ON o.key = d.key WHERE o.units_sold >= 0 AND o.starting_inventory > 0 AND d.reference_mu > 0 AND d.dispersion_r > 0 AND d.applied_discount < 1 AND d.reference_discount < 1),
g AS (SELECT -4.0 + i * 3.95 / 800 AS eps FROM range(801) t(i)), y AS (SELECT *, greatest(mu0 * exp(eps * lr), 0.01) AS mu FROM x, g WHERE cell IS NOT NULL),
a AS (SELECT cell, eps, CASE WHEN k < q THEN ln({_PMF}) ELSE ln(greatest(1 - list_sum(list_transform(range(0, q), lambda j: exp(lgamma(j + r) - lgamma(r) - lgamma(j + 1) + r * ln(r / (r + mu)) + j * ln(mu / (r + mu))))), 1e-9)) END AS ll FROM y),
s AS (SELECT cell, eps, sum(ll) - 0.5 * pow((eps + 1.0) / 0.6, 2) AS lp FROM a GROUP BY 1, 2), w AS (SELECT cell, eps, lp, exp(lp - max(lp) OVER (PARTITION BY cell)) AS w FROM s), n AS (SELECT cell, count(*) AS n FROM x WHERE cell IS NOT NULL GROUP BY 1),
m AS (SELECT cell, sum(w * eps) / sum(w) AS mean, sum(w * eps * eps) / sum(w) AS sq, arg_max(eps, lp) AS mode FROM w GROUP BY 1)
SELECT m.cell, n, round(mean, 4) AS mean, round(sqrt(greatest(sq - mean * mean, 0)), 4) AS std, round(mode, 4) AS mode FROM m JOIN n ON m.cell = n.cell""")
def stat_grid_posterior(spark, d):
    """Posterior of the elasticity per category on a grid of 801 values."""
    x = L.grid_posterior(_pairs(spark, d), "category", GRID, -1.0, 0.6)
    return x.select("cell", "n", r("mean", 4).alias("mean"), r("std", 4).alias("std"), r("mode", 4).alias("mode"))


def _guessed(spark, d) -> DataFrame:
    x = hours(spark, d).filter("units_sold >= 0")
    base = x.groupBy(c("category").alias("_k"), c("hour_of_day").alias("_h")).agg(F.avg("units_sold").alias("mu"))
    mu = F.greatest("mu", F.lit(CFG.demand_floor)).alias("mu")
    return x.join(base, c("category").eqNullSafe(c("_k")) & (c("hour_of_day") == c("_h"))).select("category", "subcategory", mu, c("units_sold").alias("k"), c("starting_inventory").alias("stock"))


@query(None)
def stat_fit_dispersion(spark, d):
    """Dispersion per subcategory by censored maximum likelihood, its category's or the overall one where rows are few; the row without names is the overall one."""
    x = L.dispersion_levels(_guessed(spark, d), "category", "subcategory", "stock")
    level = F.replace(F.replace("level", F.lit("child"), F.lit("subcategory")), F.lit("parent"), F.lit("category"))
    return x.select(c("parent").alias("category"), c("child").alias("subcategory"), "n", level.alias("level"), "level_n", r("r").alias("r"), r("fitted").alias("fitted"), r("loglik", 2).alias("loglik"))


_LEDGER = "l AS (SELECT replace(day, '-', '') AS day, costs, ledger_id FROM spread_ledger)"


def _ledger(spark, d) -> DataFrame:
    return table(spark, d, "spread_ledger").select(F.regexp_replace("day", "-", "").alias("day"), "costs", "ledger_id")


@query(f"WITH {_LEDGER}, f AS (SELECT day, coalesce(list_avg(list_filter(costs, lambda x: x <= 100)), 0) AS s FROM l) SELECT day, round(sum(s), 4) AS spend, count(*) AS decisions FROM f GROUP BY 1")
def agg_spend_by_day(spark, d):
    """Expected spend per day at a threshold of 100."""
    x = S.spend_by_day(_ledger(spark, d), 100.0)
    return x.select("day", r("spend", 4).alias("spend"), "decisions")


_CURVE = f"""{_LEDGER}, e AS (SELECT ledger_id, unnest(costs) AS tau FROM l), k AS (SELECT *, row_number() OVER w AS i, sum(tau) OVER (w ROWS UNBOUNDED PRECEDING) AS s FROM e WINDOW w AS (PARTITION BY ledger_id ORDER BY tau)),
dd AS (SELECT tau, s / i - CASE WHEN i > 1 THEN (s - tau) / (i - 1) ELSE 0 END AS delta FROM k WHERE tau IS NOT NULL), t AS (SELECT tau, sum(delta) AS delta FROM dd GROUP BY 1), c AS (SELECT tau, sum(delta) OVER (ORDER BY tau) AS spend FROM t)"""


@query(f"WITH {_CURVE} SELECT round(tau, 4) AS tau, round(spend, 6) AS spend FROM c")
def stat_spend_curve(spark, d):
    """Total expected spend at every threshold that occurs."""
    return S.spend_curve(_ledger(spark, d)).select(r("tau", 4).alias("tau"), r("spend").alias("spend"))


@query(f"WITH {_CURVE} SELECT round(max(tau), 4) AS tau FROM c WHERE spend < 20000.0")
def stat_threshold(spark, d):
    """The largest threshold whose spend stays below a budget."""
    return S.solve_threshold(_ledger(spark, d), 20000.0).select(r("tau", 4).alias("tau"))


@query(f"WITH {H}, b AS (SELECT least(CAST(floor(hour_of_day / 4.8) AS BIGINT), 4) AS bin, count(*) AS n FROM h GROUP BY 1), t AS (SELECT sum(n) / 5 AS e FROM b), x AS (SELECT sum((n - e) * (n - e) / e) AS x FROM b, t) SELECT round(x, 4) AS statistic, round(exp(-x / 2) * (1 + x / 2), 6) AS p_value FROM x")
def agg_chi_square(spark, d):
    """Goodness of fit of five bins of the hour, with the closed form of four degrees of freedom."""
    b = hours(spark, d).groupBy(F.least(F.floor(c("hour_of_day") / 4.8), F.lit(4)).alias("bin")).agg(count().alias("n"))
    x = b.crossJoin(F.broadcast(b.agg((F.sum("n") / 5).alias("e")))).agg(F.sum((c("n") - c("e")) * (c("n") - c("e")) / c("e")).alias("x"))  # one row
    return x.select(r("x", 4).alias("statistic"), r(F.exp(-c("x") / 2) * (1 + c("x") / 2)).alias("p_value"))


@query(f"""WITH {D}, {O}, x AS (SELECT {_label('d.category')} AS category, pow(d.dispersion_r / (d.dispersion_r + d.reference_mu), d.dispersion_r) AS p0, o.units_sold = 0 AS z FROM o JOIN d ON o.key = d.key WHERE o.units_sold >= 0 AND d.reference_mu > 0 AND d.dispersion_r > 0)
SELECT category, count(*) AS n, count(*) FILTER (z) AS zeros, round(sum(p0), 4) AS expected, round((count(*) FILTER (z) - sum(p0)) / sqrt(sum(p0 * (1 - p0))), 4) AS z FROM x GROUP BY 1""")
def agg_binomial_band(spark, d):
    """Zero sales against their expected number, as a z value per category."""
    o = outcomes(spark, d).filter("units_sold >= 0").select("key", "units_sold")
    k = decisions(spark, d).filter("reference_mu > 0 AND dispersion_r > 0").select("key", label(c("category")).alias("category"), F.pow(c("dispersion_r") / (c("dispersion_r") + c("reference_mu")), c("dispersion_r")).alias("p0"))
    x = o.join(k, "key").groupBy("category").agg(count().alias("n"), count(c("units_sold") == 0).alias("zeros"), F.sum("p0").alias("e"), F.sum(c("p0") * (1 - c("p0"))).alias("v"))
    return x.select("category", "n", "zeros", r("e", 4).alias("expected"), r((c("zeros") - c("e")) / F.sqrt("v"), 4).alias("z"))


@query(f"""WITH {H}, b AS (SELECT *, date_diff('day', DATE '2025-09-01', date) // 28 AS block FROM h WHERE date <= DATE '2025-09-01' + CAST(28 * (date_diff('day', DATE '2025-09-01', DATE '2026-02-28') // 28) - 1 AS INTEGER)),
u AS (SELECT block, sku_id, fc, coalesce(sum(units_sold), 0) AS y, coalesce(sum(starting_inventory), 0) AS x FROM b GROUP BY 1, 2, 3), t AS (SELECT block, sum(y) / sum(x) AS q, count(*) AS n, avg(x) AS m FROM u GROUP BY 1)
SELECT u.block, any_value(n) AS units, round(any_value(q), 6) AS ratio, round(sqrt(var_samp(y - q * x) / (any_value(n) * any_value(m) * any_value(m))), 6) AS se FROM u JOIN t ON u.block = t.block GROUP BY 1""")
def stat_block_errors(spark, d):
    """Clustered error of a ratio in every whole block of four weeks."""
    start = F.lit("2025-09-01").cast("date")
    whole = F.floor(F.datediff(F.lit("2026-02-28").cast("date"), start) / 28)
    x = hours(spark, d).withColumn("block", F.floor(F.datediff("date", start) / 28)).filter(c("block") < whole)
    u = x.groupBy("block", "sku_id", "fc").agg(F.coalesce(F.sum("units_sold"), F.lit(0)).alias("y"), F.coalesce(F.sum("starting_inventory"), F.lit(0)).alias("x"))
    t = u.groupBy("block").agg(count().alias("units"), F.sum("y").alias("sy"), F.sum("x").alias("sx"), F.var_samp("y").alias("vy"), F.var_samp("x").alias("vx"), F.covar_samp("y", "x").alias("cyx"))
    q, m = c("sy") / c("sx"), c("sx") / c("units")
    return t.select("block", "units", r(q).alias("ratio"), r(F.sqrt(F.greatest((c("vy") - 2 * q * c("cyx") + q * q * c("vx")) / (c("units") * m * m), F.lit(0.0)))).alias("se"))


# -- scalar functions --------------------------------------------------------------------------------------------------
@query(f"WITH {D} SELECT key, concat_ws('|', sku_id, fc, strftime(received_at, '%Y-%m-%dT%H')) AS tag, replace({_label('category')}, ' ', '_') AS cell, split_part(episode_id, '|', 2) AS site, length(config_version) AS len, upper(substr(subcategory, 1, 3)) AS short FROM d")
def fn_strings(spark, d):
    x = decisions(spark, d)
    return x.select("key", F.concat_ws("|", "sku_id", "fc", F.date_format("received_at", "yyyy-MM-dd'T'HH")).alias("tag"), F.replace(label(c("category")), F.lit(" "), F.lit("_")).alias("cell"), F.split_part("episode_id", F.lit("|"), F.lit(2)).alias("site"), F.length("config_version").cast("long").alias("len"), F.upper(F.substring("subcategory", 1, 3)).alias("short"))


@query(f"WITH {D} SELECT key, CAST(received_at AS DATE) AS day, isodow(received_at) - 1 AS dow, strftime(received_at, '%Y-%m') AS month, CAST(date_trunc('week', received_at) AS DATE) AS week, date_diff('day', DATE '2026-08-01', CAST(received_at AS DATE)) AS days, hour(received_at) AS hour FROM d")
def fn_dates(spark, d):
    x = decisions(spark, d)
    return x.select("key", F.to_date("received_at").alias("day"), F.weekday("received_at").cast("long").alias("dow"), F.date_format("received_at", "yyyy-MM").alias("month"), F.date_trunc("week", "received_at").cast("date").alias("week"), F.datediff("received_at", F.lit("2026-08-01").cast("date")).cast("long").alias("days"), F.hour("received_at").cast("long").alias("hour"))


@query(f"WITH {D} SELECT key, round(greatest(reference_mu * pow((1 - applied_discount) / (1 - reference_discount), epsilon_posterior_mean), 0.01), 6) AS mu, round(ln(1 + solver_latency_s), 6) AS l, round(sqrt(abs(d_max)), 6) AS s, floor(original_price / 100) * 100 AS f, least(greatest(d_max, 0.0), 0.5) AS clipped, coalesce(isfinite(tau_current), false) AS ok FROM d WHERE reference_discount < 1 AND applied_discount < 1")
def fn_math(spark, d):
    x = decisions(spark, d).filter("reference_discount < 1 AND applied_discount < 1")
    mu = L.demand_at(c("reference_mu"), c("applied_discount"), c("reference_discount"), c("epsilon_posterior_mean"), CFG.demand_floor)
    ok = F.coalesce(~F.isnan("tau_current") & (F.abs("tau_current") != float("inf")), F.lit(False)) & c("tau_current").isNotNull()
    return x.select("key", r(mu).alias("mu"), r(F.log1p("solver_latency_s")).alias("l"), r(F.sqrt(F.abs("d_max"))).alias("s"), (F.floor(c("original_price") / 100) * 100.0).alias("f"), F.least(F.greatest("d_max", F.lit(0.0)), F.lit(0.5)).alias("clipped"), ok.alias("ok"))


@query("SELECT DISTINCT CAST(sku_id AS BIGINT) AS sku_id, fc, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', CAST(sku_id AS VARCHAR), fc)), 1, 8) AS BIGINT) / 4294967296.0 < 0.5 THEN 'treatment' ELSE 'control' END AS arm FROM prepared")
def fn_hash_arm(spark, d):
    """Deterministic assignment by MD5."""
    return table(spark, d, "prepared").select("sku_id", "fc", M.arm([c("sku_id").cast("string"), c("fc")], 0.5).alias("arm")).distinct()


@query(f"WITH {D} SELECT key, len(mu_ref_path) AS n, round(list_sum(mu_ref_path[2:]), 6) AS tail, round(mu_ref_path[1], 6) AS first, list_position(mu_ref_path, list_max(mu_ref_path)) AS peak, list_transform(mu_ref_path, lambda x: round(x * 2, 4)) AS doubled FROM d WHERE len(mu_ref_path) > 0")
def fn_arrays(spark, d):
    x = decisions(spark, d).filter(F.size("mu_ref_path") > 0)
    p = c("mu_ref_path")
    tail = F.slice(p, F.lit(2), F.size(p))
    total = F.when(F.size(tail) > 0, F.aggregate(tail, F.lit(0.0), lambda a, v: a + v))
    return x.select("key", F.size(p).cast("long").alias("n"), r(total).alias("tail"), r(F.element_at(p, 1)).alias("first"), F.array_position(p, F.array_max(p)).alias("peak"), F.transform(p, lambda v: F.round(v * 2, 4)).alias("doubled"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events")
def fn_json(spark, d):
    """A value inside a JSON text."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "event_type")


@query("WITH g AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events GROUP BY 1, 2), f AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS grp FROM g) SELECT user_id, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM f GROUP BY user_id, grp")
def epi_islands_daily(spark, d):
    """Runs of consecutive active days per user, from the general session operator."""
    from dusklark.operators.sessions import merge_sessions

    days = table(spark, d, "events").select("user_id", F.unix_date(F.to_date("ts")).cast("long").alias("t")).distinct()
    s = merge_sessions(days, ["user_id"], "t", gap=1, bucket=28)
    return s.select("user_id", F.date_from_unix_date(c("start").cast("int")).alias("first_day"), F.date_from_unix_date(c("end").cast("int")).alias("last_day"), c("events").alias("days"))


@query("""WITH o AS (SELECT l_orderkey, l_partkey, sum(l_extendedprice * l_discount) AS y, sum(l_extendedprice) AS x FROM lineitem GROUP BY 1, 2)
SELECT p_brand, p_type, CAST(grouping_id(p_brand, p_type) AS BIGINT) AS cut, round(sum(y), 0) AS numerator, round(sum(x), 0) AS denominator, round(sum(y) / sum(x), 6) AS ratio FROM o JOIN part ON l_partkey = p_partkey GROUP BY GROUPING SETS ((), (p_brand), (p_type))""")
def agg_ratio_cuts_orders(spark, d):
    """Ratio of sums over the order lines, by cuts."""
    li, p = table(spark, d, "lineitem"), table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    o = li.groupBy("l_partkey").agg(F.sum(c("l_extendedprice") * c("l_discount")).alias("y"), F.sum("l_extendedprice").alias("x")).join(p, c("l_partkey") == c("p_partkey"))
    x = M.ratio_cuts(o, "y", "x", [[], ["p_brand"], ["p_type"]])
    return x.select("p_brand", "p_type", c("cut").cast("long").alias("cut"), F.round("numerator", 0).alias("numerator"), F.round("denominator", 0).alias("denominator"), r("ratio").alias("ratio"))


@query("""WITH n AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS k FROM lineitem) SELECT l_returnflag, count(*) AS row_count, round(sum(l_quantity), 2) AS quantity FROM n WHERE k = 1 GROUP BY 1""")
def filt_unique_lines(spark, d):
    """Order lines whose key occurs once."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(count().alias("k"), F.first("l_returnflag").alias("l_returnflag"), F.first("l_quantity").alias("q")).filter("k = 1")
    return li.groupBy("l_returnflag").agg(count().alias("row_count"), F.round(F.sum("q"), 2).alias("quantity"))


@query("""SELECT o_custkey, o_orderkey, round(avg(o_totalprice) OVER w, 4) AS trailing_mean, count(*) OVER w AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)""")
def win_trailing_orders(spark, d):
    """Mean order value over the 90 days before each order."""
    w = W.partitionBy("o_custkey").orderBy(F.unix_date(F.to_date("o_orderdate"))).rangeBetween(-90, -1)
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", r(F.avg("o_totalprice").over(w), 4).alias("trailing_mean"), F.count(F.lit(1)).over(w).alias("n"))


# -- fitted models -----------------------------------------------------------------------------------------------------
@query(None)
def stat_level_factors(spark, d):
    """Factors on the expected demand of category and hour, shrunk from subcategory to category to all."""
    x = hours(spark, d).filter("category IS NOT NULL AND units_sold >= 0 AND starting_inventory >= 0")
    base = x.groupBy(c("category").alias("_k"), c("hour_of_day").alias("_h")).agg(F.avg("units_sold").alias("mu"))
    y = x.join(base, (c("category") == c("_k")) & (c("hour_of_day") == c("_h"))).select("category", "subcategory", "mu", c("starting_inventory").alias("stock"), c("units_sold").alias("k"))
    return L.level_factors(y, "category", "subcategory").select(c("parent").alias("category"), c("child").alias("subcategory"), "n", r("factor").alias("factor"))


@query(None)
def stat_elasticity(spark, d):
    """Elasticity per category that best explains the opening hours' sales, on a grid and without a prior."""
    from dusklark.operators.episodes import edge_rows

    x = hours(spark, d)
    base = x.groupBy(c("category").alias("_k"), c("hour_of_day").alias("_h")).agg(F.avg("units_sold").alias("mu"))
    f = edge_rows(x, ["episode_id"], ["category", "total_discount", "d_ref", "units_sold", "starting_inventory"], last=False).filter("units_sold >= 0 AND starting_inventory > 0 AND total_discount >= 0 AND total_discount < 1")
    y = f.join(base, (c("category") == c("_k")) & (c("hour_of_day") == c("_h")))
    y = y.select("category", c("units_sold").alias("k"), c("starting_inventory").alias("stock"), "mu", F.lit(1.0).alias("r"), F.ln((1 - c("total_discount")) / (1 - c("d_ref"))).alias("log_ratio"))
    g = L.grid_posterior(y, "category", np.linspace(-4.0, -0.05, 159), 0.0, 1e6)
    return g.select(c("cell").alias("category"), "n", r("mode", 4).alias("elasticity"), r("std", 4).alias("std"))


@query(None)
def stat_baseline_glm(spark, d):
    """Sold and expected units per category of the test span, from a Tweedie model fitted to the training span."""
    from dusklark.operators import baseline
    from dusklark.operators.episodes import opened_between

    x = hours(spark, d).withColumn("dow", F.weekday("date")).withColumn("day", F.dayofmonth("date"))
    numbers, labels = ["hour_of_day", "dow", "day", "total_discount", "starting_inventory"], ["category", "fc"]
    model = baseline.fit_baseline(opened_between(x, ["episode_id"], CFG.train_start, CFG.train_end), "units_sold", numbers, labels)
    y = baseline.predict(model, opened_between(x, ["episode_id"], CFG.test_start, CFG.test_end), numbers, labels)
    return y.filter("units_sold >= 0").groupBy("category").agg(count().alias("row_count"), F.sum("units_sold").alias("sold"), r(F.sum("expected"), 4).alias("expected"))


@query(f"""WITH {H}, w AS (SELECT category, date_trunc('week', date) AS week, sum(units_sold) AS sold, sum(starting_inventory) AS stock FROM h WHERE category IS NOT NULL GROUP BY 1, 2), n AS (SELECT *, dense_rank() OVER (ORDER BY week) AS i FROM w),
t AS (SELECT n.category, n.week, span, n.sold, n.stock, sum(p.sold) / sum(p.stock) AS f FROM n CROSS JOIN (VALUES (1), (2), (4), (8)) s(span) JOIN n p ON p.category = n.category AND p.i BETWEEN n.i - span AND n.i - 1 GROUP BY 1, 2, 3, 4, 5)
SELECT span, count(*) AS cells, round(sum(sold) / sum(stock * f), 6) AS ratio, round(sum(abs(sold - stock * f)) / sum(stock), 6) AS error FROM t GROUP BY 1""")
def rep_calibration_sweep(spark, d):
    """How well the ratio of the 1, 2, 4 or 8 weeks before foretells each week."""
    w = hours(spark, d).dropna(subset=["category"]).groupBy("category", F.date_trunc("week", "date").cast("date").alias("week")).agg(F.sum("units_sold").alias("sold"), F.sum("starting_inventory").alias("stock"))
    places = w.select("week").distinct().withColumn("i", F.dense_rank().over(W.orderBy("week")))  # one row per week
    x = w.join(F.broadcast(places), "week")
    for span in (1, 2, 4, 8):
        v = W.partitionBy("category").orderBy("i").rangeBetween(-span, -1)
        x = x.withColumn(f"f{span}", F.sum("sold").over(v) / F.sum("stock").over(v))
    y = x.select("sold", "stock", F.explode(F.create_map(*[z for s in (1, 2, 4, 8) for z in (F.lit(s), c(f"f{s}"))])).alias("span", "f")).filter("f IS NOT NULL")
    return y.groupBy("span").agg(count().alias("cells"), r(F.sum("sold") / F.sum(c("stock") * c("f"))).alias("ratio"), r(F.sum(F.abs(c("sold") - c("stock") * c("f"))) / F.sum("stock")).alias("error"))
